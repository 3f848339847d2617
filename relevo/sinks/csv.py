"""CSV sinks: multi-part (default) or single-part files with a header, optional order, and
printable result lines built as a column (instead of a driver loop over ``collect()``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists",
              single_file: bool = False, order_by: Sequence[str | Column] | None = None,
              leave_out: Sequence[str] = ()) -> None:
    """Write CSV with a header.

    * multi-part (default): every task writes its own part, nothing funnels through one task;
      with ``order_by`` the rows are range-partitioned and sorted, so the parts in name order hold
      the rows in order.
    * ``single_file``: one part. ``repartition(1)`` (a shuffle) keeps the upstream stage parallel,
      unlike ``coalesce(1)``, which would squeeze the whole upstream plan into one task. Only for
      outputs small enough to pass through one task.
    * mode: ``errorifexists`` (default, an existing path fails), ``overwrite``, ``append``, ``ignore``.
    * ``leave_out``: columns that only order the rows and are not written.
    Text is written as is: no trimming of leading or trailing white space; '' is quoted, NULL is not.
    """
    out = df
    if single_file:
        out = out.repartition(1)
        if order_by:
            out = out.sortWithinPartitions(*order_by)
    elif order_by:
        out = out.orderBy(*order_by)
    (out.drop(*leave_out).write.mode(mode).option("header", header).option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_submission(scored: DataFrame, path: str, id_col: str = "id",
                     mode: str = "errorifexists", single_file: bool = False) -> None:
    """(id, relevance) ordered by id, as CSV with a header."""
    write_csv(scored.select(id_col, "relevance"), path, mode=mode, single_file=single_file,
              order_by=[id_col])


def format_lines(df: DataFrame, fmt: str, *cols: str | Column, out: str = "line") -> DataFrame:
    """One printable line per row, such as ``"%d: %s scores %f"``, as a column."""
    return df.select(F.format_string(fmt, *cols).alias(out))
