"""CSV sources: typed reads with a malformed-row policy, headerless all-string reads, views.

``strict=True`` makes the malformed-row policy independent of column pruning. Every field is read
as text together with the corrupt-record column; a row is kept when it has the declared number of
fields and every non-empty field casts to its declared type; then the fields are cast. The
validity test references every column, so the scan always parses whole rows. With DROPMALFORMED
alone, which rows vanish depends on which columns the query happens to select (and the
corrupt-record flag alone only covers the columns a query requires).
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from relevo.sources import multiline

CORRUPT = "_corrupt_record"
#: What the reader puts for a quoted empty field, so that it differs from a missing one.
EMPTY = "\u0001"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
             header: bool = True, mode: str = "PERMISSIVE", strict: bool = False,
             multi_line: bool = False) -> DataFrame:
    """Read CSV with a declared schema (all strings, ``_c0..`` names, when none is given).

    mode: ``PERMISSIVE`` keeps malformed rows with NULLs, ``DROPMALFORMED`` drops them (subject to
    column pruning), ``FAILFAST`` raises. ``strict`` overrides mode with the pruning-proof filter.
    ``multi_line`` lets quoted fields hold line breaks; such a file is split all the same
    (``relevo.sources.multiline``). A quoted empty field is '', an unquoted one NULL. A field that
    is the one character U+0001 reads as '' too: it is the reader's own mark.
    """
    options = {"emptyValue": EMPTY, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    reader = spark.read.options(header=header, **options)

    def rows(wanted: StructType | None, mode: str, **more: str) -> DataFrame:
        if not multi_line:
            return (reader if wanted is None else reader.schema(wanted)).options(mode=mode, **more).csv(path)
        # without a schema, the reader names the columns from the first record alone
        wanted = wanted or reader.option("multiLine", True).csv(path).schema
        return multiline.read(spark, path, wanted, header, mode, {**options, **more})

    if strict:
        if schema is None:
            raise ValueError("strict reading needs a declared schema")
        as_text = StructType([*[StructField(f.name, StringType(), True) for f in schema.fields],
                              StructField(CORRUPT, StringType(), True)])
        df = rows(as_text, "PERMISSIVE", columnPruning="false", columnNameOfCorruptRecord=CORRUPT)
        valid = F.col(CORRUPT).isNull()
        for f in schema.fields:
            if not isinstance(f.dataType, StringType):
                blank = F.col(f.name).isNull() | (F.col(f.name) == EMPTY)
                valid = valid & (blank | F.col(f.name).try_cast(f.dataType).isNotNull())
        return _with_empty(df.where(valid)).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name)
                                                     for f in schema.fields])
    return _with_empty(rows(schema, mode))


def _with_empty(df: DataFrame) -> DataFrame:
    """Text columns with the mark of a quoted empty field turned into ''."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name != CORRUPT]
    return df.withColumns({c: F.when(F.col(c) == EMPTY, F.lit("")).otherwise(F.col(c)) for c in text})


# File names of the search-relevance CSV layout and the schema each one is read with.
CSV_TABLES = {
    "train": ("train.csv", "TRAIN"),
    "test": ("test.csv", "TEST"),
    "attributes": ("attributes.csv", "ATTRIBUTES"),
    "product_descriptions": ("product_descriptions.csv", "DESCRIPTIONS"),
}


def read_search_tables(spark: SparkSession, folder: str, strict: bool = True, strict_products: bool = False,
                       tables: Collection[str] = tuple(CSV_TABLES), label_as: str = "double",
                       multi_line: Collection[str] = ()) -> dict[str, DataFrame]:
    """CSV tables of a search-relevance folder, typed, keyed by logical name.

    ``tables`` names the tables wanted; one that is missing is an error of the read, on whatever
    file system the folder lies. The pair files (train, test) are read with the pruning-proof
    malformed-row filter when ``strict``; attributes and descriptions are read permissively unless
    ``strict_products``, as the scripts mostly do (a malformed product row keeps NULLs and simply
    joins nothing). ``label_as='int'`` declares an integer label: strict reading then drops the rows
    with a fractional one. ``multi_line`` names tables whose fields hold line breaks.
    """
    from relevo import schemas

    out = {}
    for name in tables:
        file_name, schema_name = CSV_TABLES[name]
        if name == "train" and label_as == "int":
            schema_name = "TRAIN_INT_LABEL"
        out[name] = read_csv(spark, f"{folder.rstrip('/')}/{file_name}", schema=getattr(schemas, schema_name),
                             strict=strict if name in ("train", "test") else strict_products, multi_line=name in multi_line)
    return out
