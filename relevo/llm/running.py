"""Running sums over sorted rows of which one group may fill many tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.frames import partitions, written

#: Sums are taken modulo 2 ** 62, so that hashes can be summed without overflow.
MASK = (1 << 62) - 1


def running(df: DataFrame, group: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """``df`` with running sums of long columns within each group, in the given order.

    ``values`` maps a new column to the column it sums (the row itself included), modulo 2 ** 62.
    ``group`` is a long column without nulls. Rows are dealt by ranges of (group, order), so a group
    of any size is spread over tasks, provided that ``order`` tells its rows apart. Every task sums its own
    rows; what precedes them is carried over in a table of at most two rows a task. ``df`` must be
    a written table: its rows may not change between two reads.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions(spark), group, *order).sortWithinPartitions(group, *order)
    columns, sources = df.columns, list(values.values())
    at, places = columns.index(group), [columns.index(c) for c in sources]

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, carry, ended = None, [0] * len(places), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column(at).to_numpy()
            cuts = np.flatnonzero(g[1:] != g[:-1]) + 1
            starts = np.concatenate([[0], cuts])
            sizes = np.diff(np.concatenate([starts, [len(g)]]))
            sums = []
            for i, p in enumerate(places):
                v = batch.column(p).to_numpy().astype(np.uint64)
                total = np.cumsum(v, dtype=np.uint64)
                before = total[starts] - v[starts]
                if held == g[0]:
                    before[0] -= np.uint64(carry[i])
                sums.append((total - np.repeat(before, sizes)) & np.uint64(MASK))
            ends = [(held, carry)] if held is not None and held != g[0] and not ended else []
            if len(cuts) and not ended and not ends:
                ends = [(int(g[0]), [int(s[cuts[0] - 1]) for s in sums])]
            ended += len(ends)
            held, carry = int(g[-1]), [int(s[-1]) for s in sums]
            yield _rows(batch, sums, part, names)
            if ends:
                yield _total(batch.schema, ends, at, part, names)
        if held is not None:
            yield _total(batch.schema, [(held, carry)], at, part, names)

    def carried(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, carry = None, np.zeros(len(places), np.int64)
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held != row[0]:
                    held, carry = row[0], np.zeros(len(places), np.int64)
                out.append((*row[:2], *carry.tolist()))
                carry = (carry + np.array(row[2:], np.int64)) & MASK
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["_g", "_p", *befores])

    names = [*columns, *values, "_part", "_total"]
    befores = [f"_before{i}" for i in range(len(values))]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    kinds += [f"`{v}` long" for v in values] + ["_part long", "_total boolean"]
    found = written(dealt.mapInArrow(local, ", ".join(kinds)), "running")
    totals = found.where("_total").select(F.col(group).alias("_g"), F.col("_part").alias("_p"), *values).coalesce(1).sortWithinPartitions("_g", "_p")
    # at most two rows a task: the first and the last group of each
    before = written(totals.mapInArrow(carried, "_g long, _p long, " + ", ".join(f"{b} long" for b in befores)), "carried")
    joined = found.where("not _total").join(F.broadcast(before), (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")), "left")
    sums = [(F.col(v) + F.coalesce(F.col(b), F.lit(0))).bitwiseAND(F.lit(MASK)).alias(v) for v, b in zip(values, befores, strict=True)]
    return joined.select(*columns, *sums)


def _rows(batch: pa.RecordBatch, sums: list[np.ndarray], part: int, names: list[str]) -> pa.RecordBatch:
    n = batch.num_rows
    extra = [pa.array(s.astype(np.int64)) for s in sums]
    return pa.RecordBatch.from_arrays([*batch.columns, *extra, pa.array(np.full(n, part, np.int64)), pa.array(np.zeros(n, bool))], names)


def _total(schema: pa.Schema, ends: list, at: int, part: int, names: list[str]) -> pa.RecordBatch:
    columns = [pa.array([g for g, _ in ends], pa.int64()) if i == at else pa.nulls(len(ends), f.type) for i, f in enumerate(schema)]
    sums = [pa.array(c, pa.int64()) for c in zip(*(s for _, s in ends), strict=True)]
    return pa.RecordBatch.from_arrays([*columns, *sums, pa.array([part] * len(ends), pa.int64()), pa.array([True] * len(ends))], names)
