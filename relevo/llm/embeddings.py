"""Near-duplicate embeddings: sign hashing in several tables, exact cosines, components.

Equal vectors of a label are first folded into one with a weight. Each table keeps the signs of a
vector against ``bits`` random hyperplanes; vectors that agree in all bits of a table meet in a
bucket. Cosines there are exact double-precision products of blocks, and a pair counts in the
first table in which it meets, so each is counted once without listing pairs. ``bits`` follows
the logarithm of the largest label, which keeps buckets of unrelated vectors near
``BUCKET_ROWS``, and the number of tables follows from ``bits`` and the wanted recall at the
threshold. A bucket over ``BLOCK_ROWS`` is cut into blocks; each pair of blocks is a task's unit of
work.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.components import connected_components
from relevo.llm.frames import partitions, written

RECALL = 0.9995
BUCKET_ROWS = 32
BLOCK_ROWS = 512
SEED = 7


def tables_for(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for a label of ``rows`` vectors: recall at the threshold is at least ``recall``."""
    bits = max(4, math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS)) if rows > BUCKET_ROWS else 4)
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def hyperplanes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def _vectors(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)


def _links(vectors: np.ndarray, weights: np.ndarray, codes: np.ndarray, table: int, threshold: float, block: np.ndarray):
    """Link weights newly counted in this table, and (i, root) edges of the bucket's components."""
    norm = np.sqrt((vectors * vectors).sum(1))
    near = (vectors @ vectors.T) / np.outer(norm, norm) >= threshold
    np.fill_diagonal(near, False)
    cut = block.max(initial=0) > block.min(initial=0)
    if cut:  # a pair of blocks: only pairs across them
        near &= block[:, None] != block[None, :]
    i, j = np.nonzero(near)
    if not len(i):
        return np.zeros(len(vectors), np.int64), []
    new = np.ones(len(i), bool) if not table else ~(codes[i, :table] == codes[j, :table]).any(1)
    counts = np.bincount(i[new], weights[j[new]].astype(float), len(vectors)).astype(np.int64)
    label = np.arange(len(vectors))
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        if (low == label).all():
            break
        label = low
    return counts, [(x, r) for x, r in enumerate(label) if x != r]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", recall: float = RECALL) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row.

    Rows link only within one label. A null id, label or vector, a zero vector, and one with null
    or non-finite components link with nothing: 0 links, own component. Vectors of different
    lengths never link. Equal vectors always link. Rows that repeat an id count as other vectors.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    rows = written(rows.withColumn("ok", F.coalesce(ok, F.lit(False))), "vectors")
    folded = written(
        rows.where("ok").groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
        .withColumn("dim", F.size("v")), "folded")
    sizes = folded.groupBy("label", "dim").count()
    largest = sizes.agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(largest, threshold, recall)

    def code_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = (1 << np.arange(bits)).astype(np.int64)
        for batch in batches:
            if batch.num_rows:
                (dim,) = {len(x) for x in batch.column(1)}
                plane = hyperplanes(dim, bits, tables)
                signs = (_vectors(batch.column(1)) @ plane >= 0).reshape(batch.num_rows, tables, bits)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list((signs * power).sum(2)), pa.list_(pa.int64()))], ["rep", "codes"])

    def by_length(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(x) for x in batch.column(1)])
            for n in np.unique(lengths):
                yield from code_rows([batch.take(pa.array(np.flatnonzero(lengths == n)))])

    kind = vectors.schema[id_col].dataType.simpleString()
    codes = folded.select("rep", "v").mapInArrow(by_length, f"rep {kind}, codes array<bigint>")
    coded = written(folded.join(codes, "rep").select("rep", "weight", "label", "dim", "v", "codes"), "coded")
    slots = coded.select("rep", "weight", "label", "dim", "v", "codes", F.posexplode("codes").alias("t", "code"))
    key = ["label", "dim", "t", "code"]
    big = written(slots.groupBy(*key).count().where(F.col("count") > BLOCK_ROWS)
                  .select(*key, F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")), "big")
    parted = slots.join(big, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    parted = parted.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    parted = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = parted.select(
        F.xxhash64(*key, F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "rep", "weight", "t", "block",
        F.col("v"), "codes", F.struct("label", "dim", "code").alias("bucket"), F.struct(F.least("block", "other"), F.greatest("block", "other")).alias("pair"))
    dealt = units.repartition(4 * partitions(vectors.sparkSession), "unit").sortWithinPartitions("unit", "t", "bucket", "pair", "rep") \
        .select("rep", "weight", "t", "block", "v", "codes", F.xxhash64("unit", "t", "bucket", "pair").alias("run"))

    def link_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(t: pa.Table) -> pa.RecordBatch | None:
            if t.num_rows < 2:
                return None
            t = t.combine_chunks()
            rep = t["rep"].chunk(0)
            n = len(rep)
            counts, edges = _links(_vectors(t["v"].chunk(0)), t["weight"].to_numpy(), t["codes"].chunk(0).flatten().to_numpy().reshape(n, -1),
                                   t["t"][0].as_py(), threshold, t["block"].to_numpy())
            who = np.flatnonzero(counts)
            a = pa.array([x for x, _ in edges] + list(who), pa.int64())
            b = pa.array([x for _, x in edges] + list(who), pa.int64())
            links = pa.array([0] * len(edges) + list(counts[who]), pa.int64())
            return pa.RecordBatch.from_arrays([rep.take(a), rep.take(b), links], ["a", "b", "links"]) if len(a) else None

        held: list[pa.Table] = []
        held_run = None
        for batch in batches:
            runs = batch.column(6).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(runs[1:] != runs[:-1]) + 1, [len(runs)]]) if len(runs) else []
            for s, e in zip(starts, starts[1:], strict=False):
                part = pa.Table.from_batches([batch.slice(s, e - s)])
                if held and runs[s] != held_run:
                    if (out := work(pa.concat_tables(held))) is not None:
                        yield out
                    held = []
                held.append(part)
                held_run = runs[s]
        if held and (out := work(pa.concat_tables(held))) is not None:
            yield out

    found = written(dealt.mapInArrow(link_rows, f"a {kind}, b {kind}, links long"), "links")
    links = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("links = 0").select("a", "b")).select(F.col("node").alias("rep"), F.col("component").alias("root"))
    classes = written(
        folded.select("rep", "label", "v", "weight").join(links, "rep", "left").join(roots, "rep", "left")
        .select("label", "v", "rep", "weight", "links", F.coalesce("root", "rep").alias("root")), "classes")
    done = rows.where("ok").join(classes, ["label", "v"]).select(
        "id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("root").alias("component_id"))
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return done.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
