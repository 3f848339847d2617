"""Helpers shared by the operators: Arrow row streams and tables written in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.session import apply_skew_conf, shared_path

#: Python-side chunk: rows are handed on after so many bytes of input, whatever the batch size.
CHUNK_BYTES = 8 << 20
#: The same where numbers are kept for every byte of the input.
SMALL_CHUNK = 2 << 20
#: Arrow batches of so many bytes go to Python: rows of texts else come by 10,000, whatever their size.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Caches of a worker, by owner: how each is emptied. Workers serve one stage after another.
_CACHES: dict[str, Callable[[], None] | None] = {}


def setting(spark: SparkSession) -> None:
    apply_skew_conf(spark)
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under the application's id: ``remove_shared_tables`` deletes it."""
    return shared_path(spark, "relevo-tables", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the folder of ``spark.checkpoint.dir`` and read it back.

    It cuts lineage with files every executor can read, and the copy read back carries no
    partitioning, so that a join on it gets exchanges AQE may split.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def use_caches(owner: str, clear: Callable[[], None] | None = None) -> None:
    """Called inside a task: empties what other owners keep in this worker, and notes how to empty the owner's.

    Free memory that earlier tasks left goes back to the system.
    """
    others = [o for o in _CACHES if o != owner]
    for other in others:
        clear_other = _CACHES.pop(other)
        if clear_other is not None:
            clear_other()
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if give_back is not None:
        give_back(0)
    _CACHES[owner] = clear or _CACHES.get(owner)


def slices(batch: pa.RecordBatch, text: int, limit: int = SMALL_CHUNK) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded size of the text column (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows:
        yield batch.slice(start)


def text_rows(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list]]:
    """Split a (key, text) batch into chunks of bounded text size; null texts come as ''."""
    keys, texts, size = [], [], 0
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        t = text.as_py() or ""
        keys.append(key)
        texts.append(t)
        size += len(t)
        if size >= limit:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def map_texts(docs: DataFrame, id_col: str, text_col: str, fn: Callable[[list, list], pa.RecordBatch],
              schema: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """Apply ``fn(keys, texts)`` to bounded chunks of the rows; no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in text_rows(batch, limit):
                yield fn(keys, texts)

    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, schema)
