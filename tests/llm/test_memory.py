"""Bounds on what a Python worker holds."""

import tracemalloc

import numpy as np
import pyarrow as pa
from relevo.llm import anchors, frames, suffix_dedup


def test_suffix_array_shards_hold_few_bytes_a_symbol():
    rng = np.random.default_rng(1)
    text = rng.choice(np.frombuffer(b"abcdefgh ", np.uint8), 1 << 19).tobytes()
    contexts = [text[i : i + 1200] for i in range(0, len(text) - 1200, 1200)]
    windows = np.array([len(c) - 399 for c in contexts])
    anchors._powers.cache_clear()
    tracemalloc.start()
    try:
        suffix_dedup.repeated_starts(contexts, windows, np.zeros(len(contexts), bool), 400)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak / len(text) < 125
    assert suffix_dedup.SHARD_BYTES <= 1 << 19


def test_tables_of_powers_go_when_another_stage_follows(monkeypatch):
    monkeypatch.setattr(frames, "_CACHES", {})
    frames.use_caches("anchors", anchors.forget)
    anchors.Spans(np.arange(10, dtype=np.uint64))
    assert anchors._powers.cache_info().currsize
    frames.use_caches("anchors", anchors.forget)
    assert anchors._powers.cache_info().currsize
    frames.use_caches("ngram_join")  # one without caches of its own counts as an owner, too
    assert not anchors._powers.cache_info().currsize
    assert "ngram_join" in frames._CACHES


def test_texts_reach_python_in_batches_of_bounded_size(spark):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    before = spark.conf.get(frames.ARROW_BYTES, None)
    spark.conf.unset(frames.ARROW_BYTES)
    try:
        frames.setting(spark)
        docs = spark.range(0, 1200, numPartitions=1).selectExpr("repeat('word ', 4000) AS text")
        sizes = [r.n for r in docs.mapInArrow(size, "n long").collect()]
    finally:
        if before is not None:
            spark.conf.set(frames.ARROW_BYTES, before)
    assert sum(sizes) > 20_000_000
    assert max(sizes) < 5_000_000
