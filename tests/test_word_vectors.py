"""Word2Vec trained in Spark tasks: the kernel against plain loops, dealing, repeatability, nothing on the driver."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from relevo import models as M
from relevo.models import skipgram
from relevo.models import vectors as V
from relevo.plans import flows


def _found(model):
    return {r["word"]: tuple(r["v"]) for r in model.getVectors().select("word", vector_to_array("vector").alias("v")).collect()}


def _texts(spark, n=400):
    rng = np.random.default_rng(0)
    rows = [[f"w{int(k)}" for k in rng.zipf(1.6, 12) % 60] for _ in range(n)]
    return spark.createDataFrame([(r,) for r in rows], "tok array<string>")


def test_fits_in_several_tasks_repeat_to_the_last_digit(spark):
    """Tasks of one executor do not train on shared arrays, and texts are dealt by their places."""
    tokens = _texts(spark)

    def fit(df):
        return _found(M.word2vec(seed=3, input_col="tok", output_col="v", num_partitions=4, min_count=2).fit(flows.pinned(df, "tok", 4)))

    first = fit(tokens)
    assert len(first) > 20
    assert first == fit(tokens) == fit(tokens.repartition(7))


def test_vectors_are_a_table_not_rows_of_the_driver(spark):
    model = M.word2vec(seed=3, input_col="tok", output_col="v", num_partitions=2).fit(_texts(spark))
    plan = model.getVectors()._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan and "parquet" in plan
    assert model.is_there()


@pytest.mark.parametrize("counts", [[1], [5, 5], [9, 9, 9, 9, 9], [40, 20, 10, 5, 3, 2, 1, 1], [7] * 33, [1000, 1, 1, 1]])
def test_huffman_tree_is_optimal(counts):
    parent, bit = skipgram.huffman(np.array(counts))
    nodes, signs = skipgram.paths(np.arange(len(counts)), parent, bit)
    n, heap, best = len(counts), list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        best += (both := heapq.heappop(heap) + heapq.heappop(heap))
        heapq.heappush(heap, both)
    lengths = (nodes < n).sum(1)
    assert (lengths * counts).sum() == best
    assert ((signs != 0) == (nodes < n)).all()
    assert len({(tuple(a[:k][::-1]), tuple(b[:k][::-1])) for a, b, k in zip(nodes.tolist(), signs.tolist(), lengths, strict=True)}) == n


def _by_loops(model, ids, sentence, rate, reach):
    """What a block does to the vectors, place by place: the places of a step see the vectors before it."""
    steps, lanes, n = len(reach), model.lanes, model.n
    nodes, signs = skipgram.paths(np.arange(n), model.parent, model.bit)
    vectors, inner = model.vectors.astype(float), model.inner.astype(float)
    for i in range(steps):
        x, w = vectors.copy(), inner.copy()
        for place in (lane * steps + i for lane in range(lanes)):
            for near in range(place - reach[i], place + reach[i] + 1):
                if near == place or not (0 <= place < len(ids) and 0 <= near < len(ids)) or sentence[near] != sentence[place]:
                    continue
                c = ids[near]
                for k, sign in zip(nodes[ids[place]], signs[ids[place]], strict=True):
                    dot = x[c] @ w[k]
                    if sign and abs(dot) < skipgram.CERTAIN:
                        slope = rate * ((sign > 0) - 1 / (1 + np.exp(-dot)))
                        vectors[c] += slope * w[k]
                        inner[k] += slope * x[c]
    return vectors, inner


def test_a_block_changes_vectors_as_plain_loops_do():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.7, 300) % 12
    lengths = np.array([1, 40, 9, 100, 0, 150])
    numbers = np.arange(12) * 1000 + 7
    counts = np.bincount(ids, minlength=12) + 1
    settings = skipgram.Settings(3, 5, 60, 0.5, 11, 1, 300, 1, 0)
    model = skipgram.Training(numbers, counts, rng.normal(size=(12, 3)).astype(np.float32), rng.normal(size=(12, 3)).astype(np.float32), settings, 0)
    assert 1 <= model.lanes <= skipgram.FEWEST
    rank = {int(x): i for i, x in enumerate(model.numbers)}
    ranks = np.array([rank[int(numbers[k])] for k in ids])
    sentence = np.repeat([0, 1, 2, 3, 4, 5, 6, 7], [1, 40, 9, 60, 40, 60, 60, 30])  # cut at 60 words
    steps = -(-300 // model.lanes)
    reach = np.random.default_rng([11, 0, 0]).integers(1, 6, steps)
    want = _by_loops(model, ranks, sentence, 0.5, reach.tolist())
    known = np.insert(numbers[ids], [0, 120, 300], 5)  # words outside the vocabulary are left out
    lengths[[0, 3, 5]] += 1
    model.add(known, lengths)
    model.finish()
    assert np.allclose(model.vectors, want[0], atol=2e-3) and np.allclose(model.inner, want[1], atol=2e-3)
    assert not model.vectors[-1].any() and not model.inner[-1].any()
    assert model.read == 300


def test_blocks_do_not_depend_on_the_batches():
    rng = np.random.default_rng(2)
    ids, lengths = rng.integers(0, 50, 30_000), np.full(300, 100)
    counts, start = np.bincount(ids), rng.normal(size=(50, 3)).astype(np.float32) / 10

    def trained(texts):
        model = skipgram.Training(np.arange(50), counts, start, None, skipgram.Settings(3, 5, 1000, 0.025, 1, 1, 30_000, 1, 0), 0)
        for a in range(0, 300, texts):
            model.add(ids[a * 100:(a + texts) * 100], lengths[a:a + texts])
        model.finish()
        assert model.read == 30_000
        return model.vectors

    assert (trained(300) == trained(7)).all() and (trained(300) == trained(1)).all()


def test_two_parts_in_one_stream_are_two_models():
    schema = pa.schema([("part", pa.int32()), ("is_text", pa.bool_()), ("numbers", pa.list_(pa.int64())), ("vectors", pa.list_(pa.float32()))])
    words = [(False, [k, 5], [0.1, -0.1 * k, 0.2]) for k in range(1, 6)]
    texts = [(True, [1, 2, 3, 4, 5, 1, 2], None)] * 9
    settings = skipgram.Settings(3, 5, 1000, 0.025, 1, 2, 126, 1, 0)

    def rows(*parts):
        data = [(p, *r) for p in parts for r in words + texts]
        batches = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*data, strict=True), schema.types, strict=True)], schema=schema).to_batches(4)
        return [r for b in skipgram.train(iter(batches), settings) for r in b.to_pylist()]

    assert rows(0, 1) == rows(0) + rows(1)
    assert {r["number"] for r in rows(0)} == {1, 2, 3, 4, 5}


def test_words_with_a_shared_hash_stay_apart(spark, monkeypatch):
    """If another word has a kept word's number, other numbers are taken."""
    real = V.TableWord2Vec._number
    monkeypatch.setattr(V.TableWord2Vec, "_number", lambda self, word: F.when(F.lit(self._salt) > 0, real(self, word)).otherwise(F.lit(1).cast("long")))
    model = M.word2vec(seed=3, input_col="tok", output_col="v", num_partitions=2, min_count=3).fit(_texts(spark))
    assert len(set(_found(model).values())) == len(_found(model)) > 20


def test_further_iterations_null_and_lone_texts(spark):
    rows = [(["a", "b", "a", "c"],), (None,), ([],), (["lone"],), (["a", "rare", "b"],)] * 6 + [(["once"],)]
    df = spark.createDataFrame(rows, "tok array<string>")
    one, three = (_found(M.word2vec(seed=3, input_col="tok", output_col="v", num_partitions=2, max_iter=k).fit(df)) for k in (1, 3))
    assert set(one) == set(three) == {"a", "b", "c", "lone", "rare"}
    assert one["lone"] == three["lone"] and one["a"] != three["a"]  # a lone word keeps its start
    with pytest.raises(ValueError, match="no word"):
        M.word2vec(seed=3, input_col="tok", output_col="v", min_count=99).fit(df)


def test_words_that_stand_together_get_near_vectors(spark):
    """Two groups of words that never meet: vectors of one group are nearer to each other than to the other's."""
    rng = np.random.default_rng(5)
    rows = [([f"{g}{int(k)}" for k in rng.integers(0, 6, 20)],) for _ in range(1500) for g in "xy"]
    found = _found(M.word2vec(seed=3, input_col="tok", output_col="v", num_partitions=2).fit(spark.createDataFrame(rows, "tok array<string>")))

    def cosine(a, b):
        a, b = np.array(found[a]), np.array(found[b])
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    same = np.mean([cosine(f"{g}{i}", f"{g}{j}") for g in "xy" for i in range(6) for j in range(i)])
    other = np.mean([cosine(f"x{i}", f"y{j}") for i in range(6) for j in range(6)])
    assert same > 0.8 and other < 0


def test_pinned_rows_are_the_rows(spark):
    """Quotes, line breaks, control characters, missing and empty texts come back as they were."""
    rows = [(k, w) for k, w in enumerate([["a", 'q"uo\\te', "", None], [], None, ["\n\t\r", "\x00\x01", "\u2028é𝄞", "[1,2]", "null"], [""], [None]])]
    found = flows.pinned(spark.createDataFrame(rows, "id long, tok array<string>"), "tok")
    assert found.dtypes == [("id", "bigint"), ("tok", "array<string>")]
    assert sorted(((r["id"], r["tok"]) for r in found.collect()), key=lambda r: r[0]) == rows
