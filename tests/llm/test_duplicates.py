"""Similarity join, substring removal and embeddings against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from relevo.llm import anchors, embeddings, ngram_join, rlz_dedup, suffix_dedup
from relevo.llm.components import connected_components

from .conftest import messy_rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (None, 5)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    nodes = [*range(41), *range(100, 130)]
    assert got == _roots(nodes, [(a, b) for a, b in edges if a is not None and a != b and a < 200])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_components(messy, none):
    got = [tuple(r) for r in ngram_join.jaccard_components(messy).collect()]
    rows = messy_rows()
    sets = [(k, _shingles(t)) for k, t, *_ in rows]
    keyed = [(k, s) for k, s in sets if k is not None and s]
    links = [(a, b) for i, (a, x) in enumerate(keyed) for b, y in keyed[:i] if 100 * len(x & y) >= 75 * len(x | y)]
    root = _roots({k for k, _ in sets if k is not None}, links)
    assert sorted(got, key=str) == sorted([(k, len(s), None if k is None else root[k]) for k, s in sets], key=str)
    assert ngram_join.jaccard_components(none).count() == 0


def test_jaccard_ids_with_several_texts(spark):
    """An id that is a copy by one text still links by its others."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (4, c), (5, c), (5, b + " other end"), (6, c + " x"), (7, "quite another text of seven words")]
    got = {tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [(k, _shingles(t)) for k, t in rows]
    links = [(x, y) for i, (x, u) in enumerate(sets) for y, v in sets[:i] if 100 * len(u & v) >= 75 * len(u | v)]
    root = _roots({k for k, _ in rows}, links)
    assert got == {(k, len(u), root[k]) for k, u in sets} and {root[k] for k in range(1, 7)} == {1}


@pytest.mark.parametrize("short", [64, 1])
def test_jaccard_of_texts_that_share_a_passage(spark, monkeypatch, short):
    """Many different texts around one passage, some of them linked without sharing a min-hash; lists in chunks."""
    import random

    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 3)
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 4)
    monkeypatch.setattr(ngram_join, "SHORT_RUN", short)
    monkeypatch.setattr(ngram_join, "PERMUTATIONS", 1)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    rows, base = [], None
    for i in range(90):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(30, 60))]
        if i % 3 == 0:
            base = own
        elif i % 3 == 1:  # near the one before: a word changed every 25
            own = [w if k % 25 != 7 else "zz" for k, w in enumerate(base)]
        at = rng.randrange(len(own))
        rows.append((i, " ".join(own + passage if i % 3 < 2 else own[:at] + passage + own[at:])))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {k: _shingles(t) for k, t in rows}
    links = [(a, b) for a in sets for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert got == _roots(sets, links) and len(links) > 3


@pytest.mark.parametrize("short", [64, 1])
def test_jaccard_families_that_link_across_groups(spark, monkeypatch, short):
    """A chain of slowly changing texts: links run between families, with small groups."""
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 2)
    monkeypatch.setattr(ngram_join, "SHORT_RUN", short)
    words = [f"w{i}" for i in range(260)]
    texts = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs).collect()}
    sets = {k: _shingles(t) for k, t in texts}
    links = [(a, b) for a in sets for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert got == _roots(sets, links)


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(60):
        t = np.append(rng.integers(1, 1 + rng.integers(1, 8), rng.integers(1, 500)), 0)
        if trial % 3 == 0:
            t = np.append(np.tile(t[:-1], 7), 0)
        s = t.tolist()
        sa = suffix_dedup.suffix_array(t, int(t.max()) + 1)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        prefix = suffix_dedup.permuted_common_prefixes(t, sa, 20)
        for a, b in zip(sa, sa[1:], strict=False):
            n = 0
            while n < 20 and max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert prefix[b] == n


def _covered(n, starts, width):
    mask = np.zeros(n, bool)
    for s in starts:
        mask[s : s + width] = True
    return mask


@pytest.mark.parametrize("most", [2048, 2])
def test_repeated_bytes_go(messy, none, monkeypatch, most):
    monkeypatch.setattr(anchors, "MOST_CLASSES", most)  # 2: most anchors are refined down to single windows
    got = [tuple(r)[:5] for r in suffix_dedup.remove_repeats(messy, width=100, gram=16).collect()]
    raws = [(k, (t or "").encode()) for k, t, *_ in messy_rows()]
    count = Counter(r[i : i + 100] for _, r in raws for i in range(len(r) - 99))
    want = []
    for k, r in raws:
        mask = _covered(len(r), [i for i in range(len(r) - 99) if count[r[i : i + 100]] > 1], 100)
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) > 0).sum())
        want.append((k, np.frombuffer(r, np.uint8)[~mask].tobytes(), len(r), int(mask.sum()), runs))
    assert sorted([(k, bytes(x), *z) for k, x, *z in got], key=str) == sorted(want, key=str)
    assert suffix_dedup.remove_repeats(none, width=100).count() == 0


def test_cut_repeats_keeps_rows_and_columns(messy):
    got = suffix_dedup.cut_repeats(messy, width=100, gram=16, count_col="n_chars")
    assert got.schema == messy.schema and got.count() == messy.count()
    assert got.where("text is null and n_chars <> 0").count() == 0
    assert got.where("text is not null and n_chars <> length(text)").count() == 0


@pytest.mark.parametrize("most", [512, 2])
def test_words_of_earlier_documents_go(messy, none, monkeypatch, most):
    monkeypatch.setattr(rlz_dedup, "MOST_CLASSES", most)
    got = [tuple(r)[:4] for r in rlz_dedup.remove_earlier(messy, width=20, gram=4).collect()]
    rows = [(k, WORDS.findall(t or "")) for k, t, *_ in messy_rows()]
    low: dict = {}
    order = lambda k: -(1 << 63) if k is None else k
    for k, w in rows:
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            low[key] = min(low.get(key, order(k)), order(k))
    want = []
    for k, w in rows:
        mask = _covered(len(w), [i for i in range(len(w) - 19) if low[tuple(w[i : i + 20])] < order(k)], 20)
        want.append((k, " ".join(x for x, m in zip(w, mask, strict=True) if not m), len(w), int(mask.sum())))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert rlz_dedup.remove_earlier(none).count() == 0


def test_parse_checks_windows_across_factors():
    refs = [(0, [1, 2, 3, 4, 5, 6]), (1, [5, 6, 7, 8, 9])]
    assert rlz_dedup.repeated_ranges([*refs, (2, [3, 4, 5, 6, 7, 8, 0])], 3)[2] == [(0, 2), (2, 2)]


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 16))
    rows, vecs = [], {}
    for i in range(300):
        v = centres[i % 12] + 0.16 * rng.standard_normal(16)
        if i % 25 == 0:
            v = centres[0]
        vecs[i] = (v.astype(np.float32).astype(float), i % 2)
        rows.append((i, [float(x) for x in vecs[i][0]], i % 2))
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] * 16, 1), (1004, rows[0][1], None),
           (1005, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, label int").withColumnRenamed("missing", "x")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    links = []
    for i, (x, a) in vecs.items():
        for j, (y, b) in vecs.items():
            if j < i and a == b and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links.append((i, j))
    count = Counter(n for p in links for n in p)
    root = _roots(vecs, links)
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (count[i], root[i], root[i] == i) for i in vecs)
    assert all(got[k]["n_links"] == 0 and got[k]["component_id"] == k for k in (1000, 1001, 1002, 1003, 1004, 1005, None))
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_table_numbers_keep_the_recall():
    for rows in (10, 5_000, 10**9):
        bits, tables = embeddings.tables_for(rows, 0.93)
        agree = (1 - np.arccos(0.93) / np.pi) ** bits
        assert 1 - (1 - agree) ** tables >= embeddings.RECALL


def test_hashes_are_stable_between_processes():
    assert hashlib.sha256(ngram_join.shingle_sets(["a b c d e f"])[0].tobytes()).hexdigest()[:8] == hashlib.sha256(
        ngram_join.shingle_sets(["x", "A b c D e f"])[1].tobytes()).hexdigest()[:8]
