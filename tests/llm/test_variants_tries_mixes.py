"""Spelling variants, the prefix trie and the mix of sources against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from relevo.llm import mixing, prefix_trie, variants
from relevo.llm.frames import written
from relevo.llm.running import MASK, running

from .conftest import messy_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def test_running_sums_of_a_hot_group(spark):
    """A group over many tasks, small groups, repeated order values, and sums beyond 62 bits."""
    rng = random.Random(1)
    rows = [(7 if rng.random() < 0.7 else rng.randrange(40), rng.randrange(200), rng.randrange(MASK)) for _ in range(3000)]
    df = written(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "g long, o long, v long, u long").repartition(7), "t")
    got = {r["u"]: r["s"] for r in running(df, "g", ["o", "u"], {"s": "v"}).collect()}
    want, sums = {}, Counter()
    for u in sorted(range(len(rows)), key=lambda u: (*rows[u][:2], u)):
        sums[rows[u][0]] = (sums[rows[u][0]] + rows[u][2]) & MASK
        want[u] = sums[rows[u][0]]
    assert got == want
    assert running(written(df.limit(0), "t"), "g", ["o"], {"s": "v"}).count() == 0


# spelling variants -----------------------------------------------------------------------------


def _near(x: str, y: str) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def _variants(words: dict[str, int], ratio: int = 5) -> set[tuple]:
    form, near = {}, {}
    for w, n in words.items():
        near[w] = [o for o in words if _near(w, o)]
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


@pytest.mark.parametrize("most", [4096, 3])
def test_spelling_variants(spark, monkeypatch, most):
    """Common prefixes and endings, edits at every place, ties, accents, and words of two letters."""
    monkeypatch.setattr(variants, "MOST_PAIRS", most)
    rng = random.Random(2)
    words = {}
    for base in ["aaaaaa", "aaaaaaa", "abcabc", "éèéèéè", "internal", "internet", "interval", "xy", "ab", "q" * 40]:
        words[base] = rng.choice([1000, 5000])
        for _ in range(12):
            at, c = rng.randrange(len(base)), rng.choice("abéz")
            for w in (base[:at] + base[at + 1 :], base[:at] + c + base[at:], base[:at] + c + base[at + 1 :]):
                if len(w) > 1:
                    words.setdefault(w, rng.choice([5, 5, 30, 200, 900]))
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [tuple(r) for r in variants.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(words) and set(got) == _variants(words)
    assert variants.spelling_variants(df.limit(0)).count() == 0


def _runs(rows, every):
    total = Counter()
    for key, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            total[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return total


def test_word_counts(spark, messy, none, monkeypatch):
    """Counts of whole texts with slips; parts of counts are handed on; null ids and texts."""
    monkeypatch.setattr(variants, "HELD_WORDS", 3)
    monkeypatch.setattr(variants, "_LONG", 500)
    long = [(5, "ÀÉ × straßE Straße " * 400 + "w" * 5000, None), (None, "Abcdefg abcdefg", None), (9, None, None)]
    for df, rows in ((messy, messy_rows()), (spark.createDataFrame(long, "doc_id long, text string, lang string"), long)):
        got = dict(map(tuple, variants.word_counts(df, drop_every=2, least_length=3, least_count=2).collect()))
        assert got == {w: n for w, n in _runs(rows, 2).items() if len(w) >= 3 and n >= 2}
    assert variants.word_counts(none).count() == 0


# prefix trie -----------------------------------------------------------------------------------


def _conversations():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 14), *range(100, 112), -3, -100, -99, 205, 333, 777, 10**12]:
        for t in range(rng.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, t, rng.choice(["user", None, ""]), rng.choice(["a", "bb", "", None, "é😀"])))
    rows += [(300, t, "u", "same") for t in range(150)] + [(301, t, "u", "same") for t in range(149)]  # long chains
    rows += [(c, t, "u", "copy") for c in (400, 402, 403) for t in range(7)]
    rows += [(500, None, "u", "first"), (500, 1, "u", "x"), (500, 1, "a", "x"), (500, 1, "u", "x"), (500, 0, None, None)]
    return [*rows, (None, 1, "u", "lost"), rows[5], rows[5]]


def _trie(rows):
    def mark(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()

    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, mark(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = tuple(own.get(base, [])[:h] + ts[h:]) if base != c else tuple(ts)
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = 1 if not kids[node] else sum(leaves[k] for k in kids[node])
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in kids[node])
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("component", [1 << 16, 40, 1])
def test_prefix_trie(spark, monkeypatch, component):
    """Shared heads, copies, long chains, null and equal turns; cut in Spark down to single nodes."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(prefix_trie, "COMPONENT", component)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    rows = _conversations()
    if component == 1:
        rows = [r for r in rows if r[1] is None or r[1] < 5]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    df = df.withColumns({c: F.lit("clash") for c in ("key", "parent", "rank", "depth", "uid", "comp", "a")})
    got = [tuple(r) for r in prefix_trie.prefix_trie(df).collect()]
    assert sorted(got, key=str) == sorted(_trie(rows), key=str)
    if component > 40:
        assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
        assert prefix_trie.prefix_trie(df.where("conv_id is null")).count() == 0


def test_component_sums_of_random_forests():
    """Subtree sums of chains, stars and random trees; parents outside a component do not count."""
    rng = np.random.default_rng(4)
    columns, want = [], []
    for comp in range(60):
        n = int(rng.integers(1, 90))
        shape = comp % 3
        up = [-1] + [v - 1 if shape == 0 else 0 if shape == 1 else int(rng.integers(0, v)) for v in range(1, n)]
        depth = [0] * n
        for v in range(1, n):
            depth[v] = depth[up[v]] + 1
        value, total = rng.integers(0, 100, n), None
        total = value.copy()
        for v in sorted(range(1, n), key=lambda v: -depth[v]):
            total[up[v]] += total[v]
        for v in sorted(range(n), key=lambda v: depth[v]):
            columns.append((comp, 0, comp * 1000 + v, v, comp * 1000 + up[v] if v else 10**9, up[v] if v else 5, value[v]))
            want.append(total[v])
    x = np.array(columns, np.int64).T
    assert prefix_trie.component_sums(x[:2], x[2:4], x[4:6], x[6:])[0].tolist() == [int(v) for v in want]


# mixing ----------------------------------------------------------------------------------------


def _check(rows, words, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by hand, words near them, whole copies within the bound."""
    sources = sorted({s for _, s, *_ in words}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, k, n in words if k == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    goal, free, rest = {}, set(sources), share * sum(size.values())
    while free:
        part = rest / sum(weight[s] for s in free)
        full = {s for s in free if most * size[s] <= part * weight[s]}
        if not full:
            goal |= {s: part * weight[s] for s in free}
            break
        goal |= {s: most * size[s] for s in full}
        rest -= sum(goal[s] for s in full)
        free -= full
    assert sorted((r["doc_id"], r["size"], r["source_size"]) for r in rows if r["doc_id"] is not None) == sorted((k, n, size[s]) for k, s, n in words if k is not None)
    assert sorted(r["target"] for r in rows) == pytest.approx(sorted(goal[s] for _, s, _ in words))
    assert all(r["taken"] == r["copies"] * r["size"] <= most * r["size"] for r in rows)
    for s in sources:
        mine = [r for r in rows if r["target"] == pytest.approx(goal[s]) and r["source_size"] == size[s]]
        same = sum(1 for o in sources if size[o] == size[s] and goal[o] == pytest.approx(goal[s]))
        assert abs(sum(r["taken"] for r in mine) - same * goal[s]) <= same * max((n for _, k, n in words if k == s), default=0) / 2 + 1e-6


def test_mix(spark, messy, none):
    """Nulls, empty texts and repeated rows; reruns agree; an empty table."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    got = mixing.mix(messy).collect()
    _check(got, [(k, s, len(word.findall(t or ""))) for k, t, _, s, _ in messy_rows()])
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(messy.repartition(5)).collect()))
    assert mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_mix_of_a_hot_source_with_repeats(spark):
    """A third of all rows are one row, another third share the null id; small sources are used up."""
    rng = random.Random(6)
    rows = [(None, "w " * rng.randrange(1, 30), "a") for _ in range(400)] + [(5, "x y z", "a")] * 400
    rows += [(i, "w" + " v" * int(rng.paretovariate(1) % 300), rng.choice(["b", "c", None, "é"])) for i in range(10, 400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6), weights=(1, 5, 1)).collect()
    _check(got, [(k, s, len(t.split())) for k, t, s in rows], weights=(1, 5, 1))


def test_inclusion_is_unequal_and_kept(spark):
    """Documents are taken as often as their inclusion probabilities say, which grow with their size."""
    rows = [(i, "w " * (1, 4, 16, 64)[i % 4], "s") for i in range(8000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.25, most=1.0).collect()
    for size in (1, 4, 16, 64):
        mine = [r for r in got if r["size"] == size]
        assert len({r["chance"] for r in mine}) == 1
        assert sum(r["copies"] for r in mine) / len(mine) == pytest.approx(mine[0]["chance"], abs=0.04)
    assert len({r["chance"] for r in got}) == 4


def test_word_numbers_of_slices():
    import pyarrow as pa

    texts = ["a b", None, "", " \t", "x", "  y\x0bz", " lead", "trail "]
    want = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    array = pa.array(texts, pa.string())
    for at in range(len(texts)):
        assert mixing._words(array.slice(at)).tolist() == want[at:]
