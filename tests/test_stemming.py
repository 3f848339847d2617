"""Stemmer word list and the stemmed hit features against a brute-force Python computation."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
import pytest

from relevo.functions.porter2 import stem
from relevo.operators import features, stemming
from relevo.sources import tables as src

from .conftest import SF_MID, SF_SMALL

WORDS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "generalization": "general", "empty": "empti", "running": "run",
    "generously": "generous", "consigned": "consign", "knightly": "knight", "cries": "cri",
    "gas": "gas", "gaps": "gap", "kiwis": "kiwi", "hoping": "hope", "controlling": "control",
    "rational": "ration", "electricity": "electr", "hopeful": "hope", "goodness": "good",
    "adjustment": "adjust", "communication": "communic", "arsenal": "arsenal", "yellow": "yellow",
    "enjoying": "enjoy", "polished": "polish", "anodized": "anod", "economy": "economi",
    "skies": "sky", "dying": "die", "news": "news", "proceed": "proceed", "succeeded": "succeed",
    "a": "a", "is": "is",
}


def test_word_list():
    assert {w: stem(w) for w in WORDS} == WORDS


def test_stem_never_longer_than_word():
    for w in list(WORDS) + ["deck", "stain", "brass", "widget", "gizmo", "standard"]:
        assert len(stem(w)) <= len(w)


def _py_stemmed_hits(sf_dir):
    """Reference semantics in plain Python: clean, lower, split, stem per word, glue, find."""
    part = pq.read_table(f"{sf_dir}/part.parquet").to_pandas().set_index("p_partkey")
    li = pq.read_table(f"{sf_dir}/lineitem.parquet").to_pandas()
    docs = pq.read_table(f"{sf_dir}/documents.parquet").to_pandas().set_index("doc_id")["text"]
    li["id"] = li.l_orderkey * 10 + li.l_linenumber
    g = li.groupby("id").agg(pu=("l_partkey", "min"), sk=("l_suppkey", "min"))
    clean = lambda s: re.sub(r"[^a-zA-Z1-9\s]", "", s, flags=re.ASCII)
    stems: dict[str, str] = {}

    def tok(s):
        return [stems.setdefault(w, stem(w)) for w in s.lower().split()]

    blobs: dict[int, str] = {}
    out = {}
    for pid, r in g.iterrows():
        if r.pu not in part.index or r.sk not in part.index:
            continue
        p, s = part.loc[r.pu], part.loc[r.sk]
        title = " ".join([p.p_brand, p.p_type, p.p_name])
        which = pid % 3
        term = s.p_name if which == 0 else (
            " ".join([s.p_name, s.p_type]) if which == 1 else " ".join([s.p_brand, s.p_name, s.p_type]))
        if r.pu not in blobs:
            desc = docs.get(r.pu)
            blobs[r.pu] = "".join(tok(clean("empty" if desc is None else desc)))
        terms, t_blob, d_blob = tok(clean(term)), "".join(tok(clean(title))), blobs[r.pu]
        out[pid] = (len(terms), sum(int(t_blob.find(t) >= 0) for t in terms),
                    sum(int(d_blob.find(t) >= 0) for t in terms))
    return out


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID])
def test_stemmed_hits_match_brute_force(spark, sf_dir):
    got = features.hit_features(src.search_pairs(spark, sf_dir), src.product_descriptions(spark, sf_dir),
                                stem=True).collect()
    want = _py_stemmed_hits(sf_dir)
    assert len(got) == len(want)
    for r in got:
        assert (r["term_len"], r["tf_title"], r["tf_desc"]) == want[r["id"]], r["id"]


def test_stemmed_hits_without_broadcast(spark, monkeypatch):
    """Above the broadcast limit the stem table is joined by shuffle; results are the same."""
    pairs, descs = src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL)
    a = sorted(features.hit_features(pairs, descs, stem=True).collect())
    orig = stemming.prepared_stems
    monkeypatch.setattr(stemming, "prepared_stems",
                        lambda *frames, limit_bytes=0, dictionary=None: orig(*frames, limit_bytes=0, dictionary=dictionary))
    b = sorted(features.hit_features(pairs, descs, stem=True).collect())
    assert a == b


def test_only_exceptions_are_kept(spark):
    """Words that are their own stem need no row: they are joined to nothing and stay as they are."""
    df = spark.createDataFrame([("running cats run cat the the",), ("the cat",)], "t string")
    found = stemming.prepared_stems(stemming.explode_words(df, [], "t"))
    assert found.small and sorted(map(tuple, found.table.collect())) == [("cats", "cat"), ("running", "run")]


@pytest.mark.parametrize("small", [True, False])
def test_regrouping_with_a_hot_word(spark, small):
    """A word that fills most texts; positions come back in order, repeated words included."""
    rows = [(i, "the " * 200 + f"running {'cats ' * (i % 3)}word{i} the") for i in range(60)] + [(99, ""), (98, " ")]
    df = spark.createDataFrame(rows, "k long, t string").repartition(4)
    stems = stemming.prepared_stems(stemming.explode_words(df, ["k"], "t"), limit_bytes=1 << 20 if small else 0)
    assert stems.small == small
    found = stemming.regrouped(df, ["k"], "t", stems, "s")
    got = {r["k"]: r["s"] for r in found.collect()}
    from relevo.functions import porter2

    assert got == {k: [porter2.stem(w) for w in t.split()] for k, t in rows}
    if not small:
        # distinct words are shuffled, not tokens: the join's input has one row a text and word
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join LeftOuter") < plan.index("collect_list(_pos")


def test_stem_table_is_distinct_vocabulary(spark):
    df = spark.createDataFrame([("running",), ("running",), ("cats",), (None,)], "_tok string")
    rows = sorted(tuple(r) for r in stemming.stem_table(df).collect())
    assert rows == [("cats", "cat"), ("running", "run")]


@pytest.mark.parametrize("text,expected", [("Empty", "empti"), ("Running cats", "runcat")])
def test_default_text_is_normalised(text, expected):
    assert "".join(stemming.stem_text_constant(text)) == expected


def test_stemmed_words_by_key_keeps_order(spark):
    df = spark.createDataFrame([(1, "Running cats jumped"), (2, ""), (3, None)], "k long, t string")
    got = {r["k"]: r["s"] for r in stemming.stemmed_words_by_key(df, "k", "t", "s").collect()}
    assert got == {1: ["run", "cat", "jump"], 2: []}
    glued = {r["k"]: r["s"] for r in stemming.stemmed_words_by_key(df, "k", "t", "s", glue=True).collect()}
    assert glued == {1: "runcatjump", 2: ""}


def test_stem_dictionary_grows_and_gives_same_features(spark, scratch):
    """A persistent dictionary: first job writes every word, a second job adds only new ones."""
    import os

    path = os.path.join(scratch, "stems")
    a = spark.createDataFrame([("running",), ("cats",)], "_tok string")
    b = spark.createDataFrame([("cats",), ("jumped",)], "_tok string")
    first = sorted(tuple(r) for r in stemming.dictionary_stems(a, dictionary=path).collect())
    assert first == [("cats", "cat"), ("running", "run")]
    second = sorted(tuple(r) for r in stemming.dictionary_stems(b, dictionary=path).collect())
    assert second == [("cats", "cat"), ("jumped", "jump")]
    assert spark.read.parquet(path).count() == 3
    pairs, descs = src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL)
    plain = sorted(features.hit_features(pairs, descs, stem=True).collect())
    dict_path = os.path.join(scratch, "dict")
    with_dict = sorted(features.hit_features(pairs, descs, stem=True, stem_dictionary=dict_path).collect())
    again = sorted(features.hit_features(pairs, descs, stem=True, stem_dictionary=dict_path).collect())
    assert plain == with_dict == again
