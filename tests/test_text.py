"""Golden rows for the text expressions (hand-made cases) and properties against plain Python."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, Tokenizer
from pyspark.sql import functions as F

from relevo.functions import text as T


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_drops_zero_and_specials(spark):
    assert _one(spark, T.clean("s"), "Angle 10-in. 0.5 x 20\tZinc é") == "Angle 1in 5 x 2\tZinc "


def test_clean_keep_zero(spark):
    assert _one(spark, T.clean("s", keep_zero=True), "10-in.") == "10in"


def test_words_and_glue(spark):
    assert _one(spark, T.words("s"), "  Deck  Stain \n Pro ") == ["deck", "stain", "pro"]
    assert _one(spark, T.glue("s"), "  Deck  Stain \n Pro ") == "deckstainpro"
    assert _one(spark, T.words("s"), "") == []


def test_glue_clean_equals_glue_of_clean(spark):
    s = "Angle 10-in. 0.5 x 20\tZinc é ßtraße"
    assert _one(spark, T.glue_clean("s"), s) == _one(spark, T.glue(T.clean("s")), s)


def test_substring_hit_straddles_words(spark):
    df = spark.createDataFrame([(["deck", "over"], ["decko", "verx"])], "t array<string>, w array<string>")
    r = df.select(T.substring_hits("t", F.array_join("w", "")).alias("r")).first()["r"]
    assert r == 2


def test_duplicate_terms_count_twice(spark):
    df = spark.createDataFrame([(["deck", "deck"], "mydeck")], "t array<string>, b string")
    assert df.select(T.substring_hits("t", "b").alias("r")).first()["r"] == 2


def test_whole_word_hits_and_weighted_tf(spark):
    df = spark.createDataFrame([(["deck", "stain"], ["deck", "deck", "x"], ["stain", "deck"])],
                               "t array<string>, a array<string>, b array<string>")
    r = df.select(T.whole_word_hits("t", "a").alias("h"),
                  T.weighted_tf("t", "a", "b").alias("w")).first()
    assert r["h"] == 2
    assert r["w"] == (2 / 2) * 4.0 + (2 / 2) * 1.0


def test_weighted_tf_empty_terms_is_null(spark):
    df = spark.createDataFrame([([], ["a"], ["b"])], "t array<string>, a array<string>, b array<string>")
    assert df.select(T.weighted_tf("t", "a", "b").alias("w")).first()["w"] is None


def test_null_text_does_not_crash(spark):
    df = spark.createDataFrame([(None,)], "s string")
    r = df.select(T.words(F.coalesce("s", F.lit(""))).alias("w")).first()["w"]
    assert r == []


def test_tokenizer_semantics(spark):
    df = spark.createDataFrame([(" Deck  Stain ",), ("",), (" ",)], "s string")
    ml = Tokenizer(inputCol="s", outputCol="t").transform(df).select("t").collect()
    ours = df.select(T.ml_tokens("s").alias("t")).collect()
    assert [r["t"] for r in ml] == [["", "deck", "", "stain"], [""], []]
    assert [r["t"] for r in ours] == [r["t"] for r in ml]


def test_ngram_on_short_input(spark):
    df = spark.createDataFrame([([""],)], "w array<string>")
    assert NGram(n=2, inputCol="w", outputCol="g").transform(df).first()["g"] == []


def test_info_takes_null_as_empty(spark):
    df = spark.createDataFrame([("t", None, "d", "s")], "a string, b string, c string, d string")
    assert df.select(T.info("a", "b", "c", "d").alias("i")).first()["i"] == "t  d s"


_text = st.text(alphabet=st.sampled_from(list("abcAB19 0-.\t\nxyz")), max_size=30)


@settings(max_examples=40, deadline=None, derandomize=True)
@given(terms=_text, words=_text)
def test_substring_hits_match_python(spark, terms, words):
    def py(terms, words):
        clean = lambda s: re.sub(r"[^a-zA-Z1-9\s]", "", s, flags=re.ASCII)
        t = clean(terms).lower().split()
        sentence = "".join(clean(words).lower().split())
        return len(t), sum(int(sentence.find(x) >= 0) for x in t)

    df = spark.createDataFrame([(terms, words)], "t string, w string")
    r = df.select(T.words(T.clean("t")).alias("tt"), T.glue_clean("w").alias("b")).select(
        T.term_len("tt").alias("n"), T.substring_hits("tt", "b").alias("h")).first()
    n, h = py(terms, words)
    assert (r["n"], r["h"]) == (n, h)
    assert 0 <= r["h"] <= r["n"]


_words_text = st.text(alphabet=st.sampled_from(list("abcAB ,.\n")), max_size=25)


@settings(max_examples=40, deadline=None, derandomize=True)
@given(term=_words_text, title=_words_text, desc=_words_text)
def test_weighted_tf_matches_python_loop(spark, term, title, desc):
    """The projection equals the per-row loop it replaces (None where the loop divides by zero)."""
    def py(term, title, desc):
        words = term.split()
        n = len(words)
        if n == 0:
            return None
        s1 = sum(title.lower().split().count(w.lower()) for w in words) / (1.0 * n)
        s2 = sum(desc.lower().split().count(w.lower()) for w in words) / (1.0 * n)
        return s1 * 4.0 + s2 * 1.0

    df = spark.createDataFrame([(term, title, desc)], "t string, i string, d string")
    got = df.select(T.weighted_tf(T.words("t"), T.words("i"), T.words("d")).alias("w")).first()["w"]
    assert got == py(term, title, desc)


@settings(max_examples=40, deadline=None, derandomize=True)
@given(s=st.text(alphabet=st.sampled_from(list("aB \t\n")), max_size=12))
def test_ml_tokens_match_java_split(spark, s):
    """Tokenizer semantics: split on single whitespace, trailing empties dropped, '' -> ['']."""
    def py(s):
        parts = re.split(r"[ \t\n\x0b\f\r]", s.lower())
        if s == "":
            return [""]
        while parts and parts[-1] == "":
            parts.pop()
        return parts

    df = spark.createDataFrame([(s,)], "s string")
    ml = Tokenizer(inputCol="s", outputCol="t").transform(df).first()["t"]
    assert ml == py(s)
    assert df.select(T.ml_tokens("s").alias("t")).first()["t"] == ml


@settings(max_examples=25, deadline=None, derandomize=True)
@given(terms=_text, words=_text)
def test_substring_hits_keep_zero_match_python(spark, terms, words):
    """The keep-zero variant keeps the digit 0 in both the terms and the glued words."""
    def py(terms, words):
        clean = lambda s: re.sub(r"[^a-zA-Z0-9\s]", "", s, flags=re.ASCII)
        t = clean(terms).lower().split()
        sentence = "".join(clean(words).lower().split())
        return len(t), sum(int(sentence.find(x) >= 0) for x in t)

    df = spark.createDataFrame([(terms, words)], "t string, w string")
    r = df.select(T.words(T.clean("t", keep_zero=True)).alias("tt"),
                  T.glue_clean("w", keep_zero=True).alias("b")).select(
        T.term_len("tt").alias("n"), T.substring_hits("tt", "b").alias("h")).first()
    assert (r["n"], r["h"]) == py(terms, words)
