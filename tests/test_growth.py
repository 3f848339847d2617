"""Work that grows with the tables: product text is handled once a product, not once a pair."""
from __future__ import annotations

from pyspark.sql import functions as F

from relevo import schemas as S
from relevo.operators import features, tables
from relevo.plans import flows


def test_kept_words_of_products_equal_those_of_every_pair(spark):
    """Blank and missing terms, last empty words, texts of white space, repeated products and titles."""
    pairs = [(1, "the Red  door ", "a door"), (1, "the Red  door ", "  "), (1, "the Red  door ", ""), (1, "other", " The x  "),
             (2, "", ""), (2, "", "the"), (2, None, "k\tm"), (3, "t", None), (None, "t", "u"), (4, " ", " "), (1, "other", " The x  ")]
    train = spark.createDataFrame(pairs[:6], f"{S.PRODUCT} long, {S.TITLE} string, {S.TERM} string")
    test = spark.createDataFrame(pairs[6:], train.schema)
    attrs = spark.createDataFrame([(1, "a", "with it"), (2, "a", None), (4, "b", "")], f"{S.PRODUCT} long, {S.ATTR_NAME} string, {S.ATTR_VALUE} string")
    descs = spark.createDataFrame([(1, "long text and\n\n"), (1, "second"), (2, " \t "), (4, ""), (None, "n")], f"{S.PRODUCT} long, {S.DESCRIPTION} string")
    tok = features.tokenize(flows.corpus_info(train, test, attrs, descs), "info", "tok").drop("info")
    want = tables.drop_incomplete(features.remove_stop_words(tok, "tok", "kept").drop("tok")).select(S.PRODUCT, S.TERM, F.size("kept").alias("n_kept"))
    got = flows.corpus_kept_words(train, test, attrs, descs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert S.DESCRIPTION not in got._jdf.queryExecution().optimizedPlan().toString()  # pairs meet counts, no text


def test_stemmed_pairs_are_not_joined_to_phrases(spark):
    """Cleaned texts are stemmed in place: one join, with the descriptions, and the same stems as the vocabulary's."""
    from relevo.functions import porter2
    from relevo.functions import text as T
    from relevo.operators import stemming

    rows = [(1, 7, "Running CATS 10\tft", "the cat's run", 1.0), (2, 7, "", None, 2.0), (3, 8, None, "x", 1.0), (4, None, "Dogs", "dog", 3.0)] * 2
    pairs = spark.createDataFrame(rows, f"{S.ID} long, {S.PRODUCT} long, {S.TITLE} string, {S.TERM} string, {S.LABEL} double")
    descs = spark.createDataFrame([(7, "Cats were running\x0bfast"), (7, None), (7, "run"), (None, "dog"), (8, "")], f"{S.PRODUCT} long, {S.DESCRIPTION} string")
    df = features.hit_features(pairs, descs, stem=True)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    key = [S.ID, "term_len", "tf_title", "tf_desc"]
    got = sorted(tuple(r[c] for c in key) for r in df.collect())
    assert got == sorted([(1, 3, 2, 2), (1, 3, 2, 1), (2, 0, 0, 0), (2, 0, 0, 0), (3, 1, 0, 0), (4, 1, 1, 0)] * 2)
    texts = descs.where(f"{S.DESCRIPTION} is not null").select(T.clean(S.DESCRIPTION).alias("t"))
    for r in texts.select("t", stemming.cleaned_stems("t", T.CLEAN_PATTERN, " ").alias("s")).collect():
        assert r["s"].split() == [porter2.stem(w) for w in r["t"].lower().split()]


def test_documents_by_key_have_bounded_partitions(spark, monkeypatch):
    """Twice the text gives twice the partitions once it is more than the session's partitions hold."""
    docs = spark.createDataFrame([(i % 90, "ab cd" * 20) for i in range(100)], "doc_id long, text string")
    monkeypatch.setattr(features, "KEYED_BYTES", 100)
    assert [features.documents_by_key(docs, "doc_id", n).rdd.getNumPartitions() for n in (3000, 6000)] == [30, 60]
    found = features.tfidf_table(features.tokenize(features.documents_by_key(docs, "doc_id", 6000), "text", "tok"), "doc_id", "tok", 100)
    assert found.groupBy("doc_id").count().count() == 90
    joins = found._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in joins


def test_pairs_meet_their_products_as_bare_keys(spark, scratch, monkeypatch):
    """Repeated and null keys: the same pairs whether the searched parts are small or not."""
    from relevo.sources import tables as src

    lines = [(1, 1, 2, 1, 0.1), (1, 1, 3, 1, 0.05), (2, 2, 1, 2, 0.0), (3, None, 1, 1, 0.1), (4, 1, None, 1, 0.1), (5, 3, 9, 1, 0.1), (6, 2, 2, 1, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double").write.parquet(f"{scratch}/lineitem.parquet")
    parts = [(1, "bolt", "b1", "T1"), (2, "nut", "b2", "T2"), (2, "nut two", "b3", None), (3, "x", "y", "z"), (None, "n", "n", "n")]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{scratch}/part.parquet")
    small = src.search_pairs(spark, scratch)
    assert "strategy=broadcast" in small._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(src, "broadcast_if_small", lambda table, *cols: table)
    key = [S.ID, S.PRODUCT, S.TITLE, S.TERM, S.LABEL]
    large = sorted(map(str, src.search_pairs(spark, scratch).select(*key).collect()))
    assert sorted(map(str, small.select(*key).collect())) == large and len(large) == 8
