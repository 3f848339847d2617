"""NULLs, unseen values, hot and repeated keys, and results that do not depend on the machine."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from relevo import models as M
from relevo import schemas as S
from relevo.operators import features, tables
from relevo.plans import flows
from relevo.sinks.csv import write_csv
from relevo.sources.csv import read_csv, read_search_tables

TERMS = ["red chair", "blue sofa", "green lamp", None, "oak table", ""]


def _pairs(spark, n=60, null_title=False):
    rows = [(i, i % 7, None if null_title and i % 5 == 0 else f"title {i % 4}", TERMS[i % 6], 1.0 + i % 3) for i in range(n)]
    return spark.createDataFrame(rows, f"{S.ID} long, {S.PRODUCT} long, {S.TITLE} string, {S.TERM} string, {S.LABEL} double")


def _texts(spark):
    attrs = spark.createDataFrame([(k, "colour", "red") for k in range(5)], f"{S.PRODUCT} long, {S.ATTR_NAME} string, {S.ATTR_VALUE} string")
    desc = spark.createDataFrame([(k, f"a red chair or lamp {k}") for k in range(6)], f"{S.PRODUCT} long, {S.DESCRIPTION} string")
    return attrs, desc


def _labelled(df):
    return df.select(S.PRODUCT, S.TERM, F.col(S.LABEL).alias("label"))


def test_null_terms_and_titles_in_every_flow(spark):
    train = _pairs(spark, null_title=True)
    test = train.drop(S.LABEL)
    attrs, desc = _texts(spark)
    n = train.count()
    text = train.select(S.ID, F.col(S.TERM).alias("text"), F.col(S.LABEL).cast("int").alias("label"))
    assert flows.term_classifier(text, text)[1].count() == n
    assert flows.tfidf_linear(_labelled(train), test)[1].count() == n
    assert flows.w2v_linear(_labelled(train), test, seed=1)[1].count() == n
    assert flows.ngram_w2v_submission(train, test, seed=1).count() == n
    model = flows.corpus_embedding(spark, flows.corpus_info(train, test, attrs, desc), seed=1, min_count=1)
    for learner in ("linear", "forest"):
        assert flows.corpus_w2v_submission(spark, train, test, attrs, desc, seed=1, learner=learner, model=model).count() == n


def test_indexed_forest_scores_an_unseen_term(spark):
    train = _pairs(spark).where(F.col(S.TERM).isNotNull())
    test = spark.createDataFrame([(1, 1, "t", "purple carpet chair")], f"{S.ID} long, {S.PRODUCT} long, {S.TITLE} string, {S.TERM} string")
    attrs, desc = _texts(spark)
    model = flows.corpus_embedding(spark, flows.corpus_info(train, train, attrs, desc), seed=1, min_count=1)
    assert flows.indexed_forest_submission(spark, train, test, attrs, desc, seed=1, model=model).count() == 1


@pytest.mark.parametrize("parts", [1, 5])
def test_word_vectors_do_not_depend_on_the_input_partitioning(spark, parts):
    words = [[f"w{(i * j) % 11}" for j in range(1, 9)] for i in range(200)]
    rows = spark.createDataFrame([(w,) for w in words], "tok array<string>")

    def fit(df):
        model = M.word2vec(seed=3, input_col="tok", output_col="v", num_partitions=1).fit(flows.pinned(df, "tok", 1))
        return {r["word"]: r["v"] for r in model.getVectors().select("word", vector_to_array("vector").alias("v")).collect()}

    assert fit(rows.repartition(parts)) == fit(rows.repartition(3))


def test_training_tasks_are_not_taken_from_the_machine(spark):
    assert M.word2vec(seed=1, input_col="a", output_col="b").getNumPartitions() == M.W2V_PARTITIONS
    assert flows.pinned(spark.range(50).select(F.array(F.col("id").cast("string")).alias("t")), "t").rdd.getNumPartitions() == M.W2V_PARTITIONS


def test_rows_without_a_key_do_not_meet(spark):
    attrs = spark.createDataFrame([(None, "a", "x"), (None, "b", "y"), (1, "a", "z")], f"{S.PRODUCT} long, {S.ATTR_NAME} string, {S.ATTR_VALUE} string")
    assert [tuple(r) for r in tables.flatten_attributes(attrs).collect()] == [(1, "z")]


def test_two_descriptions_of_a_product_give_two_rows_in_both_forms(spark):
    pairs = spark.createDataFrame([(1, 7, "t", "chair", 1.0)], f"{S.ID} long, {S.PRODUCT} long, {S.TITLE} string, {S.TERM} string, {S.LABEL} double")
    desc = spark.createDataFrame([(7, "a chair"), (7, "one chair more"), (None, "chair")], f"{S.PRODUCT} long, {S.DESCRIPTION} string")
    for stem in (False, True):
        assert [r["tf_desc"] for r in features.hit_features(pairs, desc, stem=stem).collect()] == [1, 1]


def test_wide_order_splits_a_hot_product(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias(S.PRODUCT), F.col("id").alias(S.ID))
    sizes = rows.repartitionByRange(8, S.PRODUCT, S.ID).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 8_000


def test_csv_keeps_empty_and_missing_apart_and_splits(spark, scratch):
    rows = spark.createDataFrame([(1, "", "a"), (2, None, 'q"uo,te'), (3, " x ", "")], "id long, a string, b string")
    write_csv(rows, f"{scratch}/t")
    for strict in (True, False):
        back = read_csv(spark, f"{scratch}/t", schema=rows.schema, strict=strict)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    write_csv(spark.range(20_000).select("id", F.repeat(F.lit("x"), 100).alias("t")).coalesce(1), f"{scratch}/big")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert read_csv(spark, f"{scratch}/big").rdd.getNumPartitions() > 4
        assert read_csv(spark, f"{scratch}/big", multi_line=True).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_integer_labels_and_missing_tables(spark, scratch):
    rows = [(1, 7, "t", "chair", 1.0), (2, 7, "t", "sofa", 2.33)]
    write_csv(spark.createDataFrame(rows, S.TRAIN).withColumn(S.LABEL, F.when(F.col(S.ID) == 1, "1").otherwise("2.33")), f"{scratch}/train.csv")
    found = read_search_tables(spark, scratch, tables=["train"], label_as="int")["train"]
    assert [(r[S.ID], r[S.LABEL]) for r in found.collect()] == [(1, 1)]
    assert read_search_tables(spark, scratch, tables=["train"])["train"].count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_search_tables(spark, scratch, tables=["test"])["test"].count()
