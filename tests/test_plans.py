"""Plan shape: no Python in the hit-feature plan, pruned scans, hot products split across tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from relevo import schemas as S
from relevo.operators import features
from relevo.sources import tables as src

from .conftest import SF_SMALL

SF_LARGE = "/root/testdata/sf0.1"


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hit_features_plan_has_no_python(spark):
    df = features.hit_features(src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL))
    plan = _physical(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_stemming_runs_python_only_on_the_vocabulary(spark):
    df = features.hit_features(src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL),
                               stem=True)
    # The stem table is materialised before the feature plan; the feature plan itself has no Python.
    plan = _physical(df)
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_scans_read_only_needed_columns(spark):
    df = features.hit_features(src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL))
    plan = _physical(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_discount:double>" in plan
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_hot_product_is_split_across_tasks(spark):
    """A product holding a third of all pairs: AQE splits its join partition (no broadcast here)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        pairs = src.search_pairs(spark, SF_LARGE)
        skewed = pairs.withColumn(S.PRODUCT, F.when(F.col(S.ID) % 3 == 0, F.lit(7)).otherwise(F.col(S.PRODUCT)))
        df = features.hit_features(skewed, src.product_descriptions(spark, SF_LARGE))
        df.collect()
        assert "SortMergeJoin(skew=true)" in _physical(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hit(spark):
    return features.hit_features(src.search_pairs(spark, SF_LARGE), src.product_descriptions(spark, SF_LARGE))


def _weighted(spark):
    return features.weighted_tf_score(src.search_pairs(spark, SF_LARGE), src.product_descriptions(spark, SF_LARGE))


def _hit_stemmed(spark):
    return features.hit_features(src.search_pairs(spark, SF_LARGE), src.product_descriptions(spark, SF_LARGE),
                                 stem=True)


def _corpus(spark):
    from relevo.plans import flows

    train, test = src.train_test(spark, SF_LARGE)
    return flows.corpus_info(train, test, src.attributes(spark, SF_LARGE), src.product_descriptions(spark, SF_LARGE))


@pytest.mark.parametrize("build", [_hit, _hit_stemmed, _weighted, _corpus],
                         ids=["hit_features", "hit_features_stemmed", "weighted_tf", "corpus_info"])
def test_hot_product_in_the_source_is_split(spark, monkeypatch, build):
    """Skew already in lineitem: the title and description joins share one partitioning, so the
    split needs AQE's forced skew handling (turned on by every registered query).

    AQE judges skew by shuffle bytes, which are compressed: the hot product's rows repeat the same
    title and key, so the thresholds are set low enough for this small table."""
    from relevo.session import apply_skew_conf

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    orig = src.parquet

    def skewed_parquet(spark_, sf_dir, table):
        df = orig(spark_, sf_dir, table)
        if table == "lineitem":
            df = df.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7))
                               .otherwise(F.col("l_partkey")))
        return df

    monkeypatch.setattr(src, "parquet", skewed_parquet)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        apply_skew_conf(spark)
        df = build(spark)
        rows = df.count()
        df.collect()
        assert rows == df.count()
        assert _physical(df).split("== Initial Plan ==")[0].count("skew=true") >= 1
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hits_pre_join_equal_post_join(spark):
    """Normalising product text once per product gives the same features as per pair after the join."""
    from relevo.functions import text as T

    pairs, descs = src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL)
    ours = {r["id"]: (r["term_len"], r["tf_title"], r["tf_desc"])
            for r in features.hit_features(pairs, descs).collect()}
    joined = pairs.join(descs, S.PRODUCT, "left").withColumn(
        S.DESCRIPTION, F.coalesce(S.DESCRIPTION, F.lit(S.MISSING_TEXT)))
    terms = T.words(T.clean(S.TERM))
    post = joined.select(S.ID, terms.alias("t"),
                         F.array_join(T.words(T.clean(S.TITLE)), "").alias("ti"),
                         F.array_join(T.words(T.clean(S.DESCRIPTION)), "").alias("d"))
    post = post.select(S.ID, F.size("t").alias("a"), T.substring_hits("t", "ti").alias("b"),
                       T.substring_hits("t", "d").alias("c"))
    assert {r["id"]: (r["a"], r["b"], r["c"]) for r in post.collect()} == ours


def test_one_exchange_per_product_side_aggregate(spark):
    from relevo.operators import tables

    flat = tables.flatten_attributes(src.attributes(spark, SF_SMALL))
    flat.collect()
    plan = _physical(flat).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ObjectHashAggregate" in plan or "SortAggregate" in plan
