"""Model flows: closed-form agreement, seeded repeatability, label ranges, Word2Vec invariants."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from relevo import models as M
from relevo import schemas as S
from relevo.operators import features
from relevo.plans import flows
from relevo.sources import tables as src

from .conftest import SF_SMALL

HIT = list(flows.HIT_COLS)


@pytest.fixture(scope="module")
def hits(spark):
    feats = features.hit_features(src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL))
    return feats.select(*feats.columns, M.dense_features(*HIT)).cache()


def test_linear_regression_equals_ols(spark, hits):
    model = M.linear(reg_param=0.0, elastic_net=0.8).fit(hits)
    pdf = hits.select(*HIT, S.LABEL).toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf[HIT].to_numpy(float)])
    beta, *_ = np.linalg.lstsq(x, pdf[S.LABEL].to_numpy(float), rcond=None)
    assert model.intercept == pytest.approx(beta[0], abs=1e-8)
    assert list(model.coefficients) == pytest.approx(list(beta[1:]), abs=1e-8)
    coef = {r["term"]: r["value"] for r in M.coefficients(spark, model, HIT).collect()}
    assert coef["intercept"] == pytest.approx(beta[0], abs=1e-8)


def test_train_rmse_not_worse_than_mean(spark, hits):
    model = M.linear(reg_param=0.0, elastic_net=0.8).fit(hits)
    rmse = M.rmse(model.transform(hits)).first()["rmse"]
    std = hits.agg(F.stddev_pop(S.LABEL)).first()[0]
    assert rmse <= std + 1e-12


def test_random_forest_repeatable_and_in_range(spark, hits):
    def run():
        model = M.forest(seed=7, num_trees=5, max_depth=4).fit(hits)
        return sorted((r["id"], r["relevance"]) for r in M.score(model, hits).collect())

    a, b = run(), run()
    assert a == b
    lo, hi = hits.agg(F.min(S.LABEL), F.max(S.LABEL)).first()
    assert all(lo - 1e-9 <= p <= hi + 1e-9 for _, p in a)


def test_hit_rf_submission_scores_every_test_row(spark):
    pairs, descs = src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL)
    sub = flows.hit_rf_submission(pairs, descs, src.is_test_row(F.col(S.ID)), seed=42, stem=False)
    n_test = src.test_pairs(spark, SF_SMALL).count()
    assert sub.columns == [S.ID, S.LABEL]
    assert sub.count() == n_test


def test_train_validation_split_flow(spark):
    pairs, descs = src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL)
    sub = flows.hit_tvs_submission(pairs, descs, src.is_test_row(F.col(S.ID)), seed=42, stem=False,
                                   num_trees=(3, 5))
    assert sub.count() == src.test_pairs(spark, SF_SMALL).count()


def test_word2vec_vocabulary_and_mean_vectors(spark):
    docs = src.parquet(spark, SF_SMALL, "documents").select("doc_id", "text").where("text is not null")
    tok = features.tokenize(docs, "text", "tok").select("doc_id", "tok")
    model = M.word2vec(seed=1, input_col="tok", output_col="vec", min_count=5).fit(tok)
    vectors = {r["word"]: np.array(r["vector"]) for r in model.getVectors().collect()}
    vocab = {r["word"] for r in features.vocabulary(tok, "tok", 5).collect()}
    assert set(vectors) == vocab
    # a document vector is the mean over all its tokens, unknown ones counting as zeros
    row = model.transform(tok).select("tok", vector_to_array("vec").alias("v")).first()
    expected = sum((vectors.get(w, np.zeros(3)) for w in row["tok"]), np.zeros(3)) / max(len(row["tok"]), 1)
    assert np.allclose(row["v"], expected, atol=1e-6)


def test_hashing_tf_sums_to_token_count(spark):
    pairs = src.search_pairs(spark, SF_SMALL).select(S.ID, S.TERM)
    tok = Tokenizer(inputCol=S.TERM, outputCol="w").transform(pairs)
    hashed = HashingTF(inputCol="w", outputCol="tf", numFeatures=20).transform(tok)
    bad = hashed.where(F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, x: a + x)
                       != F.size("w").cast("double")).count()
    assert bad == 0


def test_logistic_on_labels_one_to_three_has_four_classes(spark):
    rows = [(i, f"w{i % 3} x", float(1 + i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, label double")
    model, scored = flows.term_classifier(df, df, num_features=32)
    assert model.stages[-1].numClasses == 4
    assert len(scored.select(M.probabilities()).first()["prob"]) == 4


def test_label_index_frequency_order(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 1.0), (4, 3.0), (5, 3.0)], "id long, relevance double")
    got = {r["relevance"]: r["label"] for r in features.index_labels(df).collect()}
    assert got == {2.0: 0.0, 3.0: 1.0, 1.0: 2.0}


def test_tf_score_linear_flow(spark):
    model, scored = flows.tf_score_linear(src.train_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL))
    assert scored.count() > 0
    assert len(model.coefficients) == 2
    model1, _ = flows.tf_score_linear(src.train_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL),
                                      feature_cols=("values",))
    assert len(model1.coefficients) == 1


def test_ml_idf_equals_relational_formula(spark):
    """IDF weights of the estimator equal ln((m + 1) / (df + 1)) per hashed bucket."""
    from pyspark.ml.feature import IDF

    docs = src.parquet(spark, SF_SMALL, "documents").select("doc_id", "text").where("text is not null")
    tok = features.tokenize(docs, "text", "tok")
    tf = HashingTF(inputCol="tok", outputCol="raw", numFeatures=64).transform(tok).cache()
    idf = IDF(inputCol="raw", outputCol="w").fit(tf).idf.toArray()
    m = tf.count()
    dfreq = (tf.select(F.posexplode(vector_to_array("raw")).alias("bucket", "c"))
             .where("c > 0").groupBy("bucket").count().collect())
    counts = {r["bucket"]: r["count"] for r in dfreq}
    for b in range(64):
        assert idf[b] == pytest.approx(np.log((m + 1.0) / (counts.get(b, 0) + 1.0)), abs=1e-12)


def test_mean_vectors_equal_the_models_transform(spark):
    """Unknown, repeated and missing words; the empty text; n-grams: as the fitted model itself."""
    from relevo.functions import text as T

    rows = [(1, "a b c a"), (2, "a zz"), (3, ""), (4, None), (5, "  "), (6, "a b c a"), (7, " lead  two ")]
    df = spark.createDataFrame(rows * 5, "id long, search_term string")
    for tokens in (T.ml_tokens(S.TERM), flows.ngrams(T.ml_tokens(S.TERM), 2)):
        filled = features.filled(df, S.TERM).withColumn("w", tokens)
        model = M.word2vec(seed=1, input_col="w", output_col="want", min_count=6, num_partitions=1).fit(filled)
        both = flows.embed_terms(model, df, tokens=tokens).withColumn("w", tokens)
        for r in model.transform(both).select(vector_to_array("vec").alias("a"), vector_to_array("want").alias("b")).collect():
            assert np.allclose(r["a"], r["b"], atol=1e-12)
        assert both.count() == len(rows) * 5


def test_ngrams_equal_the_ml_stage(spark):
    from pyspark.ml.feature import NGram

    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    for n in (1, 2, 3):
        rows = NGram(n=n, inputCol="t", outputCol="want").transform(df).select("want", flows.ngrams(F.col("t"), n).alias("got")).collect()
        assert all(r["got"] == r["want"] for r in rows)


def test_vocabulary_bound(spark):
    """Too many words are an error before the fit, with the number in the message."""
    df = spark.createDataFrame([(["a", "b", "c", "a"],)] * 3, "w array<string>")
    est = M.word2vec(seed=1, input_col="w", output_col="v", min_count=3)
    assert M.checked_vocabulary(df, "w", est) == 3
    with pytest.raises(ValueError, match="3 words"):
        M.checked_vocabulary(df, "w", est, most=8)


def test_optimality_tells_a_solution_from_another_point(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = x[:, 0] * 2 - x[:, 1] + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, label double")
    df = df.select("label", M.dense_features("a", "b", "c"))
    good = M.linear(label_col="label", reg_param=0.2, max_iter=500, tol=1e-12).fit(df)
    assert all(r["optimal"] for r in M.optimality(df, good, 0.2, 0.8, label_col="label").collect())
    assert not all(r["optimal"] for r in M.optimality(df, good, 0.25, 0.8, label_col="label").collect())
    other = M.linear(label_col="label", reg_param=0.0).fit(df)
    assert not all(r["optimal"] for r in M.optimality(df, other, 0.2, 0.8, label_col="label").collect())


def test_hashed_search_chooses_and_refits(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(v), float(3 * v + e)) for i, (v, e) in enumerate(zip(rng.normal(size=300), rng.normal(size=300) / 9, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, relevance double").select("id", "relevance", M.dense_features("a"))
    est = M.linear(elastic_net=0.0)
    model, metrics = M.hashed_search(est, M.grid(est.regParam, [5.0, 0.0, 1.0]), df, M.hashed_fold())
    errors = [v for _, v in metrics]
    assert min(errors) == errors[1] and model.getOrDefault("regParam") == 0.0
    assert model.coefficients[0] == pytest.approx(M.linear().fit(df).coefficients[0])
    share = df.where(M.hashed_fold()).count() / 300
    assert 0.1 < share < 0.28


def test_root_split_of_a_single_leaf(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 4, "a double, relevance double").select("relevance", M.dense_features("a"))
    assert M.root_split(spark, M.forest(seed=1, num_trees=1, max_depth=1, bootstrap=False).fit(df), ["a"]).count() == 0
