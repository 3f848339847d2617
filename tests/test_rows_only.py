"""Results of the model queries themselves: exact row counts from the tables, no missing predictions.

Their checked forms are compared with SQL in ``test_oracles``.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from relevo import schemas as S
from relevo.plans import registry
from relevo.sources import tables as src

from .conftest import SF_SMALL


def _expected(spark, name):
    pairs = src.search_pairs(spark, SF_SMALL)
    test = src.test_pairs(spark, SF_SMALL).count()
    return {
        "hit_features_stemmed": pairs.count(),
        "hashed_tf": pairs.count(),
        "term_vectors": pairs.count(),
        "rf_hit_submission": test,
        "tvs_rf_submission": test,
        "corpus_w2v_linear": test,
        "corpus_w2v_forest": test,
        "w2v_indexed_forest": test,
        "ngram_w2v_submission": test,
        "tfidf_linear_scores": test,
        "w2v_linear_scores": test,
        "term_classifier_pairs": test,
        "term_classifier_all_pairs": test,
        "term_classifier_converged": test,
        "tfidf_linear_coefficients": 21,
        "tf_score_linear": src.train_pairs(spark, SF_SMALL).join(
            src.product_descriptions(spark, SF_SMALL), S.PRODUCT).count(),
        "term_classifier": src.parquet(spark, SF_SMALL, "documents").count(),
        "w2v_vectors": registry.QUERIES["w2v_vocabulary"](spark, SF_SMALL).count(),
    }[name]


MODELS = ["hit_features_stemmed", "hashed_tf", "term_vectors", "rf_hit_submission", "tvs_rf_submission",
          "corpus_w2v_linear", "corpus_w2v_forest", "w2v_indexed_forest", "ngram_w2v_submission",
          "tfidf_linear_scores", "w2v_linear_scores", "term_classifier_pairs", "tfidf_linear_coefficients",
          "tf_score_linear", "term_classifier", "w2v_vectors"]


def test_every_query_of_the_library_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL) == set(registry.RESULTS)


@pytest.mark.parametrize("name", MODELS)
def test_model_query(spark, name):
    df = registry.RESULTS[name](spark, SF_SMALL)
    assert df.count() == _expected(spark, name)
    for col in ("prediction", S.LABEL, "value", "values"):
        if col in df.columns and name != "tf_score_linear":
            assert df.where(F.col(col).isNull()).count() == 0, col
