"""Registered queries (Spark) and their oracle SQL (DuckDB), keyed by name.

Each query takes (spark, sf_dir) and returns a DataFrame over the whole driver tables. Column
names and types match the SQL so results can be compared by value. Queries without SQL are
seeded model flows (rows-only check; their tests carry the proof).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.feature import HashingTF
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from relevo import models as M
from relevo import oracle as O
from relevo import schemas as S
from relevo.functions import text as T
from relevo.operators import features, tables
from relevo.plans import flows
from relevo.session import apply_skew_conf, materialize, shared_path
from relevo.sinks import csv as sink
from relevo.sources import csv as csv_src
from relevo.sources import tables as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RESULTS: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
SEED = 42
HIT = list(flows.HIT_COLS)


def register(name: str, sql: str | None = None, check: Callable[[DataFrame], DataFrame] | None = None):
    """Register a query; it runs with AQE skew-join splitting turned on for its session.

    AQE reads these settings when the result is computed, so they stay set. ``check`` turns a result
    that SQL cannot compute (a fitted model's) into rows that SQL can state: keys and whether the
    values keep their range. ``QUERIES`` has the checked form, ``RESULTS`` the result itself.
    """
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_skew_conf(spark)
            return fn(spark, sf_dir)

        RESULTS[name] = run
        QUERIES[name] = run if check is None else lambda spark, sf_dir: check(run(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _keeps(flag: str, test: str, *keys: str) -> Callable[[DataFrame], DataFrame]:
    """A check: the keys, and a flag whether the SQL test holds (NULL counts as no)."""
    return lambda df: df.selectExpr(*keys, f"coalesce({test}, false) AS {flag}")


def _finite(col: str) -> str:
    return f"NOT isnan({col}) AND abs({col}) < double('infinity')"


#: The labels' range; averages of labels stay inside.
_IN_LABELS = f"{S.LABEL} BETWEEN 1.0 AND 3.0"
_TEST_TRUE = "SELECT id, true AS {} FROM test"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; a NULL text is empty."""
    return features.filled(src.documents(spark, sf_dir).select("doc_id", "text"), "text")


def _doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.tokenize(_docs(spark, sf_dir), "text", "tok").select("doc_id", "tok")


def _scratch(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "relevo-csv", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")


# --- base tables, joins, aggregation, set operations ------------------------------------------

@register("pairs", O.with_(O.PAIRS) + "SELECT * FROM pairs")
def q_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.search_pairs(spark, sf_dir)


@register("attributes_flat", O.with_(O.ATTRIBUTES, O.ATTR_FLAT_SPACE) + "SELECT * FROM attr_flat")
def q_attributes_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.flatten_attributes(src.attributes(spark, sf_dir), sep=" ", out="attr_list")


@register("wide_table", O.with_(O.PAIRS, O.ATTRIBUTES, O.ATTR_FLAT_COMMA, O.DESCRIPTIONS) + """
SELECT q.product_uid, q.search_term, q.product_title, a.value_list, d.product_description, q.relevance
FROM pairs q LEFT JOIN attr_values a ON a.product_uid = q.product_uid
             LEFT JOIN descriptions d ON d.product_uid = q.product_uid""")
def q_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.wide_training_table(src.search_pairs(spark, sf_dir), src.attributes(spark, sf_dir),
                                     src.product_descriptions(spark, sf_dir))


@register("union_pairs", O.with_(O.PAIRS, O.TRAIN, O.TEST) + """
SELECT product_uid, product_title, search_term FROM train
UNION ALL SELECT product_uid, product_title, search_term FROM test""")
def q_union_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [S.PRODUCT, S.TITLE, S.TERM]
    train, test = src.train_test(spark, sf_dir)
    return tables.union_pairs(train.drop(S.LABEL).select(*cols), test.drop(S.ID).select(*cols))


@register("corpus_info", O.with_(O.PAIRS, O.TRAIN, O.TEST, O.ATTRIBUTES, O.ATTR_FLAT_SPACE, O.DESCRIPTIONS) + """
SELECT u.product_uid, u.search_term,
       u.product_title || ' ' || coalesce(a.attr_list, 'empty') || ' '
         || coalesce(d.product_description, 'empty') || ' ' || u.search_term AS info
FROM (SELECT product_uid, product_title, search_term FROM train
      UNION ALL SELECT product_uid, product_title, search_term FROM test) u
LEFT JOIN attr_flat a ON a.product_uid = u.product_uid
LEFT JOIN descriptions d ON d.product_uid = u.product_uid""")
def q_corpus_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = src.train_test(spark, sf_dir)
    return flows.corpus_info(train, test, src.attributes(spark, sf_dir), src.product_descriptions(spark, sf_dir))


@register("stage1_join", O.with_(O.PAIRS, O.DESCRIPTIONS) + """
SELECT CAST(q.product_uid AS VARCHAR) AS prod_uid, q.product_title AS title,
       q.search_term AS search, CAST(q.relevance AS VARCHAR) AS rel, d.product_description AS "desc"
FROM pairs q JOIN descriptions d ON d.product_uid = q.product_uid""")
def q_stage1_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless all-string CSV tables, renamed by position, joined through SQL views."""
    train_path, desc_path = _scratch(spark, "train"), _scratch(spark, "descriptions")
    sink.write_csv(src.search_pairs(spark, sf_dir), train_path, header=False)
    sink.write_csv(src.product_descriptions(spark, sf_dir), desc_path, header=False)
    return flows.stage1_join(spark, csv_src.read_csv(spark, train_path, header=False),
                             csv_src.read_csv(spark, desc_path, header=False, multi_line=True))  # texts hold line breaks


@register("csv_roundtrip", O.with_(O.PAIRS) + "SELECT * FROM pairs")
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-part CSV with a header, ordered by id; typed strict read back."""
    path = _scratch(spark, "pairs")
    sink.write_csv(src.search_pairs(spark, sf_dir), path, order_by=[S.ID])
    return csv_src.read_csv(spark, path, schema=S.TRAIN, strict=True)


@register("row_counts", O.with_(O.PAIRS, O.TRAIN, O.TEST, O.ATTRIBUTES, O.DESCRIPTIONS) + """
SELECT 'pairs' AS "table", count(*) AS n FROM pairs
UNION ALL SELECT 'train', count(*) FROM train
UNION ALL SELECT 'test', count(*) FROM test
UNION ALL SELECT 'attributes', count(*) FROM attributes
UNION ALL SELECT 'product_descriptions', count(*) FROM descriptions""")
def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table, n) for the logical tables; pairs, train and test come from one pass over the pairs."""
    test = src.is_test_row(F.col(S.ID))
    split = (src.search_pairs(spark, sf_dir)
             .agg(F.count(F.lit(1)).alias("pairs"), F.count(F.when(~test, 1)).alias("train"),
                  F.count(F.when(test, 1)).alias("test"))
             .select(F.expr("stack(3, 'pairs', pairs, 'train', train, 'test', test) AS (`table`, n)")))
    return (split.unionByName(tables.row_count(src.attributes(spark, sf_dir), "attributes"))
            .unionByName(tables.row_count(src.product_descriptions(spark, sf_dir), "product_descriptions")))


@register("top_pairs", O.with_(O.PAIRS) + "SELECT * FROM pairs ORDER BY product_uid, id LIMIT 10")
def q_top_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k preview: the first 10 pairs by (product_uid, id)."""
    return tables.ordered_limit(src.search_pairs(spark, sf_dir), 10, S.PRODUCT, S.ID)


# --- text features ------------------------------------------------------------------------------

@register("hit_features", O.with_(O.PAIRS, O.DESCRIPTIONS, O.hit_features_sql()) + "SELECT * FROM features")
def q_hit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.hit_features(src.search_pairs(spark, sf_dir),
                                 src.product_descriptions(spark, sf_dir))


@register("hit_features_stemmed", O.with_(O.PAIRS, O.DESCRIPTIONS, O.hit_features_sql()) + "SELECT id, term_len, true AS hits_in_range FROM features",
          _keeps("hits_in_range", "tf_title BETWEEN 0 AND term_len AND tf_desc BETWEEN 0 AND term_len", S.ID, "term_len"))
def q_hit_features_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.hit_features(src.search_pairs(spark, sf_dir),
                                 src.product_descriptions(spark, sf_dir), stem=True)


def _weighted_sql(more: str | None = None, pairs: str = "pairs") -> str:
    def hits(words_col: str) -> str:
        return f"list_sum(list_transform(tw, lambda t: len(list_filter({words_col}, lambda x: x = t))))"
    return O.with_(O.PAIRS, *([more] if more else []), O.DESCRIPTIONS) + f"""
SELECT id, product_uid,
       (CAST({hits('iw')} AS DOUBLE) / CAST(nullif(len(tw), 0) AS DOUBLE)) * 4.0::DOUBLE
       + (CAST({hits('dw')} AS DOUBLE) / CAST(nullif(len(tw), 0) AS DOUBLE)) * 1.0::DOUBLE AS "values",
       CAST(relevance AS DOUBLE) AS label
FROM (SELECT q.id, q.product_uid, q.relevance,
             {O.words("coalesce(q.search_term, '')")} AS tw,
             {O.words("coalesce(q.product_title, '')")} AS iw,
             {O.words("coalesce(d.product_description, '')")} AS dw
      FROM {pairs} q JOIN descriptions d ON d.product_uid = q.product_uid)"""


@register("weighted_tf_score", _weighted_sql())
def q_weighted_tf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.weighted_tf_score(src.search_pairs(spark, sf_dir),
                                      src.product_descriptions(spark, sf_dir))


@register("scored_lines", _weighted_sql().replace("SELECT id, product_uid,", "SELECT printf('(%d, %d) --> values=%f', id, product_uid, v) AS line FROM (SELECT id, product_uid,", 1).replace(' AS "values",', " AS v,", 1) + ")")
def q_scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = features.weighted_tf_score(src.search_pairs(spark, sf_dir),
                                        src.product_descriptions(spark, sf_dir))
    return sink.format_lines(scored, "(%d, %d) --> values=%f", S.ID, S.PRODUCT, "values")


@register("tokens", O.with_(O.TOKENS) + """
SELECT doc_id, CAST(generate_subscripts(tok, 1) - 1 AS INTEGER) AS pos, unnest(tok) AS token
FROM doc_tokens""")
def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.token_rows(_doc_tokens(spark, sf_dir), "doc_id", "tok")


@register("bigram_counts", O.with_(O.TOKENS) + """
SELECT ngram, count(*) AS n_rows
FROM (SELECT unnest([tok[i] || ' ' || tok[i + 1] FOR i IN range(1, len(tok))]) AS ngram FROM doc_tokens)
GROUP BY ngram""")
def q_bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.ngram_counts(_doc_tokens(spark, sf_dir), "tok", n=2)


@register("tfidf", O.with_(
    O.TOKENS,
    """tf AS (SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest(tok) AS token FROM doc_tokens)
       GROUP BY doc_id, token)""",
    "dfreq AS (SELECT token, count(*) AS df FROM tf GROUP BY token)",
    "m AS (SELECT count(*) AS m FROM doc_tokens)") + """
SELECT tf.doc_id, tf.token, tf.tf, dfreq.df,
       round(tf.tf * ln((m.m + 1.0) / (dfreq.df + 1.0)), 6) AS tfidf
FROM tf JOIN dfreq ON dfreq.token = tf.token, m""")
def q_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("n_bytes")).first()
    tok = features.tokenize(features.documents_by_key(docs, "doc_id", size["n_bytes"]), "text", "tok").select("doc_id", "tok")
    t = features.tfidf_table(tok, "doc_id", "tok", n_docs=size["n"])
    return t.withColumn("tfidf", F.round("tfidf", 6))


_STOP_WORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in O.ENGLISH_STOP_WORDS)


@register("stopwords_removed", O.with_(O.TOKENS) + f"""
SELECT doc_id, CAST(len(kept) AS INTEGER) AS n_kept, array_to_string(kept, ' ') AS kept
FROM (SELECT doc_id, list_filter(tok, lambda t: NOT list_contains([{_STOP_WORDS}], t)) AS kept FROM doc_tokens)""")
def q_stopwords_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = features.remove_stop_words(_doc_tokens(spark, sf_dir), "tok", "kept")
    return kept.select("doc_id", F.size("kept").alias("n_kept"), F.array_join("kept", " ").alias("kept"))


@register("corpus_stopwords", O.with_(O.PAIRS, O.TRAIN, O.TEST, O.ATTRIBUTES, O.ATTR_FLAT_SPACE, O.DESCRIPTIONS) + f"""
SELECT product_uid, search_term,
       CAST(len(list_filter(tok, lambda t: NOT list_contains([{_STOP_WORDS}], t))) AS INTEGER) AS n_kept
FROM (SELECT u.product_uid, u.search_term,
             {O.ml_tokens("u.product_title || ' ' || coalesce(a.attr_list, 'empty') || ' ' || coalesce(d.product_description, 'empty') || ' ' || u.search_term")} AS tok
      FROM (SELECT product_uid, product_title, search_term FROM train
            UNION ALL SELECT product_uid, product_title, search_term FROM test) u
      LEFT JOIN attr_flat a ON a.product_uid = u.product_uid
      LEFT JOIN descriptions d ON d.product_uid = u.product_uid)
WHERE product_uid IS NOT NULL AND search_term IS NOT NULL AND tok IS NOT NULL""")
def q_corpus_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus tokens without stop words; rows with any NULL dropped: (product_uid, search_term, n_kept)."""
    train, test = src.train_test(spark, sf_dir)
    return flows.corpus_kept_words(train, test, src.attributes(spark, sf_dir), src.product_descriptions(spark, sf_dir))


@register("null_term_tokens", O.with_(O.PAIRS) + f"""
SELECT id, array_to_string({O.ml_tokens("CASE WHEN id % 97 = 0 THEN '' ELSE search_term END")}, '|') AS tokens FROM pairs""")
def q_null_term_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of search terms of which some are NULL: a NULL text is tokenized as an empty one."""
    return features.tokenize(_some_null_terms(src.search_pairs(spark, sf_dir)), S.TERM, "tok").select(
        S.ID, F.array_join("tok", "|").alias("tokens"))


def _some_null_terms(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn(S.TERM, F.when(F.col(S.ID) % 97 != 0, F.col(S.TERM)))


@register("w2v_vocabulary", O.with_(O.TOKENS) + """
SELECT word, count(*) AS n FROM (SELECT unnest(tok) AS word FROM doc_tokens) GROUP BY word HAVING count(*) >= 5""")
def q_w2v_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.vocabulary(_doc_tokens(spark, sf_dir), "tok", min_count=5)


@register("label_index", O.with_(
    O.PAIRS,
    """idx AS (SELECT relevance,
               row_number() OVER (ORDER BY count(*) DESC, CAST(relevance AS VARCHAR)) - 1 AS label
        FROM pairs GROUP BY relevance)""") + """
SELECT q.id, q.relevance, CAST(i.label AS DOUBLE) AS label FROM pairs q JOIN idx i ON i.relevance = q.relevance""")
def q_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.index_labels(src.search_pairs(spark, sf_dir).select(S.ID, S.LABEL), S.LABEL, "label")


@register("hashed_tf", O.with_(O.PAIRS) + f"SELECT id, CAST(len({O.ml_tokens('search_term')}) AS DOUBLE) AS n_terms FROM pairs",
          lambda df: df.select(S.ID, F.aggregate("tf", F.lit(0.0), lambda a, x: a + x).alias("n_terms")))
def q_hashed_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = features.tokenize(src.search_pairs(spark, sf_dir).select(S.ID, S.TERM), S.TERM, "words")
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=20).transform(tok)
    return hashed.select(S.ID, vector_to_array("tf").alias("tf"))


# --- linear model with a closed-form oracle ---------------------------------------------------

def _train_hits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    feats = features.hit_features(src.search_pairs(spark, sf_dir), src.product_descriptions(spark, sf_dir))
    feats = materialize(feats.select(*feats.columns, M.dense_features(*HIT)))
    test = src.is_test_row(F.col(S.ID))
    return feats.where(~test), feats.where(test)


_OLS_BASE = O.with_(O.PAIRS, O.TRAIN, O.TEST, O.DESCRIPTIONS, O.hit_features_sql("train", "train_features"),
                    O.hit_features_sql("test", "test_features"), O.OLS)


@register("linear_coefficients", _OLS_BASE + """
SELECT term, round(value, 6) AS value FROM (
  SELECT 'term_len' AS term, w1 AS value FROM ols UNION ALL SELECT 'tf_title', w2 FROM ols
  UNION ALL SELECT 'tf_desc', w3 FROM ols UNION ALL SELECT 'intercept', w0 FROM ols)""")
def q_linear_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _train_hits(spark, sf_dir)
    model = M.linear(**flows.LINEAR_OLS).fit(train)
    return M.coefficients(spark, model, HIT).select("term", F.round("value", 6).alias("value"))


@register("linear_submission", _OLS_BASE + """
SELECT t.id, round(o.w0 + o.w1 * t.term_len + o.w2 * t.tf_title + o.w3 * t.tf_desc, 4) AS relevance
FROM test_features t, ols o""")
def q_linear_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _train_hits(spark, sf_dir)
    model = M.linear(**flows.LINEAR_OLS).fit(train)
    return M.score(model, test).select(S.ID, F.round(S.LABEL, 4).alias(S.LABEL))


@register("train_rmse", _OLS_BASE + """
SELECT round(sqrt(avg(power(t.relevance - (o.w0 + o.w1 * t.term_len + o.w2 * t.tf_title + o.w3 * t.tf_desc), 2))), 6) AS rmse
FROM train_features t, ols o""")
def q_train_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _train_hits(spark, sf_dir)
    model = M.linear(**flows.LINEAR_OLS).fit(train)
    return M.rmse(model.transform(train)).select(F.round("rmse", 6).alias("rmse"))


# --- seeded model flows (rows-only) ----------------------------------------------------------

@register("rf_hit_submission", O.with_(O.PAIRS, O.TEST) + _TEST_TRUE.format("in_range"), _keeps("in_range", _IN_LABELS, S.ID))
def q_rf_hit_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stemmed hit features → random forest (15 trees, depth 6) → test submission."""
    return flows.hit_rf_submission(src.search_pairs(spark, sf_dir), src.product_descriptions(spark, sf_dir),
                                   src.is_test_row(F.col(S.ID)), seed=SEED)


@register("tvs_rf_submission", O.with_(O.PAIRS, O.TEST) + _TEST_TRUE.format("in_range"), _keeps("in_range", _IN_LABELS, S.ID))
def q_tvs_rf_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train/validation split over numTrees [5], depth 5, ratio 0.8 → test submission."""
    return flows.hit_tvs_submission(src.search_pairs(spark, sf_dir), src.product_descriptions(spark, sf_dir),
                                    src.is_test_row(F.col(S.ID)), seed=SEED)


_LAST_CORPUS: dict[str, object] = {}


def _corpus_model(spark: SparkSession, sf_dir: str):
    """The corpus Word2Vec model; the last one is reused while application and source files are the same and its own
    files are there.

    Files are recognised by path, length and time of change, which the file system knows: no row is read for it.
    """
    key = (spark.sparkContext.applicationId, *src.files(spark, sf_dir, "lineitem", "part", "documents"))
    if _LAST_CORPUS.get("key") != key or not _LAST_CORPUS["model"].is_there():
        train, test = src.train_test(spark, sf_dir)
        corpus = flows.corpus_info(train, test, src.attributes(spark, sf_dir), src.product_descriptions(spark, sf_dir))
        _LAST_CORPUS.update(key=key, model=flows.corpus_embedding(spark, corpus, seed=SEED))
    return _LAST_CORPUS["model"]


def _corpus_flow(spark: SparkSession, sf_dir: str, learner: str) -> DataFrame:
    train, test = src.train_test(spark, sf_dir)
    return flows.corpus_w2v_submission(spark, train, test,
                                       src.attributes(spark, sf_dir), src.product_descriptions(spark, sf_dir),
                                       seed=SEED, learner=learner, model=_corpus_model(spark, sf_dir))


@register("corpus_w2v_linear", O.with_(O.PAIRS, O.TEST) + _TEST_TRUE.format("finite"), _keeps("finite", _finite(S.LABEL), S.ID))
def q_corpus_w2v_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus Word2Vec (3 dims, minCount 5) → mean term vectors → OLS → test submission."""
    return _corpus_flow(spark, sf_dir, "linear")


@register("corpus_w2v_forest", O.with_(O.PAIRS, O.TEST) + _TEST_TRUE.format("in_range"), _keeps("in_range", _IN_LABELS, S.ID))
def q_corpus_w2v_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same features → random forest (15 trees, depth 3) → test submission."""
    return _corpus_flow(spark, sf_dir, "forest")


@register("term_vectors", O.with_(O.PAIRS) + "SELECT id, true AS is_models FROM pairs",
          lambda df: df.select(S.ID, "is_models"))
def q_term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean corpus word vector of every search term (all pairs), by joins with the vectors table, and
    whether it is what the fitted model's own transform gives."""
    model = _corpus_model(spark, sf_dir)
    vec = flows.embed_terms(model, src.search_pairs(spark, sf_dir).select(S.ID, S.TERM))
    own = model.transform(vec.withColumn("tokens", T.ml_tokens(S.TERM)).withColumnRenamed("vec", "mean"))
    near = F.forall(F.zip_with(vector_to_array("vec"), vector_to_array("mean"), lambda a, b: F.abs(a - b) < 1e-9), lambda x: x)
    return own.select(S.ID, vector_to_array("mean").alias("vec"), near.alias("is_models"))


@register("w2v_indexed_forest", O.with_(O.PAIRS, O.TEST) + _TEST_TRUE.format("in_range"),
          _keeps("in_range", "prediction BETWEEN 0 AND 20", S.ID))
def q_w2v_indexed_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label index + vector index + default random forest on the corpus term vectors."""
    train, test = src.train_test(spark, sf_dir)
    return flows.indexed_forest_submission(spark, train, test,
                                           src.attributes(spark, sf_dir), src.product_descriptions(spark, sf_dir),
                                           seed=SEED, model=_corpus_model(spark, sf_dir))


@register("ngram_w2v_submission", O.with_(O.PAIRS, O.TEST) + _TEST_TRUE.format("finite"), _keeps("finite", _finite(S.LABEL), S.ID))
def q_ngram_w2v_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = src.train_test(spark, sf_dir)
    return flows.ngram_w2v_submission(train, test,
                                      seed=SEED, n=1)


def _labelled_terms(train: DataFrame) -> DataFrame:
    """(product_uid, search_term, label): the label renamed by SQL expression, as the pages do."""
    return tables.rename(train.select(S.PRODUCT, S.TERM, S.LABEL), {S.LABEL: "label"})


#: With the scripts' regularisation (0.3, elastic net 0.8) every coefficient is zero on these tables: a linear
#: model predicts the mean label of its training rows, a logistic one their class shares.
_MEAN = "(SELECT round(avg(relevance), 6) AS mean FROM train)"


@register("tfidf_linear_coefficients", O.with_(O.PAIRS, O.TRAIN) + f"""
SELECT 'bucket_' || CAST(i AS VARCHAR) AS term, 0::DOUBLE AS value FROM range(20) t(i) UNION ALL SELECT 'intercept', mean FROM {_MEAN}""")
def q_tfidf_linear_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients (20 hashed buckets) and intercept of the TF-IDF linear model."""
    train, test = src.train_test(spark, sf_dir)
    model, _ = flows.tfidf_linear(_labelled_terms(train), test.select(S.ID, S.PRODUCT, S.TERM))
    return M.coefficients(spark, model, [f"bucket_{i}" for i in range(20)]).select("term", (F.round("value", 6) + 0.0).alias("value"))


@register("tfidf_linear_scores", O.with_(O.PAIRS, O.TRAIN, O.TEST) + f"SELECT id, product_uid, search_term, mean AS prediction FROM test, {_MEAN}")
def q_tfidf_linear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = src.train_test(spark, sf_dir)
    _, scored = flows.tfidf_linear(_labelled_terms(train), test.select(S.ID, S.PRODUCT, S.TERM))
    return scored.select(S.ID, S.PRODUCT, S.TERM, F.round("prediction", 6).alias("prediction"))


@register("tfidf_linear_training_scores", O.with_(O.PAIRS, O.TRAIN) + f"SELECT product_uid, search_term, relevance AS label, mean AS prediction FROM train, {_MEAN}")
def q_tfidf_linear_training_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training rows scored by their own TF-IDF model, as the page shows them."""
    train = _labelled_terms(src.train_pairs(spark, sf_dir))
    _, scored = flows.tfidf_linear(train, train)
    return scored.select(S.PRODUCT, S.TERM, "label", F.round("prediction", 6).alias("prediction"))


@register("tfidf_weak_regularisation", "SELECT CAST(i AS INTEGER) AS feature, true AS optimal, true AS some_live FROM range(20) t(i)",
          lambda df: df.select("feature", "optimal", "some_live"))
def q_tfidf_weak_regularisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The TF-IDF linear model with little regularisation (0.001), where coefficients live: every one
    of them meets the conditions that only the problem's solution meets."""
    train = _labelled_terms(src.train_pairs(spark, sf_dir))
    model, scored = flows.tfidf_linear(train, train, reg_param=0.001, max_iter=500, tol=1e-12)
    found = M.optimality(scored, model, 0.001, 0.8, label_col="label")
    live = any(abs(float(v)) > 0 for v in model.stages[-1].coefficients.toArray())
    return found.withColumn("some_live", F.lit(live))


@register("w2v_linear_scores", O.with_(O.PAIRS, O.TRAIN, O.TEST) + f"SELECT id, product_uid, search_term, mean AS prediction FROM test, {_MEAN}")
def q_w2v_linear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = src.train_test(spark, sf_dir)
    _, scored = flows.w2v_linear(_labelled_terms(train), test.select(S.ID, S.PRODUCT, S.TERM),
                                 seed=SEED)
    return scored.select(S.ID, S.PRODUCT, S.TERM, F.round("prediction", 6).alias("prediction"))


@register("w2v_linear_training_scores", O.with_(O.PAIRS, O.TRAIN) + f"SELECT product_uid, search_term, relevance AS label, mean AS prediction FROM train, {_MEAN}")
def q_w2v_linear_training_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training rows scored by their own term-vector model, as the page shows them."""
    train = _labelled_terms(src.train_pairs(spark, sf_dir))
    _, scored = flows.w2v_linear(train, train, seed=SEED)
    return scored.select(S.PRODUCT, S.TERM, "label", F.round("prediction", 6).alias("prediction"))


@register("tfidf_lines", O.with_(O.PAIRS, O.TRAIN, O.TEST) + f"""
SELECT printf('(%d, %s) --> prediction=%f', product_uid, search_term, mean) AS line FROM test, {_MEAN}""")
def q_tfidf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored test rows as the lines the page prints."""
    return flows.prediction_lines(q_tfidf_linear_scores(spark, sf_dir))


@register("classifier_lines", O.with_(O.PAIRS, O.TRAIN, O.TEST, "labels_of AS (SELECT CAST(relevance AS INTEGER) AS label FROM train WHERE relevance = floor(relevance))") + """
SELECT printf('(%d, %s) --> prob=[%s], prediction=%f', product_uid, search_term, p, best) AS line FROM test,
  (SELECT printf('%.1f,%.1f,%.1f,%.1f', count(*) FILTER (label = 0) / count(*), count(*) FILTER (label = 1) / count(*),
                 count(*) FILTER (label = 2) / count(*), count(*) FILTER (label = 3) / count(*)) AS p FROM labels_of),
  (SELECT CAST(label AS DOUBLE) AS best FROM labels_of GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)""")
def q_classifier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified test pairs as the lines the page prints, probabilities to one digit."""
    return flows.prediction_lines(_term_classes(spark, sf_dir, "whole").withColumnRenamed("text", S.TERM), prob_digits=1)


@register("tf_score_linear", _weighted_sql(O.TRAIN, "train").replace("WITH RECURSIVE", "WITH RECURSIVE scored AS (WITH RECURSIVE", 1) + """)
SELECT id, product_uid, coalesce("values", 0) AS "values", label, (SELECT round(avg(label), 6) FROM scored) AS prediction FROM scored""")
def q_tf_score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = flows.tf_score_linear(src.train_pairs(spark, sf_dir), src.product_descriptions(spark, sf_dir))
    return scored.select(S.ID, S.PRODUCT, "values", "label", F.round("prediction", 6).alias("prediction"))


def _shares(rows: str, classes: int, keys: str, scored: str, digits: int) -> str:
    """The class shares of training rows (label) as every scored row's probabilities, and the largest class."""
    shares = ", ".join(f"round(count(*) FILTER (label = {k}) / count(*), {digits}) AS p{k}" for k in range(classes))
    return f"""SELECT {keys}, {", ".join(f"p{k}" for k in range(classes))}, best AS prediction FROM {scored},
  (SELECT {shares} FROM ({rows})), (SELECT CAST(label AS DOUBLE) AS best FROM ({rows}) GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)"""


def _rounded(digits: int, classes: int, *keys: str) -> Callable[[DataFrame], DataFrame]:
    """Keys, class probabilities to so many digits, and the predicted class."""
    return lambda df: df.select(*keys, *[(F.round(F.col("prob")[k], digits) + 0.0).alias(f"p{k}") for k in range(classes)], "prediction")


@register("term_classifier", _shares("SELECT l.quality AS label FROM documents d JOIN labels l ON l.doc_id = d.doc_id", 2, "doc_id", "documents", 6),
          _rounded(6, 2, "doc_id"))
def q_term_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents → Tokenizer → HashingTF → logistic regression; every document scored."""
    _, scored = flows.term_classifier(src.classifier_rows(spark, sf_dir), _docs(spark, sf_dir))
    return scored.select("doc_id", M.probabilities(), "prediction")


@register("term_classifier_pairs", O.with_(O.PAIRS, O.TRAIN, O.TEST) + _shares(
    "SELECT CAST(relevance AS INTEGER) AS label FROM train WHERE relevance = floor(relevance)", 4, "id, product_uid", "test", 1), _rounded(1, 4, S.ID, S.PRODUCT))
def q_term_classifier_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search terms → hashed terms → logistic regression on an integer relevance label.

    The rows an integer label column keeps: whole values; labels 1..3 give 4 classes. Ten iterations end
    within about 0.002 of the solution.
    """
    return _term_classes(spark, sf_dir, "whole")


@register("term_classifier_converged", O.with_(O.PAIRS, O.TRAIN, O.TEST) + _shares(
    "SELECT CAST(relevance AS INTEGER) AS label FROM train WHERE relevance = floor(relevance)", 4, "id, product_uid", "test", 4), _rounded(4, 4, S.ID, S.PRODUCT))
def q_term_classifier_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same model over 1,024 hash buckets, iterated to its solution."""
    return _term_classes(spark, sf_dir, "whole", max_iter=100, num_features=1 << 10)


@register("term_classifier_all_pairs", O.with_(O.PAIRS, O.TRAIN, O.TEST) + _shares(
    "SELECT CAST(round(relevance) AS INTEGER) AS label FROM train", 4, "id, product_uid", "test", 1), _rounded(1, 4, S.ID, S.PRODUCT))
def q_term_classifier_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on every train row, fractional labels rounded to the nearest class."""
    return _term_classes(spark, sf_dir, "rounded")


def _term_classes(spark: SparkSession, sf_dir: str, label_as: str, **settings) -> DataFrame:
    """Scored test pairs; ``label_as`` ``whole`` trains on whole labels only, ``rounded`` on all."""
    train, test_rows = src.train_test(spark, sf_dir)
    if label_as == "whole":
        train = train.where(F.col(S.LABEL) == F.floor(S.LABEL))
    labelled = train.select(S.PRODUCT, F.col(S.TERM).alias("text"), F.round(S.LABEL).cast("int").alias("label"))
    test = test_rows.select(S.ID, S.PRODUCT, F.col(S.TERM).alias("text"))
    _, scored = flows.term_classifier(labelled, test, **settings)
    return scored.select(S.ID, S.PRODUCT, "text", M.probabilities(), "prediction")


# --- models whose solution SQL can state -------------------------------------------------------

_HITS_TRAIN = [O.PAIRS, O.TRAIN, O.DESCRIPTIONS, O.hit_features_sql("train", "train_features")]
_SEARCHED = (0.0, 0.05, 0.5)
_KEPT_FOLD = "kept_features AS (SELECT * FROM train_features WHERE substr(md5(CAST(id AS VARCHAR)), 1, 1) NOT IN ('0', '1', '2'))"


@register("elastic_net_coefficients", O.with_(*_HITS_TRAIN, O.elastic_net(0.01, 0.8)) + """
SELECT term, round(value, 5) + 0 AS value FROM (
  SELECT 'term_len' AS term, w1 AS value FROM enet UNION ALL SELECT 'tf_title', w2 FROM enet
  UNION ALL SELECT 'tf_desc', w3 FROM enet UNION ALL SELECT 'intercept', w0 FROM enet)""")
def q_elastic_net_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An elastic net (0.01, 0.8) on the hit features: some coefficients are zero, others live."""
    train, _ = _train_hits(spark, sf_dir)
    model = M.linear(max_iter=500, reg_param=0.01, elastic_net=0.8, tol=1e-12).fit(train)
    return M.coefficients(spark, model, HIT).select("term", (F.round("value", 5) + 0.0).alias("value"))


@register("regression_stump", O.with_(*_HITS_TRAIN, O.STUMP) + """
SELECT feature, threshold, round("left", 6) AS "left", round("right", 6) AS "right" FROM stump""")
def q_regression_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of one tree of depth 1 on all rows: the split of the largest variance gain, and its leaf means."""
    train, _ = _train_hits(spark, sf_dir)
    model = M.forest(seed=SEED, num_trees=1, max_depth=1, bootstrap=False).fit(train)
    return M.root_split(spark, model, HIT).select("feature", "threshold", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"))


@register("stump_submission", O.with_(*_HITS_TRAIN, O.TEST, O.hit_features_sql("test", "test_features"), O.STUMP) + """
SELECT t.id, round(CASE WHEN CASE s.feature WHEN 'term_len' THEN t.term_len WHEN 'tf_title' THEN t.tf_title ELSE t.tf_desc END <= s.threshold
                        THEN s."left" ELSE s."right" END, 6) AS relevance FROM test_features t, stump s""")
def q_stump_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree's predictions for the test pairs."""
    train, test = _train_hits(spark, sf_dir)
    model = M.forest(seed=SEED, num_trees=1, max_depth=1, bootstrap=False).fit(train)
    return M.score(model, test).select(S.ID, F.round(S.LABEL, 6).alias(S.LABEL))


@register("hashed_search", O.with_(*_HITS_TRAIN, _KEPT_FOLD, *[O.elastic_net(r, 0, "kept_features", f"ridge{i}") for i, r in enumerate(_SEARCHED)],
                                   "searched AS (" + " UNION ALL ".join(f"SELECT {r}::DOUBLE AS reg_param, {i} AS place, * FROM ridge{i}" for i, r in enumerate(_SEARCHED)) + ")",
                                   """errors AS (
  SELECT reg_param, place, sqrt(avg(power(t.relevance - (w0 + w1 * t.term_len + w2 * t.tf_title + w3 * t.tf_desc), 2))) AS rmse, count(*) AS n_held_out
  FROM train_features t, searched WHERE substr(md5(CAST(t.id AS VARCHAR)), 1, 1) IN ('0', '1', '2') GROUP BY reg_param, place)""") + """
SELECT reg_param, n_held_out, round(rmse, 6) AS rmse, row_number() OVER (ORDER BY rmse, place) = 1 AS best FROM errors""")
def q_hashed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid search over the L2 weight of a linear model; about a fifth of the rows is held out by a hash of the id."""
    train, _ = _train_hits(spark, sf_dir)
    est = M.linear(max_iter=100, elastic_net=0.0)
    held_out = M.hashed_fold(S.ID)
    model, metrics = M.hashed_search(est, M.grid(est.regParam, _SEARCHED), train, held_out)
    n = train.where(held_out).count()
    chosen = model.getOrDefault("regParam")
    rows = [(params[est.regParam], n, value, params[est.regParam] == chosen) for params, value in metrics]
    return spark.createDataFrame(rows, "reg_param double, n_held_out long, rmse double, best boolean").withColumn("rmse", F.round("rmse", 6))


@register("w2v_vectors", O.with_(O.TOKENS) + """
SELECT word, 3 AS n_dims, true AS finite FROM (SELECT unnest(tok) AS word FROM doc_tokens) GROUP BY word HAVING count(*) >= 5""",
          lambda df: df.select("word", F.size("vector").alias("n_dims"), F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))).alias("finite")))
def q_w2v_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word vectors of the document corpus (vocabulary with count >= 5)."""
    w2v = M.word2vec(seed=SEED, input_col="tok", output_col="vec")
    model = w2v.fit(flows.pinned(_doc_tokens(spark, sf_dir).select("tok"), "tok"))
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


# --- CSV policies --------------------------------------------------------------------------------

@register("csv_malformed_rows", O.with_(O.PAIRS) + """
SELECT id, product_uid, product_title, search_term, relevance FROM pairs WHERE id % 13 <> 0""")
def q_csv_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written as CSV, some with a label that is no number, read strictly: those rows go."""
    path = _scratch(spark, "malformed")
    pairs = src.search_pairs(spark, sf_dir)
    label = F.when(F.col(S.ID) % 13 == 0, F.lit("n/a")).otherwise(F.col(S.LABEL).cast("string"))
    sink.write_csv(pairs.select(S.ID, S.PRODUCT, S.TITLE, S.TERM, label.alias(S.LABEL)), path)
    return csv_src.read_csv(spark, path, schema=S.TRAIN, strict=True)


@register("csv_single_file", O.with_(O.PAIRS) + "SELECT id, CAST(relevance AS DOUBLE) AS rel, true AS one_file FROM pairs WHERE id % 5 = 0")
def q_csv_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test labels written as one CSV part ordered by id, read back and renamed by SQL expression."""
    path = _scratch(spark, "single")
    sink.write_csv(src.search_pairs(spark, sf_dir).where(src.is_test_row(F.col(S.ID))).select(S.ID, S.LABEL), path,
                   single_file=True, order_by=[S.ID])
    back = csv_src.read_csv(spark, path, schema=S.SUBMISSION, strict=True)
    return tables.rename(back.select(S.ID, S.LABEL), {S.LABEL: "rel"}).withColumn("one_file", F.lit(len(back.inputFiles()) == 1))


@register("csv_existing_path", O.with_(O.PAIRS) + "SELECT id, product_uid, true AS refused FROM pairs")
def q_csv_existing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies for a path that exists: overwritten, appended to, left alone, refused."""
    path = _scratch(spark, "existing")
    pairs = src.search_pairs(spark, sf_dir).select(S.ID, S.PRODUCT)
    test = src.is_test_row(F.col(S.ID))
    sink.write_csv(pairs, path)
    sink.write_csv(pairs.where(test), path, mode="overwrite")
    sink.write_csv(pairs.where(~test), path, mode="append")
    sink.write_csv(pairs, path, mode="ignore")
    try:
        sink.write_csv(pairs, path)
        refused = False
    except AnalysisException:
        refused = True
    schema = StructType([StructField(S.ID, LongType()), StructField(S.PRODUCT, LongType())])
    return csv_src.read_csv(spark, path, schema=schema).withColumn("refused", F.lit(refused))


@register("stage1_test_table", O.with_(O.PAIRS, O.TEST) + """
SELECT CAST(id AS VARCHAR) AS id, CAST(product_uid AS VARCHAR) AS prod_uid, product_title AS title, search_term AS search FROM test""")
def q_stage1_test_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headerless all-string test table, renamed by position, through its SQL view."""
    paths = {name: _scratch(spark, name) for name in ("train", "descriptions", "test")}
    train, test = src.train_test(spark, sf_dir)
    for name, df in (("train", train), ("descriptions", src.product_descriptions(spark, sf_dir)), ("test", test)):
        sink.write_csv(df, paths[name], header=False)
    read = {name: csv_src.read_csv(spark, path, header=False, multi_line=name == "descriptions") for name, path in paths.items()}
    flows.stage1_join(spark, read["train"], read["descriptions"], read["test"])
    return spark.table("testdata")


@register("union_by_position", O.with_(O.PAIRS, O.TRAIN, O.TEST) + """
SELECT id, search_term FROM train UNION ALL SELECT id, product_title FROM test""")
def q_union_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional union: the second table's columns take the first one's names."""
    train, test = src.train_test(spark, sf_dir)
    return tables.union_pairs(train.select(S.ID, S.TERM), test.select(S.ID, S.TITLE), by_name=False)
