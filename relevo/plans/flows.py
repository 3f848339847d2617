"""The user-visible jobs: load, join, build features, fit, score, write.

Each flow takes logical tables (DataFrames) so any source can feed it; ``relevo.sources.tables``
builds them from the driver's Parquet tables and ``relevo.sources.csv`` from CSV files.

Model flows compute features for train and test rows in one plan where the scripts repeated the
work, cut lineage (checkpoint in the shared folder) before fitting, and score with the fitted model
as a projection. Seeds are explicit.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo import models as M
from relevo import schemas as S
from relevo.functions import text as T
from relevo.operators import features, tables
from relevo.session import materialize, shared_table
from relevo.sinks.csv import format_lines

HIT_COLS = ("term_len", "tf_title", "tf_desc")

# The model settings of the scripts, kept as they are for matching results.
# Linear regression: 10 iterations; without regularisation (OLS) or with elastic net 0.3 / 0.8.
LINEAR_OLS = {"max_iter": 10, "reg_param": 0.0, "elastic_net": 0.8}
LINEAR_ENET = {"max_iter": 10, "reg_param": 0.3, "elastic_net": 0.8}
# Logistic regression on hashed terms: 10 iterations, elastic net 0.3 / 0.8; 2^18 hash buckets.
LOGISTIC = {"max_iter": 10, "reg_param": 0.3, "elastic_net": 0.8}
TERM_HASH_BUCKETS = 1 << 18
# TF-IDF page: 20 hash buckets.
TFIDF_HASH_BUCKETS = 20
# Word2Vec: 3 dimensions; words seen fewer than 5 times dropped (0 on the term-only page).
EMBED_SIZE, EMBED_MIN_COUNT, TERM_EMBED_MIN_COUNT = 3, 5, 0
# Random forests: hit features 15 trees of depth 6; corpus vectors 15 trees of depth 3;
# tuned: numTrees grid [5], depth 5, 80 % train ratio.
HIT_FOREST = {"num_trees": 15, "max_depth": 6}
CORPUS_FOREST = {"num_trees": 15, "max_depth": 3}
TUNED_FOREST = {"num_trees": (5,), "max_depth": 5, "train_ratio": 0.8}


# --- M1: headerless tables, inner join, name-list projection --------------------------------

def stage1_join(spark: SparkSession, train: DataFrame, descriptions: DataFrame, test: DataFrame | None = None) -> DataFrame:
    """Inner join of the renamed headerless train and description tables via SQL views.

    A test table becomes the view ``testdata``."""
    if test is not None:
        tables.rename_all(test, S.STAGE1_TEST_NAMES).createOrReplaceTempView("testdata")
    tables.rename_all(train, S.STAGE1_TRAIN_NAMES).createOrReplaceTempView("traindata")
    tables.rename_all(descriptions, S.STAGE1_DESC_NAMES).createOrReplaceTempView("prod_desc")
    joined = spark.table("traindata").join(spark.table("prod_desc"),
                                           F.col("prod_id") == F.col("prod_uid"), "inner")
    return joined.select(*S.STAGE1_OUTPUT)


# --- M2: wide training table -----------------------------------------------------------------

def wide_training_table(pairs: DataFrame, attrs: DataFrame, descriptions: DataFrame, keep_id: bool = False) -> DataFrame:
    """pairs ⟕ attributes (values joined by ',') ⟕ descriptions, no defaults.

    ``keep_id`` leaves the pair id in front, for an order in which a hot product can be split."""
    flat = shared_table(tables.flatten_attributes(attrs, sep=",", out="value_list"), "attribute-values")
    joined = tables.attach_product_text(pairs, flat, descriptions, default=None)
    kept = [S.ID] if keep_id else []
    return joined.select(*kept, S.PRODUCT, S.TERM, S.TITLE, "value_list", S.DESCRIPTION, S.LABEL)


# --- M8/M9 corpus ----------------------------------------------------------------------------

def corpus_info(train: DataFrame, test: DataFrame, attrs: DataFrame,
                descriptions: DataFrame) -> DataFrame:
    """(product_uid, search_term, info): train ∪ test pairs with all product text attached.

    Attribute values are joined by a space; a missing attribute list or description becomes
    ``empty``; ``info`` concatenates title, attributes, description and search term.
    """
    cols = [S.PRODUCT, S.TITLE, S.TERM]
    both = tables.union_pairs(train.select(*cols), test.select(*cols))
    flat = shared_table(tables.flatten_attributes(attrs, sep=" ", out="attr_list"), "attribute-lists")
    joined = tables.attach_product_text(both, flat, descriptions)
    return joined.select(S.PRODUCT, S.TERM,
                         T.info(S.TITLE, "attr_list", S.DESCRIPTION, S.TERM).alias("info"))


def corpus_kept_words(train: DataFrame, test: DataFrame, attrs: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(product_uid, search_term, n_kept): the words of each row's ``info`` that are no stop words.

    ``info`` is a product's text, a space and the search term, so its words are those of both. A product's
    text is put together, tokenized and cleared of stop words once; a pair meets only its two
    counts. Only at the end of ``info`` are empty words dropped: the text keeps its own last empty ones
    (``all_kept``, counted in front of a mark) unless a blank term follows it. Rows with a NULL go.
    """
    cols = [S.PRODUCT, S.TITLE, S.TERM]
    both = tables.drop_incomplete(tables.union_pairs(train.select(*cols), test.select(*cols)), [S.PRODUCT, S.TERM])
    both = features.filled(both, S.TITLE)
    flat = shared_table(tables.flatten_attributes(attrs, sep=" ", out="attr_list"), "attribute-lists")
    texts = tables.attach_product_text(both.select(S.PRODUCT, S.TITLE).distinct(), flat, descriptions)
    parts = [F.coalesce(c, F.lit("")) for c in (S.TITLE, "attr_list", S.DESCRIPTION)]
    texts = texts.select(S.PRODUCT, S.TITLE, F.concat_ws(" ", *parts).alias("_text"))
    texts = texts.withColumn("_marked", F.concat("_text", F.lit(" .")))
    counts = _kept_words(_kept_words(texts, "_marked", "_all"), "_text", "_cut").withColumn("_all", F.col("_all") - 1)
    counts = shared_table(counts.select(S.PRODUCT, S.TITLE, "_all", "_cut"), "kept-words")
    joined = _kept_words(both, S.TERM, "_term").join(counts, [S.PRODUCT, S.TITLE])
    n = F.when(F.col(S.TERM).rlike(r"\S"), F.col("_all") + F.col("_term")).otherwise(F.col("_cut"))
    return joined.select(S.PRODUCT, S.TERM, n.alias("n_kept"))


def _kept_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the number of the words of ``text`` that are no stop words."""
    kept = features.remove_stop_words(features.tokenize(df, text, "_tokens"), "_tokens", "_kept")
    return kept.withColumn(out, F.size("_kept")).drop("_tokens", "_kept")


def pinned(tokens: DataFrame, col: str, parts: int = M.W2V_PARTITIONS) -> DataFrame:
    """Token rows in a fixed partitioning and order, written once: the input of a Word2Vec fit.

    Vectors depend on how rows are dealt to training tasks and in what order. The fit derives both from the
    rows' places here, so this is fixed by the rows alone and never by the machine. Token arrays are shuffled and
    written as JSON, in about half of the bytes.
    """
    arrays = [c for c, kind in tokens.dtypes if kind == "array<string>"]
    packed = tokens.withColumns({c: F.to_json(c) for c in arrays})
    written = materialize(packed.repartition(parts, col).sortWithinPartitions(*tokens.columns))
    return written.withColumns({c: F.from_json(c, "array<string>") for c in arrays})


def corpus_embedding(spark: SparkSession, corpus: DataFrame, *, seed: int, vector_size: int = EMBED_SIZE,
                     min_count: int = EMBED_MIN_COUNT, num_partitions: int = M.W2V_PARTITIONS):
    """Word2Vec fitted on the tokenized ``info`` corpus."""
    tokens = features.tokenize(corpus, "info", "tokens").select("tokens")
    return M.word2vec(seed=seed, input_col="tokens", output_col="vec", vector_size=vector_size, min_count=min_count,
                      num_partitions=num_partitions).fit(pinned(tokens, "tokens"))


def embed_terms(model, df: DataFrame, vectors: DataFrame | None = None, tokens: Column | None = None, out: str = "vec") -> DataFrame:
    """``df`` with the mean word vector of each search term (unknown words count in the mean, [] gives zeros).

    By joins with the table of word vectors (``vectors``, written from the model if not given)."""
    vectors = M.word_vectors(model) if vectors is None else vectors
    tokens = T.ml_tokens(S.TERM) if tokens is None else tokens
    return M.mean_vectors(features.filled(df, S.TERM), S.TERM, tokens, vectors, model.getVectorSize(), out)


def corpus_w2v_submission(spark: SparkSession, train: DataFrame, test: DataFrame, attrs: DataFrame,
                          descriptions: DataFrame, *, seed: int, learner: str = "linear",
                          model=None) -> DataFrame:
    """M8 (``learner='linear'``) and M9 (``learner='forest'``, 15 trees, depth 3): (id, relevance).

    ``model`` may be an already fitted corpus Word2Vec model (fit once, score many)."""
    model = model or corpus_embedding(spark, corpus_info(train, test, attrs, descriptions), seed=seed)
    vectors = M.word_vectors(model)
    train_vec = materialize(embed_terms(model, train.select(S.ID, S.TERM, S.LABEL), vectors))
    if learner == "linear":
        est = M.linear(features_col="vec", **LINEAR_OLS)
    else:
        est = M.forest(seed=seed, features_col="vec", **CORPUS_FOREST)
    fitted = est.fit(train_vec)
    return M.score(fitted, embed_terms(model, test.select(S.ID, S.TERM), vectors))


def indexed_forest_submission(spark: SparkSession, train: DataFrame, test: DataFrame, attrs: DataFrame,
                              descriptions: DataFrame, *, seed: int, max_categories: int = 20,
                              model=None) -> DataFrame:
    """The scripts' disabled variant of M9, made to run: the label is the StringIndexer index of
    the relevance (most frequent value = 0), the term vectors go through a VectorIndexer, and a
    default random forest is fitted on the indexed features. Predictions are label indices.
    """
    from pyspark.ml.feature import StringIndexer

    model = model or corpus_embedding(spark, corpus_info(train, test, attrs, descriptions), seed=seed)
    vectors = M.word_vectors(model)
    train_vec = materialize(embed_terms(model, train.select(S.ID, S.TERM, S.LABEL), vectors))
    pipe = M.pipeline(StringIndexer(inputCol=S.LABEL, outputCol="label"),
                      M.vector_indexer("vec", "indexedFeatures", max_categories),
                      M.forest(seed=seed, features_col="indexedFeatures", label_col="label"))
    fitted = pipe.fit(train_vec)
    return fitted.transform(embed_terms(model, test.select(S.ID, S.TERM), vectors)).select(S.ID, "prediction")


# --- M3/M4/M5/M7: ML pipelines on search terms ------------------------------------------------

def term_classifier(labelled: DataFrame, to_score: DataFrame, text_col: str = "text",
                    num_features: int = TERM_HASH_BUCKETS, **settings):
    """M3: Tokenizer → HashingTF → LogisticRegression(10, 0.3, 0.8); returns (model, scored).

    ``settings`` replace those of the logistic regression."""
    pipe = M.pipeline(Tokenizer(inputCol=text_col, outputCol="words"),
                      HashingTF(inputCol="words", outputCol="features", numFeatures=num_features),
                      M.logistic(**{**LOGISTIC, **settings}))
    model = pipe.fit(materialize(features.filled(labelled, text_col)))
    return model, model.transform(features.filled(to_score, text_col))


def tfidf_linear(train: DataFrame, test: DataFrame, num_features: int = TFIDF_HASH_BUCKETS, **settings):
    """M4: Tokenizer → HashingTF(20) → IDF → LinearRegression(10, 0.3, 0.8) on search terms.

    ``settings`` replace those of the linear model. (model, scored ``test`` rows)."""
    pipe = M.pipeline(Tokenizer(inputCol=S.TERM, outputCol="words"),
                      HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features),
                      IDF(inputCol="rawFeatures", outputCol="features"),
                      M.linear(label_col="label", **{**LINEAR_ENET, **settings}))
    model = pipe.fit(materialize(features.filled(train, S.TERM)))
    return model, model.transform(features.filled(test, S.TERM))


def w2v_linear(train: DataFrame, test: DataFrame, *, seed: int, num_partitions: int = M.W2V_PARTITIONS):
    """M5: Tokenizer → Word2Vec(3, minCount 0) → LinearRegression(10, 0.3, 0.8) on search terms.

    (linear model, scored ``test`` rows with their ``features``)."""
    words = T.ml_tokens(S.TERM)
    rows = pinned(features.filled(train, S.TERM).withColumn("words", words), S.TERM)
    model = M.word2vec(seed=seed, input_col="words", output_col="features", vector_size=EMBED_SIZE,
                       min_count=TERM_EMBED_MIN_COUNT, num_partitions=num_partitions).fit(rows)
    vectors = M.word_vectors(model)
    linear = M.linear(label_col="label", **LINEAR_ENET).fit(materialize(embed_terms(model, rows.drop("words"), vectors, words, "features")))
    return linear, linear.transform(embed_terms(model, test, vectors, words, "features"))


def ngrams(tokens: Column, n: int) -> Column:
    """The n-grams of a token array, joined by a space, as the ML ``NGram`` gives them."""
    size = F.size(tokens)
    grams = F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))


def ngram_w2v_submission(train: DataFrame, test: DataFrame, *, seed: int, n: int = 1,
                         num_partitions: int = M.W2V_PARTITIONS) -> DataFrame:
    """M7: Tokenizer → NGram(n) → Word2Vec(3, minCount 5) → LinearRegression(10, 0, 0.8)."""
    grams = ngrams(T.ml_tokens(S.TERM), n)
    rows = pinned(features.filled(train.select(S.TERM, S.LABEL), S.TERM).withColumn("nGrams", grams), S.TERM)
    model = M.word2vec(seed=seed, input_col="nGrams", output_col="features", vector_size=EMBED_SIZE,
                       min_count=EMBED_MIN_COUNT, num_partitions=num_partitions).fit(rows)
    vectors = M.word_vectors(model)
    linear = M.linear(**LINEAR_OLS).fit(materialize(embed_terms(model, rows.drop("nGrams"), vectors, grams, "features")))
    return M.score(linear, embed_terms(model, test, vectors, grams, "features"))


def prediction_lines(scored: DataFrame, prob_digits: int | None = None) -> DataFrame:
    """(line): one printable line a scored row, ``(product, term) --> prediction=...``; with ``prob_digits``
    also the class probabilities (``prob``), to so many digits."""
    if prob_digits is None:
        return format_lines(scored, "(%d, %s) --> prediction=%f", S.PRODUCT, S.TERM, "prediction")
    prob = F.concat(F.lit("["), F.array_join(F.transform("prob", lambda p: F.format_string(f"%.{prob_digits}f", p)), ","), F.lit("]"))
    return format_lines(scored, "(%d, %s) --> prob=%s, prediction=%f", S.PRODUCT, S.TERM, prob, "prediction")


# --- M6: weighted TF score → linear regression --------------------------------------------------

def tf_score_linear(train: DataFrame, descriptions: DataFrame,
                    feature_cols: tuple[str, ...] = ("values", S.PRODUCT)):
    """M6: weighted TF score per pair → LinearRegression(10, 0.3, 0.8).

    The default features (values, product_uid) are the scripts'; product_uid is an identifier, so
    pass ``feature_cols=("values",)`` for a model that does not treat it as a number. A search term
    without words has no defined score (the scripts divide by zero); no word can match it, so it
    enters the model as 0.0 and every row is kept.
    """
    scored = features.weighted_tf_score(train, descriptions)
    scored = scored.withColumn("values", F.coalesce(F.col("values"), F.lit(0.0)))
    assembled = materialize(M.assembler(list(feature_cols)).transform(scored))  # fitted and scored from it
    model = M.linear(label_col="label", **LINEAR_ENET).fit(assembled)
    return model, model.transform(assembled)


# --- M10/M11: hit features → random forest -----------------------------------------------------

def hit_feature_table(pairs: DataFrame, descriptions: DataFrame, stem: bool = True,
                      stem_dictionary: str | None = None) -> DataFrame:
    """Hit features for every pair with a features vector; computed once for train and test."""
    hits = features.hit_features(pairs, descriptions, stem=stem, stem_dictionary=stem_dictionary)
    return hits.select(*[c for c in hits.columns if c not in HIT_COLS], *HIT_COLS,
                       M.dense_features(*HIT_COLS))


def hit_rf_submission(pairs: DataFrame, descriptions: DataFrame, is_test, *, seed: int,
                      num_trees: int = HIT_FOREST["num_trees"], max_depth: int = HIT_FOREST["max_depth"],
                      stem: bool = True, stem_dictionary: str | None = None) -> DataFrame:
    """M10: random forest on (term_len, tf_title, tf_desc); (id, relevance) of the test rows."""
    feats = materialize(hit_feature_table(pairs, descriptions, stem, stem_dictionary))
    train = feats.where(~is_test)
    model = M.forest(seed=seed, num_trees=num_trees, max_depth=max_depth).fit(train)
    return M.score(model, feats.where(is_test))


def hit_tvs_submission(pairs: DataFrame, descriptions: DataFrame, is_test, *, seed: int,
                       num_trees=TUNED_FOREST["num_trees"], max_depth: int = TUNED_FOREST["max_depth"],
                       train_ratio: float = TUNED_FOREST["train_ratio"], stem: bool = True,
                       stem_dictionary: str | None = None) -> DataFrame:
    """M11: train/validation split over a numTrees grid, refit on all train rows, score test."""
    feats = materialize(hit_feature_table(pairs, descriptions, stem, stem_dictionary))
    rf = M.forest(seed=seed, max_depth=max_depth)
    tvs = M.train_validation(rf, M.grid(rf.numTrees, num_trees), seed=seed, train_ratio=train_ratio)
    model = tvs.fit(feats.where(~is_test))
    return M.score(model, feats.where(is_test))
