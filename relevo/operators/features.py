"""Feature operators: hit features, weighted term-frequency score, tokens, n-grams, TF-IDF,
stop-word removal, label indexing.

The expensive rule throughout: product text (descriptions) is normalised once per product, before
it is joined to the search pairs, never once per pair after the join.
"""

from __future__ import annotations

from pyspark.ml.feature import NGram, StopWordsRemover, StringIndexer, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo import schemas as S
from relevo.functions import text as T
from relevo.operators import stemming
from relevo.session import MAX_SHUFFLE_PARTITIONS, broadcast_if_small, shared_table

#: Bytes of text whose (document, word) counts one task holds.
KEYED_BYTES = 8 << 20

_TEXT_COLS = (S.TITLE, S.TERM, S.DESCRIPTION)


def _passthrough(pairs: DataFrame) -> list[str]:
    return [c for c in pairs.columns if c not in _TEXT_COLS]


def hit_features(pairs: DataFrame, descriptions: DataFrame, stem: bool = False,
                 keep_zero: bool = False, missing: str = S.MISSING_TEXT,
                 stem_dictionary: str | None = None) -> DataFrame:
    """term_len, tf_title, tf_desc per search pair (id, product_uid, label pass through).

    * term tokens: ``words(clean(search_term))`` (optionally stemmed);
    * tf_title / tf_desc: how many term tokens occur as a substring of the glued title / glued
      description words (see ``substring_hits``);
    * a product without a description uses the ``missing`` text, normalised like any other text.

    Descriptions are cleaned and glued (and stemmed) once per product before the left join, so a
    long text is processed once however many pairs point at it. The join is a plain equi-join:
    Catalyst/AQE broadcast the product side when it is small, and otherwise AQE splits a product
    that holds a large share of the pairs across several tasks. A product with several description
    rows gives a row for each, as any left join does. ``stem_dictionary`` names a persistent (word, stem) table in shared storage
    that stemming reads and extends instead of stemming the whole vocabulary again.
    """
    keep = _passthrough(pairs)
    if stem:
        base, desc, default_blob = _stemmed_sides(pairs, descriptions, keep, keep_zero, missing,
                                                  stem_dictionary)
    else:
        term_c = T.clean(F.coalesce(F.col(S.TERM), F.lit("")), keep_zero)
        desc = descriptions.select(
            S.PRODUCT, T.glue_clean(F.col(S.DESCRIPTION), keep_zero).alias("_desc_blob"))
        default_blob = T.glue_clean(F.lit(missing), keep_zero)
        base = pairs.select(*keep, T.words(term_c).alias("_terms"),
                            T.glue_clean(F.coalesce(F.col(S.TITLE), F.lit("")), keep_zero).alias("_title_blob"))
        base = base.select(*keep, "_terms", T.substring_hits("_terms", "_title_blob").alias("_title_hits"))

    joined = base.join(desc, S.PRODUCT, "left")
    desc_blob = F.coalesce(F.col("_desc_blob"), default_blob)
    return joined.select(
        *keep,
        T.term_len("_terms").alias("term_len"),
        F.col("_title_hits").alias("tf_title"),
        T.substring_hits("_terms", desc_blob).alias("tf_desc"),
    )


def _stemmed_sides(pairs: DataFrame, descriptions: DataFrame, keep: list[str], keep_zero: bool,
                   missing: str, stem_dictionary: str | None = None):
    """Stemmed term tokens and title hits per pair, glued description stems per product.

    Texts are stemmed where they are (``cleaned_stems``) and written, so that the joined plan has no Python.
    Only words and a number of hits of a pair, and one string of a product, go to the
    description join; written as files, not a checkpoint, because a checkpoint can keep the hash
    partitioning (whenever the plan is not adaptive) and the join could then not split a hot product.
    """
    # The default is a constant: stem it once on the driver.
    default_blob = F.lit("".join(stemming.stem_text_constant(_clean_constant(missing, keep_zero))))
    if stem_dictionary is not None:
        return *_dictionary_sides(pairs, descriptions, keep, keep_zero, stem_dictionary), default_blob
    pattern = T.CLEAN_PATTERN_KEEP_ZERO if keep_zero else T.CLEAN_PATTERN
    term, title = (F.coalesce(F.col(c), F.lit("")) for c in (S.TERM, S.TITLE))
    base = pairs.select(*keep, stemming.cleaned_stems(term, pattern, " ").alias("_term"), stemming.cleaned_stems(title, pattern).alias("_title_blob"))
    base = base.select(*keep, T.words("_term").alias("_terms"), "_title_blob")
    base = shared_table(base.select(*keep, "_terms", T.substring_hits("_terms", "_title_blob").alias("_title_hits")), "stemmed-pairs")
    # rows without a key or a text can join nothing or take the default
    cleaned = descriptions.where(F.col(S.DESCRIPTION).isNotNull() & F.col(S.PRODUCT).isNotNull())
    desc = cleaned.select(S.PRODUCT, stemming.cleaned_stems(S.DESCRIPTION, pattern).alias("_desc_blob"))
    return base, shared_table(desc, "stemmed-descriptions"), default_blob


def _dictionary_sides(pairs: DataFrame, descriptions: DataFrame, keep: list[str], keep_zero: bool, stem_dictionary: str):
    """The same sides from a persistent stem dictionary: only words that it misses are stemmed.

    One vocabulary (description, title and term words) is looked up. Titles and search terms
    repeat across pairs, so each distinct phrase is regrouped once; the phrase table is
    written to the shared folder and joined back to the pairs. The staged pairs feed three jobs (the
    vocabulary, the phrase table and the features), so they are written once.
    """
    staged = shared_table(pairs.select(
        *keep,
        T.clean(F.coalesce(F.col(S.TERM), F.lit("")), keep_zero).alias("_tc"),
        T.clean(F.coalesce(F.col(S.TITLE), F.lit("")), keep_zero).alias("_ic")), "staged-pairs")
    phrases = (staged.select(F.col("_tc").alias("_phrase"))
               .union(staged.select(F.col("_ic").alias("_phrase"))).distinct())
    phrase_tokens = stemming.explode_words(phrases, ["_phrase"], F.col("_phrase"))

    # Cleaned once and written: the vocabulary and the stems both read it. Rows get a number, so that two
    # descriptions of one product stay two; rows without a key can join nothing and would only
    # meet in one group.
    cleaned = shared_table(
        descriptions.where(F.col(S.DESCRIPTION).isNotNull() & F.col(S.PRODUCT).isNotNull())
        .select(S.PRODUCT, T.clean(F.col(S.DESCRIPTION), keep_zero).alias("_text"), F.monotonically_increasing_id().alias("_row")), "descriptions")
    desc_tokens = stemming.explode_words(cleaned, [S.PRODUCT, "_row"], "_text")
    stems = stemming.prepared_stems(phrase_tokens, desc_tokens, dictionary=stem_dictionary)

    phrase_stems = shared_table(stemming.regrouped(phrases, ["_phrase"], "_phrase", stems, "_stems"), "stemmed-phrases")
    term_side = phrase_stems.select(F.col("_phrase").alias("_tc"), F.col("_stems").alias("_terms"))
    title_side = phrase_stems.select(F.col("_phrase").alias("_ic"),
                                     F.array_join("_stems", "").alias("_title_blob"))
    base = (staged.join(term_side, "_tc", "left").join(title_side, "_ic", "left")
            .select(*keep, F.coalesce("_terms", F.array().cast("array<string>")).alias("_terms"),
                    F.coalesce("_title_blob", F.lit("")).alias("_title_blob"))
            .select(*keep, "_terms", T.substring_hits("_terms", "_title_blob").alias("_title_hits")))

    desc = stemming.regrouped(cleaned, ["_row", S.PRODUCT], "_text", stems, "_stems")
    desc = desc.select(S.PRODUCT, F.array_join("_stems", "").alias("_desc_blob"))
    # Written once per product; the join to the pairs then stays skew-splittable.
    return base, shared_table(desc, "stemmed-descriptions")


def _clean_constant(text: str, keep_zero: bool) -> str:
    import re

    pattern = T.CLEAN_PATTERN_KEEP_ZERO if keep_zero else T.CLEAN_PATTERN
    # Java's \s and Python's ASCII \s agree on the characters that survive the class.
    return re.sub(pattern, "", text, flags=re.ASCII)


def word_counts(descriptions: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(product_uid, _counts) of every description row: how often it holds the words of ``vocabulary``.

    An inverted (product, word, count) table, folded to one (word -> count) map a description.
    Each text is split into words once. Its words meet the distinct vocabulary (_word) before anything
    is shuffled if that is small, and only counted words are shuffled; a vocabulary beyond the limit
    meets distinct (description, word) rows. Descriptions are told apart by a hash of their text, so
    that two of one product stay two; equal rows are counted together and parted again.
    """
    rows = descriptions.where(F.col(S.PRODUCT).isNotNull()).select(
        S.PRODUCT, F.xxhash64(S.DESCRIPTION).alias("_text"), F.coalesce(F.col(S.DESCRIPTION), F.lit("")).alias("_d"))
    key = [S.PRODUCT, "_text"]
    tokens = rows.select(*key, F.explode(T.words("_d")).alias("_word"))
    side = broadcast_if_small(vocabulary, "_word")
    if side is not vocabulary:
        found = tokens.join(side, "_word", "left_semi").groupBy(*key, "_word").agg(F.count("*").alias("n"))
    else:
        counted = shared_table(tokens.groupBy(*key, "_word").agg(F.count("*").alias("n")), "inverted-words")
        found = counted.join(vocabulary, "_word", "left_semi")
    copies = rows.groupBy(*key).agg(F.count("*").alias("_copies"))
    entries = F.collect_list(F.struct("_word", "n"))
    counted = copies.join(found.groupBy(*key).agg(entries.alias("_found")), key, "left")
    # copies of one description were counted together; a missing entry list gives a NULL map
    each = F.transform("_found", lambda x: F.struct(x["_word"], (x["n"] / F.col("_copies")).cast("int")))
    return counted.select(S.PRODUCT, F.map_from_entries(each).alias("_counts"), F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(S.PRODUCT, "_counts")


def weighted_tf_score(pairs: DataFrame, descriptions: DataFrame, label: str = S.LABEL,
                      title_weight: float = T.TITLE_WEIGHT, desc_weight: float = T.DESCRIPTION_WEIGHT,
                      join_how: str = "inner") -> DataFrame:
    """(id, product_uid, values, label): exact whole-word hits of the search words in the title
    and the description, each divided by the number of search words, weighted 4 : 1.

    A replacement for a driver loop over ``collect()``. ``values`` is NULL for an empty search term
    (the loop divided by zero). The pairs are reduced to their search words and title hits and written
    once; their distinct words ask the descriptions (``word_counts``), and what a pair's product
    brings to the join is a small map of counts, never the text or its words.
    """
    staged = shared_table(pairs.select(
        S.ID, S.PRODUCT, F.col(label).cast("double").alias("label"), T.words(F.coalesce(F.col(S.TERM), F.lit(""))).alias("_tw"),
        T.words(F.coalesce(F.col(S.TITLE), F.lit(""))).alias("_iw")).select(
        S.ID, S.PRODUCT, "label", "_tw", T.whole_word_hits("_tw", "_iw").alias("_title")), "scored-pairs")
    vocabulary = shared_table(staged.select(F.explode("_tw").alias("_word")).distinct(), "search-words")
    counts = shared_table(word_counts(descriptions, vocabulary), "word-counts")
    values = T.weighted_hits("_tw", F.col("_title"), T.counted_hits("_tw", "_counts"), title_weight, desc_weight)
    return staged.join(counts, S.PRODUCT, join_how).select(S.ID, S.PRODUCT, values.alias("values"), "label")


def tokenize(df: DataFrame, input_col: str, output_col: str) -> DataFrame:
    """ML ``Tokenizer`` (lower-case, split on single whitespace characters); NULL text is empty."""
    return Tokenizer(inputCol=input_col, outputCol=output_col).transform(filled(df, input_col))


def filled(df: DataFrame, *cols: str) -> DataFrame:
    """NULL text to '' in these columns: ML text stages fail on NULL."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in cols})


def token_rows(df: DataFrame, key: str, tokens_col: str) -> DataFrame:
    """One row per token: (key, pos, token). A map-only flat map, no shuffle."""
    return df.select(key, F.posexplode(tokens_col).alias("pos", "token"))


def ngram_counts(df: DataFrame, tokens_col: str, n: int = 2) -> DataFrame:
    """Frequency of every n-gram (``NGram(n)``) over all rows: (ngram, n_rows)."""
    grams = NGram(n=n, inputCol=tokens_col, outputCol="_grams").transform(df)
    return (grams.select(F.explode("_grams").alias("ngram"))
            .groupBy("ngram").agg(F.count(F.lit(1)).alias("n_rows")))


def tfidf_table(tokens: DataFrame, key: str, tokens_col: str, n_docs: int | None = None) -> DataFrame:
    """Relational TF-IDF with the IDF estimator's smoothing: tf * ln((m + 1) / (df + 1)).

    (key, token, tf, df, tfidf). ``m`` (the number of documents) is one scalar count; it is
    computed with a job when not given. Term frequencies are a partial+final aggregate on
    (key, token); document frequencies another aggregate on token; they join on token.
    """
    m = n_docs if n_docs is not None else tokens.select(key).count()
    # When the documents arrive hash-partitioned by key (see ``documents_by_key``), the
    # (key, token) aggregate needs no exchange: raw text is a smaller shuffle than (key, token) rows.
    # Written once: document frequencies and the join both read the table, not the documents.
    tf = shared_table(tokens.select(key, F.explode(tokens_col).alias("token"))
                      .groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf")), "term-frequency")
    # Document frequencies are written as a table, so the tf ⋈ df join can split a frequent token
    # (one row per document containing it) across tasks, or broadcast df when it is measured to be small:
    # then no (key, token) row is shuffled or sorted.
    dfreq = shared_table(tf.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "document-frequency")
    return (tf.join(broadcast_if_small(dfreq, "token"), "token")
            .select(key, "token", "tf", "df",
                    (F.col("tf") * F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0))).alias("tfidf")))


def documents_by_key(docs: DataFrame, key: str, n_bytes: int | None = None) -> DataFrame:
    """Documents hash-partitioned by their key before tokenizing, for per-document aggregates.

    With ``n_bytes``, the measured size of their text, a partition gets about ``KEYED_BYTES`` of it, so that the
    aggregate's memory in one task does not grow with the table.
    """
    parts = -(-(n_bytes or 0) // KEYED_BYTES)
    if parts <= int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return docs.repartition(key)
    return docs.repartition(min(parts, MAX_SHUFFLE_PARTITIONS), key)


def remove_stop_words(df: DataFrame, input_col: str, output_col: str,
                      stop_words: list[str] | None = None) -> DataFrame:
    """ML ``StopWordsRemover`` (Spark's English list unless given)."""
    remover = StopWordsRemover(inputCol=input_col, outputCol=output_col)
    if stop_words is not None:
        remover.setStopWords(stop_words)
    return remover.transform(df)


def vocabulary(tokens: DataFrame, tokens_col: str, min_count: int = 5) -> DataFrame:
    """Words with at least ``min_count`` occurrences: the vocabulary Word2Vec keeps (word, n)."""
    return (tokens.select(F.explode(tokens_col).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def index_labels(df: DataFrame, input_col: str = S.LABEL, output_col: str = "label") -> DataFrame:
    """``StringIndexer``: most frequent value gets 0.0; ties in alphabetical order."""
    model = StringIndexer(inputCol=input_col, outputCol=output_col,
                          stringOrderType="frequencyDesc").fit(df)
    return model.transform(df)
