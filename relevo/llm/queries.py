"""The registered queries of the operators: production parameters over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.llm import (
    bpe, embeddings, fingerprints, frames, langid, mixing, ngram_join, oracles, packing, prefix_trie, rlz_dedup, suffix_dedup, token_counts, variants, warc)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            frames.setting(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the word-end BPE vocabulary."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), tokenizer), tokenizer))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, and whether they pass a context of 1024 tokens."""
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.with_limit(counts, 1024)


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of at most 2048 tokens."""
    rows = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(rows)


@query("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", "near_edited", "near_next")


PIECES = "piece_bpe_32k.model"


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; rows of the held-out fold never train."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()), public_tokenizers.path(PIECES))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query("op9_embedding_neardup", oracles.EMBEDDINGS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.93 within a label."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query("op10_warc", oracles.WARC)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records, index them, look every page's URL up in the index, and read the records."""
    pages = table(spark, sf_dir, "pages")
    index = warc.write_archives(pages, min_bytes=0)
    return warc.read_records(warc.captures_of(index, pages)).select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_ngram_jaccard", oracles.NGRAM_JACCARD)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingle sets have a Jaccard similarity of 0.75."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), percent=75)


@query("op6_suffix_dedup", oracles.REPEATED_BYTES)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every byte covered by a 400-byte string that starts anywhere else in the documents."""
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=400)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_rlz_substring_dedup", oracles.EARLIER_WORDS)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every word covered by 50 words that also stand in a document of smaller id."""
    rows = rlz_dedup.remove_earlier(table(spark, sf_dir, "documents"), width=50)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_spelling_variants", oracles.SPELLING)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, slips of one in 199 runs included, under their frequent near words."""
    return variants.spelling_variants(variants.word_counts(table(spark, sf_dir, "documents"), drop_every=199))


@query("op12_prefix_trie", oracles.PREFIX_TRIE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with members, children and subtree totals."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_mixing", oracles.MIXING)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of all documents by source weights, 150 % of all words, at most twice a source."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
