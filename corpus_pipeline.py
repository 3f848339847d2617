"""The corpus pipeline: language ID, near-duplicate groups, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. Its rows are written as Parquet
and read back as the next stage's documents. All stages but the last return the columns of
``documents``.

* ``language_id``: rows with text in no known language go: no text, no letter, no language of at
  least ``MIN_SCORE``, or a text most of whose words are odd even for its best language. The
  model is fitted on the stage's own labelled rows.
* ``ngram_jaccard``: rows are decided one by one, whatever their ids: of each group of near
  duplicates the row of the smallest id (then of the smallest hash) stays, and of rows that repeat
  both id and text the first by their other columns. Other rows that share an id all stay.
* ``suffix_dedup``: every byte covered by a repeated 400-byte string goes; a character that is cut
  apart goes whole. Every row stays, with its rest of text and the number of its characters.
* ``best_fit_packing``: pieces in sequences of at most 2048 tokens.

Null ids stay through all stages, extra columns are carried along, and empty tables give empty
tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.llm import anchors, frames, langid, ngram_join, packing, suffix_dedup

MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.setting(spark)
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.keep_known(docs, model, MIN_SCORE)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.setting(spark)
    row = F.when(F.col("doc_id").isNotNull(), anchors.row_key(F.col("doc_id"), F.col("text")))
    keyed = docs.withColumn("_row", row)
    found = frames.written(ngram_join.jaccard_components(keyed, percent=75, id_col="_row"), "groups")
    linked = found.where("component_id != _row")
    members = linked.select("_row", "component_id").unionByName(linked.select(F.col("component_id").alias("_row"), "component_id")).distinct()
    ids = keyed.where("_row is not null").select("_row", "doc_id").distinct()
    members = frames.written(members.join(ids, "_row"), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("_first"))
    first = frames.written(first.select("component_id", F.col("_first._row").alias("_first")), "first")
    gone = frames.written(members.join(ngram_join.small(first), "component_id").where("_row != _first").select("_row"), "gone")
    again = frames.written(found.where("_row is not null").groupBy("_row").count().where("count > 1").select("_row"), "again")
    kept = keyed.join(ngram_join.small(gone), "_row", "left_anti")
    if again.isEmpty():
        return kept.select(*docs.columns)
    side = ngram_join.small(again)
    rest = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    once = kept.join(side, "_row", "left_semi").groupBy("_row", "doc_id", "text").agg(F.min_by(F.struct(*docs.columns), rest).alias("_kept"))
    return kept.join(side, "_row", "left_anti").select(*docs.columns).unionByName(once.select("_kept.*"))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.setting(spark)
    return suffix_dedup.cut_repeats(docs, width=400, count_col="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.setting(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Language models and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = frames.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
