"""Logical search-relevance tables derived from the driver's Parquet tables.

The driver ships TPC-H-like tables; these functions turn them into the data model the scripts use
(search pairs with a label, long-form attributes, product descriptions, labelled documents). Every
function reads only the columns it needs so the Parquet scan prunes to them.

Pairs: one row per ``l_orderkey * 10 + l_linenumber`` (that pair is not unique in ``lineitem``, so
it is grouped). The title comes from the pair's own part, the search term from the part named by
``l_suppkey``, the label from ``l_discount`` (1.0 .. 3.0 in steps of 0.2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo import schemas as S
from relevo.session import broadcast_if_small, shared_table, spread


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _search_text(p_name: Column, p_type: Column, p_brand: Column, pair_id: Column) -> Column:
    which = pair_id % 3
    return (F.when(which == 0, p_name)
            .when(which == 1, F.concat_ws(" ", p_name, p_type))
            .otherwise(F.concat_ws(" ", p_brand, p_name, p_type)))


def search_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labelled pairs: id, product_uid, product_title, search_term, relevance."""
    li = parquet(spark, sf_dir, "lineitem")
    pairs = (li.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(S.ID))
             .agg(F.min("l_partkey").alias(S.PRODUCT),
                  F.min("l_suppkey").alias("_sk"),
                  F.round(F.lit(1) + F.lit(20) * F.min("l_discount"), 2).alias(S.LABEL)))
    part = parquet(spark, sf_dir, "part")
    searched = part.select(F.col("p_partkey").alias("_sk"), F.col("p_name").alias("_s_name"),
                           F.col("p_type").alias("_s_type"), F.col("p_brand").alias("_s_brand"))
    titled = part.select(F.col("p_partkey").alias(S.PRODUCT),
                         F.concat_ws(" ", "p_brand", "p_type", "p_name").alias(S.TITLE))
    # Search terms come from the few parts that suppliers' keys name. If those are measured to be small they are
    # broadcast, and the pairs are shuffled to their products as bare keys, not with their search text.
    asked = li.select(F.col("l_suppkey").alias("_sk")).distinct()
    side = shared_table(searched.join(asked, "_sk", "left_semi"), "searched-parts")
    small = broadcast_if_small(side, "_s_name", "_s_type", "_s_brand")
    term = _search_text(F.col("_s_name"), F.col("_s_type"), F.col("_s_brand"), F.col(S.ID)).alias(S.TERM)
    if small is not side:
        return pairs.join(titled, S.PRODUCT).join(small, "_sk").select(S.ID, S.PRODUCT, S.TITLE, term, S.LABEL)
    # Otherwise the search-term side joins first, so the product-side join that follows (and any later
    # join on product_uid) reuses one hash partitioning of the pairs.
    return (pairs.join(side, "_sk").select(S.ID, S.PRODUCT, term, S.LABEL).join(titled, S.PRODUCT)
            .select(S.ID, S.PRODUCT, S.TITLE, S.TERM, S.LABEL))


def is_test_row(id_col: Column) -> Column:
    """Deterministic 80/20 hold-out used by the train/test files."""
    return id_col % 5 == 0


def train_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_pairs(spark, sf_dir).where(~is_test_row(F.col(S.ID)))


def test_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_pairs(spark, sf_dir).where(is_test_row(F.col(S.ID))).drop(S.LABEL)


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test pairs cut from one written pairs table.

    Jobs that read both would otherwise run the pairs' plan (a lineitem aggregate and two joins)
    once per side; here it runs once and both sides are filters over the table. It is written as
    files rather than checkpointed: a checkpoint can keep the plan's hash partitioning (it does
    whenever the plan is not adaptive), and a later join on product_uid would then get no exchange
    of its own for AQE to split; files read back never carry one.
    """
    pairs = shared_table(search_pairs(spark, sf_dir), "pairs")
    test = is_test_row(F.col(S.ID))
    return pairs.where(~test), pairs.where(test).drop(S.LABEL)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table, spread over the session's cores when it scans as too few splits."""
    return spread(parquet(spark, sf_dir, "documents"))


def product_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_uid, product_description (documents cover only part of the products)."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias(S.PRODUCT), F.col("text").alias(S.DESCRIPTION))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long key/value attributes, three per product: brand, size, type."""
    part = parquet(spark, sf_dir, "part")
    kv = F.explode(F.array(
        F.struct(F.lit("brand").alias(S.ATTR_NAME), F.col("p_brand").alias(S.ATTR_VALUE)),
        F.struct(F.lit("size").alias(S.ATTR_NAME), F.col("p_size").cast("string").alias(S.ATTR_VALUE)),
        F.struct(F.lit("type").alias(S.ATTR_NAME), F.col("p_type").alias(S.ATTR_VALUE)),
    ))
    return (part.select(F.col("p_partkey").alias(S.PRODUCT), kv.alias("_kv"))
            .select(S.PRODUCT, "_kv.name", "_kv.value"))


def classifier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents for the classifier pages: doc_id, text, label (= quality)."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = parquet(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id")


def files(spark: SparkSession, sf_dir: str, *tables: str) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of the tables' files, from the file system."""
    out = []
    for table in tables:
        for name in sorted(parquet(spark, sf_dir, table).inputFiles()):
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
            out.append((name, status.getLen(), status.getModificationTime()))
    return out


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Name the logical tables for SQL users (``createOrReplaceTempView``)."""
    search_pairs(spark, sf_dir).createOrReplaceTempView("pairs")
    train_pairs(spark, sf_dir).createOrReplaceTempView("train")
    test_pairs(spark, sf_dir).createOrReplaceTempView("test")
    attributes(spark, sf_dir).createOrReplaceTempView("attributes")
    product_descriptions(spark, sf_dir).createOrReplaceTempView("product_descriptions")
