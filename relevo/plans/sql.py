"""The core relational queries as Spark SQL over the logical views.

``relevo.sources.tables.register_views`` names the tables (pairs, train, test, attributes,
product_descriptions); these statements then run with ``spark.sql``. They use the same built-in
functions as the DataFrame operators, so Catalyst plans them the same way (pruned scans, native
expressions, product text normalised before the join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Kept characters of the cleaning step and Java's white space (\u000B vertical tab, \u000C form
# feed), written as Spark SQL string literals.
_KEEP = r"'[a-zA-Z1-9\\s]+'"
_WS = r"' \t\n\u000B\u000C\r'"


def _clean(x: str) -> str:
    return f"array_join(regexp_extract_all({x}, {_KEEP}, 0), '')"


def _glue_clean(x: str) -> str:
    return f"lower(translate({_clean(x)}, {_WS}, ''))"


def _words(x: str) -> str:
    return rf"array_remove(split(lower({x}), '\\s+'), '')"


HIT_FEATURES = f"""
WITH d AS (
  SELECT product_uid, {_glue_clean('product_description')} AS desc_blob
  FROM product_descriptions
), p AS (
  SELECT id, product_uid, relevance,
         {_words(_clean("coalesce(search_term, '')"))} AS terms,
         {_glue_clean("coalesce(product_title, '')")} AS title_blob
  FROM pairs
)
SELECT p.id, p.product_uid, p.relevance,
       size(p.terms) AS term_len,
       size(filter(p.terms, t -> contains(p.title_blob, t))) AS tf_title,
       size(filter(p.terms, t -> contains(coalesce(d.desc_blob, 'empty'), t))) AS tf_desc
FROM p LEFT JOIN d ON d.product_uid = p.product_uid
"""

ATTRIBUTES_FLAT = """
SELECT product_uid,
       array_join(transform(array_sort(collect_list(struct(name AS n, value AS v))), x -> x.v), ' ') AS attr_list
FROM attributes
GROUP BY product_uid
"""

STAGE1_JOIN = """
SELECT q.product_uid AS prod_uid, q.product_title AS title, q.search_term AS search,
       q.relevance AS rel, d.product_description AS desc
FROM pairs q JOIN product_descriptions d ON d.product_uid = q.product_uid
"""

STATEMENTS = {"hit_features": HIT_FEATURES, "attributes_flat": ATTRIBUTES_FLAT,
              "stage1_join": STAGE1_JOIN}


def run(spark: SparkSession, name: str) -> DataFrame:
    """Run one statement over the registered views."""
    return spark.sql(STATEMENTS[name])
