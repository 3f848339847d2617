"""Relational operators on the search-relevance tables: flatten, attach, union, order, limit.

All are plain DataFrame plans. No join carries a hint: Catalyst/AQE broadcasts a side only when its
measured size is under the session threshold and otherwise plans a sort-merge join; AQE also
splits skewed join partitions (a product holding a large share of all pairs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo import schemas as S


def flatten_attributes(attrs: DataFrame, sep: str = " ", out: str = "attr_list",
                       key: str = S.PRODUCT, name: str = S.ATTR_NAME,
                       value: str = S.ATTR_VALUE) -> DataFrame:
    """One row per product with its attribute values joined by ``sep``, ordered by name.

    ``collect_list`` order is undefined after a shuffle, so (name, value) pairs are collected and
    sorted inside the group; NULL values are skipped and an all-NULL group gives ''. The partial
    aggregate runs map side, so each product's values cross the network once. A group holds exactly
    what its one output string will contain, so even a product with a large share of all attribute
    rows needs no more memory than its own result.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), F.col(value).alias("v"))))
    # a row without a key can join nothing; without the filter all of them would meet in one group
    return attrs.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array_join(F.transform(pairs, lambda x: x["v"]), sep).alias(out))


def with_default(col: str, default: str = S.MISSING_TEXT) -> Column:
    """NULL to a default text (the CASE WHEN x IS NULL default of the scripts)."""
    return F.coalesce(F.col(col), F.lit(default)).alias(col)


def attach_product_text(pairs: DataFrame, attrs_flat: DataFrame | None,
                        descriptions: DataFrame | None, key: str = S.PRODUCT,
                        default: str | None = S.MISSING_TEXT) -> DataFrame:
    """Left-join chain pairs ⟕ flattened attributes ⟕ descriptions, with default texts.

    Both joins are on the product key, so the pairs are hash-partitioned on it once and the second
    join reuses that partitioning when both joins are sort-merge joins.
    """
    out = pairs
    added = []
    for side in (attrs_flat, descriptions):
        if side is None:
            continue
        out = out.join(side, key, "left")
        added += [c for c in side.columns if c != key]
    if default is not None:
        out = out.select(*[with_default(c, default) if c in added else F.col(c) for c in out.columns])
    return out


def union_pairs(a: DataFrame, b: DataFrame, by_name: bool = True) -> DataFrame:
    """UNION ALL of two pair tables on their common columns.

    By name by default. ``by_name=False`` is the positional union of the scripts, which silently
    swaps values when the column orders differ.
    """
    if by_name:
        common = [c for c in a.columns if c in b.columns]
        return a.select(*common).unionByName(b.select(*common))
    return a.union(b)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows holding a NULL in any (or any listed) column (``na.drop()``)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def row_count(df: DataFrame, name: str) -> DataFrame:
    """(table, n): the number of rows of a table as a one-row aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")


def ordered_limit(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows by an explicit order (a plain ``limit`` picks arbitrary rows).

    Planned as TakeOrderedAndProject: each task keeps its own top ``n`` and only those reach the
    final merge, so no full sort or shuffle of the input happens.
    """
    if not order:
        raise ValueError("ordered_limit needs an order key")
    return df.orderBy(*order).limit(n)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position (``toDF(names: _*)``)."""
    return df.toDF(*names)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename selected columns by SQL expression (``selectExpr('a as b', ...)``), keeping order."""
    return df.selectExpr(*[f"`{c}` as `{mapping.get(c, c)}`" for c in df.columns])
