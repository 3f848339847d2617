"""The Spark SQL statements equal the DataFrame operators on the same views."""

from __future__ import annotations

from relevo.operators import features, tables
from relevo.plans import sql
from relevo.sources import tables as src

from .conftest import SF_SMALL


def test_sql_statements_equal_dataframe_operators(spark):
    src.register_views(spark, SF_SMALL)
    df_hits = features.hit_features(src.search_pairs(spark, SF_SMALL), src.product_descriptions(spark, SF_SMALL))
    assert sorted(sql.run(spark, "hit_features").collect()) == sorted(df_hits.collect())
    df_attrs = tables.flatten_attributes(src.attributes(spark, SF_SMALL))
    assert sorted(sql.run(spark, "attributes_flat").collect()) == sorted(df_attrs.collect())
    assert sql.run(spark, "stage1_join").count() == src.search_pairs(spark, SF_SMALL).join(
        src.product_descriptions(spark, SF_SMALL), "product_uid").count()
