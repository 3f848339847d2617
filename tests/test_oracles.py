"""Every registered query with oracle SQL agrees with DuckDB on the small driver tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from relevo.plans import registry

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def _norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(pdf, cols):
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    got = registry.QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    cols = sorted(got.columns)
    assert _rows(got, cols) == _rows(want, cols)


def test_every_query_runs_and_entry_works(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["id", "product_uid", "relevance", "term_len", "tf_title", "tf_desc"]
    assert df.count() > 0
