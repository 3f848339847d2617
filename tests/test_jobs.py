"""CSV-folder jobs end to end: write the fixture tables as the CSV layout, run, read the output."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from relevo import schemas as S
from relevo.plans import jobs
from relevo.sinks.csv import write_csv
from relevo.sources import tables as src

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def csv_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv"))
    parts = {
        "train.csv": src.train_pairs(spark, SF_SMALL),
        "test.csv": src.test_pairs(spark, SF_SMALL),
        "attributes.csv": src.attributes(spark, SF_SMALL),
        "product_descriptions.csv": src.product_descriptions(spark, SF_SMALL),
    }
    for name, df in parts.items():
        write_csv(df, os.path.join(folder, name))
    return folder


def _read(spark, path, schema):
    return spark.read.option("header", True).option("multiLine", True).schema(schema).csv(path)


@pytest.mark.parametrize("job", ["hit_forest", "hit_forest_tuned", "ngram_linear"])
def test_submission_jobs(spark, csv_dir, tmp_path, job):
    out = str(tmp_path / job)
    jobs.run(spark, job, csv_dir, out, seed=3)
    sub = _read(spark, out, S.SUBMISSION)
    test_ids = {r[S.ID] for r in src.test_pairs(spark, SF_SMALL).select(S.ID).collect()}
    got = sub.collect()
    assert {r[S.ID] for r in got} == test_ids
    assert all(r[S.LABEL] is not None for r in got)


def test_wide_table_job(spark, csv_dir, tmp_path):
    from relevo.plans import flows
    from relevo.sources.csv import read_csv
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

    out = str(tmp_path / "wide")
    jobs.run(spark, "wide_table", csv_dir, out, multi_line=["product_descriptions"])  # texts hold line breaks
    assert glob.glob(os.path.join(out, "part-*"))
    schema = StructType([StructField("product_uid", LongType()), StructField("search_term", StringType()),
                         StructField("product_title", StringType()), StructField("value_list", StringType()),
                         StructField("product_description", StringType()), StructField("relevance", DoubleType())])
    written = read_csv(spark, out, schema=schema, strict=True, multi_line=True)
    expected = flows.wide_training_table(src.train_pairs(spark, SF_SMALL), src.attributes(spark, SF_SMALL),
                                         src.product_descriptions(spark, SF_SMALL))
    assert sorted(written.collect()) == sorted(expected.collect())


def test_hit_forest_with_stem_dictionary(spark, csv_dir, tmp_path):
    out = str(tmp_path / "dict_job")
    jobs.run(spark, "hit_forest", csv_dir, out, seed=3, stem_dictionary=str(tmp_path / "stems"))
    assert _read(spark, out, S.SUBMISSION).count() == src.test_pairs(spark, SF_SMALL).count()
    assert spark.read.parquet(str(tmp_path / "stems")).count() > 0


def test_query_cli_writes_parquet_and_csv(spark, tmp_path):
    from relevo.plans import cli

    out = str(tmp_path / "hits")
    cli.main(["hit_features", SF_SMALL, out])
    assert spark.read.parquet(out).count() == src.search_pairs(spark, SF_SMALL).count()
    out_csv = str(tmp_path / "vec")
    cli.main(["hashed_tf", SF_SMALL, out_csv, "--format", "csv"])   # array column written as JSON
    assert spark.read.option("header", True).csv(out_csv).count() == src.search_pairs(spark, SF_SMALL).count()


@pytest.mark.parametrize("job", ["stage1_join", "term_classifier", "tfidf_linear", "w2v_linear", "tf_score_linear"])
def test_scored_table_jobs(spark, csv_dir, tmp_path, job):
    out = str(tmp_path / job)
    jobs.run(spark, job, csv_dir, out, seed=3, multi_line=["product_descriptions"])
    rows = spark.read.option("header", True).option("multiLine", True).csv(out)
    test = src.test_pairs(spark, SF_SMALL).count()
    expected = {"stage1_join": src.train_pairs(spark, SF_SMALL), "tf_score_linear": src.train_pairs(spark, SF_SMALL)}
    want = expected[job].join(src.product_descriptions(spark, SF_SMALL), S.PRODUCT).count() if job in expected else test
    assert rows.count() == want


def test_bigram_job(spark, csv_dir, tmp_path):
    out = str(tmp_path / "bigrams")
    jobs.run(spark, "ngram_linear", csv_dir, out, seed=3, n=2)
    assert _read(spark, out, S.SUBMISSION).count() == src.test_pairs(spark, SF_SMALL).count()
