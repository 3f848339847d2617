"""CSV sources and sinks: malformed-row policy, headerless reads, round trips, ordered output."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from relevo import schemas as S
from relevo.sinks import csv as sink
from relevo.sources import csv as csv_src
from relevo.operators import tables

INT_LABEL = StructType([
    StructField("id", IntegerType()), StructField("product_uid", IntegerType()),
    StructField("product_title", StringType()), StructField("search_term", StringType()),
    StructField("relevance", IntegerType()),
])

ROWS = "\n".join([
    "id,product_uid,product_title,search_term,relevance",
    '1,100,"Angle 10 in, zinc",angle brk,2.33',
    "2,101,Deck Over 20,deck stain,3",
    "3,101,Deck,,2.5",
    "x,102,Bad,bad,1",
    "4,103,Short row",
]) + "\n"


@pytest.fixture()
def train_csv(scratch):
    path = os.path.join(scratch, "train.csv")
    with open(path, "w") as f:
        f.write(ROWS)
    return path


def test_strict_read_drops_every_malformed_row_regardless_of_projection(spark, train_csv):
    df = csv_src.read_csv(spark, train_csv, schema=S.TRAIN, strict=True)
    ids = sorted(r["id"] for r in df.collect())
    assert ids == [1, 2, 3]
    # the same rows survive when only two columns are selected
    pruned = df.select(S.PRODUCT, S.LABEL).collect()
    assert len(pruned) == 3


def test_double_label_keeps_fractional_rows(spark, train_csv):
    df = csv_src.read_csv(spark, train_csv, schema=S.TRAIN, strict=True)
    assert sorted(r["relevance"] for r in df.collect()) == [2.33, 2.5, 3.0]


def test_integer_label_drops_fractional_rows_under_dropmalformed(spark, train_csv):
    df = csv_src.read_csv(spark, train_csv, schema=INT_LABEL, mode="DROPMALFORMED")
    assert [r["id"] for r in df.collect()] == [2]


def test_null_search_term_is_kept(spark, train_csv):
    df = csv_src.read_csv(spark, train_csv, schema=S.TRAIN, strict=True)
    row = df.where(F.col("id") == 3).first()
    assert row["search_term"] is None


def test_quoted_comma_is_one_field(spark, train_csv):
    df = csv_src.read_csv(spark, train_csv, schema=S.TRAIN, strict=True)
    assert df.where(F.col("id") == 1).first()["product_title"] == "Angle 10 in, zinc"


def test_headerless_read_joins_header_rows(spark, scratch):
    """Both files carry a header naming product_uid; read as data the two headers join."""
    train = os.path.join(scratch, "t.csv")
    desc = os.path.join(scratch, "d.csv")
    with open(train, "w") as f:
        f.write("id,product_uid,product_title,search_term,relevance\n1,100,Deck,deck,3\n")
    with open(desc, "w") as f:
        f.write("product_uid,product_description\n100,A deck\n")
    from relevo.plans import flows

    out = flows.stage1_join(spark, csv_src.read_csv(spark, train, header=False),
                            csv_src.read_csv(spark, desc, header=False))
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [("100", "Deck", "deck", "3", "A deck"),
                    ("product_uid", "product_title", "search_term", "relevance", "product_description")]


def test_round_trip_keeps_text_exactly(spark, scratch):
    text = ' leading space, "quoted" and\nnew line, trailing  '
    df = spark.createDataFrame([(1, 2, "t", "s", 1.5, text)],
                               "id long, product_uid long, product_title string, search_term string, relevance double, d string")
    path = os.path.join(scratch, "rt")
    sink.write_csv(df, path)
    schema = StructType([*S.TRAIN.fields, StructField("d", StringType())])
    back = csv_src.read_csv(spark, path, schema=schema, strict=True, multi_line=True).first()
    assert back["d"] == text


def test_existing_path_fails_by_default(spark, scratch):
    df = spark.range(3)
    path = os.path.join(scratch, "out")
    sink.write_csv(df, path)
    with pytest.raises(Exception):
        sink.write_csv(df, path)
    sink.write_csv(df, path, mode="overwrite")


def test_ordered_multi_part_output(spark, scratch):
    df = spark.range(0, 1000, numPartitions=4).select((F.lit(999) - F.col("id")).alias("id"),
                                                      F.lit(1.0).alias("relevance"))
    path = os.path.join(scratch, "sub")
    sink.write_submission(df, path)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    ids = []
    for p in parts:
        with open(os.path.join(path, p)) as f:
            ids += [int(line.split(",")[0]) for line in f.read().splitlines()[1:]]
    assert ids == list(range(1000))


def test_single_file_output(spark, scratch):
    df = spark.range(0, 100, numPartitions=4).withColumn("relevance", F.lit(2.0))
    path = os.path.join(scratch, "single")
    sink.write_submission(df, path, single_file=True)
    assert len([p for p in os.listdir(path) if p.startswith("part-")]) == 1


def test_union_by_position_swaps_silently_by_name_does_not(spark):
    a = spark.createDataFrame([(1, "title", "term")], "p long, product_title string, search_term string")
    b = spark.createDataFrame([(2, "term2", "title2")], "p long, search_term string, product_title string")
    by_pos = {r["p"]: r["product_title"] for r in tables.union_pairs(a, b, by_name=False).collect()}
    by_name = {r["p"]: r["product_title"] for r in tables.union_pairs(a, b).collect()}
    assert by_pos[2] == "term2"
    assert by_name[2] == "title2"


def test_format_lines(spark):
    df = spark.createDataFrame([(7, "deck stain", 2.5)], "id long, t string, p double")
    line = sink.format_lines(df, "(%d, %s) --> prediction=%f", "id", "t", "p").first()["line"]
    assert line == "(7, deck stain) --> prediction=2.500000"


def test_flatten_attributes_orders_by_name_and_skips_nulls(spark):
    df = spark.createDataFrame([(1, "type", "B"), (1, "brand", "A"), (2, "x", None), (1, "size", "9")],
                               "product_uid long, name string, value string")
    got = {r["product_uid"]: r["attr_list"] for r in tables.flatten_attributes(df).collect()}
    assert got == {1: "A 9 B", 2: ""}


def test_attach_product_text_defaults(spark):
    pairs = spark.createDataFrame([(1, 10), (2, 11)], "id long, product_uid long")
    desc = spark.createDataFrame([(10, "text")], "product_uid long, product_description string")
    got = {r["id"]: r["product_description"] for r in tables.attach_product_text(pairs, None, desc).collect()}
    assert got == {1: "text", 2: "empty"}


def test_ordered_limit_requires_order(spark):
    with pytest.raises(ValueError):
        tables.ordered_limit(spark.range(5), 2)
    assert [r["id"] for r in tables.ordered_limit(spark.range(5), 2, F.col("id").desc()).collect()] == [4, 3]


def test_rename_helpers(spark):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    assert tables.rename_all(df, ["a", "b"]).columns == ["a", "b"]
    assert tables.rename(df, {"y": "label"}).columns == ["x", "label"]
