"""CSV with line breaks in quoted fields, read in parallel: the same rows as a one-task read."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from relevo.sources import csv as csv_src
from relevo.sources import multiline

SCHEMA = StructType([StructField("id", IntegerType()), StructField("text", StringType()), StructField("note", StringType()),
                     StructField("value", DoubleType())])


def _field(rng: random.Random) -> str:
    parts = rng.choices(["word", "two words", "\n", "\n\n", ",", '\\"', "é😀", "x" * 30, "\r\n", ""], k=rng.randrange(12))
    return '"' + "".join(parts) + '"'


def _write(path: str, rows: int, seed: int, header: bool = True, end: str = "\n") -> None:
    rng = random.Random(seed)
    with open(path, "w", newline="") as f:
        if header:
            f.write('id,"te\nxt",note,value\n')
        f.write('-1,"first\n",plain,1.5\n')  # its line break is the file's
        for i in range(rows):
            text = _field(rng) if rng.random() < 0.7 else rng.choice(["plain", '5" pipe', "", " lead"])
            value = rng.choice(["1.5", "2", "", "n/a"])
            f.write(f"{i},{text},{_field(rng)},{value}\n" if rng.random() < 0.95 else f"{i},short\n")
            if rng.random() < 0.03:
                f.write("\n")
            if i == rows // 2:
                f.write(f'{i},"' + "long record\n" * 400 + '",n,3\n')
        f.write(f'{rows},last,"no end of file break",4{end}')


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(df):
    """The rows in an order; a record that the file's end leaves open may lack the last line break."""
    return sorted(str(tuple(v.rstrip("\n") if isinstance(v, str) else v for v in r)) for r in df.collect())


def _one_task(spark, path, header, schema=None, mode="PERMISSIVE"):
    reader = spark.read.options(header=header, multiLine=True, mode=mode, emptyValue=csv_src.EMPTY,
                                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return csv_src._with_empty((reader.schema(schema) if schema else reader).csv(path))


@pytest.mark.parametrize("schema,header,mode", [(None, True, "PERMISSIVE"), (None, False, "PERMISSIVE"), (SCHEMA, True, "PERMISSIVE"), (SCHEMA, True, "DROPMALFORMED")])
def test_many_blocks_equal_one_task(spark, scratch, small_splits, schema, header, mode):
    """Breaks, doubled and escaped quotes, quotes in plain fields, records over many blocks, several files."""
    folder = os.path.join(scratch, f"in-{header}-{mode}-{schema is None}")
    os.makedirs(folder)
    for k, end in enumerate(["\n", "", "\n\n"]):
        _write(os.path.join(folder, f"part-{k}.csv"), 150, k, header, end)
    got = csv_src.read_csv(spark, folder, schema=schema, header=header, mode=mode, multi_line=True)
    want = _one_task(spark, folder, header, schema, mode)
    # count over all columns: dropping malformed rows depends on the columns read
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)
    assert spark.read.option("lineSep", "\n").text(folder).rdd.getNumPartitions() > 20


def test_strict_reading_of_many_blocks(spark, scratch, small_splits):
    path = os.path.join(scratch, "strict.csv")
    _write(path, 200, 7)
    rows = csv_src.read_csv(spark, path, schema=SCHEMA, strict=True, multi_line=True)
    as_text = StructType([*[StructField(f.name, StringType()) for f in SCHEMA.fields], StructField("bad", StringType())])
    one = spark.read.options(header=True, multiLine=True, emptyValue=csv_src.EMPTY, columnNameOfCorruptRecord="bad", columnPruning=False,
                             ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).schema(as_text).csv(path)
    good = [r for r in one.collect() if r["bad"] is None and str(r["id"]).removeprefix("-").isdecimal() and r["value"] in (None, "1.5", "2", "3", "4")]
    assert 20 < len(good) < 200
    assert sorted(str(r["id"]) for r in rows.collect()) == sorted(r["id"] for r in good)
    assert rows.select("id").count() == rows.count()


def test_state_after_a_line():
    after = multiline.inside_after
    assert not after("a,b", False) and after("a,b", True)
    assert after('a,"b', False) and not after('b",c', True)
    # the reader's escape is a backslash: a doubled quote ends what can hold a break
    assert not after('a,"b ""c"" d",e', False) and not after('"a ""', False)
    assert not after('5" pipe,12" board', False)
    assert after('"a \\" b', False) and not after('\\" b",c', True)
    assert not after("", False) and after("", True)
    assert after('x","y', True)


def test_windows_line_breaks(spark, scratch, small_splits):
    path = os.path.join(scratch, "crlf.csv")
    with open(path, "w", newline="") as f:
        f.write("id,text,note,value\r\n" + "".join(f'{i},"x\r\ny{i}",plain,1.5\r\n\r\n' for i in range(90)))
    got = csv_src.read_csv(spark, path, schema=SCHEMA, multi_line=True)
    assert _rows(got) == _rows(_one_task(spark, path, True, SCHEMA)) and got.count() == 90
    assert {r["text"] for r in got.collect()} == {f"x\ny{i}" for i in range(90)}


def test_empty_file(spark, scratch):
    path = os.path.join(scratch, "empty.csv")
    open(path, "w").close()
    assert csv_src.read_csv(spark, path, schema=SCHEMA, multi_line=True).count() == 0
