"""CSV files whose quoted fields hold line breaks, read in parallel.

A line break ends a record only outside quotes, so where a block's first record starts depends on
all blocks before it. Two passes over the file find it without reading it in one task:

1. every block (a split of the file) is scanned from both possible states, outside and inside
   quotes, and tells the state at its end for each;
2. those pairs are chained per file on the driver: two flags a block, whatever the block's size;
3. every block now cuts its own lines into records. What precedes its first break belongs to a record
   that began earlier; such pieces (at most two a block) are joined by the record they belong to.

The records are then parsed one by one with the reader's own rules: quotes are escaped by a backslash.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: A quoted field's rest: anything up to a quote that is not escaped. What follows that quote up to the next
#: comma belongs to the field, but can hold no line break any more.
_CLOSING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)


def inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after a line, given whether one was open before it."""
    at = 0
    if not inside and '"' not in line:
        return False
    while True:
        if inside:
            end = _CLOSING.match(line, at)
            if end is None:
                return True
            at, inside = end.end(), False
        else:
            if line.startswith('"', at):
                at, inside = at + 1, True
                continue
        at = line.find(",", at) + 1  # the next field; a quote inside an unquoted one means nothing
        if not at:
            return False


def records(spark: SparkSession, path: str | Sequence[str], header: bool) -> DataFrame:
    """(record): the records of CSV files as text, line breaks in quoted fields kept.

    ``header`` drops the first record of every file; empty lines between records are none. A file is split as
    any text file is, and one task reads the lines of a split in order. A file whose first line ends in
    CR LF has that for a line break everywhere, and LF in its fields. A file that ends inside
    quotes ends its last record there, without the last line break.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ends outside in, inside in; a record ends in between, inside in; whether the first line ends in CR
        found: dict[tuple, list[bool]] = {}
        for batch in batches:
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                state = found.setdefault((file, start), [False, True, False, line.endswith("\r")])
                state[0], state[1] = inside_after(line, state[0]), inside_after(line, state[1])
                state[2] |= not state[1]
        yield pa.RecordBatch.from_pylist([dict(zip(_BLOCKS.names, (*k, *v), strict=True)) for k, v in found.items()], _BLOCKS)

    blocks: dict[tuple, tuple] = {}
    inside, owner, last, crlf = False, 0, None, False
    # two flags a split; the driver plans as many splits anyway
    for b in sorted(lines.mapInArrow(scan, "file string, start long, outside boolean, inside boolean, broken boolean, crlf boolean").collect()):
        if b["file"] != last:
            inside, owner, last, crlf = False, b["start"], b["file"], b["crlf"]
        blocks[b["file"], b["start"]] = (inside, owner, crlf)
        if not inside or b["broken"]:
            owner = b["start"]  # a record that is open at this block's end began in it
        inside = b["inside"] if inside else b["outside"]
    shared = spark.sparkContext.broadcast(blocks)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, inside, head, first = None, [], False, False, False
        for batch in batches:
            out = []
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != (file, start):
                    if held:
                        out.append(piece(block, held, head, False, first))
                    block, held = (file, start), []
                    inside = head = shared.value[block][0]
                    first = start == 0
                held.append(line)
                inside = inside_after(line, inside)
                if not inside:
                    out.append(piece(block, held, head, not head, first))
                    held, head, first = [], False, False
            yield pa.RecordBatch.from_pylist(out, _PIECES)
        if held:
            yield pa.RecordBatch.from_pylist([piece(block, held, head, False, first)], _PIECES)

    def piece(block: tuple, held: list[str], head: bool, whole: bool, first: bool) -> dict:
        owner = shared.value[block][1] if head else block[1]
        return dict(zip(_PIECES.names, (block[0], owner, block[1], whole, first, shared.value[block][2], "\n".join(held)), strict=True))

    pieces = lines.mapInArrow(cut, "file string, owner long, start long, whole boolean, first boolean, crlf boolean, text string")
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    split = pieces.where("not whole").groupBy("file", "owner").agg(
        F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"), F.max("first").alias("first"),
        F.max("crlf").alias("crlf"))
    found = pieces.where("whole").select("text", "first", "crlf").unionByName(split.select("text", "first", "crlf"))
    found = found.withColumn("text", F.when(F.col("crlf"), F.regexp_replace(F.regexp_replace("text", r"\r\z", ""), "\r\n", "\n")).otherwise(F.col("text")))
    wanted = ~F.col("first") if header else F.lit(True)
    return found.where(wanted & (F.col("text") != "")).select(F.col("text").alias("record"))


def read(spark: SparkSession, path: str | Sequence[str], schema: StructType, header: bool, mode: str, options: dict[str, str]) -> DataFrame:
    """The records parsed with a schema, like a multi-line read by one task a file."""
    drop = mode.upper() == "DROPMALFORMED"
    fields = list(schema.fields)
    if drop:
        fields.append(StructField(_MALFORMED, StringType()))
        options = {**options, "columnNameOfCorruptRecord": _MALFORMED}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    options = {**options, "mode": "PERMISSIVE" if drop else mode, "multiLine": "true"}
    rows = records(spark, path, header).select(F.from_csv("record", ddl, options).alias("_row")).select("_row.*")
    return rows.where(F.col(_MALFORMED).isNull()).drop(_MALFORMED) if drop else rows


_MALFORMED = "_malformed_record"
_BLOCKS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()), ("broken", pa.bool_()), ("crlf", pa.bool_())])
_PIECES = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("whole", pa.bool_()), ("first", pa.bool_()), ("crlf", pa.bool_()), ("text", pa.string())])
