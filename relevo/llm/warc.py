"""WARC archives with a two-level capture index.

Pages become WARC/1.1 records, each its own gzip member, in one archive file per task. Of equal
payloads one record carries the payload; the others are ``revisit`` records that name it. The
capture index has two levels: entries sorted by reversed-host URL key are packed into compressed
blocks, and a sparse directory keeps the first and last key of each block. A lookup searches
the directory, unpacks the blocks that may hold its key, searches them, and reads only the byte
ranges it finds.

Archives lie in the folder of ``spark.checkpoint.dir`` and are written and read through
``pyarrow.fs``, by the scheme of that folder. Every task attempt writes a file of its own name; only
entries of successful tasks reach the index, so a lost executor leaves at most an unused file.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo.llm.bpe import arrow_type
from relevo.llm.frames import partitions, scratch, written

#: Entries of one compressed index block.
BLOCK_ENTRIES = 512
GZIP_LEVEL = 5
#: The tables carry no capture time; the mandatory date field gets this one.
DATE = "1970-01-01T00:00:00Z"
ENTRY = "key string, page {0}, file string, offset long, length int"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """The URL with its host reversed, lower-cased, without scheme: ``org,example)/path``."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?(.*)", url or "", re.S)
    host = ",".join(reversed(m.group(1).lower().split(".")))
    return f"{host}{m.group(2) or ''}){m.group(3) or '/'}" if url else ""


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record; a revisit keeps the HTTP header of the full payload but not the payload."""
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    target = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m.group()):02X}", url) if url else "about:invalid"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one uncompressed record."""
    head, rest = record.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length does not agree with its header")
    return fields, rest[:n]


def _payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def write_archives(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row and return the capture index (see ``build_index``).

    Of records with equal payloads of at least ``min_bytes`` that with the largest id is the
    response, the others revisit it; smaller payloads are all responses. Null html is empty, a null
    URL has an empty key. A row with a null id is a response that nothing refers to; rows that
    repeat the largest id are all responses. An empty table gives an empty index.
    """
    spark = pages.sparkSession
    kind, key_type = pages.schema[id_col].dataType.simpleString(), arrow_type(pages, id_col)
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), _payload(F.col(html_col)).alias("payload"))
    marked = rows.withColumn("sha", F.sha1("payload"))
    same = written(
        marked.where(F.col("page").isNotNull() & (F.length("payload") >= min_bytes))
        .groupBy("sha").agg(F.max("page").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first"), "same")
    big = F.length("payload") >= min_bytes
    typed = marked.join(same, "sha", "left").select(
        "page", "url", "payload", F.when(big & F.col("page").isNotNull() & (F.col("page") != F.col("first")), F.col("first")).alias("refers_to"))
    folder = scratch(spark, "warc")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            entries = []
            for page, url, payload, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                gz = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                raw = gz.compress(_record(page.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())) + gz.flush()
                out.write(raw)
                entries.append((url_key(url.as_py()), page.as_py(), f"{folder}/{name}", at, len(raw)))
                at += len(raw)
            if entries:
                yield _entries(entries, key_type)
        if out is not None:
            out.close()

    # written at once: each entry then names a finished file
    return build_index(written(typed.mapInArrow(write, ENTRY.format(kind)), "captures"))


def _entries(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    kinds = (pa.string(), key_type, pa.string(), pa.int64(), pa.int32())
    cols = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["key", "page", "file", "offset", "length"])


def build_index(captures: DataFrame) -> DataFrame:
    """Pack sorted entries into blocks: (part, block, first_key, last_key, entries, data), written as Parquet.

    The key columns are the sparse directory; ``data`` is the compressed block; ``part`` the range
    of keys that one task packed.
    """

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= BLOCK_ENTRIES:
                yield block(held[:BLOCK_ENTRIES])
                held = held[BLOCK_ENTRIES:]
        if held:
            yield block(held)

    def block(rows: list[dict]) -> pa.RecordBatch:
        data = zlib.compress(json.dumps([list(r.values()) for r in rows]).encode())
        return pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "block": uuid.uuid4().hex, "first_key": rows[0]["key"], "last_key": rows[-1]["key"], "entries": len(rows), "data": data}],
                                          pa.schema([("part", pa.int32()), ("block", pa.string()), ("first_key", pa.string()), ("last_key", pa.string()), ("entries", pa.int32()), ("data", pa.binary())]))

    n = partitions(captures.sparkSession)
    order = ["key", "page", "file", "offset"]
    ranged = captures.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return written(ranged.mapInArrow(blocks, "part int, block string, first_key string, last_key string, entries int, data binary"), "index")


def entries(index: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Every entry of the index: (key, page, file, offset, length)."""
    key_type = pa.string() if id_type == "string" else pa.int64()

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield _entries(json.loads(zlib.decompress(data.as_py())), key_type)

    return index.select("data").mapInArrow(unpack, ENTRY.format("string" if id_type == "string" else "bigint"))


def lookup(index: DataFrame, urls: list[str], id_type: str = "bigint") -> DataFrame:
    """The entries of some URLs: the directory is searched first, then only the blocks it names.

    ``urls`` is a list the caller holds; it travels with the tasks. URLs that are not in the index
    give no rows, repeated URLs give their entries once.
    """
    keys = sorted({url_key(u) for u in urls})
    key_type = pa.string() if id_type == "string" else pa.int64()

    def hits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bisect.bisect_left(keys, a) < bisect.bisect_right(keys, b)
                    for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], ["block"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = json.loads(zlib.decompress(data.as_py()))
                names = [r[0] for r in rows]
                found = [r for k in keys for r in rows[bisect.bisect_left(names, k) : bisect.bisect_right(names, k)]]
                yield _entries([tuple(r) for r in found], key_type)

    named = index.select("block", "first_key", "last_key").mapInArrow(hits, "block string")
    return index.join(named, "block", "left_semi").select("data").mapInArrow(search, ENTRY.format("string" if id_type == "string" else "bigint"))


def captures_of(index: DataFrame, urls: DataFrame, url_col: str = "url", id_type: str = "bigint") -> DataFrame:
    """The entries of all URLs of a table, through both levels of the index.

    A key is routed to its part by the parts' bounds (one row a part, at most as many as shuffle
    partitions), binary-searched in the part's directory for the blocks that may hold it, and
    binary-searched in these blocks. Keys and directory rows of a part, then keys and data of a block, meet sorted in
    one stream, so nothing is held but one part's directory and one block. A null URL has the empty key. Repeated URLs give
    their entries once, URLs that are not in the index none.
    """
    spark = index.sparkSession
    bounds = sorted((r["a"], r["b"], r["part"]) for r in index.groupBy("part").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b")).collect())
    lows, highs, parts = ([b[i] for b in bounds] for i in range(3))
    key_type = pa.string() if id_type == "string" else pa.int64()

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(p, k) for k in map(url_key, batch.column(0).to_pylist()) for p in parts[bisect.bisect_left(highs, k) : bisect.bisect_right(lows, k)]]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([k for _, k in out], pa.string())], ["part", "key"])

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, last, names = None, [], [], []
        for batch in batches:
            out = []
            for part, role, key, end, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != held:
                    held, first, last, names = part, [], [], []
                if role == 0:
                    first.append(key)
                    last.append(end)
                    names.append(block)
                else:
                    out += [(b, key) for b in names[bisect.bisect_left(last, key) : bisect.bisect_right(first, key)]]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.string()), pa.array([k for _, k in out], pa.string())], ["block", "key"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, names = None, [], []
        for batch in batches:
            out = []
            for block, role, key, data in zip(*(batch.column(i) for i in range(4)), strict=True):
                if role.as_py() == 0:
                    held, rows = block.as_py(), json.loads(zlib.decompress(data.as_py()))
                    names = [r[0] for r in rows]
                elif block.as_py() == held:
                    k = key.as_py()
                    out += rows[bisect.bisect_left(names, k) : bisect.bisect_right(names, k)]
            yield _entries(out, key_type)

    n = partitions(spark)
    asked = urls.select(F.col(url_col).cast("string").alias("url")).distinct().mapInArrow(route, "part int, key string").distinct()
    nothing = F.lit(None)
    directory = index.select("part", F.lit(0).alias("role"), F.col("first_key").alias("key"), F.col("last_key").alias("end"), "block")
    keyed = asked.select("part", F.lit(1).alias("role"), "key", nothing.cast("string").alias("end"), nothing.cast("string").alias("block"))
    met = directory.unionByName(keyed).repartition(n, "part").sortWithinPartitions("part", "role", "key", "end")
    named = met.mapInArrow(blocks, "block string, key string")
    data = index.select("block", F.lit(0).alias("role"), nothing.cast("string").alias("key"), "data")
    both = data.unionByName(named.select("block", F.lit(1).alias("role"), "key", nothing.cast("binary").alias("data")))
    both = both.repartition(n, "block").sortWithinPartitions("block", "role", "key")
    return both.mapInArrow(search, ENTRY.format("string" if id_type == "string" else "bigint"))


def read_records(found: DataFrame) -> DataFrame:
    """Read the records of index entries by byte range.

    (page, url, payload, payload_bytes, payload_digest, record_type, refers_to): ``payload`` is
    null for a revisit; bytes and digest are those of the full payload. A record whose payload
    does not have the digest of its header is an error. Entries are read in file order.
    """
    kind, key_type = found.schema["page"].dataType.simpleString(), arrow_type(found, "page")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for file, offset, length, page in zip(*(batch.slice(at, 256).column(i).to_pylist() for i in range(4)), strict=True):
                    if file != name:
                        fs, path = _open(file)
                        name, source = file, fs.open_input_file(path)
                    fields, block = parse(zlib.decompress(source.read_at(length, offset), 31))
                    head, payload = block.split(b"\r\n\r\n", 1)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response":
                        if _digest(payload) != digest:
                            raise ValueError(f"record of page {page} does not have the digest of its header")
                        rows.append((page, fields["WARC-Target-URI"], payload.decode("utf-8", "replace"), len(payload), digest, "response", None))
                    else:
                        refers = fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">")
                        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                        rows.append((page, fields["WARC-Target-URI"], None, size, digest, "revisit", refers if kind == "string" else int(refers)))
                kinds = (key_type, pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), key_type)
                names = ["page", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    dealt = found.repartition(partitions(found.sparkSession), "file").sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length", "page").mapInArrow(
        read, f"page {kind}, url string, payload string, payload_bytes long, payload_digest string, record_type string, refers_to {kind}")
