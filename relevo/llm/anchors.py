"""Where equal windows can meet: content-chosen anchors, classes of contexts, and their groups.

A *window* is ``width`` consecutive symbols (bytes or word hashes). Its anchor is its leftmost
gram of smallest hash, so equal windows have equal anchors at equal places. Each anchor occurrence
owns a range of window starts, and its *context* is the text those windows cover. Occurrences
with equal contexts form a class; a window can only be repeated within its class or in another
class of the same anchor. So one row per anchor, not per window, is shuffled, and only contexts
of anchors with several classes have to be compared as text.

An anchor with too many classes is refined: its windows are cut into blocks by their distance to
the anchor, keyed anew by the text all windows of a block share, in steps down to single
windows, where the key alone decides. So no group grows with the corpus and nothing is capped.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo.llm.fingerprints import mix
from relevo.llm.frames import partitions, use_caches, written
from relevo.llm.words import power

#: Symbols handled at once; a longer text is cut into overlapping segments of this many windows.
SEGMENT = 1 << 19
#: Classes of one anchor that a task compares; more are refined.
MOST_CLASSES = 2048
NULL_ID = -(1 << 63)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Sizes of the tables of powers are multiples of this.
_ROUND = 1 << 18


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return power(n, np.uint64(_BASE)), power(n, np.uint64(_INVERSE))


def forget() -> None:
    """Gives back what this worker keeps between tasks."""
    _powers.cache_clear()


class Spans:
    """Hashes of any range of a symbol array."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = _powers((len(symbols) // _ROUND + 1) * _ROUND)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.multiply(symbols, up[: len(symbols)], out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k symbols from each place on (k a power of two); not 0."""
    h, size, base = symbols, 1, _BASE
    while size < k:
        h = h[: len(h) - size] + h[size:] * np.uint64(base)
        size, base = 2 * size, base * base % (1 << 64)
    return np.maximum(mix(h), np.uint64(1))


def _sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick over each run of n neighbours."""
    size = 1
    while 2 * size <= n:
        x = pick(x[: len(x) - size], x[size:])
        size *= 2
    return pick(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def anchor_rows(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, context, start, windows, distance) of every anchor of concatenated texts.

    ``first`` and ``size`` are the texts' places in ``symbols``. ``start`` is relative to the
    text; ``distance`` is from the start to the anchor.
    """
    none = np.zeros(0, np.int64)
    n, reach = len(symbols), width - k  # a window has reach + 1 grams
    if n < width:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    grams = gram_hashes(symbols, k)
    low = _sliding(grams, reach + 1, np.minimum)  # the smallest gram of the window at each start
    text = np.repeat(np.arange(len(size)), size)
    low[text[: len(low)] != text[width - 1 :]] = 0  # windows across texts
    pad = np.zeros(reach, np.uint64)
    top = _sliding(np.concatenate([pad, low, pad]), reach + 1, np.maximum)  # the largest of those windows' minima
    at = np.flatnonzero(top[: len(grams)] == grams)
    if not len(at):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    of, value = text[at], grams[at]
    new = np.concatenate([[True], of[1:] != of[:-1]])
    prior = np.concatenate([[0], at[:-1]])
    smaller = np.concatenate([[True], value[1:] < value[:-1]])
    begin = np.where(new, first[of], np.where(smaller, at - reach, prior + 1))
    end = np.concatenate([begin[1:], [0]])  # one past the last start
    last = np.concatenate([new[1:], [True]])
    end[last] = (first[of] + size[of] - width + 1)[last]
    end = np.minimum.accumulate(end[::-1])[::-1]  # of equal grams some own no window
    keep = end > begin
    of, value, begin, end, at = of[keep], value[keep], begin[keep], end[keep], at[keep]
    context = mix(Spans(symbols).hash(begin, end + width - 1) + (at - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return of, value, context, begin - first[of], end - begin, at - begin


@dataclass(frozen=True)
class Kind:
    """What the symbols of a text are, and how wide windows and grams are."""

    symbols: Callable[[str], np.ndarray]  # the uint64 symbol of each place
    raw: Callable[[str], Callable[[int, int], bytes]]  # a cutter of contexts, from place to place
    unit: int  # bytes of a symbol in a cut context
    decode: Callable[[bytes], np.ndarray]  # the symbols of a cut context
    width: int
    gram: int
    steps: tuple[int, ...]  # distances to the anchor that a refined block spans; all below width - gram


OCC = "h long, ctx long, id long, rk long, s long, m int, d int"
_OCC = ["h", "ctx", "id", "rk", "s", "m", "d"]


def _occ_batch(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    h, ctx, ids, rk, s, m, d = (np.concatenate(c) for c in zip(*rows, strict=True))
    arrays = [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)) for x in (h, ctx, ids, rk, s)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(m.astype(np.int32)), pa.array(d.astype(np.int32))], _OCC)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, rk, text): a null id is the smallest number; ``rk`` is a key of id and text."""
    row = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return row.select(F.coalesce("id", F.lit(NULL_ID)).alias("id"), row_key(F.col("id"), F.col("text")).alias("rk"), "text")


def row_key(key: Column, text: Column) -> Column:
    return F.xxhash64(F.coalesce(key, F.lit(NULL_ID)), text)


def occurrences(rows: DataFrame, kind: Kind) -> DataFrame:
    """One row per anchor occurrence of every text: anchor, context, id, key, start, windows, distance."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("anchors", forget)
        for batch in batches:
            held, total, out = [], 0, []
            for i in range(batch.num_rows):
                symbols = kind.symbols(batch.column(2)[i].as_py())
                for at in range(0, max(1, len(symbols) - kind.width + 1), SEGMENT):
                    part = symbols[at : at + SEGMENT + kind.width - 1]
                    if len(part) >= kind.width:
                        held.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), at, part))
                        total += len(part)
                    if total >= SEGMENT:
                        out.append(rows_of(held))
                        held, total = [], 0
                if len(out) >= 8:
                    yield _occ_batch(out)
                    out = []
            if held:
                out.append(rows_of(held))
            if out:
                yield _occ_batch(out)

    def rows_of(held: list[tuple]) -> tuple[np.ndarray, ...]:
        size = np.array([len(x[3]) for x in held], np.int64)
        first = np.cumsum(size) - size
        of, h, ctx, s, m, d = anchor_rows(np.concatenate([x[3] for x in held]), first, size, kind.width, kind.gram)
        ids, rk, base = (np.array([x[i] for x in held], np.int64) for i in range(3))
        return h, ctx, ids[of], rk[of], s + base[of], m, d

    return written(rows.mapInArrow(run, OCC), "occurrences")


def with_lists(rows: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """Texts with their per-text lists (rk, list)."""
    return rows.join(lists, "rk", how)


def listed(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Fold rows of numbers into one binary list per text: it is no longer than the text's windows."""

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("anchors", forget)
        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            rk = batch.column(0).to_numpy()
            values = np.stack([batch.column(i + 1).cast(pa.int64()).to_numpy() for i in range(len(cols))], 1)
            cuts = np.concatenate([[0], np.flatnonzero(rk[1:] != rk[:-1]) + 1, [len(rk)]])
            done = []
            for s, e in zip(cuts, cuts[1:], strict=False):
                if at is not None and rk[s] != at:
                    done.append((at, np.concatenate(held)))
                    held = []
                at = rk[s]
                held.append(values[s:e])
            if done:
                yield out(done)
        if held:
            yield out([(at, np.concatenate(held))])

    def out(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.int64()), pa.array([v.astype("<i8").tobytes() for _, v in done], pa.binary())], ["rk", "list"])

    dealt = df.select("rk", *cols).repartition(partitions(df.sparkSession), "rk").sortWithinPartitions("rk", *cols)
    return written(dealt.mapInArrow(fold, "rk long, list binary"), name)


def unlist(data: bytes | None, n: int) -> np.ndarray:
    return np.frombuffer(data or b"", "<i8").reshape(-1, n)


def refine(wide: DataFrame, kind: Kind, step: int) -> DataFrame:
    """Cut contexts into blocks of ``step`` distances, keyed by the text all windows of a block share.

    Only the contexts themselves are read, not the texts. ``oh``, ``octx`` and ``off`` lead back to
    the class a part was cut from.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("anchors", forget)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                h, m, d = (part.column(i).to_numpy().astype(np.int64) for i in (0, 6, 7))
                data = part.column(8).to_pylist()
                symbols = [kind.decode(x) for x in data]
                sizes = np.array([len(x) for x in symbols], np.int64)
                first = np.cumsum(sizes) - sizes
                spans = Spans(np.concatenate(symbols))
                c, lo = _blocks(m, d, step)
                far, near = np.minimum(lo + step - 1, d[c]), np.maximum(lo, (d - m + 1)[c])
                begin, count = d[c] - far, far - near + 1
                anchor = first[c] + d[c]
                core = spans.hash(anchor - lo, anchor - lo - step + 1 + kind.width)
                key = mix(h[c].view(np.uint64) + core + (lo + 1).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(step))
                ctx = spans.hash(first[c] + begin, first[c] + begin + count - 1 + kind.width) + far.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                cuts = [data[i][x * kind.unit : (x + n - 1 + kind.width) * kind.unit] for i, x, n in zip(c.tolist(), begin.tolist(), count.tolist(), strict=True)]
                take = pa.array(c)
                rest = {i: part.column(i).take(take) for i in (2, 3, 4, 5, 9, 10, 11)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(mix(ctx).view(np.int64)), rest[2], rest[3], rest[4], pa.array(rest[5].to_numpy() + begin),
                     pa.array(count.astype(np.int32)), pa.array(far.astype(np.int32)), pa.array(cuts, pa.binary()), rest[9], rest[10],
                     pa.array(rest[11].to_numpy() + begin)], _PARTS)

    return written(wide.select(*_PARTS).mapInArrow(run, PARTS), "refined")


def _blocks(m: np.ndarray, d: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, first distance) of every block of ``step`` distances that holds windows."""
    low = (d - m + 1) // step
    n = d // step - low + 1
    c = np.repeat(np.arange(len(m)), n)
    return c, (low[c] + np.arange(len(c)) - np.repeat(np.cumsum(n) - n, n)) * step


def part_classes(parts: DataFrame) -> DataFrame:
    """Contexts cut by ``refine``, with what their class and key hold.

    Adds ``total`` (copies of the class), ``low`` (its smallest id), ``classes`` (of the key), ``least``
    (copies of the rarest) and ``first`` (whether the row stands for its class).
    """
    by = parts.groupBy("h", "ctx").agg(F.sum("copies").alias("total"), F.min("id").alias("low"), F.min(F.struct("id", "rk", "s")).alias("one"))
    by = written(by, "classes")
    many = written(by.groupBy("h").agg(F.count("*").alias("classes"), F.min("total").alias("least")), "many")
    return written(parts.join(by, ["h", "ctx"]).join(many, "h").withColumn("first", F.struct("id", "rk", "s") == F.col("one")).drop("one"), "parts")


def classes_of(occ: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repeated occurrences and their classes.

    The first has the occurrences whose anchor occurs more than once; the second (h, ctx, copies,
    low: smallest id, rep: an occurrence with that id, classes: of the anchor).
    """
    often = written(occ.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "often")
    live = written(occ.join(often, "h", "left_semi"), "live")
    by = live.groupBy("h", "ctx").agg(F.count("*").alias("copies"), F.min(F.struct("id", "rk", "s", "m", "d")).alias("rep"))
    by = written(by, "classes")
    many = written(by.groupBy("h").agg(F.count("*").alias("classes"), F.min("copies").alias("least")), "many")
    return live, written(by.join(many, "h"), "classes")


PARTS = ("h long, ctx long, copies long, id long, rk long, s long, m int, d int, data binary, oh long, octx long, off long")
_PARTS = ["h", "ctx", "copies", "id", "rk", "s", "m", "d", "data", "oh", "octx", "off"]


def contexts(rows: DataFrame, classes: DataFrame, kind: Kind) -> DataFrame:
    """The class representatives with the bytes of their contexts, and the classes of their anchor.

    It is the one place where texts are shuffled to their contexts; refinement goes on from these.
    """
    flat = classes.select("rep.rk", "h", "ctx", "copies", "rep.id", "rep.s", "rep.m", "rep.d", "classes")
    texts = with_lists(rows, listed(flat, ["s", "h", "ctx", "copies", "id", "m", "d", "classes"], "contexts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("anchors", forget)
        for batch in batches:
            for i in range(batch.num_rows):
                whole = unlist(batch.column(2)[i].as_py(), 8)
                cut = kind.raw(batch.column(1)[i].as_py())
                for at in range(0, len(whole), 4096):
                    s, h, ctx, copies, ids, m, d, n_classes = whole[at : at + 4096].T
                    data = [cut(a, a + n + kind.width - 1) for a, n in zip(s.tolist(), m.tolist(), strict=True)]
                    rk = np.full(len(s), batch.column(0)[i].as_py())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(ctx), pa.array(copies), pa.array(ids), pa.array(rk), pa.array(s), pa.array(m.astype(np.int32)),
                         pa.array(d.astype(np.int32)), pa.array(data, pa.binary()), pa.array(h), pa.array(ctx), pa.array(np.zeros(len(s), np.int64)),
                         pa.array(n_classes)], [*_PARTS, "classes"])

    return written(texts.select("rk", "text", "list").mapInArrow(run, PARTS + ", classes long"), "contexts")


def merged(ranges: np.ndarray, width: int) -> np.ndarray:
    """Maximal runs (start, end) covered by windows of ``width`` starting in ranges (start, count)."""
    if not len(ranges):
        return np.zeros((0, 2), np.int64)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    start, end = ranges[:, 0], np.maximum.accumulate(ranges[:, 0] + ranges[:, 1] + width - 1)
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([new[1:], [True]])
    return np.stack([start[new], end[last]], 1)


def possible(h: np.ndarray, m: np.ndarray, d: np.ndarray, symbols: list[np.ndarray], width: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, windows): parts of contexts that can hold a window of another context.

    Windows of a block of distances share a text; if no other context of the anchor has it there,
    none of them is repeated.
    """
    sizes = np.array([len(x) for x in symbols], np.int64)
    first = np.cumsum(sizes) - sizes
    spans = Spans(np.concatenate(symbols))
    c, lo = _blocks(m, d, block)
    anchor = first[c] + d[c]
    key = spans.hash(anchor - lo, anchor - lo - block + 1 + width) + h[c].view(np.uint64) * np.uint64(0x9FB21C651E98DF25) + lo.astype(np.uint64)
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    keep = np.flatnonzero(count[which] > 1)
    c, lo = c[keep], lo[keep]
    if not len(c):
        return c, c, c
    new = np.concatenate([[True], (c[1:] != c[:-1]) | (lo[1:] != lo[:-1] + block)])
    last = np.concatenate([new[1:], [True]])
    near, far, c = np.maximum(lo[new], (d - m + 1)[c[new]]), np.minimum(lo[last] + block - 1, d[c[last]]), c[new]
    return c, d[c] - far, far - near + 1
