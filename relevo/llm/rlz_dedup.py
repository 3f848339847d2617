"""Removal of word passages that an earlier document holds, by relative Lempel-Ziv parsing.

Texts are words. Contexts that may hold a repeated window of words (see ``anchors``) are brought
together by anchor. In each group contexts are parsed in the order of their smallest document id
against an index of every reference block before them: the contexts of smaller ids, in a suffix
automaton. The parse takes the longest factor that the reference holds; where a factor ends, it
goes on from the longest suffix that the reference still holds, so windows across a factor's
border are checked as well. Factors of at least ``width`` words give the repeated windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm import anchors
from relevo.llm.bpe import arrow_type
from relevo.llm.frames import partitions, written
from relevo.llm.words import words_of

WIDTH = 50
#: Spans of refined blocks, step by step down to single windows.
STEPS = (16, 4, 1)
GRAM = 8
#: Bytes of contexts (8 a word) that a task takes at once, whole anchors at a time.
TASK_BYTES = 4 << 20
#: Distances to the anchor that are tested together before a context is parsed.
BLOCK = 8
#: Contexts that one index holds; anchors with more are refined.
MOST_CLASSES = 512
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


class Reference:
    """An index of reference blocks: the suffix automaton of all of them."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, block: list[int]) -> None:
        """Index a block, on top of those before."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in block:
            if c in nxt[last]:
                q = nxt[last][c]
                if length[q] == length[last] + 1:
                    last = q
                    continue
                last = self._split(last, c, q)
                continue
            new = len(length)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p, last = last, new
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the strings of q up to the length that p allows."""
        new = len(self.length)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def factors(self, block: list[int]) -> list[tuple[int, int]]:
        """(end, length) where the longest factor ending at a place cannot be extended."""
        out, state, size = [], 0, 0
        nxt, link, length = self.next, self.link, self.length
        for i, c in enumerate(block):
            if c not in nxt[state] and size:
                out.append((i, size))
            while state >= 0 and c not in nxt[state]:
                state = link[state]
                size = length[state] if state >= 0 else 0
            state, size = (nxt[state][c], size + 1) if state >= 0 else (0, 0)
        if size:
            out.append((len(block), size))
        return out


def repeated_ranges(contexts: list[tuple[int, list[int]]], width: int) -> list[list[tuple[int, int]]]:
    """Per context (id, words), the ranges (start, count) of windows that a smaller id's context holds."""
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][0])
    reference, waiting, at = Reference(), [], None
    for i in order:
        key, words = contexts[i]
        if key != at:  # blocks of one id do not refer to each other
            for block in waiting:
                reference.add(block)
            waiting, at = [], key
        last = 0
        for end, size in reference.factors(words):
            if size >= width:
                start = max(end - size, last)
                if end - width + 1 > start:
                    out[i].append((start, end - width + 1 - start))
                    last = end - width + 1
        if sum(n for _, n in out[i]) < len(words) - width + 1:
            waiting.append(words)
    return out


def _symbols(text: str) -> np.ndarray:
    return words_of([text.encode("utf-8")])[3]


def _raw(text: str):
    symbols = _symbols(text)
    return lambda a, b: symbols[a:b].tobytes()


_RANGES = ["oh", "octx", "low", "off", "n"]


def _group_rows(contexts: DataFrame, width: int) -> DataFrame:
    """(oh, octx, low, off, n): ranges of a class's windows that contexts of smaller ids hold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if size >= TASK_BYTES and row[0] != held[-1][0]:
                    if out := ranges(held):
                        yield made(out)
                    held, size = [], 0
                held.append(row)
                size += len(row[7])
        if held and (out := ranges(held)):
            yield made(out)

    def ranges(held: list[tuple]) -> list[tuple]:
        h, low, m, d, oh, octx, off, data = zip(*held, strict=True)
        words = [np.frombuffer(x, np.uint64) for x in data]
        found = anchors.possible(np.array(h), np.array(m, np.int64), np.array(d, np.int64), words, width, BLOCK)
        groups: dict[int, list[tuple]] = {}
        for i, a, n in zip(*(x.tolist() for x in found), strict=True):
            groups.setdefault(h[i], []).append((i, a, (low[i], words[i][a : a + n + width - 1].tolist())))
        return [(oh[i], octx[i], low[i], off[i] + a + x, n) for parts in groups.values()
                for (i, a, _), r in zip(parts, repeated_ranges([p[2] for p in parts], width), strict=True) for x, n in r]

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], _RANGES)

    dealt = contexts.select("h", "id", "m", "d", "oh", "octx", "off", "data").repartition(2 * partitions(contexts.sparkSession), "h").sortWithinPartitions("h", "id")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in _RANGES))


def earlier_windows(rows: DataFrame, kind: anchors.Kind) -> DataFrame:
    """(rk, s, m): ranges of window starts whose window also starts in a document of smaller id."""
    live, classes = anchors.classes_of(anchors.occurrences(rows, kind))
    low = classes.where("copies > 1").select("h", "ctx", F.col("rep.id").alias("low"))
    parts = anchors.contexts(rows, classes.where("classes > 1"), kind)
    found = []
    for step in (*kind.steps, None):
        found.append(written(_group_rows(parts.where(F.col("classes") <= MOST_CLASSES), kind.width), "ranges"))
        wide = parts.where(F.col("classes") > MOST_CLASSES)
        if step is None or wide.isEmpty():
            break
        seen = anchors.part_classes(anchors.refine(wide, kind, step))
        found.append(seen.where("id > low").select("oh", "octx", F.col("id").alias("low"), "off", F.col("m").cast("long").alias("n")))
        parts = seen.where("id = low and classes > 1")  # several parts of one document may be equal
    ranges = found[0]
    for x in found[1:]:
        ranges = ranges.unionByName(x)
    # what holds for a class's smallest document holds at each of its places there
    ranges = ranges.select(F.col("oh").alias("h"), F.col("octx").alias("ctx"), "low", "off", "n")
    inside = live.join(ranges, ["h", "ctx"]).where("id = low").select("rk", (F.col("s") + F.col("off")).alias("s"), F.col("n").cast("int").alias("m"))
    return live.join(low, ["h", "ctx"]).where("id > low").select("rk", "s", "m").unionByName(inside)


def remove_earlier(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept, n_words, n_removed, spans), one row per input row.

    A word is removed if a window of ``width`` consecutive words covers it that also starts in a
    document with a smaller id. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; ``kept`` joins the
    rest by one space, ``spans`` are the removed runs (start, length) in words. Null texts have no
    words; rows that repeat an id are one document and do not remove each other. A null id is the
    smallest id and stays null. An empty table gives an empty table.
    """
    kind = anchors.Kind(_symbols, _raw, 8, lambda x: np.frombuffer(x, np.uint64), width, gram, tuple(x for x in STEPS if x <= width - gram))
    rows = anchors.keyed(docs, id_col, text_col)
    lists = anchors.listed(earlier_windows(rows, kind), ["s", "m"], "spans")
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("rk", anchors.row_key(F.col("id").cast("long"), F.col("text")))
    joined = anchors.with_lists(source, lists, "left").select("id", "text", "list")
    key, key_type = docs.schema[id_col].dataType.simpleString(), arrow_type(docs, id_col)
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                out = []
                for name, text, data in zip(*(batch.slice(at, 512).column(i).to_pylist() for i in range(3)), strict=True):
                    words = _WORDS.findall(text)
                    spans = anchors.merged(anchors.unlist(data, 2), width)
                    ends = np.concatenate([[0], spans.reshape(-1), [len(words)]]).astype(int).reshape(-1, 2).tolist()
                    kept = [w for a, b in ends for w in words[a:b]]
                    out.append((name, " ".join(kept), len(words), len(words) - len(kept), [{"start": int(a), "length": int(b - a)} for a, b in spans]))
                if out:
                    kinds = (key_type, pa.string(), pa.int64(), pa.int64(), span)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                     [id_col, "kept", "n_words", "n_removed", "spans"])

    return joined.mapInArrow(cut, f"`{id_col}` {key}, kept string, n_words long, n_removed long, spans array<struct<start:bigint,length:bigint>>")
