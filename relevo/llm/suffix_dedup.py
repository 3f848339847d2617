"""Removal of repeated substrings by suffix arrays built by induced sorting.

Texts are bytes. Contexts that may hold a repeated window (see ``anchors``) are brought together
by anchor and packed into shards of bounded size. Each shard's suffix array is built by induced
sorting: suffixes are classified as smaller or larger than their successor, the substrings
between leftmost-smaller suffixes are sorted by induction and named, the string of names is
sorted recursively, and its order induces the whole array, bucket by bucket. The permuted
common-prefix array (in text order, against the predecessor in the suffix array) then shows which
neighbours agree in a whole window.

Induction handles a bucket at a time with arrays. The recursion writes a name as two digits, so
that there are few buckets at every level.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm import anchors
from relevo.llm.bpe import arrow_type
from relevo.llm.frames import partitions, use_caches, written
from relevo.llm.words import _BYTE

WIDTH = 400
#: Spans of refined blocks, step by step down to single windows.
STEPS = (64, 8, 1)
GRAM = 32
#: Bytes of contexts that a task takes at once, whole anchors at a time.
SHARD_BYTES = 1 << 19
#: Places whose common prefixes are found at once.
PLACES = 1 << 17
#: Distances to the anchor that are tested together before the suffix array is built.
BLOCK = 32
_SMALL = 48  # strings up to this length are sorted directly


# --- suffix array -------------------------------------------------------------------------------

def _smaller_type(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the last, the end mark, is)."""
    n = len(t)
    step = np.sign(t[1:].astype(np.int32) - t[:-1]).astype(np.int8)
    place = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n))
    ahead = np.minimum.accumulate(place[::-1])[::-1]  # the next place where neighbours differ
    out = np.ones(n, bool)
    known = ahead < n
    out[:-1] = np.where(known, step[np.minimum(ahead, n - 2)] > 0, True)
    return out


def _spread(values: np.ndarray, keys: np.ndarray, buckets: list[list]) -> None:
    """Append each value to the bucket of its key, order kept."""
    if len(values):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts = [0, *cuts.tolist(), len(keys)]
        values = values[order]
        for s, e in zip(starts, starts[1:], strict=False):
            buckets[keys[s]].append(values[s:e])


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """The suffix array induced by seeds: leftmost-smaller suffixes in order."""
    empty = np.zeros(0, np.int32)
    seeds = seeds.astype(np.int32)
    lms: list[list] = [[] for _ in range(k)]
    _spread(seeds, t[seeds], lms)
    larger: list[list] = [[] for _ in range(k)]
    done_larger = [empty] * k
    for c in range(k):
        wave = np.concatenate(larger[c]) if larger[c] else empty
        got = []
        while len(wave):
            got.append(wave)
            prior = wave[wave > 0] - 1
            prior = prior[~small[prior]]
            key = t[prior]
            _spread(prior[key != c], key[key != c], larger)
            wave = prior[key == c]
        done_larger[c] = np.concatenate(got) if got else empty
        if lms[c]:
            wave = np.concatenate(lms[c])
            prior = wave[wave > 0] - 1
            prior = prior[~small[prior]]
            _spread(prior, t[prior], larger)
    smaller: list[list] = [[] for _ in range(k)]
    out = [empty] * (2 * k)
    for c in range(k - 1, -1, -1):  # from the right; lists are in descending order
        wave = np.concatenate(smaller[c]) if smaller[c] else empty
        got = []
        while len(wave):
            got.append(wave)
            prior = wave[wave > 0] - 1
            prior = prior[small[prior]]
            key = t[prior]
            _spread(prior[key != c], key[key != c], smaller)
            wave = prior[key == c]
        if c == 0:
            got = [np.array([len(t) - 1], np.int32)]  # the end mark
        out[2 * c + 1] = np.concatenate(got)[::-1] if got else empty
        wave = done_larger[c][::-1]
        prior = wave[wave > 0] - 1
        prior = prior[small[prior]]
        _spread(prior, t[prior], smaller)
        out[2 * c] = done_larger[c]
    return np.concatenate(out)


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """The suffix array of t, whose last symbol 0 occurs nowhere else; symbols are below k."""
    n = len(t)
    t = t.astype(np.uint16)  # sorted by counting
    if n <= _SMALL:
        s = t.tolist()
        return np.array(sorted(range(n), key=lambda i: s[i:]), np.int64)
    small = _smaller_type(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induce(t, small, lms, k)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]  # by substring
    # name the substrings; a substring reaches to the next leftmost-smaller suffix, itself included
    end = np.empty(n, np.int32)
    end[lms] = np.append(lms[1:], n - 1) + 1
    spans = _spans(t)
    size, digest = end[order] - order, spans.hash(order, end[order])
    del spans, end
    names = np.empty(n, np.int32)
    names[order] = np.cumsum(np.concatenate([[True], (size[1:] != size[:-1]) | (digest[1:] != digest[:-1])])) - 1
    top = int(names[order[-1]]) + 1
    if top < len(lms):
        reduced = names[lms]
        if top <= 4096:
            rank = suffix_array(reduced, top)
        else:  # two digits a name: the order of the even places is that of the names
            base = int(np.sqrt(top)) + 1
            digits = np.empty(2 * len(reduced), np.int64)
            digits[0::2], digits[1::2] = reduced // base + 1, reduced % base + 1
            rank = suffix_array(np.append(digits, 0), max(base, top // base + 1) + 2)
            rank = rank[(rank % 2 == 0) & (rank < len(digits))] // 2
        order = lms[rank]
    return _induce(t, small, order, k)


def _spans(t: np.ndarray) -> anchors.Spans:
    symbols = t.astype(np.uint64)
    symbols += np.uint64(1)
    symbols *= np.uint64(0x9FB21C651E98DF25)
    return anchors.Spans(symbols)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each place, the symbols (at most ``most``) its suffix shares with its predecessor in ``sa``.

    ``sa`` holds all suffixes in order, or some of them; places it leaves out have 0. Common lengths
    are found by halving steps on range hashes, for ``PLACES`` places at once.
    """
    n = len(t)
    out = np.zeros(n, np.int32)
    if len(sa) < 2:
        return out
    spans = _spans(t)
    order = np.argsort(sa[1:], kind="stable")  # in text order
    for at in range(0, len(order), PLACES):
        part = order[at : at + PLACES]
        a, b = sa[1:][part], sa[:-1][part]
        shared = np.zeros(len(a), np.int64)
        room = np.minimum(n - np.maximum(a, b), most)
        step = 1 << int(most).bit_length() - 1
        while step:
            fits = np.flatnonzero(shared + step <= room)
            x, y, s = a[fits], b[fits], shared[fits]
            same = spans.hash(x + s, x + s + step) == spans.hash(y + s, y + s + step)
            shared[fits[same]] += step
            step //= 2
        out[a] = shared
    return out


def repeated_starts(contexts: Sequence[bytes], windows: np.ndarray, many: np.ndarray, width: int) -> list[np.ndarray]:
    """Per context, whether each of its first ``windows`` starts begins a window found elsewhere.

    ``many`` marks contexts that occur more than once; their windows are all repeated. Only places
    that begin a window are compared: the common prefix of two of them that are neighbours without the
    others is the least of those in between.
    """
    sizes = np.array([len(c) for c in contexts])
    first = np.cumsum(sizes + 1) - sizes - 1
    t = np.frombuffer(b"\x00".join([*contexts, b"", b""]), np.uint8).astype(np.uint16)
    t += 2
    t[first + sizes] = 1  # between contexts
    t[-1] = 0
    present = np.zeros(258, bool)
    present[t] = True
    t = (np.cumsum(present) - 1).astype(np.uint16)[t]  # only bytes that occur
    sa = suffix_array(t, int(present.sum()))
    weight = np.zeros(len(t) + 1, np.int8)
    np.add.at(weight, first, np.where(many, 2, 1))
    np.add.at(weight, first + windows, -np.where(many, 2, 1))
    weight = np.cumsum(weight, dtype=np.int8)[:-1]
    sa = sa[weight[sa] > 0]
    prefix = permuted_common_prefixes(t, sa, width)
    group = np.cumsum(prefix[sa] < width)  # suffixes that agree in a window share a number
    total = np.bincount(group, weight[sa])
    repeated = np.zeros(len(t), bool)
    repeated[sa] = total[group] > 1
    return [repeated[f : f + m] for f, m in zip(first, windows, strict=True)]


# --- the distributed operator -------------------------------------------------------------------

def _symbols(text: str) -> np.ndarray:
    return _BYTE[np.frombuffer(text.encode("utf-8"), np.uint8)]


def _raw(text: str):
    data = text.encode("utf-8")
    return lambda a, b: data[a:b]


def _kind(width: int, gram: int) -> anchors.Kind:
    return anchors.Kind(_symbols, _raw, 1, lambda x: _BYTE[np.frombuffer(x, np.uint8)], width, gram, tuple(x for x in STEPS if x <= width - gram))


def _shard_rows(contexts: DataFrame, width: int) -> DataFrame:
    """(rk, s, m): ranges of repeated window starts of contexts that occur once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("anchors", anchors.forget)
        held: list[tuple] = []
        parts: list[tuple] = []
        size = ready = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if size >= SHARD_BYTES and row[0] != held[-1][0]:
                    found = narrowed(held)
                    parts += found
                    ready += sum(len(x[3]) for x in found)
                    held, size = [], 0
                    if ready >= SHARD_BYTES:
                        yield ranges(parts)
                        parts, ready = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            parts += narrowed(held)
        if parts:
            yield ranges(parts)

    def narrowed(held: list[tuple]) -> list[tuple]:
        h, copies, rk, s, m, d, data = zip(*held, strict=True)
        found = anchors.possible(np.array(h), np.array(m, np.int64), np.array(d, np.int64), [_BYTE[np.frombuffer(x, np.uint8)] for x in data], width, BLOCK)
        return [(rk[i], s[i] + a, copies[i] > 1, data[i][a : a + n + width - 1], n) for i, a, n in zip(*(x.tolist() for x in found), strict=True)]

    def ranges(parts: list[tuple]) -> pa.RecordBatch:
        holders: dict[bytes, list[tuple]] = {}
        for rk, s, many, data, windows in parts:
            holders.setdefault(data, []).append((rk, s, many, windows))
        out, alone, twice = [], {}, []
        for data, rows in holders.items():  # a part cut from several contexts is repeated as a whole
            if len(rows) > 1 or rows[0][2]:
                twice.append((data, rows[0][3]))
                out += [(rk, s, windows) for rk, s, many, windows in rows if not many]
            else:
                alone[data] = rows[0]
        if alone:
            data, windows = [*alone, *(x for x, _ in twice)], np.array([x[3] for x in alone.values()] + [n for _, n in twice])
            hits = repeated_starts(data, windows, np.arange(len(data)) >= len(alone), width)
            for (rk, s, _, _), hit in zip(alone.values(), hits, strict=False):
                if hit.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                    out += [(rk, s + int(x), int(y - x)) for x, y in edge.reshape(-1, 2)]
        cols = zip(*out, strict=True) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32()), strict=True)], ["rk", "s", "m"])

    dealt = contexts.select("h", "copies", "rk", "s", "m", "d", "data").repartition(2 * partitions(contexts.sparkSession), "h")
    return dealt.sortWithinPartitions("h", "rk", "s").mapInArrow(run, "rk long, s long, m int")


def repeated_windows(rows: DataFrame, kind: anchors.Kind) -> DataFrame:
    """(rk, s, m): ranges of window starts whose window starts anywhere else too."""
    live, classes = anchors.classes_of(anchors.occurrences(rows, kind))
    twice = classes.where("copies > 1").select("h", "ctx")
    found = [live.join(twice, ["h", "ctx"], "left_semi").select("rk", "s", "m")]
    parts = anchors.contexts(rows, classes.where("classes > 1 and least = 1"), kind)
    for step in (*kind.steps, None):
        few = parts.where(F.col("classes") <= anchors.MOST_CLASSES)
        found.append(written(_shard_rows(few, kind.width), "ranges"))
        wide = parts.where(F.col("classes") > anchors.MOST_CLASSES)
        if step is None or wide.isEmpty():
            break
        seen = anchors.part_classes(anchors.refine(wide, kind, step))
        found.append(seen.where("total > 1 and copies = 1").select("rk", "s", "m"))
        parts = seen.where("first and classes > 1 and least = 1").withColumn("copies", F.col("total"))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def _kept(text: str, data: bytes | None, width: int) -> tuple[bytes, np.ndarray, int]:
    """The rest of a text, the removed (start, end) runs, and its bytes."""
    raw = text.encode("utf-8")
    spans = anchors.merged(anchors.unlist(data, 2), width)
    ends = np.concatenate([[0], spans.reshape(-1), [len(raw)]]).astype(int).reshape(-1, 2).tolist()
    return b"".join(raw[a:b] for a, b in ends), spans, len(raw)


def cut_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                count_col: str | None = None) -> DataFrame:
    """All rows and columns with the repeated bytes cut out of the text (see ``remove_repeats``).

    A character of which only some bytes are repeated goes whole. Null texts stay null.
    ``count_col`` gets the number of characters left.
    """
    kind = _kind(width, gram)
    lists = anchors.listed(repeated_windows(anchors.keyed(docs, id_col, text_col), kind), ["s", "m"], "spans")
    source = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"),
                         anchors.row_key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("rk"))
    joined = anchors.with_lists(source, lists, "left").select("row.*", F.col("text").alias("_cut_text"), F.col("list").alias("_cut_list"))
    place = docs.columns.index(text_col)
    count = docs.columns.index(count_col) if count_col in docs.columns else None
    n = len(docs.columns)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("anchors", anchors.forget)
        for batch in batches:
            texts = [None if t is None else _kept(t, d, width)[0].decode("utf-8", "ignore")
                     for t, d in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True)]
            cols = [batch.column(i) for i in range(n)]
            cols[place] = pa.array(texts, pa.string()).cast(cols[place].type)
            if count is not None:
                cols[count] = pa.array([len(t or "") for t in texts], pa.int64()).cast(cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, list(docs_columns))

    docs_columns = tuple(docs.columns)
    return joined.mapInArrow(cut, docs.schema)


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept, n_bytes, n_removed, n_spans, spans), one row per input row.

    Every byte covered by a ``width``-byte string that also starts at another place of any row is
    removed; ``kept`` is the binary rest and ``spans`` the maximal removed runs (start, length).
    Null texts are empty; texts shorter than ``width`` stay whole. Repeated rows are places of
    their own, so both copies go. A null id is kept as null. An empty table gives an empty table.
    """
    kind = _kind(width, gram)
    rows = anchors.keyed(docs, id_col, text_col)
    lists = anchors.listed(repeated_windows(rows, kind), ["s", "m"], "spans")
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("rk", anchors.row_key(F.col("id").cast("long"), F.col("text")))
    joined = anchors.with_lists(source, lists, "left").select("id", "text", "list")
    key, key_type = docs.schema[id_col].dataType.simpleString(), arrow_type(docs, id_col)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("anchors", anchors.forget)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for name, text, data in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    kept, spans, n = _kept(text, data, width)
                    out.append((name, kept, n, n - len(kept), len(spans), [{"start": int(a), "length": int(b - a)} for a, b in spans]))
                kinds = (key_type, pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                     [id_col, "kept", "n_bytes", "n_removed", "n_spans", "spans"])

    return joined.mapInArrow(cut, f"`{id_col}` {key}, kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<start:bigint,length:bigint>>")
