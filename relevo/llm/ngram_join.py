"""Exact Jaccard join of documents on word shingles, through groups of similar documents.

1. Documents with equal shingle sets fold into one class.
2. *Grouping.* Each class meets the classes that share one of its min-hashes, and is compared with
   the smallest of them (one comparison per min-hash, however many share it). Linked classes form
   families, which are cut into groups of about ``GROUP_ROWS``. The other classes are grouped by the
   most frequent of their rare shingles, so that those that share a passage stand together; such
   a group is cut too, into parts of ``GROUP_ROWS`` or of the square root of its rows.
3. *Token-group matrix.* Shingles are ordered from rare to frequent (by a fixed-size table of
   bucket counts over all documents; any fixed order is right, this one keeps lists short). Two
   linked sets share a shingle among their first ``n - ceil(0.75 n) + 1``. Those prefixes,
   partitioned by shingle, give (query, group) rows, one a shingle and group, with the number of shared shingles;
   a bound on that number drops most of them. The list of a frequent shingle is dealt to several
   tasks by chunks of groups, and every chunk meets all queries.
4. A qualifying group's sets and its queries meet in one task. The group's token union bounds the
   overlap of each query; only groups that can still reach the threshold are opened and compared
   set by set. A query that finds a link in a group of one family need not look further there.
5. Components of all links.

The similarity of two classes of one family does not matter for components, so no pairs are
expanded within families. Shingles are compared by 48-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.components import connected_components
from relevo.llm.fingerprints import mix
from relevo.llm.frames import SMALL_CHUNK, map_texts, partitions, slices, use_caches, written
from relevo.llm.words import words_of

SHINGLE = 5
PERMUTATIONS = 3
GROUP_ROWS = 128
QUERIES_PER_TASK = 1024
#: log2 of the number of frequency buckets: a table of 4 MB, whatever the corpus.
BUCKET_BITS = 20
CHUNK_BITS = 12
#: A bucket that holds so many documents more than twice the usual has its shingles' lists cut into chunks.
HOT_ROWS = 4096
#: Lists up to this length are compared row by row, many lists together; longer ones by group.
SHORT_RUN = 64
#: A side is broadcast if it has at most so many rows (of a few numbers each).
BROADCAST_ROWS = 1_000_000
_HASH_BITS = 48
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text; one of all words if there are fewer."""
    doc, _, _, h = words_of([t.encode("utf-8") for t in texts], lower=True)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    n = len(h)
    if n >= size:
        joined = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            joined += h[k : n - size + 1 + k] * _mixer(k)
        joined = mix(joined) >> np.uint64(64 - _HASH_BITS)
    out = []
    for s, e in zip(bounds, bounds[1:], strict=False):
        if e - s >= size:
            out.append(np.unique(joined[s : e - size + 1]))
        elif e > s:
            few = (h[s:e] * np.array([_mixer(k) for k in range(e - s)])).sum(keepdims=True) + np.array([e - s], np.uint64)
            out.append(mix(few) >> np.uint64(64 - _HASH_BITS))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _mixer(k: int) -> np.uint64:
    return _MIX[k % len(_MIX)] + np.uint64(2 * (k // len(_MIX)) << 32)


def pack48(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def least_overlap(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest overlap with a set of n that can reach the threshold: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def frequencies(docs: DataFrame, text_col: str = "text", size: int = SHINGLE) -> np.ndarray:
    """Document counts of shingle buckets over the whole table: a fixed-size array.

    Every task sums its texts into the array and hands it on in compressed chunks; chunks are
    added in a stream.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("ngram_join")
        total = np.zeros(1 << BUCKET_BITS, np.uint32)
        for batch in batches:
            for part in slices(batch, 0):
                found = shingle_sets([x or "" for x in part.column(0).to_pylist()], size)
                buckets = (np.concatenate(found) >> np.uint64(_HASH_BITS - BUCKET_BITS)).astype(np.int64)
                total += np.bincount(buckets, minlength=len(total)).astype(np.uint32)
        if total.any():
            yield packed({i: part for i, part in enumerate(total.reshape(-1, 1 << CHUNK_BITS))})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(zlib.decompress(data.as_py()), np.uint64)
                total[chunk] = total[chunk] + part if chunk in total else part
        if total:
            yield packed(total)

    def packed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(parts.keys(), pa.int32()), pa.array([zlib.compress(p.astype(np.uint64).tobytes(), 1) for p in parts.values()], pa.binary())], ["chunk", "data"])

    schema = "chunk int, data binary"
    parts = docs.select(text_col).mapInArrow(count, schema)
    sums = parts.repartition(partitions(docs.sparkSession), "chunk").mapInArrow(add, schema)
    out = np.zeros((1 << (BUCKET_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.uint64)
    for r in sums.collect():
        out[r["chunk"]] = np.frombuffer(zlib.decompress(r["data"]), np.uint64)
    return np.minimum(out.reshape(-1), (1 << 32) - 1).astype(np.uint32)


def small(df: DataFrame) -> DataFrame:
    """A written table as a broadcast side if it has few rows; else unchanged (a shuffle join)."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def profiles(docs: DataFrame, counts: np.ndarray, percent: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, k1, k2, mins, prefix, hottest) of every document: set size, set key, min-hashes, rarest
    shingles, and the most frequent of these. ``counts`` are those of shingle buckets."""
    table = docs.sparkSession.sparkContext.broadcast(counts)
    seeds = [np.uint64(0xA0761D6478BD642F * (2 * m + 1) & (1 << 64) - 1) for m in range(PERMUTATIONS)]

    def rows(keys: list, texts: list) -> pa.RecordBatch:
        counts, out = table.value, []
        for key, s in zip(keys, shingle_sets(texts, size), strict=True):
            n = len(s)
            if not n:
                out.append((key, 0, 0, 0, [], b"", 0))
                continue
            wide = mix(s + np.uint64(n))
            order = np.lexsort((s, counts[(s >> np.uint64(_HASH_BITS - BUCKET_BITS)).astype(np.int64)]))
            prefix = s[order[: n - least_overlap(n, percent) + 1]]
            mins = [int(mix(s ^ x).min().astype(np.int64)) for x in seeds]
            out.append((key, n, int(wide.sum().astype(np.int64)), int((wide * wide).sum().astype(np.int64)), mins, pack48(prefix), int(prefix[-1])))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    names = ["id", "n", "k1", "k2", "mins", "prefix", "hottest"]
    typed = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col))
    return written(map_texts(typed, id_col, text_col, rows, "id long, n int, k1 long, k2 long, mins array<bigint>, prefix binary, hottest long", SMALL_CHUNK), "profiles")


def verify(docs: DataFrame, pairs: DataFrame, members: DataFrame, percent: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) between queries and documents of their groups.

    ``pairs`` is (q, g), ``members`` (g, id, one): ``one`` marks groups of one family, where a query's
    first link is enough. A group with many queries is served by several tasks, each with the
    group's sets.
    """
    salts = pairs.groupBy("g").agg(F.ceil(F.count("*") / QUERIES_PER_TASK).cast("int").alias("salts"))
    salted = written(members.join(salts, "g"), "members")
    role = F.when(F.col("one"), 0).otherwise(1)
    inside = salted.select("id", "g", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), role.alias("role"))
    asked = pairs.join(salted.select("g", "salts").distinct(), "g").select(
        F.col("q").alias("id"), "g", F.pmod(F.xxhash64("q"), F.col("salts")).cast("int").alias("salt"), F.lit(2).alias("role"))
    targets = written(inside.unionByName(asked), "targets")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text"))
    wanted = texts.join(small(targets), "id").select("id", "_text", "g", "salt", "role")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for batch in batches:
            for part in slices(batch, 1):
                ids, found, todo = part.column(0).to_pylist(), [], {}
                texts = part.column(1).to_pylist()
                for i, (k, t) in enumerate(zip(ids, texts, strict=True)):
                    if (k, t) != known and (k, t) not in todo:
                        todo[k, t] = i
                made = dict(zip(todo, map(pack48, shingle_sets([t or "" for _, t in todo], size)), strict=True))
                if known[0] is not None:
                    made.setdefault(known, known_set)
                found = [made[k, t] for k, t in zip(ids, texts, strict=True)]
                known, known_set = (ids[-1], texts[-1]), found[-1]
                yield pa.RecordBatch.from_arrays([part.column(2), part.column(3), part.column(4), part.column(0), pa.array(found, pa.binary())],
                                                 ["g", "salt", "role", "id", "tokens"])

    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, inside, union, one = None, [], None, True
        for batch in batches:
            links = []
            for g, salt, role, key, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                tokens = unpack48(data)
                if unit != (g, salt):
                    unit, inside, union, one = (g, salt), [], None, True
                if role < 2:
                    inside.append((key, tokens))
                    one = one and role == 0
                    continue
                if union is None:
                    union = np.unique(np.concatenate([t for _, t in inside])) if inside else np.zeros(0, np.uint64)
                least = least_overlap(len(tokens), percent)
                if not len(tokens) or _shared(tokens, union) < least:
                    continue
                for other, held in inside:
                    if len(held) >= least and len(tokens) >= least_overlap(len(held), percent):
                        both = _shared(tokens, held)
                        if 100 * both >= percent * (len(tokens) + len(held) - both) and other != key:
                            links.append((key, other))
                            if one:
                                break
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])

    dealt = wanted.mapInArrow(sets, "g long, salt int, role int, id long, tokens binary") \
        .repartition(2 * partitions(docs.sparkSession), "g", "salt").sortWithinPartitions("g", "salt", "role", "id")
    return written(dealt.mapInArrow(match, "a long, b long"), "links")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """The number of common values of two ascending distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def candidates(prefixes: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(q, g) pairs that share enough prefix shingles.

    ``prefixes``: (id, n, prefix, family, g, family_rows); a null family: not linked to its group, a null
    g: alone in its own. Of two families the documents of the smaller one ask the groups of the larger;
    others ask families, the groups after their own, and their own. ``counts``, by shingle bucket,
    say how many chunks a shingle's list is cut into: one, unless its bucket stands out.
    """
    chunks_of = 1 + np.maximum(counts.astype(np.int64) - 2 * int(np.median(counts)), 0) // HOT_ROWS
    table = prefixes.sparkSession.sparkContext.broadcast(chunks_of.astype(np.int32))

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                found = [unpack48(x.as_py()) for x in part.column(2)]
                h = np.concatenate([np.zeros(0, np.uint64), *found])
                row = np.repeat(np.arange(len(found)), [len(x) for x in found])
                chunks = table.value[(h >> np.uint64(_HASH_BITS - BUCKET_BITS)).astype(np.int64)]
                g = pc.coalesce(part.column(4), part.column(0)).to_numpy()[row]
                own = mix(g.astype(np.uint64)) % chunks.astype(np.uint64)
                again = np.repeat(np.arange(len(h)), chunks)
                chunk = np.arange(len(again)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                rest = [part.column(i).take(pa.array(row[again])) for i in (0, 1, 3, 4, 5)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[again].astype(np.int64)), pa.array(chunk.astype(np.int32)), pa.array(own[again] == chunk.astype(np.uint64)), *rest],
                    ["h", "chunk", "member", "id", "n", "family", "g", "family_rows"])

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            h, chunk = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            member, single = (batch.column(i).to_numpy(zero_copy_only=False) if i == 2 else batch.column(i).is_null().to_numpy(zero_copy_only=False) for i in (2, 5))
            ids, n = (batch.column(i).to_numpy() for i in (3, 4))
            g = pc.coalesce(batch.column(6), batch.column(3)).to_numpy()
            family = np.where(single, 0, batch.column(5).fill_null(0).to_numpy())
            rows = np.where(single, 0, batch.column(7).fill_null(0).to_numpy())
            now = np.stack([h, chunk, ids, n, family, g, rows, member])
            cuts = np.flatnonzero((now[:2, 1:] != now[:2, :-1]).any(0)) + 1
            if held and (held[0][:2, 0] != now[:2, 0]).any():
                yield from pairs(np.concatenate(held, 1))
                held = []
            if len(cuts):
                yield from pairs(np.concatenate([*held, now[:, : cuts[-1]]], 1))
                held = [now[:, cuts[-1] :]]
            else:
                held.append(now)
        if held:
            yield from pairs(np.concatenate(held, 1))

    def pairs(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero((x[:2, 1:] != x[:2, :-1]).any(0)) + 1
        starts = np.concatenate([[0], cuts])
        sizes = np.diff(np.concatenate([starts, [x.shape[1]]]))
        out, rows = [], 0
        short = (sizes > 1) & (sizes <= SHORT_RUN)
        together = (np.cumsum(sizes[short] ** 2) - 1) // 1_000_000
        edges = np.concatenate([[0], np.flatnonzero(np.diff(together)) + 1, [int(short.sum())]])
        work = [(starts[short][a:b], sizes[short][a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        work += [(np.array([s]), np.array([k])) for s, k in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True)]
        for s, k in work:
            for found in short_runs(x, s, k) if not len(k) or k[0] <= SHORT_RUN else long_run(x[2:, s[0] : s[0] + k[0]]):
                out.append(found)
                rows += found.shape[1]
                if rows > 200_000:
                    yield batch_of(out)
                    out, rows = [], 0
        if out:
            yield batch_of(out)

    def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The overlap needed by sets of n and m, less what can lie beyond the prefix that ends first."""
        return np.maximum(-(-percent * (n + m) // (100 + percent)) - (least_overlap(np.maximum(n, m), percent) - 1), 1)

    def short_runs(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
        """(q, g, need) of many short lists at once."""
        row = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        of, k = np.repeat(np.arange(len(size)), size), np.repeat(size, size)
        i = np.repeat(row, k)
        j = np.repeat(start[of] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
        n, m, qr, gr, qf, gf, qg, g = x[3, i], x[3, j], x[6, i], x[6, j], x[4, i], x[4, j], x[5, i], x[5, j]
        asks = (qr < gr) | (qr == gr) & np.where(qr > 0, qf < gf, qg <= g)
        ok = np.flatnonzero(asks & (i != j) & (x[7, j] == 1) & (100 * n >= percent * m) & (100 * m >= percent * n))
        if len(ok):
            found = np.stack([np.repeat(of, k)[ok], x[2, i[ok]], g[ok], needed(n[ok], m[ok])])
            found = found[:, np.lexsort(found[::-1])]  # several sizes of one group: keep the weakest need
            yield found[1:, np.concatenate([[True], (found[:3, 1:] != found[:3, :-1]).any(0)])]

    def long_run(run: np.ndarray) -> Iterator[np.ndarray]:
        """(q, g, need) of one list, its members taken together by group and size."""
        inside = run[:, run[5] == 1]
        if not inside.shape[1] or (run[4, 0] and (run[2] == run[2, 0]).all()):
            return
        # groups by (family rows, family, group, n), with the holders of each; rows 0: not a family
        groups, holders = np.unique(inside[[4, 2, 3, 1]], axis=1, return_counts=True)
        first = np.concatenate([[True], (groups[:3, 1:] != groups[:3, :-1]).any(0)])
        part = np.cumsum(first) - 1
        alone = (np.bincount(part, holders) == 1)[part]
        step = max(1, 2_000_000 // groups.shape[1])
        for at in range(0, run.shape[1], step):
            q = run[:, at : at + step]
            qr, qf, qg = (q[i][:, None] for i in (4, 2, 3))
            i, j = np.nonzero((qr < groups[0]) | (qr == groups[0]) & ((qr > 0) & (qf < groups[1]) | (qr == 0) & ((qg < groups[2]) | (qg == groups[2]) & ~alone)))
            n, m = q[1][i], groups[3][j]
            ok = (100 * n >= percent * m) & (100 * m >= percent * n)
            i, j, n, m = i[ok], j[ok], n[ok], m[ok]
            if len(i):
                found = np.stack([q[0][i], groups[2][j], needed(n, m)])
                found = found[:, np.lexsort(found[::-1])]
                yield found[:, np.concatenate([[True], (found[:2, 1:] != found[:2, :-1]).any(0)])]

    def batch_of(out: list[np.ndarray]) -> pa.RecordBatch:
        q, g, need = np.concatenate(out, 1)
        return pa.RecordBatch.from_arrays([pa.array(q), pa.array(g), pa.array(need.astype(np.int32))], ["q", "g", "need"])

    spark = prefixes.sparkSession
    schema = "h long, chunk int, member boolean, id long, n int, family long, g long, family_rows int"
    by_shingle = prefixes.select("id", "n", "prefix", "family", "g", "family_rows").mapInArrow(explode, schema) \
        .repartition(2 * partitions(spark), "h", "chunk").sortWithinPartitions("h", "chunk")
    met = by_shingle.mapInArrow(meet, "q long, g long, need int")
    return written(met.groupBy("q", "g").agg(F.count("*").alias("c"), F.min("need").alias("need")).where("c >= need").select("q", "g"), "pairs")


def grouped(reps: DataFrame, families: DataFrame) -> DataFrame:
    """(id, n, prefix, family, g, family_rows) of every class: its group (null: its own alone), and its
    family if it has one. Only group sizes are written; the classes are read again where they are used."""
    rows = reps.join(small(families), "id", "left")
    sizes = rows.where("family is null").groupBy("hottest").agg(F.count("*").alias("rows")).where("rows > 1")
    parts = written(sizes.select("hottest", F.ceil(F.col("rows") / F.greatest(F.lit(GROUP_ROWS), F.sqrt("rows"))).alias("parts")), "parts")
    alike = F.when(F.col("parts").isNotNull(), F.xxhash64("hottest", F.pmod(F.xxhash64("id"), F.col("parts")), F.lit("alike")))
    return rows.join(small(parts), "hottest", "left").select("id", "n", "prefix", "family", F.coalesce("g", alike).alias("g"), "family_rows")


def jaccard_components(docs: DataFrame, percent: int = 75, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id), one row per input row; ids are integers.

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets. A
    null, empty or wordless text has no shingles and links with nothing. A row with a null id links
    with nothing and has a null component. Rows that repeat an id count as one document with
    several texts. An empty table gives an empty table.
    """
    counts = frequencies(docs, text_col, size)
    rows = profiles(docs, counts, percent, size, id_col, text_col)
    live = rows.where("id is not null and n > 0")
    classes = live.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    folded = written(classes.where("copies > 1").select("k1", "k2", "n", "rep"), "classes")
    copies = written(live.select("id", "k1", "k2", "n").join(folded, ["k1", "k2", "n"]).where("id != rep"), "copies")
    # by set, not by id alone: another text of the same id still has to meet its own
    folds = written(copies.select("id", "k1", "k2", "n").distinct(), "folds")
    reps = live.join(small(folds), ["id", "k1", "k2", "n"], "left_anti")

    slots = reps.select("id", F.posexplode("mins").alias("m", "low"))
    pivots = written(slots.groupBy("m", "low").agg(F.min("id").alias("g"), F.max("id").alias("top")).where("g != top").select("m", "low", "g"), "pivots")
    near = written(slots.join(pivots, ["m", "low"]).where("id != g").select(F.col("id").alias("q"), "g").distinct(), "near")
    first = verify(docs, near, near.select("g", F.col("g").alias("id"), F.lit(True).alias("one")).distinct(), percent, size, id_col, text_col)
    roots = connected_components(first)

    rows_of = roots.groupBy("component").agg(F.count("*").cast("int").alias("family_rows"))
    families = written(
        roots.join(rows_of, "component").select(
            F.col("node").alias("id"), F.col("component").alias("family"), "family_rows",
            F.xxhash64("component", F.pmod(F.xxhash64("node"), F.ceil(F.col("family_rows") / GROUP_ROWS))).alias("g")), "families")
    prefixes = grouped(reps, families)
    found = candidates(prefixes, counts, percent)
    asked = found.select("g").distinct()
    held = prefixes.select(F.coalesce("g", "id").alias("g"), "id", F.col("family").isNotNull().alias("one"))
    members = held.join(small(written(asked, "asked")), "g", "left_semi")
    second = verify(docs, found, members, percent, size, id_col, text_col)

    links = roots.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second)
    links = links.unionByName(copies.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    final = connected_components(links)
    return rows.select("id", F.col("n").cast("long").alias("n_shingles")).join(
        final.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
