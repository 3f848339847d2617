"""The prefix trie of conversations, with subtree totals by centroid decomposition.

1. *Turns.* A turn is two 60-bit numbers of the MD5 of its role and text. Turns are ranked, and
   their place-dependent hashes summed along each conversation, in rows dealt by ranges of
   (conversation, place), so a conversation of any length fills many tasks. The running sum names the prefix.
2. *Nodes* are the distinct sums, with their members counted before the shuffle; the sum before a
   node's last turn names its parent: a forest of parent edges.
3. *Centroid decomposition.* A component's centroid is its lightest node whose subtree holds at least half
   of the component's rows. It is cut out: its children's subtrees and what lies above become components
   of at most half the weight. Components of at most ``COMPONENT`` rows are finished
   inside a task, where the same steps run on arrays; larger ones are cut in Spark, all of a
   round together. There a node lies under the centroid if its smallest member runs through it, so the table
   of member rows finds it without walking the tree, and the path from the centroid to the top is one
   member's rows.
4. *Rollup.* Backwards through the rounds, the totals of a centroid's children and its own value
   make its total, which is added to every node on its path to the component's top. After the
   first round's turn every node has the total of its subtree.
5. The ids that end in a node are joined in sorted pieces by many tasks, and a stream over a node's pieces makes
   the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo.llm.frames import partitions, written
from relevo.llm.ngram_join import small
from relevo.llm.running import MASK, running

#: Most turns a conversation takes over from the first of its hundred, and ids in such a group.
MOST_HEAD = 5
FAMILY = 100
#: Components of at most so many member rows are finished in one task.
COMPONENT = 1 << 16
#: Ids joined to one piece before the digest.
PIECE = 4096
_EMPTY = hashlib.sha256(b"").hexdigest()


def _lane(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, rank, x, y, chars) of every turn, ranked from 1 in its conversation.

    Turns stand by number, null first; those of one number by their MD5. Null roles and texts are empty.
    Rows without a conversation id belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.length(text).cast("long").alias("chars"), digest.alias("md5"))
    rows = rows.select("conv_id", "turn", _lane(F.col("md5"), 1).alias("x"), _lane(F.col("md5"), 16).alias("y"), "chars",
                       F.lit(1).cast("long").alias("one"), F.monotonically_increasing_id().alias("uid"))
    return running(written(rows, "turns"), "conv_id", ["turn", "x", "y", "uid"], {"rank": "one"}).select("conv_id", "rank", "x", "y", "chars")


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows): the ids, and (conv_id, pos, x, y, chars) of the rebuilt conversations.

    Conversation c starts with the first h turns of conversation c - c % 100 (all, if it has fewer;
    none, if there is none), h = crc32 of the decimal c, modulo 6, and goes on with its own turns after
    its first h.
    """
    ranked = written(ranked, "ranked")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    h = F.when(F.col("conv_id") % FAMILY == 0, 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1))
    convs = written(ranked.where("rank = 1").select("conv_id", base.alias("base"), h.alias("h")), "conversations")
    heads = written(ranked.where((F.col("conv_id") % FAMILY == 0) & (F.col("rank") <= MOST_HEAD)).withColumnRenamed("conv_id", "base"), "heads")
    held = written(heads.groupBy("base").agg(F.count("*").alias("k")), "held")
    own = ranked.withColumns({"base": base, "h": h}).where("rank > h").join(small(held), "base", "left").select(
        "conv_id", (F.col("rank") - F.col("h") + F.least("h", F.coalesce("k", F.lit(0)))).alias("pos"), "x", "y", "chars")
    taken = convs.where("h > 0").join(heads, "base").where("rank <= h").select("conv_id", F.col("rank").alias("pos"), "x", "y", "chars")
    return convs.select("conv_id"), own.unionByName(taken)


def _key(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _root() -> Column:
    return _key(F.lit(0).cast("long"), F.lit(0).cast("long"))


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, chars) of every prefix of at least one turn."""
    a = F.xxhash64("x", "y", "pos", F.lit(1)).bitwiseAND(F.lit(MASK))
    b = F.xxhash64(F.lit(7), "pos", "y", "x").bitwiseAND(F.lit(MASK))
    hashed = written(rows.select("conv_id", "pos", "chars", a.alias("a"), b.alias("b")), "hashed")
    summed = running(hashed, "conv_id", ["pos"], {"ka": "a", "kb": "b"})
    before = [(F.col(k) - F.col(v) + F.lit(MASK + 1)).bitwiseAND(F.lit(MASK)) for k, v in (("ka", "a"), ("kb", "b"))]
    return written(summed.select("conv_id", F.col("pos").alias("depth"), _key(F.col("ka"), F.col("kb")).alias("key"), _key(*before).alias("parent"), "chars"), "prefixes")


def nodes(convs: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends): (key, parent, depth, rep, n_convs, chars, weight) and (conv_id, key, depth) of
    the conversations' last nodes. ``rep`` is the smallest member, ``weight`` the member rows below."""
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "key")).alias("_last"))
    ends = convs.join(last, "conv_id", "left").select("conv_id", F.coalesce("_last.key", _root()).alias("key"), F.coalesce("_last.depth", F.lit(0)).alias("depth"))
    ends = written(ends, "ends")
    sized = paths.join(ends.select("conv_id", F.col("depth").alias("length")), "conv_id")
    found = sized.groupBy(F.col("key.a").alias("a"), F.col("key.b").alias("b")).agg(
        F.min("parent.a").alias("pa"), F.min("parent.b").alias("pb"), F.min("depth").alias("depth"), F.min("conv_id").alias("rep"),
        F.count("*").alias("n_convs"), F.min("chars").alias("chars"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    found = found.select(_key(F.col("a"), F.col("b")).alias("key"), _key(F.col("pa"), F.col("pb")).alias("parent"), "depth", "rep", "n_convs", "chars", "weight")
    top = ends.agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.sum(F.col("depth") + 1).alias("weight")).where("n_convs > 0").select(
        _root().alias("key"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("parent"), F.lit(0).cast("long").alias("depth"), "rep", "n_convs",
        F.lit(0).cast("long").alias("chars"), "weight")
    return written(found.unionByName(top), "nodes"), ends


def subtree_sums(tree: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """(key, *values): the long columns ``values`` of a forest's nodes, summed over their subtrees.

    ``tree``: (key, parent, depth, rep, weight, comp, *values), a written table of all nodes, ``comp`` the
    key of the tree's top; ``paths``:
    (conv_id, depth, key, parent), the nodes below the top on every member's way. Rounds are at
    most the logarithm of a tree's weight over ``COMPONENT``, or over its heaviest node if that is heavier.
    """
    live = tree.select("key", "parent", "depth", "rep", "weight", "comp", *values)
    done, rounds = [], []
    while True:
        tops = live.where("key = comp").select("comp", F.col("weight").alias("total"), F.col("depth").alias("top"))
        big = written(tops.where(F.col("total") > COMPONENT), "big")
        if big.isEmpty():
            done.append(live.select("key", "parent", "depth", "comp", *values))
            break
        side = small(big)
        done.append(live.join(side, "comp", "left_anti").select("key", "parent", "depth", "comp", *values))
        at = written(live.join(side, "comp"), "at")
        heavy = at.where(2 * F.col("weight") >= F.col("total")).groupBy("comp", "top")
        found = heavy.agg(F.min(F.struct("weight", "key", "depth", "rep")).alias("_c")).select(
            "comp", "top", F.col("_c.key").alias("c"), F.col("_c.weight").alias("cut"), F.col("_c.depth").alias("c_depth"), F.col("_c.rep").alias("c_rep"))
        cents = written(found, "centroids")
        near = small(cents)
        # one member's rows up to the centroid: their parents are the path to the top
        path = paths.join(near, (F.col("conv_id") == F.col("c_rep")) & (F.col("depth") > F.col("top")) & (F.col("depth") <= F.col("c_depth")))
        path = written(path.select(F.col("parent").alias("key"), "c", "cut"), "path")
        below = paths.select("conv_id", "parent", F.col("key").alias("child")).join(near.select("comp", "c", "c_depth"), F.col("parent") == F.col("c"))
        below = written(below.select(F.col("conv_id").alias("rep"), "comp", "child", "c_depth"), "below")
        state = at.join(below, ["rep", "comp"], "left").join(small(path.select("key", "cut")), "key", "left")
        under = F.coalesce(F.col("depth") > F.col("c_depth"), F.lit(False))
        state = state.select("key", "parent", "depth", "rep", (F.col("weight") - F.coalesce("cut", F.lit(0))).alias("weight"),
                             F.when(under, F.col("child")).otherwise(F.col("comp")).alias("comp"), under.alias("under"), *values)
        # the centroid stands alone; without one above it, its component has no other rest
        state = written(state.join(small(cents.select(F.col("c").alias("key"), F.lit(True).alias("alone"))), "key", "left"), "state")
        done.append(state.where("alone").select("key", "parent", "depth", F.col("key").alias("comp"), *values))
        children = written(state.where("under and key = comp").select("key", F.col("parent").alias("c")), "children")
        rounds.append((cents, path, children))
        live = state.where("alone is null").drop("under", "alone")

    parts = done[0]
    for more in done[1:]:
        parts = parts.unionByName(more)
    base = written(_finish(parts, values), "finished")
    sums = [F.sum(v).alias(v) for v in values]
    added = None
    for cents, path, children in reversed(rounds):
        now = children.join(base, "key")
        if added is not None:
            now = now.unionByName(children.join(added, "key"))
        kids = written(now.groupBy("c").agg(*sums), "kids")
        own = base.join(small(cents.select(F.col("c").alias("key"))), "key").select(F.col("key").alias("c"), *values)
        totals = written(own.unionByName(kids).groupBy("c").agg(*sums), "totals")
        more = kids.withColumnRenamed("c", "key").unionByName(path.join(small(totals), "c").select("key", *values))
        added = written(more if added is None else added.unionByName(more), "added")
    out = base if added is None else base.unionByName(added)
    return out.groupBy("key").agg(*sums)


def _finish(parts: DataFrame, values: list[str]) -> DataFrame:
    """(key, *values): sums over the subtrees inside each component, components together in tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = np.stack([batch.column(i).fill_null(-1).to_numpy() for i in range(len(names) + 7)])
            held = now if held is None else np.concatenate([held, now], 1)
            last = int(np.argmax((held[0] == held[0, -1]) & (held[1] == held[1, -1])))  # the last component may go on
            if last:
                yield finished(held[:, :last])
                held = held[:, last:]
        if held is not None:
            yield finished(held)

    def finished(x: np.ndarray) -> pa.RecordBatch:
        out = component_sums(x[:2], x[2:4], x[4:6], x[7:])
        return pa.RecordBatch.from_arrays([pa.array(x[2]), pa.array(x[3]), *(pa.array(v) for v in out)], ["a", "b", *names])

    names = values
    rows = parts.select(F.col("comp.a").alias("ca"), F.col("comp.b").alias("cb"), F.col("key.a").alias("a"), F.col("key.b").alias("b"),
                        F.col("parent.a").alias("pa"), F.col("parent.b").alias("pb"), "depth", *values)
    rows = rows.repartition(partitions(parts.sparkSession), "ca", "cb").sortWithinPartitions("ca", "cb", "depth", "a", "b")
    found = rows.mapInArrow(run, "a long, b long, " + ", ".join(f"{v} long" for v in values))
    return found.select(_key(F.col("a"), F.col("b")).alias("key"), *values)


def component_sums(comp: np.ndarray, key: np.ndarray, parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of whole components by centroid decomposition, all components together.

    Nodes are columns, ordered by (component, depth); a component's first node is its top, and a
    parent outside the component does not count.
    """
    n = key.shape[1]
    start = np.concatenate([[True], (comp[:, 1:] != comp[:, :-1]).any(0)])
    order = np.lexsort((key[1], key[0]))
    up = _places(key[:, order], parent)
    up = np.where(start | (up < 0), -1, order[np.maximum(up, 0)])
    top = np.maximum.accumulate(np.where(start, np.arange(n), 0))  # component by its top
    counts = [1] * n
    for v, above in zip(range(n - 1, -1, -1), up[::-1].tolist(), strict=True):  # parents stand before their children
        if above >= 0:
            counts[above] += counts[v]
    weight = np.array(counts, np.int64)
    rounds, live = [], np.arange(n)
    while len(live):
        total = weight[top[live]]
        heavy = live[2 * weight[live] >= total]
        heavy = heavy[np.lexsort((heavy, weight[heavy], top[heavy]))]
        c = heavy[np.concatenate([[True], top[heavy][1:] != top[heavy][:-1]])]
        cut = np.zeros(n, bool)
        cut[c] = True
        walk, ways = [], c[c != top[c]]
        at = up[ways]
        while len(at):  # all paths step by step
            walk.append((at, ways))
            weight[at] -= weight[ways]
            on = at != top[at]
            at, ways = up[at[on]], ways[on]
        kids = live[(up[live] >= 0) & cut[up[live]] & (live != top[live])]
        rounds.append((c, kids, walk))
        alone = live[cut[live]]
        rest = live[~cut[live]]
        # new tops: children of centroids; others look up until they meet a top
        jump = np.where(up >= 0, up, np.arange(n))
        jump[kids] = kids
        jump[top[rest]] = top[rest]
        jump[alone] = alone
        jump[c[c == top[c]]] = c[c == top[c]]
        ptr = jump[rest]
        while True:
            nxt = jump[ptr]
            if (nxt == ptr).all():
                break
            jump[rest] = nxt
            ptr = jump[rest]
        top[rest] = ptr
        live = rest
    sums = values.astype(np.int64).copy()
    for c, kids, walk in reversed(rounds):
        for v in sums:
            np.add.at(v, up[kids], v[kids])
            for at, ways in walk:
                np.add.at(v, at, v[ways])
    return sums


def _places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of two-part keys in sorted ones; -1 where there is none."""
    pair = np.dtype([("a", np.int64), ("b", np.int64)])
    have, want = (np.ascontiguousarray(k.T).view(pair).reshape(-1) for k in (keys, wanted))
    at = np.minimum(np.searchsorted(have, want), max(len(have) - 1, 0))
    return np.where(have[at] == want, at, -1)


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ids that end in a node, ascending, joined by commas.

    Rows dealt by ranges of (node, id) are joined to pieces of ``PIECE`` ids, which a stream hashes
    in order; no task holds a node's ids together.
    """

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = None, []
        for batch in batches:
            out = []
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held != (a, b) or len(ids) == PIECE:
                    if ids:
                        out.append((*held, ids[0], ",".join(map(str, ids))))
                    held, ids = (a, b), []
                ids.append(conv)
            yield pieces(out)
        if ids:
            yield pieces([(*held, ids[0], ",".join(map(str, ids)))])

    def pieces(out: list) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], ["a", "b", "first", "ids"])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            out = []
            for a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held != (a, b):
                    if held is not None:
                        out.append((*held, state.hexdigest()))
                    held, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield digests(out)
        if held is not None:
            yield digests([(*held, state.hexdigest())])

    def digests(out: list) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2], pa.string())], ["a", "b", "ends_sha256"])

    n = partitions(ends.sparkSession)
    rows = ends.select(F.col("key.a").alias("a"), F.col("key.b").alias("b"), "conv_id").repartitionByRange(n, "a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    joined = rows.mapInArrow(join, "a long, b long, first long, ids string").repartition(n, "a", "b").sortWithinPartitions("a", "b", "first")
    return joined.mapInArrow(digest, "a long, b long, ends_sha256 string").select(_key(F.col("a"), F.col("b")).alias("key"), "ends_sha256")


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one
    row per distinct prefix of the rebuilt conversations, the textless root included.

    ``conv_id`` is the prefix's smallest member. A conversation that is left without turns is a
    member of the root, which has no parent. Rows that repeat are turns of their own. An empty table, or one without
    conversation ids, gives an empty table.
    """
    convs, rows = rebuilt(turns(conversations, id_col, turn_col, role_col, text_col))
    paths = prefixes(rows)
    found, ends = nodes(convs, paths)
    children = found.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    tree = found.join(written(children, "n_children"), "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    tree = written(tree.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"), "comp": _root()}), "tree")
    sums = written(subtree_sums(tree, paths, ["n_leaves", "saved_tokens"]), "sums")
    parents = tree.select(F.col("key").alias("parent"), F.col("rep").alias("parent_conv_id"))
    out = tree.drop("n_leaves", "saved_tokens", "comp").join(sums, "key").join(parents, "parent", "left").join(written(end_digests(ends), "digests"), "key", "left")
    return out.select(F.col("rep").alias(id_col), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
