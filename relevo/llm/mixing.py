"""Mixing sources to target weights by Pareto order sampling.

1. *Targets.* Sources share a given multiple of all words by weight; a target stops at a given multiple
   of its source's size, and the excess is shared anew by weight until none is above.
2. *Certain copies.* Every document of a source is taken ``floor(target / size)`` times whole.
3. *Inclusion.* The words still missing come from one more copy of some documents. A document's
   inclusion probability is proportional to the square root of its size, scaled so that the expected
   words are the missing ones: a long document brings more words a copy, a short one still has its
   chance. Where that reaches 1 the copy is certain too, and the rest is scaled anew.
4. *Order.* The others are ranked by their random odds divided by their inclusion odds. The random number
   is a hash of id and text, so that reruns agree. The first in that order are taken, up to
   the number of words still missing: the sample is fixed in words, to half a document.

Sums over one source run over rows dealt by ranges of (source, rank), so a hot source fills many
tasks; scaling works on counts of equal sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo.llm.frames import written
from relevo.llm.ngram_join import small
from relevo.llm.running import running
from relevo.llm.words import SPACES

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, luck) of every row: its words ``[^\\x20\\x09-\\x0D]+`` (null text: 0), and a
    number in (0, 1) from the MD5 of id and text."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(_words(batch.column(3)))], ["id", "source", "luck", "size"])

    seed = F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))), 1, 12)
    luck = (F.conv(seed, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), luck.alias("luck"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(count, f"id {kind}, source string, luck double, size long")


def _words(texts: pa.Array) -> np.ndarray:
    """The number of words of each text: places that hold no space, after a space or a text's start."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    letter = ~_SPACE[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]]
    bounds = bounds - bounds[0]
    starts = letter.copy()
    starts[1:] &= ~letter[:-1]
    first = bounds[:-1][np.diff(bounds) > 0]
    starts[first] = letter[first]
    before = np.concatenate([[0], np.cumsum(starts)])
    return (before[bounds[1:]] - before[bounds[:-1]]).astype(np.int64)


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(src, source, source_size, target) of the sources of rows (source, size).

    Sources stand by code point, null last, numbered from 1; ``weights`` repeat along them. Targets
    are the weights times one level, at most ``most`` times the source's size; the level is raised
    until the targets sum to ``share`` times all sizes. The driver sees two sums a round.
    """
    if share > most:
        raise ValueError("no mix can be larger than the most that may be taken of every source")
    found = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    # numbered in order: null sources come last by the first key, and every row is one group
    keyed = written(found.select(F.lit(0).cast("long").alias("_all"), F.col("source").isNull().alias("_null"), "source", "source_size", F.lit(1).cast("long").alias("_one")), "sources")
    numbered = running(keyed, "_all", ["_null", "source"], {"src": "_one"})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("src") - 1, F.lit(len(weights))) + 1).cast("int"))
    found = written(numbered.select("src", "source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("cap")), "numbered")
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        total, full_caps, free, n = found.agg(F.sum("source_size"), F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if n == capped or not free:
            break
        level, capped = (share * (total or 0) - (full_caps or 0.0)) / free, n
    target = F.when((F.col("cap") <= F.lit(level) * F.col("weight")) | F.lit(not free), F.col("cap")).otherwise(F.lit(level) * F.col("weight"))
    return written(found.select("src", "source", "source_size", target.alias("target")), "targets")


def _scales(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(src, scale): the factor of the square root of sizes that gives the missing words in expectation.

    Probabilities that reach 1 are set to 1 and the others scaled anew, until none changes; all
    sources go together, on counts of equal sizes.
    """
    same = rows.where("size > 0").groupBy("src", "size").agg(F.count("*").alias("n"))
    same = written(same.join(small(sources.where("missing > 0").select("src", "missing")), "src"), "same_sizes")
    scales, last = None, None
    while True:
        known = same if scales is None else same.join(small(scales.select("src", "scale")), "src", "left")
        sure = F.lit(False) if scales is None else F.coalesce(F.col("scale") * F.sqrt("size") >= 1, F.lit(False))
        words = F.col("size") * F.col("n")
        sums = known.groupBy("src").agg(F.first("missing").alias("missing"), F.sum(F.when(sure, words).otherwise(0)).alias("certain"),
                                        F.sum(F.when(sure, 0.0).otherwise(words * F.sqrt("size"))).alias("free"), F.sum(F.when(sure, F.col("n")).otherwise(0)).alias("sure"))
        scales = written(sums.select("src", F.when(F.col("free") > 0, (F.col("missing") - F.col("certain")) / F.col("free")).otherwise(float("inf")).alias("scale"), "sure"), "scales")
        now = scales.agg(F.sum("sure")).first()[0]
        if now == last or now is None:
            return scales
        last = now


def inclusion(scale: Column, size: Column) -> Column:
    """The inclusion probability of a further copy; 0 for a document without words."""
    return F.when(size > 0, F.least(scale * F.sqrt(size), F.lit(1.0))).otherwise(0.0)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, copies, taken, chance), one row per input row.

    ``copies`` of the document are in the mix, ``taken`` = copies x size words; ``chance`` is the
    inclusion probability of the copy beyond the whole ones. Rows with a null source are a source.
    Rows of one id and text have the same luck; they stand next to each other in the order and
    are taken one by one. Documents without words take nothing. An empty table gives an empty table.
    """
    rows = written(sizes(docs, id_col, text_col, source_col).withColumn("uid", F.monotonically_increasing_id()), "sizes")
    goal = targets(rows, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = rows.join(small(goal.select("src", F.col("source").alias("_source"))), F.col("source").eqNullSafe(F.col("_source"))).select("id", "src", "luck", "size", "uid")
    rows = written(rows, "documents")
    scales = _scales(rows, goal)
    scale = F.coalesce("scale", F.lit(0.0)).alias("scale")
    goal = written(goal.join(scales, "src", "left").select("src", "source_size", "target", "whole", "missing", scale), "goals")
    side = small(goal)
    ranked = rows.join(side, "src").withColumn("chance", inclusion(F.col("scale"), F.col("size")))
    odds = F.try_divide(F.col("luck") * (1 - F.col("chance")), (1 - F.col("luck")) * F.col("chance"))  # null: no chance
    rank = F.when(F.col("chance") >= 1, -1.0).otherwise(F.coalesce(odds, F.lit(float("inf"))))
    ranked = written(ranked.select("id", "src", "size", "uid", "chance", rank.alias("rank")), "ranked")
    placed = running(ranked, "src", ["rank", "size", "uid"], {"upto": "size"})
    # certain copies stand first; a further one is taken if its middle lies before the missing words' end
    more = (F.col("missing") > 0) & ((F.col("chance") >= 1) | (2 * F.col("upto") - F.col("size") <= 2 * F.col("missing")))
    out = placed.join(side, "src").withColumn("copies", F.col("whole") + F.when((F.col("size") > 0) & more, 1).otherwise(0))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "chance")
