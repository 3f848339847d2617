"""Spelling variants: words one edit apart, grouped under their frequent forms, by asymmetric q-chunks.

1. *Counts.* Every task counts the letter runs of its texts and hands on sums.
2. *Chunks and grams.* A word of length L gives two disjoint chunks, its halves. A word of length L
   or L + 1 gives its positional grams of those lengths. One edit leaves a half of the shorter word
   whole, and moves it by at most one place; so two near words meet under a half (its text, and
   what is left open of the word). Only grams within a shift of one of a chunk's place can meet a
   chunk, so only they are made.
3. *Hot chunks.* A common prefix or ending is the chunk of many words. Where chunk holders times gram
   holders pass ``MOST_PAIRS``, the rows of the chunk are cut again: the open rest of the word is
   halved in turn, and one of its halves is whole too. That ends at rests of one letter, whose holders
   the alphabet bounds. No group grows with the vocabulary and nothing is capped.
4. Words that meet are verified by their edit distance in the join, so only near pairs leave it.
5. Forms are followed to their roots by joining the form table with itself, doubling the steps.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo.llm.frames import text_rows, written
from relevo.llm.ngram_join import small

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: Holders of a chunk times holders of the gram; beyond it the chunk is refined.
MOST_PAIRS = 4096
#: A task hands its counts on after so many distinct words, or so many letters of them.
HELD_WORDS = 200_000
HELD_LETTERS = 16 << 20
_LONG = 1 << 20


def word_counts(docs: DataFrame, drop_every: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the letter runs of every whole text: ASCII and Latin-1 letters, A-Z lower-cased.

    With ``drop_every``, a run whose hash (crc32 of ``id:run``) is divisible by it loses the code
    point at the hash modulo its length, as a typing slip would. Words shorter than
    ``least_length`` or rarer than ``least_count`` are left out. A null text has no runs; a null
    id counts as an empty one. Rows that repeat count each time. An empty table gives no words.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        letters = 0
        for batch in batches:
            for keys, texts in text_rows(batch):
                for key, text in zip(keys, texts, strict=True):
                    low = text.encode().lower().decode()  # bytes: only A-Z
                    start = zlib.crc32(f"{key}:".encode())
                    for run, n in Counter(RUN.findall(low) if len(low) < _LONG else (m[0] for m in RUN.finditer(low))).items():
                        if len(run) < least_length:
                            continue
                        if drop_every:
                            h = zlib.crc32(run.encode(), start)
                            if h % drop_every == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                                if len(run) < least_length:
                                    continue
                        if run not in total:
                            letters += len(run)
                        total[run] += n
                    if len(total) > HELD_WORDS or letters > HELD_LETTERS:
                        yield batch_of(total)
                        total, letters = Counter(), 0
        if total:
            yield batch_of(total)

    def batch_of(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _key(size: Column) -> Column:
    """The text around the open rest of a word, and the length of the chunk word."""
    return F.concat(size.cast("string"), F.lit(":"), F.expr("left(word, i)"), F.lit("*"), F.expr("right(word, j)"))


def _halved(rows: DataFrame) -> DataFrame:
    """Both ways to take a half of the open rest as whole: its first letters, or its last."""
    half = F.expr("(size - i - j) div 2")
    first = F.struct((F.col("i") + half).alias("i"), F.col("j"))
    last = F.struct(F.col("i"), (F.col("size") - F.col("i") - half).alias("j"))
    out = rows.select("gram", "word", "n", "m", "size", F.explode(F.array(first.cast("struct<i:int,j:int>"), last.cast("struct<i:int,j:int>"))).alias("_x"))
    out = out.select("gram", "word", "n", "m", "size", F.col("_x.i").alias("i"), F.col("_x.j").alias("j"))
    return out.withColumn("key", _key(F.col("size")))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways, of words (word, n) of at least two letters one edit apart."""
    base = words.select("word", "n", F.length("word").alias("m"))
    start = [F.lit(0).alias("i"), F.lit(0).alias("j")]
    chunks = base.select(F.lit(False).alias("gram"), "*", F.col("m").alias("size"), *start)
    grams = base.select(F.lit(True).alias("gram"), "*", F.explode(F.array("m", F.col("m") - 1)).alias("size"), *start)
    rows, found = _halved(chunks.unionByName(grams)), []
    while True:
        rows = written(rows, "chunks")
        counts = rows.groupBy("key").agg(F.count_if(~F.col("gram")).alias("c"), F.count_if("gram").alias("g"), F.min(F.expr("size - i - j")).alias("rest"))
        hot = written(counts.where((F.col("c") * F.col("g") > MOST_PAIRS) & (F.col("rest") > 1)).select("key"), "hot")
        if hot.isEmpty():
            found.append(_met(rows))
            break
        side = small(hot)
        found.append(_met(rows.join(side, "key", "left_anti")))
        rows = _halved(rows.join(side, "key", "left_semi"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.distinct()  # a pair may meet under several halves
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def _met(rows: DataFrame) -> DataFrame:
    """Near pairs under one key: the chunk word is the shorter, or the smaller of equal length."""
    a = rows.where(~F.col("gram")).select("key", "word", "n", "m")
    b = rows.where("gram").select("key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("m").alias("other_m"))
    order = (F.col("m") < F.col("other_m")) | ((F.col("m") == F.col("other_m")) & (F.col("word") < F.col("other")))
    met = a.join(b, (a["key"] == b["key"]) & order & (F.levenshtein("word", "other", 1) == 1))
    return met.select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last; without cycles."""
    up = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        nxt = written(up.join(above, "root", "left").select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "roots")
        up = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return up


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n) of at least two letters.

    Two words are near if one inserted, deleted or replaced code point makes them equal. A word's
    form is its most frequent near word (ties: smallest in code-point order), if that is at least
    ``ratio`` times as frequent; else null. The root follows forms to the last one: counts grow
    by ``ratio`` with every step, so there are few. No words give an empty table.
    """
    words = written(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = written(near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "near")
    rows = words.join(near, "word", "left").select("word", "n", "n_near", F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best")).alias("best"))
    rows = written(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n")), "forms")
    found = roots(rows.where("form is not null"))
    return rows.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
