"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its pairs of adjacent words (a lone word stands for itself), weighted
by how often they occur. A term is the 64-bit hash of a pair. For each term and sample there are a
fixed ``r`` and ``c`` (gamma distributed, shape 2) and ``b`` (uniform), derived from hashes of the
term. A term of weight ``w`` is quantised to ``t = floor(ln w / r + b)`` and gets the value
``ln c - r * (t + 1 - b)``. The sample is the term (and its ``t``) of the smallest value. Two texts
agree in a sample with a probability equal to their generalised Jaccard similarity, the sum of the
smaller weights over the sum of the larger ones, at any length. The fingerprint is 16 bits of each
sample as hex; the likeness of two fingerprints is the share of samples that agree.

``r``, ``c`` and ``b`` come from three independent exponential numbers ``x``, ``y``, ``z`` of the term
and sample: ``c = x + y``, ``r = z + ln(c / x)``, ``b = z / r``. (A gamma number of shape 2 times an
independent uniform one is exponential, and independent of the rest; so the three have the
distributions above and are independent.) At weight 1, ``t`` is 0 and the value is ``ln x``, so that
among the terms of weight 1 the smallest hash behind ``x`` decides, without a logarithm.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.bpe import Memo, arrow_type
from relevo.llm.frames import CHUNK_BYTES, map_texts, partitions

SAMPLES = 64
TERM_BITS = 64
SEED = 20240229
#: Numbers (terms x samples) that are handled at once.
BLOCK = 1 << 16
#: Terms of a weight above 1 whose numbers a worker remembers.
HEAVY = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """The numbers of every term and sample, by hashing, and the fingerprint of a text."""

    def __init__(self, samples: int = SAMPLES, term_bits: int = TERM_BITS, seed: int = SEED):
        self.samples, self.shift, self.step = samples, np.uint64(64 - term_bits), max(1, BLOCK // samples)
        keys = np.arange(1, 3 * samples + 1, dtype=np.uint64) + np.uint64(seed << 32)
        self.keys = mix(keys * np.uint64(0x9E3779B97F4A7C15)).reshape(3, samples, 1)
        self.word = Memo(self._word)
        self.at: dict[int, int] = {}
        self.numbers = np.empty((HEAVY, 3, samples))
        self.empty = "0" * (4 * samples)

    @staticmethod
    def _word(word: str) -> int:
        return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")

    def terms(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a text, ascending, and their weights."""
        words = text.split()
        h = np.fromiter(map(self.word.__getitem__, words), np.uint64, len(words))
        if len(h) > 1:
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ np.uint64(0xC2B2AE3D27D4EB4F))
        return np.unique(mix(h) >> self.shift, return_counts=True)

    def _hashes(self, terms: np.ndarray, which: int) -> np.ndarray:
        """The hash (sample, term) behind one of ``x``, ``y``, ``z``: mix of term and key, in place."""
        h = terms ^ self.keys[which]
        shifted = h >> np.uint64(30)
        h ^= shifted
        h *= np.uint64(0xBF58476D1CE4E5B9)
        np.right_shift(h, np.uint64(27), out=shifted)
        h ^= shifted
        h *= np.uint64(0x94D049BB133111EB)
        np.right_shift(h, np.uint64(31), out=shifted)
        h ^= shifted
        return h

    def _light(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per sample the term of weight 1 with the smallest value, and that value."""
        best, least = np.zeros(self.samples, np.uint64), np.full(self.samples, np.iinfo(np.uint64).max)
        for at in range(0, len(terms), self.step):
            part = terms[at : at + self.step]
            h = self._hashes(part, 0)
            place = h.argmin(1)
            low = h[np.arange(self.samples), place]
            less = low <= least if not at else low < least
            best[less], least[less] = part[place[less]], low[less]
        return best, np.log(exponential(least))

    def _heavy(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per sample the term of smallest value, its ``t`` and the value; any weights."""
        best, step, least = np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.int64), np.full(self.samples, np.inf)
        column = np.arange(self.samples)
        for at in range(0, len(terms), self.step):
            part = terms[at : at + self.step]
            ln_c, r, b = self.numbers[self._known(part)].transpose(1, 0, 2)
            t = np.floor(np.log(weights[at : at + self.step])[:, None] / r + b)
            value = ln_c - r * (t + 1 - b)
            place = value.argmin(0)
            low = value[place, column]
            less = low < least
            best[less], least[less], step[less] = part[place[less]], low[less], t[place[less], column[less]].astype(np.int64)
        return best, step, least

    def _known(self, terms: np.ndarray) -> list[int]:
        """The rows of ``numbers`` (ln c, r, b) that hold at most ``step`` terms."""
        keys = terms.tolist()
        new = [k for k in keys if k not in self.at]
        if len(self.at) + len(new) > HEAVY:
            self.at.clear()
            new = keys
        if new:
            part = np.array(new, np.uint64)
            x, y, z = (exponential(self._hashes(part, i)).T for i in range(3))
            c = x + y
            r = z + np.log(c / x)
            first = len(self.at)
            rows = self.numbers[first : first + len(new)]
            rows[:, 0], rows[:, 1], rows[:, 2] = np.log(c), r, z / r
            self.at.update(zip(new, range(first, first + len(new)), strict=True))
        return [self.at[k] for k in keys]

    def fingerprint(self, text: str) -> str:
        """The fingerprint; a text without words has all zeros."""
        terms, weights = self.terms(text)
        if not len(terms):
            return self.empty
        heavy = weights > 1
        best, step, least = self._heavy(terms[heavy], weights[heavy])
        light = terms[~heavy]
        if len(light):
            other, value = self._light(light)
            less = value < least
            best[less], step[less] = other[less], 0
        code = mix(best + (step + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFF)
        code[code == 0] = 1  # all zeros is kept for texts without words
        return code.astype(">u2").tobytes().hex()


def exponential(h: np.ndarray) -> np.ndarray:
    """Exponential numbers, ascending with the hashes."""
    return -np.log1p(-((h >> np.uint64(11)).astype(float) + 0.5) / (1 << 53))


@functools.lru_cache(2)
def sampler(samples: int = SAMPLES) -> Sampler:
    return Sampler(samples)


def likeness(a: str, b: str) -> float:
    """The share of equal samples of two fingerprints."""
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float((x == y).mean())


def fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every whole text; null or wordless texts have all zeros. No shuffle."""

    def rows(keys: list, texts: list) -> pa.RecordBatch:
        s = sampler(samples)
        return pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array([s.fingerprint(t) for t in texts], pa.string())], names)

    key_type, kind, names = arrow_type(docs, id_col), docs.schema[id_col].dataType.simpleString(), [id_col, "fingerprint"]
    return map_texts(docs, id_col, text_col, rows, f"`{id_col}` {kind}, fingerprint string")


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (_part, _ghost, _key, _text), partitioned and sorted so that each row meets the next.

    Ranges of the id make parts. The first row of a part is copied to the end of the part before
    it (of the first part: to the last), so the successor of every row lies in its own part. The
    driver sees quantiles and one id per part; the texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    parts = 4 * partitions(spark)
    keys = rows.select(F.col("_key").cast("double").alias("_at"))
    bounds = sorted(set(keys.approxQuantile("_at", [i / parts for i in range(1, parts)], 1 / (4 * parts)))) or [0.0]
    split = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol="_at", outputCol="_bucket", handleInvalid="keep")

    def with_part(df: DataFrame) -> DataFrame:
        placed = split.transform(df.withColumn("_at", F.col("_key").cast("double")))
        return placed.withColumn("_part", F.when(F.col("_key").isNull(), -1).otherwise(F.col("_bucket").cast("int"))).drop("_at", "_bucket")

    heads = {r["_part"]: r["_head"] for r in with_part(rows.select("_key")).groupBy("_part").agg(F.min("_key").alias("_head")).collect()}
    order = sorted(heads)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    own = F.struct(F.col("_part").alias("part"), F.lit(0).alias("ghost"))
    placed = with_part(rows)
    if order:
        head = F.create_map(*[x for p in order for x in (F.lit(p), F.lit(heads[p]))])
        prior = F.create_map(*[x for p in order for x in (F.lit(p), F.lit(before[p]))])
        copy = F.struct(prior[F.col("_part")].alias("part"), F.lit(1).alias("ghost"))
        to = F.when(F.col("_key").eqNullSafe(head[F.col("_part")]), F.array(own, copy)).otherwise(F.array(own))
    else:
        to = F.array(own)
    dealt = placed.withColumn("_to", F.explode(to)).select(F.col("_to.part").alias("_part"), F.col("_to.ghost").alias("_ghost"), "_key", "_text")
    return dealt.repartition(partitions(spark), "_part").sortWithinPartitions("_part", "_ghost", "_key", "_text")


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next text by ascending id.

    The edited text replaces the last floor(n / 4) code points by the first as many (or all) of
    the next document; after the last comes the first. Returns (id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next), one row per input row. Null texts are empty; two
    texts without words are alike (1.0). Rows of one id follow each other by text, a null id comes
    first, a lone row is its own successor. ``id_col`` must be numeric.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler(samples)
        out: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for part, ghost, key, text in zip(*(batch.column(i) for i in range(4)), strict=True):
                part, ghost, text = part.as_py(), ghost.as_py(), text.as_py()
                own = s.fingerprint(text)
                if last is not None and last[0] == part:
                    n = len(last[2])
                    edited = last[2][: n - n // 4] + text[: n // 4]
                    mark = s.fingerprint(edited)
                    out.append((last[1], n, edited, last[3], mark, likeness(last[3], mark), likeness(last[3], own)))
                    size += n
                last = None if ghost else (part, key.as_py(), text, own)
                if size >= CHUNK_BYTES:
                    yield rows(out)
                    out, size = [], 0
        if out:
            yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    kinds = [arrow_type(docs, id_col), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [id_col, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kind = docs.schema[id_col].dataType.simpleString()
    return in_order(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
