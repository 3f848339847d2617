"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability of
a word is the sum over all its segmentations into pieces (a forward pass over its characters);
the log probability of a text is the sum over its words. Probabilities are fitted by expectation
maximisation: expected uses of each piece in the training words (forward and backward passes),
summed per language by Spark, become the next probabilities.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo.llm.bpe import MEMO, arrow_type
from relevo.llm.frames import map_texts, partitions, slices, text_rows, use_caches, written

UNKNOWN = "und"
#: About so many labelled rows per language are used to fit the probabilities (all, if fewer).
TRAIN_ROWS = 1000
ROUNDS = 3
#: Words whose expected uses are summed together.
TOGETHER = 2048
#: Added to the expected uses of every piece.
ADDED = 0.05
#: Letter runs are cut at this length, so that no product of probabilities underflows.
LONGEST = 32
_LETTERS = re.compile(r"[^\W\d_]+")
#: A word is odd for a language if its log probability is so much a letter below that of the language's training
#: words; a text is usual if its odd words hold at most this share of its letters. Names, keys and slips
#: leave a text usual.
MARGIN, ODD_SHARE = 1.0, 0.65
START = "▁"  # marks the start of a word in the vocabulary


def words(text: str) -> list[str]:
    """Lower-cased letter runs, a long one in parts of ``LONGEST``; only the first part is a word start."""
    out = []
    for w in _LETTERS.findall(unicodedata.normalize("NFC", text).lower()):
        if len(w) < LONGEST:
            out.append(START + w)
        else:
            out += [START * (i == 0) + w[i : i + LONGEST] for i in range(0, len(w), LONGEST)]
    return out


class Lattice:
    """The vocabulary's letter pieces, and where they occur in a word."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {sp.id_to_piece(i) for i in range(sp.get_piece_size())}
        self.pieces = sorted({p.lower() for p in found if _LETTERS.fullmatch(p.replace(START, "", 1)) or p == START})
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(self.pieces):
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.other = len(self.pieces)  # a character that no piece holds
        self.singles = {p for p in self.pieces if len(p) == 1}

    def arcs(self, word: str) -> list[tuple[int, int, int]]:
        """(start, end, piece) by end; every character that is no piece is an arc of its own."""
        out = [(at + 1 - n, at + 1, i) for at, (n, i) in self.automaton.iter(word)]
        if not self.singles.issuperset(word):
            out += [(i, i + 1, self.other) for i, c in enumerate(word) if c not in self.singles]
            out.sort(key=lambda a: a[1])
        return out


@functools.lru_cache(2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def all_arcs(lat: Lattice, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The arcs (word, start, end, piece) of words, by end, and the words' lengths."""
    flat: list[int] = []
    for i, word in enumerate(found):
        for start, end, piece in lat.arcs(word):
            flat += (i, start, end, piece)
    arcs = np.array(flat, np.int64).reshape(-1, 4)
    return arcs[np.argsort(arcs[:, 2], kind="stable")], np.array([len(w) for w in found])


def forward(arcs: list, n: int, p: np.ndarray) -> list[np.ndarray]:
    """The probability of each prefix over all segmentations; one entry per language."""
    alpha = [np.zeros(p.shape[1]) for _ in range(n + 1)]
    alpha[0] = np.ones(p.shape[1])
    for start, end, piece in arcs:
        alpha[end] = alpha[end] + alpha[start] * p[piece]
    return alpha


def expected_uses(lat: Lattice, found: list[str], column: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected uses of every piece, by language, over all segmentations of words.

    Word i occurs ``n[i]`` times in the language of column ``column[i]``. All words go forward and
    backward together, place by place.
    """
    arcs, size = all_arcs(lat, found)
    w, start, end, piece = arcs.T
    q = p[piece, column[w]]
    alpha, beta = (np.zeros((len(found), int(size.max()) + 1)) for _ in range(2))
    alpha[:, 0] = 1
    beta[np.arange(len(found)), size] = 1
    cuts = np.searchsorted(end, np.arange(1, alpha.shape[1] + 1))
    parts = [slice(x, y) for x, y in zip(cuts, cuts[1:], strict=False)]
    for at, part in enumerate(parts, 1):
        np.add.at(alpha[:, at], w[part], alpha[w[part], start[part]] * q[part])
    for at, part in reversed(list(enumerate(parts, 1))):
        np.add.at(beta, (w[part], start[part]), q[part] * beta[w[part], at])
    total = alpha[np.arange(len(found)), size]
    share = n / np.where(total > 0, total, np.inf)
    uses = np.bincount(piece * p.shape[1] + column[w], alpha[w, start] * q * beta[w, end] * share[w], p.size)
    return uses.reshape(p.shape)


@dataclass
class Model:
    """Log priors, piece probabilities and usual log probabilities, one column per language."""

    path: str
    languages: list[str]
    prior: np.ndarray
    p: np.ndarray
    #: Mean log probability, a letter, of the language's own training words.
    level: np.ndarray | None = None


class Scorer:
    """Log probabilities of words (remembered, at most ``MEMO``) and of texts."""

    def __init__(self, model: Model):
        self.model, self.lat = model, lattice(model.path)
        self.rows = np.empty((MEMO, len(model.languages)))
        self.odd = np.zeros((MEMO, len(model.languages)), np.int32)  # the letters of a word that is odd
        self.at: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        """Log probabilities of words, all of them forward place by place."""
        p, lat = self.model.p, self.lat
        if len(self.at) + len(new) > len(self.rows):
            raise ValueError("more words than rows")
        arcs, size = all_arcs(lat, new)
        alpha = np.zeros((len(new), int(size.max()) + 1, p.shape[1]))
        alpha[:, 0] = 1
        cuts = np.searchsorted(arcs[:, 2], np.arange(1, alpha.shape[1] + 1))
        for end in range(1, alpha.shape[1]):
            w, start, _, piece = arcs[cuts[end - 1] : cuts[end]].T
            np.add.at(alpha[:, end], w, alpha[w, start] * p[piece])
        first = len(self.at)
        found = np.log(np.maximum(alpha[np.arange(len(new)), size], 1e-300))
        self.rows[first : first + len(new)] = found
        if self.model.level is not None:
            odd = (self.model.level - MARGIN) * size[:, None] > found
            self.odd[first : first + len(new)] = np.where(odd, size[:, None], 0)
        self.at.update(zip(new, range(first, first + len(new)), strict=True))

    def predict_all(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, posterior probability) of each text; ('und', 0.0) without a letter."""
        return [(k, x) for k, x, _ in self.judge_all(texts)]

    def judge_all(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, posterior probability, usual) of each text; ('und', 0.0, False) without a letter.

        The posterior only compares the languages. ``usual`` says whether the best one explains most of the
        text about as well as its own training words (see ``MARGIN``).
        """
        out: list[tuple[str, float, bool]] = []
        model = self.model
        for at in range(0, len(texts), 64):
            found = [words(t) for t in texts[at : at + 64]]
            totals = [model.prior.copy() for _ in found]
            odd = [np.zeros(len(model.languages), np.int64) for _ in found]
            if not model.languages:
                out += [(UNKNOWN, 0.0, False)] * len(found)
                continue
            for i, ws in enumerate(found):
                if len(ws) <= MEMO // 64:
                    continue
                for s in range(0, len(ws), MEMO // 64):  # a very long text, part by part
                    part = ws[s : s + MEMO // 64]
                    totals[i] += self._sums([part])[0]
                    odd[i] += self._odd(part)
            short = [i for i, ws in enumerate(found) if 0 < len(ws) <= MEMO // 64]
            for i, x in zip(short, self._sums([found[i] for i in short]), strict=True):
                totals[i] += x
                odd[i] += self._odd(found[i])
            for ws, score, letters in zip(found, totals, odd, strict=True):
                best = int(score.argmax())
                if ws:
                    usual = bool(letters[best] <= ODD_SHARE * sum(map(len, ws)))
                    out.append((model.languages[best], float(1 / np.exp(score - score[best]).sum()), usual))
                else:
                    out.append((UNKNOWN, 0.0, False))
        return out

    def _odd(self, ws: list[str]) -> np.ndarray:
        """The letters of the odd words of a list whose words are known, by language."""
        return self.odd[list(map(self.at.__getitem__, ws))].sum(0)

    def _sums(self, lists: list[list[str]]) -> list[np.ndarray]:
        """The summed log probabilities of each list; together at most ``MEMO`` words."""
        if not lists:
            return []
        distinct = set().union(*lists)
        new = distinct.difference(self.at)
        if len(self.at) + len(new) > MEMO:
            self.at.clear()
            new = distinct
        if new:
            self._learn(sorted(new))
        return [self.rows[list(map(self.at.__getitem__, ws))].sum(0) for ws in lists]


def fit(train: DataFrame, path: str, train_rows: int = TRAIN_ROWS, rounds: int = ROUNDS, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit piece probabilities per language on a bounded sample of labelled rows.

    About ``train_rows`` rows of each language are chosen by a hash of the id: a bounded sample of
    labelled rows for a classifier. Rows without text, label or letters teach nothing; without any
    training row the model has no language and predicts ``und``. The driver holds the
    probabilities (vocabulary size x languages).
    """
    spark = train.sparkSession
    rows = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"))
    sizes = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    languages = sorted(sizes)
    lat = lattice(path)
    if not languages:
        return Model(path, [], np.zeros(0), np.zeros((len(lat.pieces) + 1, 0)))
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, train_rows / n)))])
    luck = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("train")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(luck < share[F.col("_lang")])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_caches("langid", _forget)
        for batch in batches:
            for langs, texts in text_rows(batch):
                found = Counter((k, w) for k, t in zip(langs, texts, strict=True) for w in words(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.string()), pa.array([w for _, w in found], pa.string()),
                     pa.array(found.values(), pa.int64())], ["lang", "word", "n"])

    counts = sample.select("_lang", "_text").mapInArrow(count, "lang string, word string, n long") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # dealt evenly: a few words would otherwise end in very few tasks, and each takes long
    counts = written(counts, "words").repartition(partitions(spark))
    p = np.full((len(lat.pieces) + 1, len(languages)), 1.0 / (len(lat.pieces) + 1))
    column = {k: i for i, k in enumerate(languages)}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(p)

        def uses(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            use_caches("langid", _forget)
            lat, p = lattice(path), shared.value
            total = np.zeros(p.shape)
            for batch in batches:
                for at in range(0, batch.num_rows, TOGETHER):
                    langs, found, n = (batch.column(i).slice(at, TOGETHER) for i in range(3))
                    langs = np.array([column[k] for k in langs.to_pylist()])
                    total += expected_uses(lat, found.to_pylist(), langs, n.to_numpy(), p)
            piece, c = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[piece, c], pa.float64())], ["c", "piece", "n"])

        found = counts.mapInArrow(uses, "c int, piece int, n double").groupBy("c", "piece").agg(F.sum("n").alias("n")).toPandas()
        p = np.full_like(p, ADDED)
        p[found["piece"].to_numpy(), found["c"].to_numpy()] += found["n"].to_numpy()
        p /= p.sum(0)
        shared.unpersist()
    prior = np.log(np.array([sizes[k] for k in languages], float) / sum(sizes.values()))
    return Model(path, languages, prior, p, _usual(counts, Model(path, languages, prior, p)))


def _usual(counts: DataFrame, model: Model) -> np.ndarray:
    """Per language, the mean log probability a letter of its training words (lang, word, n)."""
    shared = counts.sparkSession.sparkContext.broadcast(model)
    column = {k: i for i, k in enumerate(model.languages)}

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, total = Scorer(shared.value), np.zeros((2, len(column)))
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                langs, found, n = (batch.column(i).slice(at, TOGETHER).to_pylist() for i in range(3))
                s.at.clear()
                s._learn(sorted(set(found)))
                c, n = np.array([column[k] for k in langs]), np.array(n, float)
                np.add.at(total[0], c, n * s.rows[[s.at[w] for w in found], c])
                np.add.at(total[1], c, n * np.array([len(w) for w in found]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(column)), pa.int32()), *map(pa.array, total)], ["c", "x", "letters"])

    rows = counts.mapInArrow(sums, "c int, x double, letters double").groupBy("c").agg(F.sum("x").alias("x"), F.sum("letters").alias("letters")).collect()
    level = np.zeros(len(column))
    for r in rows:
        level[r["c"]] = r["x"] / r["letters"] if r["letters"] else 0.0
    return level


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text, one row per input row; no shuffle.

    ``score`` is the posterior probability of the language. A null text, or one without a letter,
    is ``und`` with score 0. Only the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(keys: list, texts: list) -> pa.RecordBatch:
        found = scorer(shared).predict_all(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, key_type), pa.array([k for k, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names)

    key_type, kind, names = arrow_type(docs, id_col), docs.schema[id_col].dataType.simpleString(), [id_col, "lang_pred", "score"]
    return map_texts(docs, id_col, text_col, rows, f"`{id_col}` {kind}, lang_pred string, score double")


_SCORERS: dict[int, Scorer] = {}


def _forget() -> None:
    _SCORERS.clear()
    lattice.cache_clear()


def scorer(shared) -> Scorer:
    """The worker's scorer of a broadcast model; only the latest is kept."""
    use_caches("langid", _forget)
    found = _SCORERS.get(id(shared.value))
    if found is None or found.model is not shared.value:
        _SCORERS.clear()
        found = _SCORERS[id(shared.value)] = Scorer(shared.value)
    return found


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def keep_known(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text has a known language with at least that score, and is usual for it; all columns stay.

    A text in no language of the model has a clear best one too: what it lacks is the usual log
    probability. A text without a letter goes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                found = scorer(shared).judge_all([t or "" for t in part.column(place).to_pylist()])
                yield part.filter(pa.array([k != UNKNOWN and x >= least and usual for k, x, usual in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
