"""Stemming as a vocabulary job.

Spark has no stemmer, so one small Python helper stems a single word. Texts are cleaned and stemmed in
place (``cleaned_stems``): each task keeps the stems of what it has met, and no token is exploded or shuffled.
With a stem dictionary, or for texts that are not cleaned, the helper runs only on the vocabulary:

1. the tokens of all texts are reduced to the distinct vocabulary (partial aggregation map side,
   so only distinct words cross the network);
2. each distinct word is stemmed once in an Arrow-batched pandas UDF. Only the exceptions, words whose
   stem is another string, are kept and materialised (checkpointed), so the Python work is never
   repeated; any other word is its own stem;
3. words meet the exceptions and the stems are regrouped in position order.

The exceptions are broadcast only after their size has been measured against a limit; the exploded
rows then keep the partitioning of their source, and regrouping needs no shuffle. Above the limit,
each text's distinct words (with their positions) are shuffled to the exceptions, not its tokens.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StringType

from relevo.functions import porter2
from relevo.functions.text import words
from relevo.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, materialize

# Ship the helper to Python workers by value: workers need not have this package installed.
cloudpickle.register_pickle_by_value(porter2)

POS, TOK, STEM = "_pos", "_tok", "_stem"


def _make_stem_udf():
    stem_one = porter2.stem

    def stem_series(tokens: pd.Series) -> pd.Series:
        return tokens.map(stem_one)

    return F.pandas_udf(stem_series, StringType())


stem_udf = _make_stem_udf()


#: Texts up to this length are phrases, which repeat: a task keeps the stems of the last ones.
_PHRASE = 256


def cleaned_stems(text: str | Column, pattern: str, sep: str = "") -> Column:
    """The stems of a text's words in order, joined by ``sep``; characters of ``pattern`` are deleted first.

    ``pattern`` must leave only ASCII letters, digits and white space (``functions.text``): those Python lowers and
    splits as Spark does. A task keeps the stems of words and phrases it has met, and a batch's repeated
    texts are stemmed once; nothing is exploded or shuffled. Write the rows before they are
    joined, so that no plan runs it twice.
    """
    stem = porter2.stem

    def stems(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        deleted, stem_one = re.compile(pattern, re.ASCII), functools.lru_cache(1 << 17)(stem)

        def of(t: str) -> str:
            return sep.join(map(stem_one, deleted.sub("", t).lower().split()))

        phrase = functools.lru_cache(1 << 16)(of)
        for batch in batches:
            texts = batch.dictionary_encode()
            made = [phrase(t) if len(t) <= _PHRASE else of(t) for t in texts.dictionary.to_pylist()]
            yield pa.array(made, pa.string()).take(texts.indices)

    return F.arrow_udf(stems, StringType())(text)


def stem_text_constant(text: str) -> list[str]:
    return [porter2.stem(w) for w in text.lower().split()]


class Stems(NamedTuple):
    """A table of exceptions (_tok, _stem), and whether it is marked for broadcast."""

    table: DataFrame
    small: bool


def exceptions(stems: DataFrame) -> DataFrame:
    """The words of a (_tok, _stem) table whose stem is another string."""
    return stems.where(F.col(TOK) != F.col(STEM))


def stem_table(*token_frames: DataFrame, token_col: str = TOK) -> DataFrame:
    """Distinct vocabulary of ``token_col`` over all frames with the stem of each word: (_tok, _stem)."""
    toks = [f.select(F.col(token_col).alias(TOK)) for f in token_frames]
    vocab = reduce(DataFrame.union, toks).where(F.col(TOK).isNotNull()).distinct()
    return vocab.select(TOK, stem_udf(F.col(TOK)).alias(STEM))


def _read_dictionary(spark, path: str) -> DataFrame | None:
    try:
        table = spark.read.parquet(path).select(TOK, STEM)
    except AnalysisException:  # no dictionary written yet
        return None
    # Concurrent jobs may add the same word; its stem is the same, so keep one row per word.
    return table.dropDuplicates([TOK])


def dictionary_stems(*token_frames: DataFrame, dictionary: str) -> DataFrame:
    """Stem table of the frames' tokens backed by a persistent (word, stem) dictionary.

    Only words missing from the dictionary go through Python; they are added to it as a new batch
    folder, so repeated jobs over a large, slowly changing vocabulary stem each word once and
    concurrent jobs never write into the same folder. Returns the dictionary rows for this
    vocabulary.
    """
    spark = token_frames[0].sparkSession
    vocab = reduce(DataFrame.union, [f.select(F.col(TOK)) for f in token_frames]) \
        .where(F.col(TOK).isNotNull()).distinct()
    vocab = materialize(vocab)
    known = _read_dictionary(spark, dictionary)
    missing = vocab if known is None else vocab.join(known.select(TOK), TOK, "left_anti")
    # Each job writes its new words to its own batch folder, so concurrent jobs never share a
    # commit; readers see the union of all batches.
    batch = f"{dictionary.rstrip('/')}/batch={uuid.uuid4().hex}"
    missing.select(TOK, stem_udf(F.col(TOK)).alias(STEM)).write.parquet(batch)
    return _read_dictionary(spark, dictionary).join(vocab, TOK, "left_semi")


def prepared_stems(*token_frames: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES,
                   dictionary: str | None = None) -> Stems:
    """The exceptions among the frames' tokens, materialised and broadcast-marked when small.

    With ``dictionary`` (a folder in shared storage) the stems come from a persistent dictionary
    that grows with every job instead of being recomputed.
    """
    if dictionary is not None:
        table = materialize(exceptions(dictionary_stems(*token_frames, dictionary=dictionary)))
    else:
        table = materialize(exceptions(stem_table(*token_frames)))
    side = broadcast_if_small(table, TOK, STEM, limit_bytes=limit_bytes)
    return Stems(side, side is not table)


def ordered_stems(pos: str | Column, stem: str | Column) -> Column:
    """Aggregate: the stems of a group in position order (rows with NULL position are skipped)."""
    p = F.col(pos) if isinstance(pos, str) else pos
    s = F.col(stem) if isinstance(stem, str) else stem
    ordered = F.array_sort(F.collect_list(F.when(p.isNotNull(), F.struct(p.alias("p"), s.alias("s")))))
    return F.transform(ordered, lambda x: x["s"])


def explode_words(df: DataFrame, keys: list[str], text: str | Column) -> DataFrame:
    """(keys, _pos, _tok) for the words of ``text``; a row without words keeps one NULL token."""
    t = F.col(text) if isinstance(text, str) else text
    return df.select(*keys, F.posexplode_outer(words(t)).alias(POS, TOK))


def regrouped(df: DataFrame, keys: list[str], text: str, stems: Stems, out: str) -> DataFrame:
    """(keys, ``out``): the stems of ``words(text)`` in order; ``keys`` identify one text.

    ``stems`` are exceptions (``prepared_stems``). Marked for broadcast, they meet the token rows in
    place: the texts are partitioned by their key before they are exploded, since the raw text is a
    smaller shuffle than token rows, and nothing else is shuffled. Otherwise the distinct words of a text
    go to the exceptions with their positions and back.
    """
    tokens = explode_words(df.select(*keys, text).repartition(*keys[:1]), keys, text)
    if not stems.small:
        words_at = tokens.groupBy(*keys, TOK).agg(F.collect_list(POS).alias("_at"))
        met = words_at.join(stems.table, TOK, "left").select(*keys, F.coalesce(STEM, TOK).alias(STEM), "_at")
        tokens = met.select(*keys, STEM, F.explode_outer("_at").alias(POS))
        return tokens.groupBy(*keys).agg(ordered_stems(POS, STEM).alias(out))
    return tokens.join(stems.table, TOK, "left").groupBy(*keys).agg(ordered_stems(POS, F.coalesce(STEM, TOK)).alias(out))


def stemmed_words_by_key(df: DataFrame, key: str | list[str], text: str | Column, out: str,
                         glue: bool = False, stems: Stems | None = None) -> DataFrame:
    """Per key row: the stems of ``words(text)`` in order (or glued with no separator).

    Rows with NULL text are dropped (callers left-join and apply their default); a text with no
    words gives [] (or ''). The key must identify one text.
    """
    keys = [key] if isinstance(key, str) else list(key)
    t = F.col(text) if isinstance(text, str) else text
    texts = df.where(t.isNotNull()).select(*keys, t.alias("_text"))
    stems = stems if stems is not None else prepared_stems(explode_words(texts, keys, "_text"))
    found = regrouped(texts, keys, "_text", stems, out)
    return found.withColumn(out, F.array_join(out, "")) if glue else found
