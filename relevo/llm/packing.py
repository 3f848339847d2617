"""Best-fit packing of token pieces into sequences under several capacities.

A document becomes its token ids (pre-tokens looked up in a table that the ``tokenizers`` library's
model fills) and an end id; one longer than a sequence is cut into full
sequences, its first piece being the shorter rest. A sequence has a capacity *vector*: tokens,
documents, and attention cost (the sum of squared piece lengths). Pieces are placed in
descending order of weighted demand. Among the open sequences that can take a piece in every
dimension the one chosen has the smallest weighted residual norm after it is placed (``norm``) or
the largest weighted dot product of demand and residual (``dot``).

Only (id, piece, length) rows are shuffled, never ids. Pieces are dealt at random into shards of
about ``shard_pieces``, or of more short ones, so that a shard fills ``SHARD_SEQUENCES`` at least; each is
packed by one task. A shard leaves at most a few sequences open, so its loss is a fixed number per
thousand sequences at every size.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.bpe import Memo, arrow_type, library, vocabulary
from relevo.llm.frames import map_texts, use_caches, written

#: Pre-tokens whose ids a worker remembers.
IDS = 400_000
#: Pieces of a shard: enough that nearly every gap finds a fitting piece.
SHARD_PIECES = 2048
#: Sequences that a shard fills at least, where there are as many.
SHARD_SEQUENCES = 256


@functools.lru_cache(2)
def encoder(path: str) -> Memo:
    """The packed ids of pre-tokens, by the library's own model."""
    symbols, tokenize = vocabulary(path).symbols, library(path).model.tokenize
    return Memo(lambda piece: array("i", [t.id for t in tokenize(symbols(piece))]).tobytes(), IDS)


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, the first taking the rest."""
    first = n % most or min(n, most)
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 0, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document; a null text is empty.

    An empty text is the end id alone. Null ids and repeated rows are kept as rows of their own.
    """

    def rows(keys: list, texts: list) -> pa.RecordBatch:
        use_caches("packing", encoder.cache_clear)
        bpe, ids_of, end = vocabulary(tokenizer), encoder(tokenizer), np.int32(end_id).tobytes()
        out: list[tuple] = []
        ids = []
        for key, text in zip(keys, texts, strict=True):
            whole = np.frombuffer(bpe.packed(text, ids_of) + end, np.int32)
            for i, (start, length) in enumerate(cut(len(whole), max_tokens)):
                part = whole[start : start + length]
                out.append((key, i, start, length, zlib.crc32(part.astype("<u4").tobytes())))
                if with_ids:
                    ids.append(part)
        cols = list(zip(*out, strict=True))
        kinds = (key_type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names)

    key_type, kind = arrow_type(docs, id_col), docs.schema[id_col].dataType.simpleString()
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return map_texts(docs, id_col, text_col, rows,
                     f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def best_fit(lengths: np.ndarray, capacity: Sequence[float], weights: Sequence[float], rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Place pieces: (sequence, offset in it) of each, by vector best fit in descending order.

    Demand of a piece of n tokens: (n, 1 document, n * n attention cost). Every demand must fit an
    empty sequence.
    """
    cap = np.asarray(capacity, float)
    n = len(lengths)
    demand = np.stack([lengths, np.ones(n), lengths.astype(float) ** 2], 1) / cap
    if n and demand.max() > 1:
        raise ValueError("a piece exceeds the capacity of an empty sequence")
    w = np.asarray(weights, float)
    order = np.argsort(-(demand * w).sum(1), kind="stable")
    least = demand.min(0) if n else np.zeros(3)
    residual, ident = np.empty((n + 1, 3)), np.empty(n + 1, np.int64)
    filled = np.zeros(n, np.int64)
    bin_of, offset, open_n, made = np.empty(n, np.int64), np.empty(n, np.int64), 0, 0
    for i in order:
        d, at = demand[i], -1
        if open_n:
            left = residual[:open_n] - d
            fits = (left >= -1e-12).all(1)
            if fits.any():
                score = ((left * left) @ w) if rule == "norm" else -(residual[:open_n] @ (w * d))
                at = int(np.where(fits, score, np.inf).argmin())
        if at < 0:
            at, ident[open_n], residual[open_n] = open_n, made, 1.0
            open_n, made = open_n + 1, made + 1
        b = ident[at]
        bin_of[i], offset[i] = b, filled[b]
        filled[b] += lengths[i]
        residual[at] -= d
        if (residual[at] < least - 1e-12).any():  # not even the smallest piece fits: close it
            open_n -= 1
            residual[at], ident[at] = residual[open_n], ident[open_n]
    return bin_of, offset


def pack(piece_rows: DataFrame, max_tokens: int = 2048, max_docs: int = 2048, max_cost: float | None = None,
         weights: Sequence[float] | None = None, rule: str = "norm", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to piece rows (any columns, with ``length``).

    Pieces of one sequence lie side by side from offset 0. ``weights`` of tokens, documents and attention
    cost default to 1 each: all three residuals choose the sequence. An empty table gives an
    empty table; equal pieces are placed one by one.
    """
    capacity = (max_tokens, max_docs, float(max_cost or max_tokens**2))
    w = weights or (1.0, 1.0, 1.0)
    rows = written(piece_rows, "pieces")
    n, total = rows.agg(F.count("*"), F.sum("length")).first()
    shards = max(1, min(round(n / shard_pieces), (total or 0) // (max_tokens * SHARD_SEQUENCES)))
    # dealt by row, not by any key of the data: no key can make a shard hot
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = rows.schema.add("sequence_id", "long").add("offset", "long")

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        seq, offset = best_fit(pdf["length"].to_numpy(), capacity, w, rule)
        return pdf.assign(sequence_id=(int(pdf["_shard"].iloc[0]) << 32) + seq, offset=offset).drop(columns="_shard")

    return dealt.groupBy("_shard").applyInPandas(place, schema)
