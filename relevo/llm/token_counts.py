"""Token counts of whole texts without encoding most of them.

Which vocabulary strings encode alone as one token is proved once from the merge table
(``Bpe.whole``). A pre-token whose bytes are such a string counts as one; only the others are
merged, by applying the merges to their symbols in rank order, and only their number is kept.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.bpe import INF, WORD_END, Bpe, Memo, arrow_type, every, vocabulary
from relevo.llm.frames import map_texts

#: Counts of pre-tokens that a worker remembers.
COUNTS = 1_000_000


class Counter:
    """The number of tokens of pre-tokens: a table of whole tokens, and merges for the rest."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.whole = {t for t, i in bpe.vocab.items() if i in bpe.whole}
        self.count_of = Memo(self._count, COUNTS)

    def _count(self, piece: str) -> int:
        bpe = self.bpe
        symbols = bpe.symbols(piece)
        if bpe.words:
            symbols = symbols[:-1] + WORD_END
        return 1 if symbols in self.whole else len(self.merged(piece))

    def merged(self, piece: str) -> list[int]:
        """The tokens left when the merges of lowest rank, leftmost first, are applied."""
        bpe = self.bpe
        rank, made, vocab = bpe.pair_rank.get, bpe.merged_id, bpe.vocab
        text = bpe.symbols(piece)
        parts = [vocab[c] for c in text] if not bpe.words else [*(vocab[c] for c in text[:-2]), vocab[text[-2] + WORD_END]]
        ranks = [rank(a << 20 | b, INF) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == INF:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | parts[i], INF)
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 20 | parts[i + 1], INF)
        return parts

    def count(self, text: str) -> int:
        n = 0
        for part in self.bpe.segments(text):
            n += 1 if isinstance(part, int) else sum(every(self.count_of, self.bpe.pieces(part)))
        return n


@functools.lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count the tokens of every whole text: (id, n_bytes, n_tokens), one row per input row.

    A null or empty text has 0 bytes and 0 tokens. A special string inside a text counts as its
    one token, as the ``tokenizers`` library does by default. Null ids stay null, repeated rows
    give repeated rows, an empty table gives an empty table. It is a map without a shuffle.
    """

    def rows(keys: list, texts: list) -> pa.RecordBatch:
        c = counter(tokenizer)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, key_type), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
             pa.array([c.count(t) for t in texts], pa.int64())], names)

    key_type, kind, names = arrow_type(docs, id_col), docs.schema[id_col].dataType.simpleString(), [id_col, "n_bytes", "n_tokens"]
    return map_texts(docs, id_col, text_col, rows, f"`{id_col}` {kind}, n_bytes long, n_tokens long")


def with_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
