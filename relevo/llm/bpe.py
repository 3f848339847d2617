"""Byte-pair encoding and decoding with the vocabulary of a public ``tokenizers`` file.

Encoding is dynamic programming over the prefixes of a pre-token. Every prefix of a text has one
encoding, so one *last token*: the token that ends there and whose predecessor (the last token of
the shorter prefix) it may stand next to. For each prefix the vocabulary tokens that are suffixes
of it come from an automaton over the vocabulary (its suffix links list them longest first), and
a pair test accepts the one that fits. Following the stored tokens backwards gives the ids. No
merge queue runs, and the cost per symbol is the few tokens that end there.

*Pair test.* While pairs merge in rank order, tokens ``l`` and ``r`` built side by side keep their
border unless some merge joins a part on the right edge of ``l`` to a part on the left edge of
``r`` while both still stand alone. A part stands alone from its own rank up to its parent's, so
the test compares the rank of each such pair with the ranks of both parents. Equal ranks merge
from the left.

Texts whose characters the running Python does not know (code points newer than its Unicode
tables), and texts with characters that lower-case by context, are normalised and split by the
``tokenizers`` library's own normaliser and splitter; the encoding of the pieces is the same.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Mapping
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.llm.frames import map_texts

INF = 1 << 60
#: Entries kept in each per-worker memo before it is emptied. It bounds memory, never results.
MEMO = 400_000
# The white space of the split patterns, and the contractions they keep together.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'(?:s|t|re|ve|m|ll|d)"
WORD_END = "</w>"
_END = "\ue000"  # stands for the word-end mark inside the automaton: no byte maps to it


def _ranges(ok: Callable[[str], bool]) -> str:
    """The code points of the basic plane that satisfy ``ok``, as the inside of a character class."""
    out, first = [], None
    for cp in range(0x10001):
        good = cp < 0x10000 and ok(chr(cp))
        if good and first is None:
            first = cp
        elif not good and first is not None:
            out.append(f"\\u{first:04x}-\\u{cp - 1:04x}")
            first = None
    return "".join(out)


@functools.lru_cache(None)
def patterns() -> dict[str, re.Pattern]:
    """The split patterns over the basic plane, from Python's own Unicode categories."""
    cat = unicodedata.category
    letter, number = _ranges(lambda c: cat(c)[0] == "L"), _ranges(lambda c: cat(c)[0] == "N")
    known = _ranges(lambda c: cat(c) not in ("Cn", "Cs") and c != "Σ")
    other = f"[^{SPACE}{letter}{number}]+"
    return {
        "byte": re.compile(f" ?[{letter}]+|{CONTRACTIONS}| ?[{number}]+| ?{other}|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"),
        "word": re.compile(f"{CONTRACTIONS}|[{letter}]+|[{number}]|{other}"),
        "unknown": re.compile(f"[^{known}]"),
    }


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte, as byte-level vocabularies write them."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in plain)}
    return [rest.get(b, chr(b)) for b in range(256)]


class Memo(dict):
    """A dict that computes missing values and is emptied when it holds too many."""

    def __init__(self, make: Callable, most: int = MEMO):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def every(table: Mapping, keys: list) -> tuple:
    """The values of all keys, in one call."""
    return itemgetter(*keys)(table) if len(keys) > 1 else tuple(table[k] for k in keys)


class Bpe:
    """A byte-level BPE vocabulary, its automaton, and the prefix encoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.vocab = path, model["vocab"]
        self.words = model.get("end_of_word_suffix") == WORD_END  # else byte-level with spaces
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.rank, self.parts, self.pair_rank, self.merged_id = {}, {}, {}, []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            l, r, t = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.rank[t], self.parts[t], self.pair_rank[l << 20 | r] = rank, (l, r), rank
            self.merged_id.append(t)
        self._right: dict[int, tuple] = {}
        self._left: dict[int, tuple] = {}
        self.whole = self._prove_whole()
        self.fits = Memo(lambda key: not self._crossed(key >> 20, key & 0xFFFFF))
        self.automaton = ahocorasick.Automaton()
        for text, i in self.vocab.items():
            if i in self.whole:
                key = text[: -len(WORD_END)] + _END if self.words and text.endswith(WORD_END) else text
                self.automaton.add_word(key, (len(key), i))
        self.automaton.make_automaton()
        alphabet = byte_alphabet()
        self._table = {b: alphabet[b] for b in range(256)}
        self._split = patterns()["word" if self.words else "byte"].findall
        self._unknown = patterns()["unknown"].search
        self.ids_of = Memo(lambda piece: np.array(self.encode_piece(piece), np.int32).tobytes())

    # --- pair test ---------------------------------------------------------------------------

    def _edge(self, t: int, side: int) -> tuple:
        """(part, rank of its parent) along the right (1) or left (0) edge of token t."""
        cache = self._right if side else self._left
        if t not in cache:
            out, limit = [], INF
            while True:
                out.append((t, limit))
                if t not in self.parts:
                    break
                limit, t = self.rank[t], self.parts[t][side]
            cache[out[0][0]] = tuple(out)
            return cache[out[0][0]]
        return cache[t]

    def _crossed(self, l: int, r: int, below: int = INF) -> bool:
        """Whether a merge of rank under ``below`` joins l and r across their border."""
        rank = self.pair_rank
        for a, a_end in self._edge(l, 1):
            for b, b_end in self._edge(r, 0):
                m = rank.get(a << 20 | b)
                if m is not None and m < below and m < a_end and m <= b_end:
                    return True
        return False

    def _prove_whole(self) -> frozenset[int]:
        """The tokens whose own string encodes as that one token.

        A base symbol does. A merged token does if both its parts do and nothing joins them
        across their border before its own merge.
        """
        whole = {i for i in self.vocab.values() if i not in self.parts}
        for t, (l, r) in sorted(self.parts.items(), key=lambda x: self.rank[x[0]]):
            if l in whole and r in whole and not self._crossed(l, r, self.rank[t]):
                whole.add(t)
        return frozenset(whole)

    # --- encoding ----------------------------------------------------------------------------

    def symbols(self, piece: str) -> str:
        """The byte stand-ins of a pre-token, with the end mark where the vocabulary has one."""
        text = piece if piece.isascii() and piece.isprintable() and " " not in piece else piece.encode("utf-8").decode("latin-1").translate(self._table)
        return text + _END if self.words else text

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """The ids of one pre-token, by the last token of every prefix."""
        text = self.symbols(piece)
        n = len(text)
        blocked = n - 1 if self.words else 0  # no border between the last symbol and its mark
        last: list[int] = [-1] * (n + 1)
        start_of = [0] * (n + 1)
        fits = self.fits
        for at, (size, t) in self.automaton.iter(text):
            end = at + 1
            if last[end] >= 0 or end == blocked:
                continue
            start = end - size
            if start == 0 or last[start] >= 0 and fits[last[start] << 20 | t]:
                last[end], start_of[end] = t, start
        out = []
        end = n
        while end:
            out.append(last[end])
            end = start_of[end]
        return tuple(out[::-1])

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if text.isascii() or not self._unknown(text):
            if self.words:
                text = unicodedata.normalize("NFC", text).lower()
                # composing or lower-casing could give a character outside the checked ones
                if not text.isascii() and self._unknown(text):
                    return self._library_pieces(text)
            return self._split(text)
        return self._library_pieces(text)

    def _library_pieces(self, text: str) -> list[str]:
        tok = library(self.path)
        if tok.normalizer is not None:
            text = tok.normalizer.normalize_str(text)
        back = {ord(c): b for b, c in self._table.items()}
        return [p.translate(back).encode("latin-1").decode("utf-8") for p, _ in tok.pre_tokenizer.pre_tokenize_str(text)]

    def segments(self, text: str) -> Iterator[str | int]:
        """The text cut at special strings: parts of text, and the ids of the special strings."""
        if self._special is None or not any(s in text for s in self.special):
            yield text
            return
        at = 0
        for m in self._special.finditer(text):
            if m.start() > at:
                yield text[at : m.start()]
            yield self.special[m.group()]
            at = m.end()
        if at < len(text):
            yield text[at:]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, special strings as their tokens."""
        return np.frombuffer(self.packed(text, self.ids_of), np.int32)

    def packed(self, text: str, ids_of: Mapping[str, bytes]) -> bytes:
        """The ids of a whole text as 32-bit numbers, from the bytes ``ids_of`` has for pre-tokens."""
        return b"".join(np.int32(x).tobytes() if isinstance(x, int) else b"".join(every(ids_of, self.pieces(x))) for x in self.segments(text))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, special tokens written out.

        A byte-level vocabulary gives its bytes back. One with word ends names no decoder; its
        tokens are joined by one space, word ends included.
        """
        if self.words:
            return " ".join(map(self.tokens.__getitem__, ids))
        out, run, back = [], [], {c: b for b, c in self._table.items()}
        for i in ids:
            if i in self.vocab_ids:
                run.append(self.tokens[i])
            else:
                out += [bytes(back[c] for c in "".join(run)).decode("utf-8", "replace"), self.tokens[i]]
                run = []
        return "".join([*out, bytes(back[c] for c in "".join(run)).decode("utf-8", "replace")])

    @functools.cached_property
    def vocab_ids(self) -> frozenset[int]:
        return frozenset(self.vocab.values())


@functools.lru_cache(4)
def vocabulary(path: str) -> Bpe:
    """One ``Bpe`` per worker process and file."""
    return Bpe(path)


@functools.lru_cache(4)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _list_array(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32)))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text: (id, ids array<int>), one row per input row.

    A null or empty text has no ids. Special strings inside a text become their tokens, as the
    ``tokenizers`` library does by default; nothing is added, truncated or padded. A null id stays
    null; repeated rows give repeated rows; an empty table gives an empty table. It is a map
    without a shuffle: a worker keeps the ids of recent pre-tokens (at most ``MEMO``).
    """

    def rows(keys: list, texts: list) -> pa.RecordBatch:
        bpe = vocabulary(tokenizer)
        return pa.RecordBatch.from_arrays([pa.array(keys, key_type), _list_array([bpe.encode(t) for t in texts])], names)

    key_type, kind, names = arrow_type(docs, id_col), docs.schema[id_col].dataType.simpleString(), [id_col, "ids"]
    return map_texts(docs, id_col, text_col, rows, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Decode id arrays: the input's id and ids with ``text``, special tokens written out.

    No ids (or a null array) give ''. An id outside the vocabulary is an error.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [bpe.decode(x.values.to_pylist() if x.is_valid else []) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names)

    kind, names = encoded.schema[id_col].dataType.simpleString(), [id_col, ids_col, "text"]
    return encoded.select(id_col, ids_col).mapInArrow(rows, f"`{id_col}` {kind}, `{ids_col}` array<int>, text string")


def arrow_type(df: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[col].dataType)


def digests(encoded_text: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of a decoded table."""
    return encoded_text.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
