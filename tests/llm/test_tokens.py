"""Encoding, decoding, counting and packing against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from relevo.llm import bpe, packing, token_counts

from .conftest import messy_rows

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def _odd() -> list[str]:
    rng = random.Random(2)
    pick = "aAbeé 's.\n1ñ日Ω😀 ſﬀΣς"
    wild = lambda: chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)]))
    return (["", " ", "'s don't I'LL", "ΣΑΣ İ", "x<|endoftext|>y<|startoftext|>", "a" * 300, " " * 40 + "x", "</w> w</w>"]
            + ["".join(rng.choice(pick) for _ in range(rng.randint(1, 60))) for _ in range(300)]
            + ["".join(wild() for _ in range(rng.randint(1, 30))) for _ in range(300)])


@pytest.mark.parametrize("name", FILES)
def test_ids_counts_and_text_are_the_librarys(name):
    path = public_tokenizers.path(name)
    lib, own, counter = Tokenizer.from_file(path), bpe.vocabulary(path), token_counts.counter(path)
    for text in _odd():
        ids = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert counter.count(text) == len(ids)
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_whole_tokens_are_those_that_encode_alone():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, model = bpe.vocabulary(path), Tokenizer.from_file(path).model
    sample = random.Random(1).sample(sorted(own.vocab.items()), 3000)
    assert all((i in own.whole) == ([t.id for t in model.tokenize(s)] == [i]) for s, i in sample)


def test_memo_is_bounded_and_forgets_nothing_it_returns():
    memo = bpe.Memo(lambda k: k * 2, 3)
    assert [memo[k] for k in (1, 2, 3, 4, 1)] == [2, 4, 6, 8, 2] and len(memo) <= 3


def test_encode_and_decode_messy_rows(messy, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = bpe.digests(bpe.decode(bpe.encode(messy, path), path)).collect()
    want = []
    for key, text, *_ in messy_rows():
        ids = lib.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((key, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(none, path), path).count() == 0


def test_count_messy_rows(messy, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    got = token_counts.with_limit(token_counts.token_counts(messy, path), 1024).collect()
    n = [len(lib.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in messy_rows()]
    want = [(k, len((t or "").encode()), c, c > 1024) for (k, t, *_), c in zip(messy_rows(), n, strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(none, path).count() == 0


def test_pieces_and_sequences(messy, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rows = packing.pack(packing.pieces(messy, path, max_tokens=256), max_tokens=256).collect()
    want = []
    for key, text, *_ in messy_rows():
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(key, i, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, (s, n) in enumerate(packing.cut(len(ids), 256))]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(packing.pieces(none, path)).count() == 0


def test_cut_keeps_short_documents_whole():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)] and packing.cut(16, 8) == [(0, 8), (8, 8)]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    lengths = np.random.default_rng(0).integers(1, 101, 500)
    seq, _ = packing.best_fit(lengths, (100, 3, 6000.0 + 4000), (1.0, 0.5, 0.5), rule)
    assert np.bincount(seq, lengths).max() <= 100 and np.bincount(seq).max() <= 3
    assert np.bincount(seq, lengths.astype(float) ** 2).max() <= 10_000
    tokens, _ = packing.best_fit(lengths, (100, 100, 1e4), (1.0, 0.0, 0.0), rule)
    if rule == "norm":
        assert tokens.max() + 1 <= max(-(-lengths.sum() // 100), (lengths > 50).sum()) * 1.03
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), (100, 3, 1e6), (1.0, 0.0, 0.0))


def test_all_three_residuals_choose(spark):
    """By default the packing weighs tokens, documents and attention cost; by tokens alone it would differ."""
    lengths = np.random.default_rng(3).integers(1, 900, 400)
    capacity = (2048, 2048, 2048.0**2)
    seq, offset = packing.best_fit(lengths, capacity, (1.0, 1.0, 1.0))
    alone, _ = packing.best_fit(lengths, capacity, (1.0, 0.0, 0.0))
    assert (seq != alone).any() and seq.max() <= alone.max() + 1
    rows = packing.pack(spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "id long, length long").coalesce(1)).collect()
    assert sorted((r["id"], r["sequence_id"], r["offset"]) for r in rows) == [(i, int(s), int(o)) for i, (s, o) in enumerate(zip(seq, offset, strict=True))]
