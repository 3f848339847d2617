"""Words of many texts at once: their byte ranges and 64-bit hashes as arrays."""

from __future__ import annotations

import numpy as np

from relevo.llm.fingerprints import mix

_RANDOM = np.random.default_rng(20240301)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def power(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def words_of(raw: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end, hash) of the words ``[^\\x20\\x09-\\x0D]+`` of each UTF-8 text.

    ``start`` and ``end`` are byte positions in the text itself; ``lower`` folds A-Z in the hash.
    """
    a = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    first = np.cumsum(sizes) - sizes
    if not len(a):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    if lower:
        a = _LOWER[a]
    space = _IS_SPACE[a]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]  # the last byte is always a space
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    length = end - start
    letters = np.flatnonzero(~space)
    begin = np.cumsum(length) - length
    offset = np.arange(len(letters)) - np.repeat(begin, length)
    h = np.add.reduceat(_BYTE[a[letters]] * power(int(length.max()))[offset], begin)
    h = mix(h + length.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    doc = np.searchsorted(first, start, "right") - 1
    return doc, start - first[doc], end - first[doc], h
