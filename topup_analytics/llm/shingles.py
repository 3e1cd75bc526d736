"""Hashes of words and of word shingles, computed with numpy over the bytes of a text."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Texts are hashed in pieces of about so many bytes.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS))
        _POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, dtype=np.uint64))])
    return _POWERS[:n]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in order; A to Z count as a to z.

    A word's hash is a polynomial over its bytes, so equal words have equal
    hashes wherever they stand.
    """
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= PIECE:
        return _hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def _hashes(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    codes = np.frombuffer(data, dtype=np.uint8)
    blank = _SPACE[codes]
    edges = np.diff(np.concatenate(([1], blank.view(np.int8), [1])))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = _BYTE[codes[~blank]] * _powers(int(lengths.max()))[inside]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64))


def shingle_set(text: str, width: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted.

    A text with fewer words has its whole sequence as one shingle, and a text
    without words has none.
    """
    words = word_hashes(text)
    n = len(words) - width + 1
    if n > 0:
        hashes = words[:n]
        for k in range(1, width):
            hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
        return np.unique(hashes)
    if not len(words):
        return words
    whole = np.array([len(words)], dtype=np.uint64)
    for k in range(len(words)):
        whole = mix(whole * np.uint64(0xD1342543DE82EF95) + words[k : k + 1])
    return whole
