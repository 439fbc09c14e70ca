"""Hashes of all words of many texts at once, and of any run of them, by polynomials modulo 2^64."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_LINE, _SPACE = 10, [9, 10, 11, 12, 13, 32]


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base % 2 ** 64, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(28))


@dataclass
class Words:
    """Words in order: hash, text and line (counted from 0 in each text); poly() hashes runs of neighbours.

    Lines and sums are made when they are first asked for.
    """
    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    stops: np.ndarray
    data: np.ndarray

    @cached_property
    def line(self) -> np.ndarray:
        feeds = np.cumsum(self.data == _LINE)
        first = np.concatenate([[0], feeds[self.stops[:-1] - 1]]) if len(self.stops) else np.zeros(0, np.int64)
        return feeds[self.start] - first[self.text]

    @cached_property
    def sums(self) -> np.ndarray:
        total = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * powers(WORD_BASE, len(self.hash))[:len(self.hash)], out=total[1:])
        return total

    @cached_property
    def inverse(self) -> np.ndarray:
        return powers(pow(WORD_BASE, -1, 2 ** 64), len(self.hash))

    def poly(self, a: np.ndarray, b: np.ndarray, shift: int = 0) -> np.ndarray:
        """Sum of hash[a + k] * WORD_BASE^(k + shift) over the words from a to before b: concatenation adds such sums."""
        return (self.sums[b] - self.sums[a]) * self.inverse[a] * np.uint64(pow(WORD_BASE, shift, 2 ** 64))


def words_of(column: pa.Array, letters_only: bool = False) -> Words:
    """Words of a text column: what white space separates, capitals A-Z as small letters; NULL is empty.

    With `letters_only` ASCII punctuation separates words as well, and all capitals are folded.
    """
    texts = [(t.lower() if letters_only else t).encode("utf-8", "surrogatepass") if t else b"" for t in column.to_pylist()]
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    byte = np.arange(256, dtype=np.uint64)
    byte[65:91] += np.uint64(32)
    code = mix((byte + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    apart = np.zeros(256, bool)
    apart[_SPACE] = True
    if letters_only:
        apart[:128] = ~np.array([chr(c).isalnum() for c in range(128)])
    gap = apart[data]
    edge = np.flatnonzero(np.diff(gap, prepend=True))  # starts and ends take turns, the last byte is a gap
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * powers(BYTE_BASE, len(data) - 1), out=sums[1:])
    back = powers(pow(BYTE_BASE, -1, 2 ** 64), len(data) - 1)
    word = mix((sums[end] - sums[start]) * back[start])
    stops = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, stops), prepend=0))
    return Words(word, text, start, stops, data)
