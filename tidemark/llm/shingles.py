"""Hashes of words and of word shingles, array by array.

A word is a run of bytes other than white space with A-Z lower-cased. Its hash is a polynomial
of its bytes, taken for all words of a text at once from running sums: the sum over a word's
bytes times the inverse power of its first place does not depend on where the word stands.
Hashes are 64 bits wide and mixed; two texts are compared by hashes of their shingles only.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finaliser of a well-known generator)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hasher:
    def __init__(self, words: int = 5):
        self.width = words
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        values = mixed(np.arange(1, 257, dtype="u8") * _U(_BASE))
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
        self.values = values
        self.powers = self.inverses = np.ones(0, "u8")
        self.factors = mixed(np.arange(1000, 1000 + words, dtype="u8")) | _U(1)

    def _reach(self, n: int) -> None:
        if n > len(self.powers):
            size = max(1 << 16, 2 * n)
            ones = np.ones(size, "u8")
            ones[1:] = _U(_BASE)
            self.powers = np.multiply.accumulate(ones)
            ones[1:] = _U(_INVERSE)
            self.inverses = np.multiply.accumulate(ones)

    def words(self, text: str) -> np.ndarray:
        """The hashes of a text's words, in order."""
        raw = np.frombuffer(text.encode(), "u1")
        n = len(raw)
        self._reach(n + 1)
        inside = np.zeros(n + 2, "i1")
        inside[1:-1] = ~self.space[raw]
        turns = np.diff(inside)
        starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        sums = np.zeros(n + 1, "u8")
        np.cumsum(self.values[raw] * self.powers[:n], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def sequence(self, words: np.ndarray) -> int:
        """One hash of a whole word sequence, as a signed number."""
        places = mixed(np.arange(1, len(words) + 1, dtype="u8"))
        total = mixed(words ^ places).sum(dtype="u8") + _U(len(words))
        return int(mixed(np.array([total], "u8")).view("i8")[0])

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """The distinct shingle hashes, sorted, as signed numbers. Fewer words than a shingle
        has make one shingle; no words make none."""
        n = len(words)
        if not n:
            return np.zeros(0, "i8")
        span = min(n, self.width)
        total = np.full(n - span + 1, span, "u8")
        for k in range(span):
            total += words[k : n - span + 1 + k] * self.factors[k]
        return np.unique(mixed(total).view("i8"))
