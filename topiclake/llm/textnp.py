"""Words of many texts at once with numpy: a 64-bit hash per word, no Python string per word.

A word is a run of ASCII digits, ASCII letters (lower-cased) and any character
beyond ASCII: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM = 0xD6E8FEB86659FD93


def word_bytes() -> np.ndarray:
    """Per byte: 0 outside words, else the lower-cased byte."""
    lut = np.zeros(256, np.uint64)
    lut[0x30:0x3A] = np.arange(0x30, 0x3A)
    lut[0x61:0x7B] = lut[0x41:0x5B] = np.arange(0x61, 0x7B)
    lut[0x80:] = np.arange(0x80, 0x100)
    return lut


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Splits batches of UTF-8 texts; holds the power tables between batches."""

    def __init__(self) -> None:
        self.lut = word_bytes()
        self.inword = self.lut != 0
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def split(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end byte of every word, and the n + 1 word offsets of the texts."""
        n = len(raw)
        if n == 0:
            z = np.zeros(0, np.int64)
            return z.astype(np.uint64), z, z, np.zeros(len(at), np.int64)
        self._powers(n + 1)
        inside = self.inword[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edge = at[(at > 0) & (at < n)]  # words end where a text ends
        first[edge] = inside[edge]
        last[edge - 1] = inside[edge - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.lut[raw] * self.up[:n], out=total[1:])
        h = mixed((total[e] - total[s]) * self.down[s])
        return h, s, e, np.searchsorted(s, at)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (text ends are not looked at)."""
    n = max(0, len(h) - k + 1)
    g = np.zeros(n, np.uint64)
    q = 1
    for j in range(k):
        g += h[j : j + n] * np.uint64(q)
        q = q * _GRAM % (1 << 64)
    return mixed(g)


def sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over each window of ``w`` values."""
    done = 1
    while done < w:
        step = min(done, w - done)
        x = op(x[:-step], x[step:])
        done += step
    return x
