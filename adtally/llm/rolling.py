"""Hashes of any stretch of a batch of texts, by prefix sums of a polynomial over 64-bit numbers."""

from __future__ import annotations

import functools

import numpy as np

from adtally.llm.common import code_points, mix64

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, _INVERSE):
        powers = np.full(size, base, dtype=np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


@functools.lru_cache(maxsize=1)
def _symbol_values() -> np.ndarray:
    return mix64(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


class Rolling:
    """Polynomial hashes over an array of code points or other numbers."""

    def __init__(self, symbols: np.ndarray) -> None:
        size = 1 << max(10, int(len(symbols)).bit_length())
        self.powers, self.inverses = _powers(size)
        small = len(symbols) and int(symbols.max()) < 1 << 16
        values = _symbol_values()[symbols] if small else mix64(symbols.astype(np.uint64) + np.uint64(1))
        self.sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[: len(symbols)], out=self.sums[1:])

    def stretches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash per stretch; equal stretches have equal hashes wherever they stand."""
        return (self.sums[ends] - self.sums[starts]) * self.inverses[starts]

    def windows(self, size: int) -> np.ndarray:
        """A hash per window of `size` symbols, by start."""
        if len(self.sums) <= size:
            return np.zeros(0, dtype=np.uint64)
        return (self.sums[size:] - self.sums[:-size]) * self.inverses[: len(self.sums) - size]


class Words:
    """The words of a batch of texts: runs without white space (code points 9 to 13 and 32).

    `padded` puts a line break before and after every text, so that stretches may include word borders.
    """

    def __init__(self, texts: list[str], *, lower_ascii: bool = False) -> None:
        points, offsets = code_points([f"\n{t}\n" for t in texts])
        if lower_ascii:
            points = points + np.where((points >= 65) & (points <= 90), np.uint32(32), np.uint32(0))
        self.points, self.offsets = points, offsets
        self.blank = (points == 32) | ((points >= 9) & (points <= 13))
        self.rolling = Rolling(points)
        edges = np.flatnonzero(self.blank[1:] != self.blank[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.hashes = mix64(self.rolling.stretches(self.starts, self.ends))
        # Words of text d are numbers first[d] to first[d + 1].
        self.first = np.searchsorted(self.starts, offsets)
