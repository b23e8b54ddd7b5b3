"""Texts as arrays of 64-bit token values, and fingerprints of token runs, in numpy.

A run's fingerprint is a polynomial over its values, taken from prefix sums, then mixed. All
arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
# texts are worked on in pieces of about this many bytes, longer texts on their own
CHUNK_BYTES = 1 << 20

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n; kept for the next call unless very many."""
    global _powers
    if n <= len(_powers[0]):
        return _powers[0][:n], _powers[1][:n]
    made = []
    for factor in (BASE, INVERSE):
        steps = np.full(n, factor, dtype=np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    if n <= 2 * CHUNK_BYTES:
        _powers = made
    return made[0], made[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs:
    """Fingerprints of runs in one array of token values."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def fingerprints(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def every(self, length: int) -> np.ndarray:
        """Of each run of ``length`` values."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def byte_values(data: np.ndarray) -> np.ndarray:
    return data.astype(np.uint64) + np.uint64(1)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints of words, byte starts and ends within their text, offsets of each text's words).

    Words are what stands between spaces and the controls from tab to carriage return.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8) if texts else np.zeros(0, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))
    offsets = np.searchsorted(starts, begin)
    prints = Runs(byte_values(data)).fingerprints(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    shift = np.repeat(begin[:-1], np.diff(offsets))
    return prints, starts - shift, ends - shift, offsets


def lowered(text: bytes) -> bytes:
    """A-Z lower-cased; bytes.lower leaves all others as they are."""
    return text.lower()


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_BYTES`` together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
