"""Words of a text as numpy arrays: no Python object per word."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Odd multiplier of the polynomial hashes (modulo 2**64), and its inverse.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the longest request up to 4 M."""
    key = int(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, dtype=np.uint64)
        have[0] = 1
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        if size <= 1 << 22:
            _powers[key] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes, so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values(seed: int) -> np.ndarray:
    """A pseudo-random odd 64-bit value for every byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed)) | np.uint64(1)


class Spans:
    """64-bit hashes of any [start, end) spans of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers(len(values)), out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        shift = powers(len(self.total), _INVERSE)[starts]
        return mix((self.total[ends] - self.total[starts]) * shift + (ends - starts).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of every span of that length."""
        count = len(self.total) - length
        return mix((self.total[length:] - self.total[:count]) * powers(count, _INVERSE) + np.uint64(length))


def byte_spans(data: np.ndarray, seed: int) -> Spans:
    return Spans(byte_values(seed)[data])


def split_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without 0x20 and 0x09 to 0x0D."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = ~SPACE[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def normal_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one 0x20 after each word and none before, with word starts and ends.

    Words are the runs without 0x20 and 0x09 to 0x0D.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return raw, np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = SPACE[raw]
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first space after a word stays
    kept = np.where(space, np.uint8(0x20), raw)[keep]
    if not space[-1]:
        kept = np.append(kept, np.uint8(0x20))
    ends = np.flatnonzero(kept == 0x20)
    starts = np.empty_like(ends)
    if len(ends):
        starts[0] = 0
        starts[1:] = ends[:-1] + 1
    if len(ends) and ends[0] == 0:  # the text began with a space
        starts, ends = starts[1:], ends[1:]
    return kept, starts, ends


# What forgets the things that operators keep in a worker from task to task.
HELD: list[Callable[[], None]] = []


def start_afresh() -> None:
    """Forget what other operators have left in this worker, and return its memory."""
    for forget in HELD:
        forget()
    gc.collect()
    give_back()


def give_back() -> None:
    """Let a Python worker, which outlives its tasks, return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
