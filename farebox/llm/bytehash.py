"""Hashes of byte ranges for whole batches of texts at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the word."""
    x = x ^ (x >> np.uint64(31))
    x = x * _SCRAMBLE
    return x ^ (x >> np.uint64(29))


def kept() -> dict:
    """Values that last as long as the worker process: functions travel by value, their globals with them."""
    return sys.__dict__.setdefault("_farebox_kept", {})


def _table(seed: int) -> tuple[np.ndarray, int, int]:
    if ("table", seed) not in kept():
        rng = np.random.default_rng(seed)
        values = rng.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1, 2**62)) * 8 + 5
        kept()["table", seed] = values, base, pow(base, -1, 2**64)
    return kept()["table", seed]


def _powers(seed: int, n: int, inverse: bool) -> np.ndarray:
    held = kept().get(("powers", seed, inverse))
    if held is None or len(held) < n:
        held = kept()["powers", seed, inverse] = _grown_powers(seed, n, inverse)
    return held


def _grown_powers(seed: int, n: int, inverse: bool) -> np.ndarray:
    _, base, inverted = _table(seed)
    step = inverted if inverse else base
    out = np.ones(n, np.uint64)
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(step, filled, 2**64))
        filled += more
    return out


class Ranges:
    """Hashes of any [start, end) of a byte array from one running sum."""

    def __init__(self, data: np.ndarray, seed: int):
        size = 1 << max(12, (len(data) + 1).bit_length())
        self.seed, self.inverse = seed, _powers(seed, size, True)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_table(seed)[0][data] * _powers(seed, size, False)[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        """Of every ``k`` bytes in a row."""
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and the row bounds in them."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    return held, bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: int, most_bytes: int, most_rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most so many bytes of text; a larger row stands alone."""
    _, bounds = flat(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(bounds, bounds[low] + most_bytes, "right")) - 1
        high = min(max(high, low + 1), low + most_rows, batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row bound. No word crosses rows."""
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = ~_WHITE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    opens[cut] |= inside[cut]
    closes[cut - 1] |= inside[cut - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(start, bounds)
