"""Words of many texts at once as numpy arrays: places and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# bytes that separate words: blank and tab to carriage return
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
# a fixed random value for each byte
_VALUE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK_BYTES = 1 << 20

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if n <= 16 * CHUNK_BYTES:
            _powers[base] = held
    return held[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values; different salts give independent hashes."""
    x = np.asarray(x, dtype=np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def range_hasher(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of starts and ends: the hash of ``values[start:end]`` for each range, the same wherever the range lies."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), dtype=np.uint64, out=total[1:])
    back = _power(_INVERSE, len(values) + 1)
    return lambda starts, ends: mix((total[ends] - total[starts]) * back[starts])


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hasher(values)(starts, ends)


class Texts(NamedTuple):
    """Some texts as one run of bytes; text i has the bytes offsets[i] to offsets[i + 1]."""

    first: int  # number of the first text in its column
    data: np.ndarray
    offsets: np.ndarray

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the runs of bytes that are ``inside``, never across texts; runs before each text."""
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        edges = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        begins[edges] = inside[edges]
        last = self.offsets[1:][self.offsets[1:] > 0] - 1
        finishes[last] = inside[last]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """A string column without nulls in pieces of whole texts, of about ``limit`` bytes."""
    if not len(column):
        return
    kind = "<i8" if pa.types.is_large_string(column.type) else "<i4"
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        until = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield Texts(at, data[offsets[at] : offsets[until]], offsets[at : until + 1] - offsets[at])
        at = until


def word_hashes(texts: Texts, starts: np.ndarray, ends: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
    return range_hashes(_VALUE[texts.data if data is None else data], starts, ends)
