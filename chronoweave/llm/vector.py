"""Vectorised work on many texts at once: words, their hashes, rolling hashes and sliding minima.

Words are runs of bytes other than space, tab, LF, VT, FF and CR, as in ``[^\\x20\\x09-\\x0D]+``; all six are
single bytes in UTF-8, so bytes and characters give the same words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_RNG = np.random.Generator(np.random.PCG64(20240613))
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
_UP = np.ones(1, dtype=np.uint64)
_DOWN = np.ones(1, dtype=np.uint64)


def lean() -> None:
    """Makes the C library give large blocks back as soon as they are free; a worker lives through many tasks."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-8, 2)  # M_ARENA_MAX
        libc.malloc_trim(0)
    except (OSError, AttributeError):
        pass


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    global _UP, _DOWN
    while len(_UP) < n:
        k = len(_UP)
        _UP = np.concatenate([_UP, _UP * np.uint64(pow(BASE, k, 2**64))])
        _DOWN = np.concatenate([_DOWN, _DOWN * np.uint64(pow(INVERSE, k, 2**64))])
    return _UP[:n], _DOWN[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive values; equal runs have equal hashes wherever they stand."""
    if len(values) < n:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mixed((total[n:] - total[:-n]) * down[: len(values) - n + 1])


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each n consecutive values, by doubling."""
    if len(values) < n:
        return values[:0]
    out, have = values, 1
    while have * 2 <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return out if have == n else np.minimum(out[: len(out) - (n - have)], out[n - have :])


class Words:
    """The words of some documents: byte places in ``buf``, 64-bit hashes, and each document's first word."""

    def __init__(self, docs: list[bytes], lower: bool = False):
        joined = b"\n".join(docs) + b"\n"
        self.buf = buf = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
        self.doc_start = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
        solid = ~SPACE[buf]
        edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        if len(solid) and solid[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.doc_start)
        if len(self.start):
            length = self.end - self.start
            up, _ = powers(int(length.max()) + 1)
            place = np.zeros(len(buf), dtype=np.int64)
            place[self.start] = self.start
            np.maximum.accumulate(place, out=place)
            np.subtract(np.arange(len(buf)), place, out=place)
            np.minimum(place, len(up) - 1, out=place)
            value = BYTE_CODE[buf]
            value *= up[place]
            value[~solid] = 0
            self.hash = mixed(np.add.reduceat(value, self.start) + length.astype(np.uint64))
        else:
            self.hash = np.zeros(0, dtype=np.uint64)

    def __len__(self) -> int:
        return len(self.first) - 1


def parcels(rows: Iterable, weight, most: int) -> Iterator[list]:
    """Consecutive rows in lists of about ``most`` in weight; a heavier row stands alone."""
    held, total = [], 0
    for row in rows:
        w = weight(row)
        if held and total + w > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += w
    if held:
        yield held


def table_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def runs_union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open runs, sorted, with those that overlap or touch made one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ends) - 1]])
    return starts[new], ends[last]


def run_bounds(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The half-open runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).view(np.int8)))
    return edge[0::2], edge[1::2]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A batch of plain lists or arrays under a schema."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
