"""Vectorised work on the UTF-8 bytes of whole Arrow string columns.

Words are runs of bytes outside space and 0x09-0x0D. A word's hash is a polynomial over its bytes modulo 2**64, taken
for every word of a batch at once from one cumulative sum, then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows handled at once, so that a row's number fits in ROW_BITS.
ROW_BITS = 13
#: Bytes of text handled at once; bounds the scratch memory of a Python worker (about 60 bytes for each byte of text).
SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}
_model: dict[tuple[str, str], Any] = {}

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def model(make: Callable[[str], Any], path: str) -> Any:
    """make(path), kept by the worker with its cache until it needs another one."""
    key = (make.__qualname__, path)
    if key not in _model:
        _model.clear()
        _model[key] = make(path)
    return _model[key]


def forget() -> None:
    """Drops the model that the worker keeps."""
    _model.clear()


def release() -> None:
    """Gives the memory that Arrow and the C library hold free back to the system; a few milliseconds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in glibc
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], models: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, with its free memory given back between batches and at its end. Spark keeps idle workers, and what
    they hold counts while later stages run in the JVM of the same executor. Unless it uses models, an earlier one is dropped."""

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not models:
            forget()
        yield from run(between(batches))
        release()

    return outer


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about SLICE_BYTES of text and 2**ROW_BITS rows at most; a longer row stands alone."""
    ends = offsets(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, start + 1), start + (1 << ROW_BITS), len(column))
        yield start, stop
        start = stop


def offsets(column: pa.Array) -> np.ndarray:
    """The n + 1 byte offsets of a string column, absolute in its data buffer."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def as_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one string array with nulls made empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.string()), "")


class Words:
    """The words of some rows: start, end (byte positions in `data`), row (which text), hash, and the rows' byte bounds."""

    def __init__(self, column: pa.Array, start: int, stop: int, lower: bool = False):
        at = offsets(column)[start : stop + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
        self.bounds = at - at[0]
        self.rows = stop - start
        self.data = _LOWER[raw] if lower else raw
        n = len(raw)
        solid = np.zeros(n + 2, dtype=np.int8)
        solid[1:-1] = ~_SPACE[raw]
        change = np.diff(solid)
        # A text's end also ends its last word: split runs that go over a border between rows.
        first = change == 1
        last = change == -1
        inner = self.bounds[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        joined = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)] if len(inner) else inner
        first[joined] = True
        last[joined] = True
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last)
        self.row = np.searchsorted(self.bounds, self.start, side="right") - 1

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words and their rows; a row of fewer words (but one at least) gives its whole sequence."""
    h = words.hashes()
    count = words.counts()
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(h)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    # Positions at which a run of `size` words stays inside its row.
    left = first[words.row] + count[words.row] - np.arange(n)
    full = np.flatnonzero(left >= size)
    run = np.zeros(len(full), dtype=np.uint64)
    for k in range(size):
        run = mix(run * np.uint64(0x100000001B3) + h[full + k] + np.uint64(k + 1))
    rows = words.row[full]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        tail = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            step = mix(tail * np.uint64(0x100000001B3) + h[np.minimum(first[short] + k, n - 1)] + np.uint64(k + 1))
            tail = np.where(has, step, tail)
        run = np.concatenate([run, mix(tail ^ count[short].astype(np.uint64))])
        rows = np.concatenate([rows, short])
    return run, rows
