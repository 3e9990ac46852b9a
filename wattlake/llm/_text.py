"""Arrow and numpy helpers inside tasks: words of whole texts and their 64-bit hashes.

Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased. All steps work on the
bytes of many texts at once; null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WINDOW = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each, at least one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, n = 0, batch.num_rows
    while at < n:
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows."""
    a = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    if not len(a) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(a) + 1, np.int64)
    return np.frombuffer(a.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, WINDOW + 4096)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (np.uint64(_BASE), np.uint64(_INVERSE))]
    return _powers[0], _powers[1]


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes; words end where their text ends."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word
    last[:-1] &= ~word[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(column, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a string column, and the n + 1 offsets of its rows in them; `space` marks the
    bytes that are in no word."""
    data, offsets = utf8(column)
    starts, ends = word_spans(data, offsets, space)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + WINDOW, "right")))
        hi = ends[to - 1]
        up, down = powers(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((LOWER[data[lo:hi]].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(out), np.searchsorted(starts, offsets, "left")
