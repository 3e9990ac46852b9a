"""Runs of equal keys in sorted Arrow batches, and what tasks leave behind in their workers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """task for mapInArrow, whose worker, which later tasks use too, gives its freed memory back to the system in the end."""

    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
        if trim:
            trim(0)

    return run


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of equal `key` (a long without nulls) as one table, across batches."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        keys = t.column(key).to_numpy()
        if not len(keys):
            continue
        cut = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        for lo, hi in zip(cut[:-1], cut[1:]):
            yield t.slice(lo, hi - lo)
        rest = t.slice(cut[-1])
    if rest is not None and rest.num_rows:
        yield rest
