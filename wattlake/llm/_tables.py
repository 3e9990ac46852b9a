"""Tables of counters of a fixed size, filled inside tasks and summed by Spark."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ._runs import lean

BLOCKS = 64


def packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, size: int, dtype) -> np.ndarray:
    return np.frombuffer(pa.decompress(bytes(raw), size * np.dtype(dtype).itemsize, codec="zstd"), dtype)


def summed_table(df: DataFrame, size: int, update: Callable[[np.ndarray, pa.RecordBatch], None], dtype=np.int64) -> np.ndarray:
    """The sum over all rows of what update(total, batch) adds to a table of `size` counters (a
    multiple of 64). Each task sends its table once, in blocks that meet by key; the driver gets
    them as dtype, whatever the number of rows; beyond its range counters saturate."""

    def count(batches):
        total = np.zeros(size, dtype)
        for batch in batches:
            update(total, batch)
        parts = [packed(x) for x in np.split(total, BLOCKS)]
        yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "counts": pa.array(parts, pa.binary())})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size // BLOCKS, np.int64)
        for raw in frame["counts"]:
            total += unpacked(raw, size // BLOCKS, dtype)
        return pd.DataFrame({"block": frame["block"].iloc[:1], "counts": [packed(total)]})

    # as many tasks as keep all cores busy: each sends a table of its own
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    blocks = df.coalesce(tasks).mapInArrow(lean(count), "block int, counts binary")
    out = np.zeros((BLOCKS, size // BLOCKS), dtype)
    for r in blocks.groupBy("block").applyInPandas(add, "block int, counts binary").collect():
        out[r.block] = np.minimum(unpacked(r.counts, size // BLOCKS, np.int64), np.iinfo(dtype).max)
    return out.reshape(-1)
