"""A broadcast filter of fixed size that thins documents before their texts are shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 1 MB is collected and broadcast, whatever the number of ids.
FILTER_BITS = 23


def thinned(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text of the rows of docs whose doc_id may be among ids (all that are, some others)."""
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << FILTER_BITS))
    bits = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("v")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[bits["w"].to_numpy(np.int64)] = bits["v"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def keep(batches):
        for batch in batches:
            s = batch.column("slot").to_numpy()
            yield batch.filter(pa.array(((shared.value[s >> 6] >> (s & 63)) & 1).astype(bool))).select(["doc_id", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", slot.alias("slot")).where("doc_id is not null")
    return rows.mapInArrow(keep, "doc_id long, text string")
