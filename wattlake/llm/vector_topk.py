"""Exact top-k inner products over integer vectors by MaxScore.

Method. Components x become floor(1024 * x). A term is a dimension with a sign; its postings are the
vectors of a shard with that sign there, and its score bound for a query is the query's component times
the largest posting. A query's terms are those that can add to its score, in the order of falling
bounds. Postings of terms are traversed while a vector in none of them could still be among the best:
these are the essential ones. For the others, vectors are probed while their partial score plus the
bounds left is competitive with the k-th best score so far; negative parts enter in a last exact score.
Ties stay in. Shards have at most SHARD_ROWS vectors and meet blocks of at most QUERY_ROWS queries, so
each task holds a bounded cell whatever the table; per-shard winners are merged by rank.

Vectors that are null or hold null or non-finite components take no part. Empty vectors score 0 with
all; of vectors of unequal length the shorter counts as ending in zeros. Other rows with a query's own
vec_id are its own too. Scores that need more than 53 bits are summed in Python integers; beyond 63
bits the query fails with an overflow.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import read, written

K = 10
QUERY_EVERY = 100
SCALE = 1024
SHARD_ROWS = 1 << 16
QUERY_ROWS = 1 << 13


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, v: the integer vectors of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))


def matrix(column, width: int) -> np.ndarray:
    if all(len(x) == width for x in column):
        return np.stack(column.to_list()).astype(np.int64) if len(column) else np.zeros((0, width), np.int64)
    out = np.zeros((len(column), width), np.int64)
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def best_of_shard(q: np.ndarray, own: int, ids: np.ndarray, x: np.ndarray, postings, k: int):
    """The k best (score, id) of a shard for one query."""
    terms = [(int(c) * postings[d, c > 0][1], d) for d, c in enumerate(q) if c and postings[d, c > 0][1]]
    terms.sort(reverse=True)
    left = sum(b for b, _ in terms)
    part = np.zeros(len(ids), np.int64)
    seen = np.zeros(len(ids), bool)
    floor_ = None
    at = 0
    while at < len(terms):
        if floor_ is not None and left < floor_:
            break  # what is in no list yet can't compete: the rest is non-essential
        bound, d = terms[at]
        rows, _ = postings[d, q[d] > 0]
        part[rows] += q[d] * x[rows, d]
        seen[rows] = True
        left -= bound
        at += 1
        if at in (1, 2, 4, 8, 16, 32) or at == len(terms):
            some = np.flatnonzero(seen)
            if len(some) > 4 * k:
                some = some[np.argpartition(-part[some], 4 * k)[: 4 * k]]
            some = some[ids[some] != own]
            exact = np.sort(x[some] @ q)
            if len(exact) >= k and (floor_ is None or exact[-k] > floor_):
                floor_ = int(exact[-k])
    live = np.arange(len(ids)) if floor_ is None else np.flatnonzero(part + left >= floor_)
    for bound, d in terms[at:]:
        part[live] += np.maximum(q[d] * x[live, d], 0)
        left -= bound
        live = live[part[live] + left >= floor_]
    live = live[ids[live] != own]
    score = x[live] @ q
    order = np.lexsort((ids[live], -score))[:k]
    return score[order], ids[live][order]


def search_cell(k: int):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            width = max(left["v"].map(len).max(), right["v"].map(len).max())
            ids, x, qs = left["vec_id"].to_numpy(), matrix(left["v"], width), matrix(right["v"], width)
            if float(np.abs(x).max(initial=0)) * float(np.abs(qs).max(initial=0)) * max(width, 1) >= 2.0**62:
                x, qs = x.astype(object), qs.astype(object)
            postings = {}
            for d in range(width):
                for up in (True, False):
                    rows = np.flatnonzero(x[:, d] > 0 if up else x[:, d] < 0)
                    postings[d, up] = rows, int(x[rows, d].max() if up else x[rows, d].min()) if len(rows) else 0
            for own, q in zip(right["vec_id"], qs):
                score, found = best_of_shard(q, own, ids, x, postings, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": score.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score; vectors and queries: vec_id, v (arrays of long)."""
    spark = vectors.sparkSession
    vectors, queries = written(vectors), written(queries.dropDuplicates(["vec_id", "v"]))
    shards = max(-(-vectors.count() // SHARD_ROWS), 4 * spark.sparkContext.defaultParallelism)
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = vectors.select("vec_id", "v", place(shards).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = queries.select("vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), place(blocks).alias("block"))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search_cell(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


QUERIES = {"op3_maxscore_topk": op3_maxscore_topk}

SQL = {
    "op3_maxscore_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
""",
}
