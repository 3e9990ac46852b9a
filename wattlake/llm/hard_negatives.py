"""Hard negatives of anchor vectors by exact inner products, pruned by length and by coordinates.

Method. Rows are cut into LENGTHS buckets of vector length, and buckets into shards of at most SHARD_ROWS rows.
A shard holds, for each coordinate, the list of its unit vectors' values in rising order. Where a score of at
least t > 0 is asked for, the angle between an anchor and a row is at most acos(t / (anchor's length * longest
of the bucket)). That bounds each coordinate of the row from both sides: for the anchor's FOCUS largest coordinates
the feasible ranges of the sorted lists are found by bisection, and only rows that are in all of them are verified
by their integer inner product. Buckets too short for t are not visited at all.

First every anchor's best rows of its own label are found; each shard's k-th best so far, from the rows at the
end of the strongest coordinate's list, is its t. Then, for each positive's score s, rows of other labels with
low * s <= 100 * score <= high * s; t is what the smallest s asks for. Where no t > 0 is known, all rows of
the shard are verified, so results are exact everywhere. Blocks of at most ANCHOR_ROWS anchors meet shards, and the
winners of shards are merged by rank: a task holds one bounded cell whatever the table. Labels play no part in how
rows are dealt, so one label may hold any share of them.

Rows with a null id or label, a null vector, or any null or non-finite component take no part. Empty vectors and
vectors of zeros score 0; of vectors of unequal length the shorter counts as ending in zeros. Equal rows are held
once with their number and come up as often as they are there. Rows with an anchor's own vec_id are never its positives;
distinct anchor rows of one id have lists of their own. Negative positive scores have no negatives (their range is
empty). Products that need more than 53 bits are summed in Python integers; beyond 63 bits the query fails.
Ties go to the smaller vec_id. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import read, written
from .vector_topk import matrix

K = 5
LOW, HIGH = 80, 100
LENGTHS = 16
SHARD_ROWS = 1 << 15
ANCHOR_ROWS = 1 << 13
FOCUS = 4
#: Room for rounding in the feasible ranges.
ROOM = 1e-9


class Lists:
    """Rows of one shard with their sorted coordinate lists."""

    def __init__(self, x: np.ndarray):
        self.x = x
        real = x.astype(np.float64)
        length = np.sqrt((real * real).sum(axis=1))
        self.longest = float(length.max(initial=0.0))
        self.unit = real / np.where(length > 0, length, 1.0)[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.sorted[f] = order, self.unit[order, f]
        return self.sorted[f]

    def feasible(self, q: np.ndarray, least: int) -> np.ndarray:
        """Rows that may score `least` or more with q: all that do, some others."""
        real = q.astype(np.float64)
        length = float(np.sqrt((real * real).sum()))
        if least <= 0 or not np.isfinite(length * self.longest):
            return np.arange(len(self.x))
        if length * self.longest * (1 + ROOM) < least:
            return np.zeros(0, np.int64)
        near = np.arccos(min(1.0, least / (length * self.longest)))
        focus = np.argsort(-np.abs(real), kind="stable")[:FOCUS]
        seen = np.zeros(len(self.x), np.uint8)
        for f in focus:
            turn = np.arccos(np.clip(real[f] / length, -1, 1))
            low, high = np.cos(min(np.pi, turn + near)) - ROOM, np.cos(max(0.0, turn - near)) + ROOM
            order, values = self.coordinate(int(f))
            seen[order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]] += 1
        return np.flatnonzero(seen == len(focus))

    def ends(self, q: np.ndarray, n: int) -> np.ndarray:
        """n rows that are likely to score high: those at the end of the list of q's largest coordinate."""
        if not len(q):
            return np.arange(len(self.x))[:n]
        f = int(np.argmax(np.abs(q)))
        order, _ = self.coordinate(f)
        return order[-n:] if q[f] > 0 else order[:n]


def scored(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (x @ q).astype(np.int64) if len(x) else np.zeros(0, np.int64)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then by smaller id."""
    if len(score) > k:
        keep = np.flatnonzero(score >= np.sort(score)[-k])
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((ids[keep], -score[keep]))][:k]


def _matrices(left: pd.DataFrame, right: pd.DataFrame):
    width = max(left["v"].map(len).max(), right["v"].map(len).max())
    x, qs = matrix(left["v"], width), matrix(right["v"], width)
    most = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(qs.astype(np.float64)).max(initial=0)) * max(width, 1)
    # doubles hold sums below 2 ** 53 exactly
    kind = np.float64 if most < 2.0**53 else object
    return x.astype(kind), qs.astype(kind)


def positives_of_cell(k: int):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, qs = _matrices(left, right)
            ids, labels, mult = (left[c].to_numpy() for c in ("vec_id", "label", "mult"))
            places = {label: np.flatnonzero(labels == label) for label in set(right["label"]) & set(labels)}
            lists = {label: Lists(x[rows]) for label, rows in places.items()}
            for key, own, label, q in zip(right["key"], right["vec_id"], right["label"], qs):
                if label not in lists:
                    continue
                rows, mine = places[label], lists[label]
                first = mine.ends(q, 8 * k)
                first = first[ids[rows[first]] != own]
                tops = np.sort(scored(mine.x[first], q))
                at = mine.feasible(q, int(tops[-k]) if len(tops) >= k else 0)
                at = at[ids[rows[at]] != own]
                score, found = scored(mine.x[at], q), rows[at]
                keep = best(score, ids[found], k)
                out.append(pd.DataFrame({"key": key, "vec_id": ids[found[keep]], "score": score[keep], "mult": mult[found[keep]]}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "vec_id": [], "score": [], "mult": []}).astype("int64")

    return search


def least_score(s: int, low: int) -> int:
    return -(-low * int(s) // 100)


def negatives_of_cell(k: int, low: int, high: int):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, qs = _matrices(left, right)
            ids, labels, mult = (left[c].to_numpy() for c in ("vec_id", "label", "mult"))
            lists = Lists(x)
            for key, label, scores, q in zip(right["key"], right["label"], right["scores"], qs):
                at = lists.feasible(q, least_score(min(scores), low))
                at = at[labels[at] != label]
                score = scored(x[at], q)
                for s in scores:
                    fit = np.flatnonzero((score >= least_score(s, low)) & (score <= high * int(s) // 100))
                    keep = fit[best(score[fit], ids[at[fit]], k)]
                    if len(keep):
                        out.append(pd.DataFrame({"key": key, "asked": int(s), "vec_id": ids[at[keep]], "score": score[keep], "mult": mult[at[keep]]}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "asked": [], "vec_id": [], "score": [], "mult": []}).astype("int64")

    return search


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best of each group over all shards, equal rows as often as they are there."""
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("mult"), F.lit(k)).cast("int")))).drop("copy", "mult")
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Shards:
    """The table dealt by length and hash, and how anchors meet it."""

    def __init__(self, vectors: DataFrame):
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        rows = written(vectors.groupBy("vec_id", "label", "v").agg(F.count("*").alias("mult")).withColumn("norm", norm))
        found = rows.agg(F.percentile_approx("norm", [i / LENGTHS for i in range(1, LENGTHS)])).first()[0] or []
        bucket = F.lit(0)
        for c in sorted(set(found)):
            bucket = bucket + (F.col("norm") > c).cast("int")
        sizes = {r.bucket: r for r in rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.max("norm").alias("longest")).collect()}
        total = sum(r.n for r in sizes.values())
        per = min(SHARD_ROWS, max(256, total // (4 * rows.sparkSession.sparkContext.defaultParallelism)))
        n = len(set(found)) + 1
        self.parts = F.element_at(F.array(*[F.lit(-(-sizes[b].n // per) if b in sizes else 0) for b in range(n)]), F.col("bucket") + 1)
        self.longest = F.element_at(F.array(*[F.lit(float(sizes[b].longest) if b in sizes else 0.0) for b in range(n)]), F.col("bucket") + 1)
        self.buckets = F.sequence(F.lit(0), F.lit(n - 1))
        self.rows = rows.withColumn("bucket", bucket).withColumn("part", F.pmod(F.xxhash64("vec_id", "label", "v"), self.parts).cast("int")).drop("norm")

    def meet(self, anchors: DataFrame, n_anchors: int, reach: Column, search, schema: str) -> DataFrame:
        """What search returns for each cell: a shard and a block of the anchors that reach its bucket."""
        blocks = max(1, -(-n_anchors // ANCHOR_ROWS))
        place = ["bucket", "part", "block"]
        right = anchors.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("bucket", F.explode(self.buckets)).withColumn("longest", self.longest)
        right = right.where(reach & (self.parts > 0)).drop("longest").withColumn("part", F.explode(F.sequence(F.lit(0), self.parts - 1)))
        left = self.rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return left.groupBy(place).cogroup(right.groupBy(place)).applyInPandas(search, schema)


def mined(vectors: DataFrame, anchors: DataFrame, k_positives: int = K, k_negatives: int = K, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors and anchors: vec_id, label, v (array of long); low and high in percent of a positive's score."""
    shards = Shards(vectors)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    asked = written(anchors.select("vec_id", "label", "v").distinct().withColumn("norm", norm).withColumn("key", F.monotonically_increasing_id()))
    n = asked.count()
    found = shards.meet(asked, n, F.lit(True), positives_of_cell(k_positives), "key long, vec_id long, score long, mult long")
    positives = written(ranked(found, ["key"], k_positives).select("key", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    scores = positives.where("positive_score >= 0").groupBy("key").agg(F.collect_set("positive_score").alias("scores"))  # at most k_positives
    seeking = asked.join(scores, "key")
    reach = F.col("norm") * F.col("longest") * (1 + ROOM) >= F.array_min("scores") * (low / 100) - 1
    found = shards.meet(seeking, n, reach, negatives_of_cell(k_negatives, low, high), "key long, asked long, vec_id long, score long, mult long")
    negatives = ranked(found, ["key", "asked"], k_negatives).select("key", F.col("asked").alias("positive_score"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    out = positives.join(asked.select("key", F.col("vec_id").alias("anchor_id")), "key").join(negatives, ["key", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def labelled_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, v: floor(scale * x) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(fit).withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))


def op12_lemp_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_vectors(read(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mined(rows, rows.where(F.col("vec_id") % 100 == 0))


QUERIES = {"op12_lemp_hard_negatives": op12_lemp_hard_negatives}

SQL = {
    "op12_lemp_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
}
