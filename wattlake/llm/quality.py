"""Quality by importance resampling: a target and a raw text model over hashed n-grams.

Method. Words, pairs of words, word shapes and pairs of shapes (with whether the words repeat) are hashed
into BUCKETS buckets. The raw model counts them in all documents, the target model in the labelled
training documents of quality 1. A document's log importance weight is the sum over its n-grams of the
log ratio of the two models; the mean log ratio is calibrated to a score of 0 to 1 on at most FIT_ROWS
labelled training documents (those of the smallest hash; the bound is this parameter). Sampling without
replacement adds Gumbel noise, drawn from the id's hash, to the log weights and keeps the k highest keys;
k is the number of documents that score at least 0.5. The k-th key is found by histograms that
narrow, never by a global sort.

Labels of documents with crc32(doc_id as text) mod 5 = 0 are never used. Null and empty texts have weight
0 and the score of no evidence. Without usable labels of both kinds all scores are 0.5 and all are kept.
Rows that repeat an id get equal keys. Texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import read, written
from ._filters import thinned
from ._tables import summed_table
from ._text import mix, pieces, utf8, word_spans, words

BUCKETS = 1 << 16
FIT_ROWS = 20_000
FOLDS = 5
BINS = 4096
#: Byte kinds: 1 upper case, 2 lower case and bytes over 127, 4 digits, 8 other signs, 0 white space.
KIND = np.full(256, 8, np.uint8)
KIND[65:91], KIND[97:123], KIND[128:], KIND[48:58] = 1, 2, 2, 4
KIND[[0x20, *range(0x09, 0x0E)]] = 0


def held_out(doc_id) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0


def ngrams(column) -> tuple[np.ndarray, np.ndarray]:
    """The bucket and the row of every n-gram of a string column."""
    data, offsets = utf8(column)
    starts, ends = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, at = words(column)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    kind = KIND[data]
    has = np.bitwise_or.reduceat(kind, starts).astype(np.uint64)
    shape = has | kind[starts].astype(np.uint64) << np.uint64(4) | kind[ends - 1].astype(np.uint64) << np.uint64(8) | np.minimum((ends - starts) // 4, 7).astype(np.uint64) << np.uint64(12)
    pair = np.flatnonzero(row[1:] == row[:-1])
    again = (h[1:] == h[:-1])[pair].astype(np.uint64)
    found = [mix(h + np.uint64(1)), mix(h[pair] * np.uint64(3) + h[pair + 1]), mix(shape + np.uint64(1 << 20)), mix((shape[pair] << np.uint64(20) | shape[pair + 1]) * np.uint64(4) + again + np.uint64(2))]
    return np.concatenate([(x % np.uint64(BUCKETS)).astype(np.int64) for x in found]), np.concatenate([row, row[pair], row, row[pair]])


def counted(docs: DataFrame) -> np.ndarray:
    def update(total, batch):
        for p in pieces(batch, "text", 2 << 20):
            total += np.bincount(ngrams(p.column("text"))[0], minlength=BUCKETS).astype(np.uint32)

    return summed_table(docs.select("text"), BUCKETS, update)


def weighed(docs: DataFrame, ratio) -> DataFrame:
    """docs (doc_id, text, ...) without text, with n_grams and log_weight."""
    rest = [f for f in docs.schema if f.name != "text"]

    def weigh(batches):
        for batch in batches:
            for p in pieces(batch, "text", 2 << 20):
                b, row = ngrams(p.column("text"))
                n = np.bincount(row, minlength=p.num_rows)
                w = np.bincount(row, ratio.value[b], p.num_rows).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*(p.column(f.name) for f in rest), pa.array(n.astype(np.int64)), pa.array(w)], [*(f.name for f in rest), "n_grams", "log_weight"])

    return docs.mapInArrow(weigh, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["n_grams long", "log_weight double"]))


def calibrated(mean: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on the standardised mean log ratio."""
    mid, spread = mean.mean(), mean.std() + 1e-12
    x = np.stack([np.ones(len(mean)), (mean - mid) / spread], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), x.T @ (y - p) - 0.01 * b)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return b[1] / spread, b[0] - b[1] * mid / spread


def kth_highest(keys: DataFrame, k: int) -> DataFrame:
    """Adds kept: whether a row's (key, doc_id) is among the k highest; smaller ids win ties."""
    level = F.asinh("key")
    lo, hi, above = -1000.0, 1000.0, 0
    while True:
        width = (hi - lo) / BINS
        inside = keys.where((level >= lo) & (level < hi))
        # one row a bin
        bins = {r.b: r.n for r in inside.groupBy(F.least(F.lit(BINS - 1), F.floor((level - lo) / width).cast("int")).alias("b")).agg(F.count("*").alias("n")).collect()}
        b = BINS - 1
        while b > 0 and above + bins.get(b, 0) < k:
            above += bins.get(b, 0)
            b -= 1
        narrow_lo, narrow_hi = lo + b * width, lo + (b + 1) * width
        if bins.get(b, 0) <= 10_000 or width < 1e-9:
            break
        lo, hi = narrow_lo, narrow_hi
    edge = F.least(F.lit(BINS - 1), F.floor((level - lo) / width).cast("int"))
    place = F.when((level >= lo) & (level < hi), edge).when(level >= hi, BINS).otherwise(-1)
    rows = keys.withColumn("__b", place)
    last = rows.where(F.col("__b") == b).withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy(F.desc("key"), "doc_id")))
    other = rows.where(F.col("__b") != b).withColumn("kept", F.col("__b") > b)
    return other.unionByName(last.withColumn("kept", F.col("__r") + above <= k).drop("__r")).drop("__b")


def resampled(docs: DataFrame, labels: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, log_weight, score, predicted, key, kept of every row of docs."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("long").alias("quality"))
    seen = written(seen.where(~held_out(F.col("doc_id"))))
    good = seen.where("quality = 1").select("doc_id")
    raw, target = counted(docs).astype(float), counted(thinned(docs, good).join(good, "doc_id", "left_semi")).astype(float)
    model = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    ratio = spark.sparkContext.broadcast(model)
    sample = written(seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS))
    known = weighed(thinned(docs, sample).join(sample, "doc_id"), ratio).where("n_grams > 0").select("quality", (F.col("log_weight") / F.col("n_grams")).alias("mean")).toPandas()
    slope, start = calibrated(known["mean"].to_numpy(), known["quality"].to_numpy(float)) if known["quality"].nunique() > 1 else (0.0, 0.0)
    rows = weighed(docs, ratio)
    mean = F.when(F.col("n_grams") > 0, F.col("log_weight") / F.col("n_grams")).otherwise(0.0)
    rows = rows.withColumn("score", 1 / (1 + F.exp(-F.least(F.lit(30.0), F.greatest(F.lit(-30.0), slope * mean + start)))))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    rows = written(rows.withColumn("key", F.col("log_weight") - F.log(-F.log(u))))
    k = rows.where("score >= 0.5").count()
    return kth_highest(rows, k).select("doc_id", "log_weight", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "key", "kept")


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {"op6_importance_resampling": op6_importance_resampling}
SQL: dict[str, str] = {}
