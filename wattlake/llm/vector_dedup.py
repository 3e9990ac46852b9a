"""Near-duplicate vectors: iterative quantisation codes, multi-index Hamming tables, exact rerank.

Method. Equal vectors of a label form a class with a multiplicity. A rotation is learnt by iterative
quantisation on FIT_ROWS classes (those of the smallest hash, a bounded sample): principal axes of the
centred unit vectors, rotated so that the signs lose least. Every class gets the code of BITS signs.
Tables are keyed by label and one byte of the code each; two classes meet in the first table whose
byte they share, those within RADIUS bits are candidates, and their cosine in double precision, from
the original vectors, decides. A tile returns, for each class, its links' multiplicities and one
edge to the smallest class it is connected with there, so nothing grows with the square of a group;
buckets of more than TILE classes are cut into square tiles. Components come from distributed star
contraction.

Labels that are null, and vectors that are null, empty, zero or hold null or non-finite components link
with nothing: their rows have n_links 0 and stand for themselves. Vectors of another length than the
first fitted one are coded by a seeded rotation of their own and only meet their own length. A repeated
row counts as another vector. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import components, read, written
from ._runs import runs

COSINE = 0.98
FIT_ROWS = 20_000
BITS = 64
ROUNDS = 50
#: At a cosine of 0.98 about 4 of 64 bits differ; beyond this radius pairs aren't compared.
RADIUS = 16
TILE = 1024


def learn(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotation (columns are code bits) of unit vectors; balanced signs of least loss."""
    mean = sample.mean(axis=0)
    x = sample - mean
    _, _, axes = np.linalg.svd(x.T @ x)
    proj = axes[: min(BITS, x.shape[1])].T
    v = x @ proj
    rng = np.random.default_rng(7)
    r, _ = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))
    for _ in range(ROUNDS):
        b = np.where(v @ r >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(b.T @ v)
        r = (u @ w).T
    return mean, proj @ r


def fallback(width: int) -> tuple[np.ndarray, np.ndarray]:
    r, _ = np.linalg.qr(np.random.default_rng(width).normal(size=(max(width, 1), max(width, 1))))
    return np.zeros(width), r[:width, :BITS]


def codes(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    bits = (x - model[0]) @ model[1] >= 0
    weight = np.uint64(1) << np.arange(bits.shape[1], dtype=np.uint64)
    return (bits * weight).sum(axis=1, dtype=np.uint64)


def unit(values) -> np.ndarray:
    x = np.asarray(values, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def links_of_tile(code, same, side, mult, u, table: int, cosine: float):
    """Row pairs of a tile that link, each in the first table that holds both."""
    left = np.arange(len(code)) if same else np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    apart = code[left][:, None] ^ code[right][None, :]
    ok = np.bitwise_count(apart) <= RADIUS
    for j in range(table):
        ok &= (apart >> np.uint64(8 * j)) & np.uint64(255) != 0
    if same:
        ok = np.triu(ok, 1)
    i, k = np.nonzero(ok)
    i, k = left[i], right[k]
    keep = np.concatenate([np.einsum("ij,ij->i", u[i[s : s + 65536]], u[k[s : s + 65536]]) >= cosine for s in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
    return i[keep], k[keep]


def roots(n: int, i: np.ndarray, k: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row is connected with through the pairs."""
    low = ids.copy()
    while len(i):
        m = np.minimum(low[i], low[k])
        new = low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, k, m)
        if (new == low).all():
            break
        low = new
    return low


def class_links(classes: DataFrame, cosine: float) -> DataFrame:
    """node, links, root: from each tile, what the linked classes of it have there."""
    spark = classes.sparkSession
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(FIT_ROWS).select("v").toPandas()["v"]
    widths = sample.map(len)
    width = int(widths.iloc[0]) if len(sample) else 0
    fit = learn(unit(np.stack(sample[widths == width].to_list()))) if width else fallback(0)
    model = spark.sparkContext.broadcast((width, fit))

    def encode(batches):
        width, fit = model.value
        for batch in batches:
            v = batch.column("v")
            length = np.asarray(v.value_lengths())
            out = np.zeros(batch.num_rows, np.uint64)
            for w in np.unique(length):
                rows = np.flatnonzero(length == w)
                x = unit(np.stack([v[int(i)].values.to_numpy(zero_copy_only=False) for i in rows]))
                out[rows] = codes(x, fit if w == width else fallback(int(w)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], [*batch.schema.names, "code"])

    coded = classes.select("label", "rep", "mult", "v").mapInArrow(encode, "label long, rep long, mult long, v array<double>, code long")
    rows = coded.withColumn("table", F.explode(F.sequence(F.lit(0), F.lit(BITS // 8 - 1))))
    byte = F.expr("cast(shiftright(code, 8 * table) & 255 as int)")
    rows = rows.withColumn("bucket", F.xxhash64("label", F.size("v"), "table", byte))
    blocks = rows.groupBy("bucket").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    rows = rows.join(blocks, "bucket").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = rows.select(F.xxhash64("bucket", F.least("i", "j"), F.greatest("i", "j")).alias("tile"), (F.col("i") > F.col("j")).cast("int").alias("side"), (F.col("i") == F.col("j")).alias("same"), "table", "rep", "mult", "code", "v")

    def link(batches):
        for t in runs(batches, "tile"):
            if t.num_rows < 2:
                continue
            c = {k: t.column(k).to_numpy() for k in ("side", "same", "table", "rep", "mult", "code")}
            v = t.column("v").combine_chunks()
            u = unit(v.flatten().to_numpy().reshape(t.num_rows, -1))
            i, k = links_of_tile(c["code"].view(np.uint64), bool(c["same"][0]), c["side"], c["mult"], u, int(c["table"][0]), cosine)
            if len(i):
                total = np.bincount(i, c["mult"][k], t.num_rows) + np.bincount(k, c["mult"][i], t.num_rows)
                low = roots(t.num_rows, i, k, c["rep"])
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"node": c["rep"][at], "links": total[at].astype(np.int64), "root": low[at]})

    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(link, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (vec_id, embedding, label)."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    fit = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(F.size("v") > 0, F.lit(False)) & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(fit, F.transform("v", lambda x: x + 0.0)))  # -0.0 equals 0.0
    classes = written(rows.where("v is not null").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult")))
    found = written(class_links(classes, cosine))
    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links")).join(comp, "node", "left")
    classes = classes.join(links, F.col("rep") == F.col("node"), "left").select("label", "v", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("comp"))
    out = rows.join(classes, ["label", "v"], "left").select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("comp", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op7_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


QUERIES = {"op7_itq_near_dedup": op7_itq_near_dedup}

SQL = {
    "op7_itq_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
k AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) >= 0.98 * sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))),
r AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, k.b FROM r JOIN k ON r.seen = k.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM k WHERE k.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.node = vec_id
""",
}
