"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only.

Method. Sources, by code point with null last, weigh WEIGHTS in turn and share BUDGET times all
words; a target stops at CAP times its source's words, and the excess goes to the others by weight
until none is above: with sources by cap over weight, one water level serves all that are not full.
A source's documents stand in the order of their ids' MD5; it gives whole rounds of all of them and
then those of a last round while the middle of a document lies under the rest of the target. Over the
training time t of 0 to 1 a source's share follows a linear schedule target * (1 + r * (2t - 1)) with
ramp r; its integral inverted at the words taken before a copy gives that copy's time, and the mix is
all copies range-sorted by time.

Null and empty texts have size 0: nothing is taken of them. Empty tables give no rows; a source
without words has target 0. Repeated rows count as documents of their own; ties of equal ids and texts
give equal rows. Null ids stand together at the start of their source's order. Other columns pass
through `mixed`, whatever their names; `position` replaces one of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import BUCKETS, read, written

#: The weights of sources in turn, and how their shares move over the training time.
WEIGHTS = [3, 1, 2]
RAMPS = [-0.5, 0.5, 0.25]
BUDGET = 1.5
CAP = 2.0
WORD = "[^\\x20\\x09-\\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, ramp of each source; sizes: source, size. The windows run over one row a source."""
    every = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(WEIGHTS)))
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), F.col("turn").cast("int") + 1)
    w = every.withColumn("turn", turn).withColumn("weight", pick(WEIGHTS).cast("double")).withColumn("ramp", pick(RAMPS))
    w = w.withColumn("cap", CAP * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    prior = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    w = w.withColumn("level", (BUDGET * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(prior), F.lit(0.0))) / F.sum("weight").over(onward))
    w = w.withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", F.col("source").isNull(), "source", "level"))).over(everything)["level"])
    return w.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"), "ramp")


def placed(docs: DataFrame) -> DataFrame:
    """docs with __size, __source_size, __target, __ramp, __copies and __start: the words of its source before it."""
    rows = docs.withColumn("__size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    rows = rows.withColumn("__md5", F.md5(F.col("doc_id").cast("string").cast("binary")))
    # buckets in the order of the MD5 itself, so that the two-level sum keeps that order
    rows = rows.withColumn("__b", F.coalesce((F.conv(F.substring("__md5", 1, 4), 16, 10).cast("int") * BUCKETS / 65536).cast("int"), F.lit(-1)))
    # the window and the join below deal by the same three columns, so that texts are shuffled once for both
    rows = rows.withColumns({"__k1": F.coalesce("source", F.lit("")), "__k2": F.col("source").isNull()})
    totals = rows.groupBy("source", "__b").agg(F.sum("__size").alias("__sum"))
    ahead = Window.partitionBy("source").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__sum").over(ahead), F.lit(0))).select(F.col("source").alias("__s"), "__b", "__off")
    targets = source_targets(totals.select("source", F.col("__sum").alias("size")))
    targets = targets.select(F.col("source").alias("__t"), *[F.col(c).alias(f"__{c}") for c in ("source_size", "target", "ramp")])
    offsets = offsets.join(targets, F.col("__s").eqNullSafe(F.col("__t"))).drop("__t")
    offsets = offsets.withColumns({"__k1": F.coalesce("__s", F.lit("")), "__k2": F.col("__s").isNull()}).drop("__s")
    keys = ["__k1", "__k2", "__b"]
    inner = Window.partitionBy(*keys).orderBy("__md5", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__start", F.coalesce(F.sum("__size").over(inner), F.lit(0)))
    out = rows.join(offsets, keys)
    out = out.withColumn("__start", F.col("__start") + F.col("__off"))
    rounds = F.when(F.col("__source_size") > 0, F.floor(F.col("__target") / F.col("__source_size"))).otherwise(0)
    rest = F.col("__target") - rounds * F.col("__source_size")
    some = F.when((F.col("__size") > 0) & (F.col("__start") + F.col("__size") / 2 < rest), 1).otherwise(0)
    return out.withColumn("__copies", F.when(F.col("__size") > 0, rounds + some).otherwise(0).cast("int")).drop("__md5", *keys, "__off")


def dealt(rows: DataFrame, had: list[str]) -> DataFrame:
    """The copies of what placed() returns, with the columns `had` and `position` (0 to 1; in place of a column of
    that name), in the order of the mix."""
    rows = rows.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    u = F.least(F.lit(1.0), (F.col("__start") + F.col("__copy") * F.col("__source_size")) / F.col("__target"))
    r = F.col("__ramp")
    t = F.when(r == 0, u).otherwise((r - 1 + F.sqrt((1 - r) * (1 - r) + 4 * r * u)) / (2 * r))
    rows = rows.withColumn("position", t).select(*[c for c in had if c != "position"], "position")
    return rows.repartitionByRange(F.col("position"), F.col("doc_id")).sortWithinPartitions("position", "doc_id")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix: a row for each copy of each document of docs, with `position` (0 to 1), in its order."""
    return dealt(placed(docs), docs.columns)


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and the words that the mix takes of it, counted in the mix."""
    rows = written(placed(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"))
    facts = [F.col("doc_id"), *[F.col(f"__{c}").alias(c) for c in ("size", "source_size", "target")]]
    mix = written(dealt(rows, ["source", "doc_id", "__start", "__size", "__source_size", "__target"]))
    # only documents with words are taken, so that no two of a source start at the same word
    taken = mix.groupBy("source", "__start", "doc_id", "__size", "__source_size", "__target").agg(F.sum("__size").alias("taken"), F.min("position").alias("first_position"), F.max("position").alias("last_position"))
    ends = ["first_position", "last_position"]
    return taken.select(*facts, "taken", *ends).union(rows.where("__copies = 0").select(*facts, F.lit(0).cast("long"), *[F.lit(None).cast("double") for _ in ends]))


def op9_curriculum_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document with its place in the training time."""
    rows = mixed(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("doc_id", "source", F.round("position", 9).alias("position"))


QUERIES = {"op9_curriculum_mix": op9_curriculum_mix, "op9_curriculum_order": op9_curriculum_order}

SQL = {
    "op9_curriculum_mix": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight FROM s),
c AS (SELECT *, list_extract([-0.5, 0.5, 0.25], 1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT))::DOUBLE AS ramp, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS full_at FROM w),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
    - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, ramp, least(cap, weight * (SELECT level FROM l WHERE level <= full_at ORDER BY full_at, source NULLS LAST LIMIT 1)) AS target FROM c),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.ramp,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE CAST(floor(target / source_size) + CASE WHEN start + size / 2 < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END AS BIGINT) END AS copies FROM p),
u AS (SELECT *, least(1.0::DOUBLE, start / target) AS u0, least(1.0::DOUBLE, (start + (copies - 1) * source_size) / target) AS u1 FROM n)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
  CASE WHEN copies > 0 THEN (ramp - 1 + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * u0)) / (2 * ramp) END AS first_position,
  CASE WHEN copies > 0 THEN (ramp - 1 + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * u1)) / (2 * ramp) END AS last_position
FROM u
""",
    "op9_curriculum_order": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight FROM s),
c AS (SELECT *, list_extract([-0.5, 0.5, 0.25], 1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT))::DOUBLE AS ramp, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS full_at FROM w),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
    - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, ramp, least(cap, weight * (SELECT level FROM l WHERE level <= full_at ORDER BY full_at, source NULLS LAST LIMIT 1)) AS target FROM c),
p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.ramp,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CAST(floor(target / source_size) + CASE WHEN start + size / 2 < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END AS BIGINT) AS copies FROM p WHERE size > 0),
u AS (SELECT *, least(1.0::DOUBLE, (start + copy * source_size) / target) AS u FROM (SELECT *, unnest(range(copies)) AS copy FROM n))
SELECT doc_id, source, round((ramp - 1 + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * u)) / (2 * ramp), 9) AS position FROM u
""",
}
