"""What the operators share: shared-folder tables, running sums, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.shipping import shared_folder, ship

#: Buckets of a two-level running sum; the table of bucket totals has at most this many rows a group.
BUCKETS = 1024
#: Whether an execution's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    schema = df.schema
    old = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # the table stands for them from here on
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, old)
    return spark.read.schema(schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Removes the files of a table that written() made."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def before(df: DataFrame, group: list[str], order: list[str], value: str, name: str, salt: str) -> DataFrame:
    """Adds `name`: the sum of `value` over the rows before this one, in the order (hash bucket of
    `salt`, `order`) within `group`. Two levels, so that no task holds a whole group."""
    b, off = "__bucket", "__offset"
    rows = df.withColumn(b, F.pmod(F.xxhash64(salt), F.lit(BUCKETS)).cast("int"))
    keys = [*group, b]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))
    w2 = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("__total")).withColumn(off, F.coalesce(F.sum("__total").over(w2), F.lit(0))).drop("__total")
    renamed = totals.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], off)
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = inner.join(renamed, cond)
    return joined.withColumn(name, F.col(name) + F.col(off)).drop(off, b, *[f"__k{i}" for i in range(len(keys))])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) long pairs: (node, component), component the smallest node
    reachable. Alternates large-star and small-star, each a partly aggregated minimum and an
    equi-join, until the edges no longer change; nodes without an edge to another are not returned."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def mark(x: DataFrame):
        return x.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()

    seen = mark(e)
    while seen[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        new = written(small.union(least.select("u", "m")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
        now = mark(new)
        drop_written(e)
        e = new
        if now == seen:
            break
        seen = now
    star = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return star.union(e.select(F.col("b"), F.col("b")).distinct())
