"""Runs that go on where they stopped, and the meter as a stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.shipping import shared_folder


def resume(rows: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame], key: str = "customer_id") -> DataFrame:
    """Computes the keys that the results under `path` don't have yet, appends them as another run,
    and returns all results, each key's from its last run."""
    spark = rows.sparkSession
    try:
        done = spark.read.parquet(path)
    except AnalysisException:
        done = None
    pending = rows if done is None else rows.join(done.select(key).distinct(), key, "left_anti")
    runs = 0 if done is None else (done.agg(F.max("run")).first()[0] or 0)
    compute(pending).withColumn("run", F.lit(runs + 1)).write.mode("append").parquet(path)
    last = Window.partitionBy(key).orderBy(F.desc("run"))
    return spark.read.parquet(path).withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n", "run")


def stream_daily(spark: SparkSession, path: str, delay: str = "2 hours") -> DataFrame:
    """Daily sums by customer from a directory of event files read as a stream: a watermark bounds the
    state, repeats within it count once, and each batch's days, open ones too, replace their former sums."""
    schema = spark.read.parquet(path).schema
    work = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    events = spark.readStream.schema(schema).parquet(path if path.endswith("/") else path + "*")
    m = events.select(F.col("user_id").cast("string").alias("customer_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 100).alias("conso_kwh"))
    days = m.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["customer_id", "ts"]).groupBy(F.window("ts", "1 day"), "customer_id").agg(F.sum("conso_kwh").alias("conso_kwh"), F.count("*").alias("n"))
    flat = days.select("customer_id", F.to_date(F.col("window.start")).alias("date"), F.round("conso_kwh", 6).alias("conso_kwh"), "n")

    def keep(batch: DataFrame, number: int) -> None:
        # a batch that runs again after a failure replaces what it wrote
        batch.write.mode("overwrite").parquet(f"{work}/days/batch={number}")

    query = flat.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    try:
        every = spark.read.parquet(f"{work}/days")
    except AnalysisException:
        return spark.createDataFrame([], flat.schema)
    last = every.groupBy("customer_id", "date").agg(F.max_by(F.struct("conso_kwh", "n"), "batch").alias("d"))
    return last.select("customer_id", "date", "d.conso_kwh", "d.n")


def apply_by_customer(rows: DataFrame, function, schema: str, key: str = "customer_id") -> DataFrame:
    """A user's own function of one customer's frame, for what columns can't express."""
    return rows.groupBy(key).applyInPandas(function, schema)
