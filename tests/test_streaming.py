import datetime as dt
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from wattlake.plans import model_queries
from wattlake.streaming import incremental


def test_stream_has_the_days_that_are_still_open(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(u, base + dt.timedelta(hours=7 * k), float(u + k)) for u in range(3) for k in range(10)]
    frame = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double")
    frame.write.parquet(f"{tmp_path}/events.parquet")
    day = frame.groupBy(F.col("user_id").cast("string").alias("customer_id"), F.to_date("ts").alias("date")).agg(F.round(F.sum(F.col("value") / 100), 6).alias("conso_kwh"), F.count("*").alias("n"))
    got = incremental.stream_daily(spark, f"{tmp_path}/events.parquet")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, day.collect()))
    shared = urlparse(spark.conf.get("spark.checkpoint.dir")).path
    assert all(Path(shared) in Path(urlparse(f).path).parents for f in got.inputFiles())


def test_incremental_run_writes_to_the_shared_folder(spark, sf):
    shared = urlparse(spark.conf.get("spark.checkpoint.dir")).path
    assert all(Path(shared) in Path(urlparse(f).path).parents for f in model_queries.incremental_run(spark, sf).inputFiles())
