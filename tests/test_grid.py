"""Grids that rows spread over without meeting a table of steps."""

import datetime as dt

from pyspark.sql import functions as F

from wattlake.operators import timeseries

START = dt.datetime(2024, 1, 1, 0, 5)


def at(minute):
    return START + dt.timedelta(minutes=minute)


def test_filled_grid_is_the_interpolation_of_the_grid(spark):
    rows = [("a", at(0), 1.0), ("a", at(15), None), ("a", at(75), 4.0), ("a", at(300), 2.0), ("a", at(330), None), ("b", at(0), None), ("b", at(45), 3.0), (None, at(0), 1.0), (None, at(30), 2.0), ("c", None, 5.0)]
    df = spark.createDataFrame(rows, "customer_id string, ts timestamp_ntz, v double")
    for limit in (None, 2, 8):
        both = [{(r.customer_id, r.ts, r.v) for r in x.collect()} for x in (timeseries.interpolate(timeseries.reindex(df), ["v"], limit=limit), timeseries.fill_grid(df, ["v"], limit=limit))]
        assert both[0] == both[1] and len(both[0]) == 23 + 4 + 3


def test_rows_off_the_grid_fall_away_and_repeated_times_stay(spark):
    rows = [("a", at(0), 1.0), ("a", at(7), 9.0), ("a", at(30), 2.0), ("a", at(30), 3.0), ("a", at(52), 9.0)]
    got = timeseries.reindex(spark.createDataFrame(rows, "customer_id string, ts timestamp_ntz, v double"))
    assert sorted((r.ts, r.v or 0.0) for r in got.collect()) == [(at(0), 1.0), (at(15), 0.0), (at(30), 2.0), (at(30), 3.0), (at(45), 0.0)]


def test_no_grid_is_joined(spark):
    """The steps are made after the last shuffle, so nothing of the grid's size is shuffled or sorted."""
    df = spark.createDataFrame([("a", at(0), 1.0)], "customer_id string, ts timestamp_ntz, v double")
    plan = timeseries.reindex(df.groupBy("customer_id", "ts").agg(F.sum("v").alias("v")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.index("Generate") < plan.index("Window")
