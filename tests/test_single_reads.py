"""What large inputs are read for: once where one pass is enough."""

import datetime as dt

from wattlake.operators import timeseries
from wattlake.plans import load_queries
from wattlake.sources import adapters as A

TIME = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_an_asof_join_reads_its_left_side_once(spark):
    left = spark.createDataFrame([("a", TIME)], "customer_id string, ts timestamp_ntz")
    right = spark.createDataFrame([(TIME, 1.0)], "ts timestamp_ntz, v double")
    for way in ("backward", "nearest"):
        assert plan(timeseries.asof_join(left, right, 900, way)).count("LogicalRDD") == 2


def test_training_rows_are_made_in_one_pass(spark):
    meter = spark.createDataFrame([("1", TIME, 1.0, 10.0, 0.0), ("3", TIME, 1.0, 10.0, 0.0), ("4", TIME, 1.0, None, 0.0)], "customer_id string, ts timestamp_ntz, conso_kwh double, t_2m_c double, global_rad_w double")
    rows = A.training(meter)
    assert plan(rows).count("LogicalRDD") == 1
    assert sorted((r.type, r.customer_id, r.value_kw_mean) for r in rows.collect()) == [("AC", "1", 0.25), ("HP", "3", 0.75), ("TOT", "1", 4.0), ("TOT", "3", 4.0)]


def test_the_manifest_groups_by_customer_alone(spark, sf):
    """Flags of a customer need no table of all its times."""
    groups = [x for x in plan(load_queries.appliance_manifest(spark, sf)).splitlines() if "Aggregate [customer_id" in x]
    assert not [x for x in groups if "first(" in x or "pivot" in x]


def test_carrying_the_last_row_reads_its_left_side_once(spark):
    at = lambda minutes: TIME + dt.timedelta(minutes=minutes)
    minutes = [-1, 0, 20, 31, 59, 60, 170, 185, 190, 100_000, None]
    left = spark.createDataFrame([(i, None if m is None else at(m)) for i, m in enumerate(minutes)], "n int, ts timestamp_ntz")
    right = spark.createDataFrame([(at(0), 1.0), (at(30), 2.0), (at(185), None), (at(190), 4.0)], "ts timestamp_ntz, v double")
    out = timeseries.asof_join(left, right, None)
    assert sum("LogicalRDD [n#" in x for x in plan(out).splitlines()) == 1
    assert [r.v for r in out.orderBy("n").collect()] == [None, 1.0, 1.0, 2.0, 2.0, 2.0, 2.0, None, 4.0, 4.0, None]
    assert [r.v for r in timeseries.asof_join(left, right.limit(0), None).collect()] == [None] * len(minutes)
