import datetime as dt
from itertools import permutations

from pyspark.sql import functions as F

from wattlake.functions.columns import balance, clip, safe_corr, slot_of_day, wilson
from wattlake.operators import pv, timeseries


def t(minute, day=1):
    return dt.datetime(2024, 1, day) + dt.timedelta(minutes=minute)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_asof_backward_keeps_unmatched_rows_and_tolerance(spark):
    left = frame(spark, [("a", t(0)), ("a", t(14)), ("b", t(40))], "customer_id string, ts timestamp_ntz")
    right = frame(spark, [(t(0), 1.0), (t(10), 2.0)], "ts timestamp_ntz, v double")
    got = {(r.customer_id, r.ts): r.v for r in timeseries.asof_join(left, right, 900).collect()}
    assert got == {("a", t(0)): 1.0, ("a", t(14)): 2.0, ("b", t(40)): None}


def test_asof_nearest_prefers_the_earlier_row_at_equal_distance(spark):
    left = frame(spark, [("a", t(5))], "customer_id string, ts timestamp_ntz")
    right = frame(spark, [(t(0), 1.0), (t(10), 2.0)], "ts timestamp_ntz, v double")
    assert timeseries.asof_join(left, right, 960, "nearest").first().v == 1.0


def test_asof_without_tolerance_carries_over_days(spark):
    left = frame(spark, [("a", t(30, 5)), ("a", t(0, 1))], "customer_id string, ts timestamp_ntz")
    right = frame(spark, [(t(10, 1), 1.0), (t(20, 2), 2.0), (t(40, 5), 3.0)], "ts timestamp_ntz, v double")
    got = {r.ts: r.v for r in timeseries.asof_join(left, right, None).collect()}
    assert got == {t(30, 5): 2.0, t(0, 1): None}


def test_interpolation_stops_after_the_limit_and_carries_at_the_end(spark):
    df = frame(spark, [("a", t(15 * i), v) for i, v in enumerate([0.0, None, None, None, 4.0, None, None])], "customer_id string, ts timestamp_ntz, v double")
    got = [r.v for r in timeseries.interpolate(df, ["v"], limit=2).orderBy("ts").collect()]
    assert got == [0.0, 1.0, 2.0, None, 4.0, 4.0, 4.0]


def test_grid_drops_rows_between_steps(spark):
    df = frame(spark, [("a", t(0), 1.0), ("a", t(7), 9.0), ("a", t(30), 3.0)], "customer_id string, ts timestamp_ntz, v double")
    assert [(r.ts, r.v) for r in timeseries.reindex(df).orderBy("ts").collect()] == [(t(0), 1.0), (t(15), None), (t(30), 3.0)]


def test_runs_keep_steady_ones_only(spark):
    values = [3, 3, 3, 0, 3, 0, 3, 9, 3]
    df = frame(spark, [("a", t(15 * i), float(v)) for i, v in enumerate(values)], "customer_id string, ts timestamp_ntz, kw double")
    got = timeseries.runs(df, F.col("kw") > 1, "kw", 2, 0.15).collect()
    assert [(r.start, r.n, r.mean) for r in got] == [(t(0), 3, 3.0)]


def test_guarded_statistics(spark):
    df = frame(spark, [(float(i), 2.0 * i, 1.0) for i in range(12)], "x double, y double, k double")
    r = df.agg(safe_corr("x", "y").alias("a"), safe_corr("x", "k").alias("b")).first()
    assert abs(r.a - 1) < 1e-9 and r.b is None
    few = df.limit(5).agg(safe_corr("x", "y").alias("a")).first()
    assert few.a is None
    one = spark.range(1).select(balance(F.lit(3.0), F.lit(1.0)).alias("p"), balance(F.lit(None).cast("double"), F.lit(1.0)).alias("q"), clip(F.lit(None).cast("double"), 0.0, 1.0).alias("c"), *[w.alias(n) for w, n in zip(wilson(F.lit(5), F.lit(10)), ("lo", "hi"))]).first()
    assert abs(one.p - 0.5) < 1e-6 and one.q is None and one.c is None and 0.2 < one.lo < 0.5 < one.hi < 0.8


def test_bootstrap_draws_are_whole_months_and_repeatable(spark):
    days = frame(spark, [("a", dt.date(2024, m, d)) for m in (1, 2) for d in range(1, 11)], "customer_id string, date date")
    a = pv.day_draws(days, 4, 1).groupBy("replicate").agg(F.sum("w").alias("w")).collect()
    assert {r.replicate: r.w for r in a} == {k: 20 for k in range(1, 5)}
    same = [sorted(map(tuple, pv.day_draws(x, 4, 1).collect())) for x in (days, days.repartition(3))]
    assert same[0] == same[1]


def test_slot_of_day(spark):
    assert frame(spark, [(t(47),)], "ts timestamp_ntz").select(slot_of_day("ts").alias("s")).first().s == 3


def test_runs_at_the_limit_of_spread_do_not_depend_on_the_order_of_sums(spark):
    """Readings whose deviation is exactly 0.6 of their mean, in all orders and two units."""
    kinds = [p for q in ((2, 5, 8), (3, 7, 15, 15), (5, 5, 13, 17)) for p in sorted(set(permutations(q)))]
    rows = [(f"{i}-{unit}", t(15 * k), x * unit) for i, p in enumerate(kinds) for unit in (0.016, 0.08) for k, x in enumerate(p)]
    df = frame(spark, rows, "customer_id string, ts timestamp_ntz, kw double")
    assert timeseries.runs(df, F.col("kw") > 0, "kw", 3, 0.6, digits=9).count() == 2 * len(kinds)
    assert timeseries.runs(df, F.col("kw") > 0, "kw", 3, 0.599999, digits=9).count() == 0


def test_own_use_of_equal_days_is_none_whatever_the_order_of_sums(spark):
    """Sunny and dull middays of equal means have no share of own use where nothing is produced; noise gave a share of 1."""
    x = (0.1, 0.2, 0.3, 0.7)
    days = [(f"{i}", b, c, 0.0) for i, p in enumerate(permutations(x)) for b, values in (("low", x), ("high", p)) for c in values]
    df = frame(spark, days, "customer_id string, rad_bucket string, conso_midday double, prod_midday double").coalesce(1)
    got = pv.share_parts(df, ["customer_id"], F.lit(1.0), digits=9)
    assert got.count() == 24 and got.where("sc_share is not null").count() == 0
