"""Single operators on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.functions.columns import day_night_balance
from wattlake.operators import charts, timeseries, training, weather
from wattlake.plans import pipeline


def test_evenings_with_ties_and_days_that_stay_bright(spark):
    day = lambda d, values: [(dt.datetime(2024, 6, d, 8 + i), v) for i, v in enumerate(values)]
    rows = day(1, [10.0, 100.0, 100.0, 15.0, 5.0]) + day(2, [50.0, 90.0, 60.0]) + day(3, [None, None]) + day(4, [5.0]) + day(5, [19.0, 30.0, None, 20.0, 19.9])
    got = {r.date.day: (r.peak.hour, r.evening and r.evening.hour) for r in weather.evening_start(spark.createDataFrame(rows, "ts timestamp_ntz, global_rad_w double")).collect()}
    assert got == {1: (9, 11), 2: (9, None), 4: (8, 8), 5: (9, 12)}


def test_zscore(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0), ("b", 10.0, 5.0), (None, 4.0, 5.0), (None, None, 5.0)], "k string, v double, w double")
    got = {(r.k, r.v): (r.v_norm, r.w_norm) for r in timeseries.zscore(df, ["v", "w"], ["k"]).collect()}
    assert got["a", 1.0][0] == pytest.approx(-(0.5**0.5)) and got["b", 10.0] == (0.0, 0.0) and got[None, 4.0] == (0.0, 0.0) and len(got) == 5
    whole = timeseries.zscore(df, ["w"])
    assert whole.columns == ["k", "v", "w", "w_norm"] and {r.w_norm for r in whole.collect()} == {0.0}


def test_first_keys(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4), ("a", 5)], "customer_id string, v int")
    assert sorted(r.v for r in timeseries.first_keys(df, 2).collect()) == [1, 2, 5]


def test_unknown_radiation_is_night_or_nothing(spark):
    df = spark.createDataFrame([("a", 4.0, 60.0), ("a", 2.0, 10.0), ("a", 6.0, None)], "k string, v double, rad double")
    r = df.groupBy("k").agg(day_night_balance("v", "rad").alias("n"), day_night_balance("v", "rad", unknown_is_night=False).alias("o")).first()
    assert r.n == pytest.approx(0.0) and r.o == pytest.approx(2 / 6)


def test_late_merge_adds_only_what_is_absent(spark):
    r = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "customer_id string, sc_share double")
    steps = {"has_pv": spark.createDataFrame([("b", True, 9.0), ("c", False, 9.0)], "customer_id string, has_pv boolean, sc_share double"), "sc_share": spark.createDataFrame([("z", 7.0)], "customer_id string, sc_share double")}
    got = {x.customer_id: (x.sc_share, x.has_pv) for x in charts.late_merge(r, steps).collect()}
    assert got == {"a": (1.0, None), "b": (2.0, True), "c": (None, False)}


def test_production_comes_from_the_indicators_if_at_all(spark):
    r = spark.createDataFrame([("a", 3.0), ("b", None)], "customer_id string, pv_capacity_kwp double")
    i = spark.createDataFrame([("a", 900.0)], "customer_id string, yearly_prod_kwh double")
    assert [tuple(x) for x in charts.dashboard_points(r, i).collect()] == [("a", 3.0, 900.0)]
    own = r.withColumn("yearly_prod", F.lit(5.0))
    assert charts.with_production(own, i).columns == own.columns


def test_stages_without_a_model_keep_their_columns(spark):
    for kind, schema in pipeline.STAGES.items():
        empty = pipeline.nothing(spark, schema)
        assert empty.count() == 0 and empty.columns[0] == "customer_id" and f"has_{kind.lower()}" in empty.columns


def test_features_of_some_months(spark):
    rows = [("a", dt.datetime(2024, m, 1 + k % 20, k % 24, 15 * (k % 4)), 1.0 + k % 7) for m in (1, 7) for k in range(300)]
    meter = spark.createDataFrame(rows, "customer_id string, ts timestamp_ntz, conso_kwh double").dropDuplicates(["ts"])
    w = spark.createDataFrame([(dt.datetime(2024, m, d, h), 10.0 + h, 60.0 if h > 6 else 0.0) for m in (1, 7) for d in range(1, 21) for h in range(24)], "ts timestamp_ntz, t_2m_c double, global_rad_w double")
    july = training.series_features(meter, w, "AC", (7,)).first()
    both = training.series_features(meter, w, "AC").first()
    assert july.n_rows < both.n_rows and july.season_balance is None and both.season_balance is not None
    assert training.series_features(meter.where("conso_kwh < 0"), w, "HP").count() == 0


def test_density_is_that_of_every_value_at_every_place(spark):
    import numpy as np

    from wattlake.operators import portfolio

    v = np.random.default_rng(2).gamma(2.0, 900.0, 400)
    got = portfolio.density(spark.createDataFrame([(float(x),) for x in [*v, -3.0]], "e double"), "e", 200).orderBy("x").toPandas()
    lo, hi, h = v.min(), v.max(), v.std(ddof=1) * 400**-0.2
    x = lo - 0.5 * (hi - lo) + 2 * (hi - lo) * np.arange(200) / 199
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).mean(axis=1) / (h * np.sqrt(2 * np.pi))
    assert np.allclose(got["x"], x) and np.allclose(got["density"], want, rtol=2e-5, atol=1e-16)
    assert portfolio.density(spark.createDataFrame([(1.0,), (1.0,)], "e double"), "e").count() == 0
