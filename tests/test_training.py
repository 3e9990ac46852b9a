"""Training data and trainers on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.operators import appliances as ap
from wattlake.operators import models as ml
from wattlake.operators import prefix
from wattlake.operators import training as tr

SCHEMA = "type string, source string, customer_id string, ts timestamp_ntz, value_kw_mean double, temp double, glob_rad double"
RULES = (20, 0, 0, 400.0, 0.0)


def curve(who, kind, source="dataport", n=200, value=lambda k: 1.0 + k % 5, temp=lambda k: 5.0 + k % 20, start=dt.datetime(2020, 6, 1)):
    return [(kind, source, who, start + dt.timedelta(minutes=15 * k), float(value(k)), None if temp(k) is None else float(temp(k)), float(60 if k % 2 else 0)) for k in range(n)]


@pytest.fixture(scope="module")
def rows(spark):
    warm = lambda k: (5.0 + k % 20) / 10
    out = curve("pos", "AC", value=warm) + curve("pos", "TOT")
    out += curve("weak", "AC", value=lambda k: 0.01 + 0.001 * (k % 2)) + curve("weak", "TOT")
    out += curve("short", "AC", n=5, value=warm) + curve("short", "TOT")
    out += curve("bare", "AC", value=warm)
    out += [("AC", "dataport", "untimed", None, 1.0, 20.0, 60.0)] + curve("untimed", "TOT")
    out += curve("neg", "TOT", source="Refit") + curve("other", "TOT", source="elsewhere") + curve("nosource", "TOT", source=None)
    out += curve("fewtot", "TOT", n=7) + curve("cold", "TOT", temp=lambda k: 9.0 if k < 5 else None) + curve("car", "EV")
    out += curve("neg", "TOT", source="Refit")[:50]  # repeated times
    return spark.createDataFrame(out, SCHEMA)


def test_first_failing_rule_decides(rows):
    got = {r.customer_id: (r.reason, r.target_name, r.target, r.corr_all is not None) for r in tr.modelled(rows, "AC", RULES, RULES).collect()}
    assert got == {
        "pos": ("ok", "has_ac", 1, True), "neg": ("ok", "no_ac", 0, True), "weak": ("weak_ac_signal", None, None, False), "short": ("ac_too_few_rows", None, None, False), "bare": ("no_total_curve", None, None, False),
        "untimed": ("empty_ac_curve", None, None, False), "other": ("source_without_negatives", None, None, False), "nosource": ("source_without_negatives", None, None, False), "fewtot": ("tot_too_few_rows", None, None, False),
        "cold": ("tot_too_few_temp_rows", None, None, False), "car": ("no_curve", None, None, False),
    }
    assert {r.reason: r.n for r in tr.reasons(tr.modelled(rows, "AC", RULES, RULES)).collect()}["ok"] == 2


def test_heat_pumps_need_dark_rows(rows, spark):
    bright = spark.createDataFrame([(*r[:6], 500.0) for r in curve("bright", "TOT")], SCHEMA)
    falls = spark.createDataFrame(curve("heats", "HP", value=lambda k: 3 - (k % 20) / 10) + curve("heats", "TOT"), SCHEMA)
    got = {r.customer_id: (r.reason, r.target_name) for r in tr.modelled(rows.unionByName(bright).unionByName(falls), "HP", RULES, RULES).collect()}
    assert got["bright"] == ("tot_too_few_night_rows", None) and got["heats"] == ("ok", "winter_hp") and got["other"] == ("ok", "no_hp")


def test_repeated_times_count_once(rows):
    q = {r.customer_id: r for r in ap.curve_quality(rows.where("type = 'TOT' and ts is not null"), ["customer_id"]).collect()}
    assert q["neg"].n_rows == 200 and q["neg"].coverage == 1.0 and q["neg"].n_summer == 200 and q["fewtot"].n_rows == 7


def test_first_source_holds_under_any_partitioning(spark):
    rows = spark.createDataFrame([("a", None, 0), ("a", "z", 1), ("a", "b", 2), ("b", "q", 5), ("b", "q", 4), ("c", None, 1)], "customer_id string, source string, n int")
    want = {"a": "z", "b": "q", "c": "UNKNOWN"}
    for parts in (1, 5):
        assert {r.customer_id: r.source for r in tr.first_source(rows.repartition(parts, "n"), "n").collect()} == want
    assert {r.customer_id: r.source for r in tr.first_source(rows).collect()}["a"] == "b"


def test_arranged_keeps_a_customer_together(rows):
    part = tr.arranged(rows, 3).withColumn("p", F.spark_partition_id()).toPandas()
    assert (part.groupby("customer_id")["p"].nunique() == 1).all()
    for _, p in part.groupby("p", sort=False):
        keys = list(zip(p["customer_id"], p["type"], p["ts"].astype("int64").where(p["ts"].notna(), -1)))
        assert keys == sorted(keys)


@pytest.mark.parametrize("share", [0.2, 0.35])
def test_stratified_split_is_exact(spark, share):
    df = spark.range(1003).select(F.col("id").cast("string").alias("customer_id"), F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") == 7, None).otherwise("common").alias("label"), F.lit(1).alias("__x"))
    fit, test = tr.stratified_split(df, "label", share)
    want = {r.label: r.n for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    got = {r.label: r.n for r in test.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert all(abs(got.get(k, 0) - n * share) <= 0.5 for k, n in want.items())
    assert fit.count() + test.count() == 1003 and fit.join(test, "customer_id").count() == 0 and fit.columns == df.columns
    again = tr.stratified_split(df.repartition(13), "label", share)[1]
    assert {r.customer_id for r in again.collect()} == {r.customer_id for r in test.collect()}


def test_running_sums_over_ranges(spark):
    # one value holds most rows
    data = [(f"g{i % 2}", 5 if i % 3 else i, i, (i * 7) % 11) for i in range(500)] + [(None, None, 900, None), ("g0", None, 901, 4)]
    df = spark.createDataFrame(data, "g string, v int, id int, x int").repartition(5)
    for group in ([], ["g"]):
        got = {r.id: r.s for r in prefix.running(df, group, ["v", "id"], "x", "s").collect()}
        total, want = {}, {}
        for g, v, i, x in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            k = g if group else 0
            total[k] = total.get(k, 0) + (x or 0)
            want[i] = total[k]
        assert got == want


def test_running_capacity(spark):
    got = tr.running_capacity(spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", None), ("d", 1.0)], "customer_id string, pv_capacity_kwp double")).orderBy("rank").collect()
    assert [(r.customer_id, r.rank, r.running, r.share) for r in got] == [("b", 1, 1.0, 0.2), ("d", 2, 2.0, 0.4), ("a", 3, 5.0, 1.0)]


def table(spark, n=400):
    """x decides whether it runs; in summer it takes 3 kW, in winter 1."""
    return spark.range(n).select((F.col("id") % 20).cast("double").alias("x"), F.when(F.col("id") % 2 == 0, 7).otherwise(1).alias("month"), (F.col("id") % 20 >= 10).cast("double").alias("on")).withColumns({"kw": F.when(F.col("month") == 7, 3.0).otherwise(1.0) * F.col("on"), "ratio": F.col("on") * 0.5, "sample_weight": F.lit(1.0)})


def test_amount_learns_from_summer_or_else_from_all_running_rows(spark):
    df = table(spark)
    small = {"rounds": (3, 3), "depth": (2, 2), "rate": 1.0, "leaf": (5, 5)}
    said = {r.amount for r in ml.TwoStage(["x"], "AC").fit(df, **small).predict(df).select("amount").distinct().collect()}
    assert said == {3.0}
    winter = ml.TwoStage(["x"], "AC").fit(df.where("month = 1"), **small).predict(df).select("amount").distinct().collect()
    assert [r.amount for r in winter] == [1.0]
    with pytest.raises(ValueError):
        ml.TwoStage(["x"], "AC").fit(df.where("on = 0"), **small)


def test_leaves_are_regularised(spark):
    rows = spark.createDataFrame([(0.0, 1.0, 1.0)] * 6 + [(1.0, 5.0, 1.0)] * 4, "x double, y double, w double")
    from pyspark.ml.feature import VectorAssembler

    x = VectorAssembler(inputCols=["x"], outputCol="__vector").transform(rows)
    one = ml.Boosted("squared", 1.0).fit(x, rounds=1, depth=1, leaf=1, l2=2.0)
    got = {r.x: r.s for r in one.score(x, "s").select("x", "s").distinct().collect()}
    # from a mean of 2.6: slopes of -1.6 each in six rows, 2.4 in four
    assert got[0.0] == pytest.approx(2.6 - 9.6 / 8) and got[1.0] == pytest.approx(2.6 + 9.6 / 6)
    wide = ml.Boosted("squared", 1.0).fit(x, rounds=1, depth=1, leaf=5, l2=2.0)
    assert wide.score(x, "s").select("s").distinct().count() == 1  # no leaf of five on both sides


def test_leaf_of_heat_pumps_is_80():
    assert ml.STAGES["HP"][0] == (80, 80) and ml.STAGES["AC"][0] == (80, 40)


def test_medians_are_weighted(spark):
    rows = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 1.0), (0, 9.0, 5.0), (1, 4.0, 1.0), (1, 4.0, 1.0)], "leaf int, r double, w double")
    assert ml._leaf_medians(rows) == {0: 9.0, 1: 4.0}


def test_models_come_back_from_disk(spark, tmp_path):
    df = table(spark)
    model = ml.TwoStage(["x"], "HP").fit(df, rounds=(2, 2), depth=(2, 2), leaf=(5, 5))
    model.save(str(tmp_path / "m"))
    a, b = (m.predict(df).orderBy("x", "month").select("on_prob", "amount").collect() for m in (model, ml.TwoStage.load(str(tmp_path / "m"))))
    assert a == b and len(a) == 400


def test_scores(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 3 + [("b", "b")] * 2 + [("c", "a")]
    got = ml.weighted_f1(spark.createDataFrame(rows, "t string, s string"), "t", "s").first()
    assert got.n == 11 and got.f1 == pytest.approx((8 * 10 / 14 + 2 * 4 / 7) / 11)


def test_unknown_components_fail_at_once(rows):
    with pytest.raises(ValueError):
        tr.train(rows, ("ac_detector", "fridge"))
