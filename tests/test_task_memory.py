"""What a task holds does not grow with the columns or the days of its customers."""

import datetime as dt

from wattlake.operators import charts, weather

DAY = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_evenings_need_no_table_of_days(spark):
    rad = {8: 100.0, 10: 500.0, 12: 500.0, 14: None, 16: 120.0, 18: 10.0}
    rows = [("a", DAY + dt.timedelta(hours=h), v) for h, v in rad.items()] + [("a", DAY + dt.timedelta(days=1, hours=h), 300.0) for h in (9, 9, 11)] + [("b", DAY, None)]
    out = weather.evening_start(spark.createDataFrame(rows, "customer_id string, ts timestamp_ntz, global_rad_w double"), ["customer_id"], 150.0)
    assert "Aggregate" not in plan(out)
    assert sorted((r.customer_id, r.date.day, r.peak.hour, r.evening and r.evening.hour) for r in out.collect()) == [("a", 1, 10, 16), ("a", 2, 9, None)]


def test_a_heatmap_holds_one_mean_a_quarter_hour(spark):
    rows = [("a", DAY, 1.0), ("a", DAY + dt.timedelta(minutes=14), 2.0), ("a", DAY + dt.timedelta(minutes=15), None), ("a", DAY + dt.timedelta(hours=23, minutes=45), 4.0), ("b", DAY, None)]
    out = charts.customer_heatmap(spark.createDataFrame(rows, "customer_id string, ts timestamp_ntz, conso_kwh double"))
    assert plan(out).count("avg(") == 1
    got = {r.customer_id: r.asDict() for r in out.collect()}
    assert {k: v for k, v in got["a"].items() if k[0] == "q" and v is not None} == {"q0": 1.5, "q95": 4.0} and got["b"]["q0"] is None
    assert out.columns == ["customer_id", "date", *[f"q{k}" for k in range(96)]]
