"""Queries of single operators: cleaned series, scaled columns, evenings, late merges; with their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions.columns import day_night_balance
from ..operators import charts as ch
from ..operators import timeseries as ts_
from ..operators import training as tr
from ..operators import weather as wx
from ..sources import adapters as A
from ..streaming import incremental
from . import pipeline
from .chart_queries import _R, _spread
from .load_queries import _AC_FEATURES, _L
from .series_queries import AL, DAY_SQL, EV, M, W, _STEP, aligned, rounded, with_sql
from .shipping import ship


def clean_series(spark, d):
    """Events as a meter with repeated times: the smallest value of a time, on a full grid, gaps of eight steps filled."""
    e = A.meter_events(spark, d).withColumn("ts", ts_.floor_time("ts"))
    return rounded(ts_.clean_and_resample(e, ["conso_kwh"], ["conso_kwh"]), 9)


def zscore_by_customer(spark, d):
    out = ts_.zscore(A.meter(spark, d), ["conso_kwh", "prod_kwh"], ["customer_id"])
    return rounded(out.select("customer_id", "ts", "conso_kwh_norm", "prod_kwh_norm"))


def evening_window(spark, d):
    """When the sun is gone, on the days of the meter."""
    days = A.meter(spark, d).select(F.to_date("ts").alias("date")).distinct()
    return wx.evening_start(A.weather(spark)).join(days, "date", "left_semi")


def evening_window_by_customer(spark, d):
    """The same of each customer's own readings, on days when the threshold is passed and on days when it is not."""
    return wx.evening_start(aligned(spark, d), ["customer_id"], 150.0)


def day_night_share(spark, d):
    """Balance of day and night where the radiation of every third day is unknown, with and without those rows."""
    rad = F.when(F.dayofmonth("ts") % 3 != 0, F.col("global_rad_w"))
    a = aligned(spark, d).withColumn("rad", rad)
    return rounded(a.groupBy("customer_id").agg(day_night_balance("conso_kwh", "rad").alias("unknown_is_night"), day_night_balance("conso_kwh", "rad", unknown_is_night=False).alias("known_only")))


def first_customers(spark, d):
    """Energy of the first five customers by id."""
    return rounded(ts_.first_keys(A.meter(spark, d), 5).groupBy("customer_id").agg(F.sum("conso_kwh").alias("kwh"), F.count("*").alias("n")))


def late_merge(spark, d):
    """Results of a run without solar steps, merged with what the steps wrote for some customers of it and some others."""
    r = A.results(spark, d)
    k = F.col("customer_id").cast("long")
    run = r.where(k % 3 != 0).select("customer_id", "prob_battery", "sc_share")
    steps = {"has_pv": r.where(k % 2 == 0).select("customer_id", F.lit(1.0).alias("has_pv"), "prob_pv"), "pv_capacity_kwp": r.where(k % 4 == 0).select("customer_id", "pv_capacity_kwp", F.lit(-1.0).alias("sc_share"))}
    return rounded(ch.late_merge(run, steps))


def dashboard_points(spark, d):
    """Capacity against production, which the indicators add."""
    r = A.results(spark, d)
    return rounded(ch.dashboard_points(r.drop("yearly_prod"), r.where("has_pv").select("customer_id", F.col("yearly_prod").alias("yearly_prod_kwh"))))


def ev_energy_hist(spark, d):
    return rounded(ch.ev_energy_histogram(A.results(spark, d)))


def summer_features(spark, d):
    """The air-conditioning features of June to August alone."""
    return rounded(tr.series_features(A.meter(spark, d), A.weather(spark), "AC", (6, 7, 8)))


def coverage_report(spark, d):
    """Whether the weather covers the meter; flags as numbers."""
    r = pipeline.coverage_report(A.meter(spark, d), A.weather(spark))
    return r.withColumn("short", F.col("short").cast("int"))


def restricted_results(spark, d):
    """Detected heat pumps among the first customers of the results."""
    r = A.results(spark, d)
    return rounded(ch.detected_only(ch.restricted(r, ts_.first_keys(r.select("customer_id"), 200)), "hp").select("customer_id", "hp_type", "hp_energy_kwh"))


def day_sets(spark, d):
    """Days on which customer 4 produced against bright days of the years of the meter."""
    m = A.meter(spark, d)
    sun = m.where("customer_id = '4' and prod_kwh > 0").select(F.to_date("ts").alias("date"))
    bright = wx.weather_day(A.weather(spark)).where("rad_bucket = 'high' and year(date) between 1996 and 1997").select("date")
    return ts_.set_parts(sun, bright)


def longest_rise(rows):
    """A user's function of one customer's rows: how often in a row consumption rose at most."""
    rows = rows.sort_values("ts")
    up = (rows["conso_kwh"].diff() > 1e-9).astype(int)
    best = int(up.groupby((up == 0).cumsum()).sum().max()) if len(up) else 0
    return pd.DataFrame({"customer_id": rows["customer_id"].iloc[:1], "longest": [best][: len(rows)]})


def user_function(spark, d):
    """A function of a user over each customer's rows."""
    ship(spark)
    return incremental.apply_by_customer(A.meter(spark, d).select("customer_id", "ts", "conso_kwh"), longest_rise, "customer_id string, longest long")


QUERIES = {f.__name__: f for f in (clean_series, zscore_by_customer, evening_window, evening_window_by_customer, day_night_share, first_customers, late_merge, dashboard_points, ev_energy_hist, summer_features, coverage_report, restricted_results, day_sets, user_function)}

_MEAN = "avg(conso_kwh) FILTER ({0})"
_PART = "round(({0} - {1}) / (abs({0}) + abs({1}) + 1e-8), 6)"
_DAY, _NIGHT, _KNOWN = _MEAN.format("coalesce(rad > 50, FALSE)"), _MEAN.format("NOT coalesce(rad > 50, FALSE)"), _MEAN.format("rad <= 50")


def _evening(source, keys, below):
    return f"""e0 AS (SELECT {keys} CAST(ts AS DATE) AS date, ts, global_rad_w AS rad FROM {source} WHERE global_rad_w IS NOT NULL),
e1 AS (SELECT {keys} date, min(ts) AS peak FROM (SELECT *, max(rad) OVER (PARTITION BY {keys} date) AS top FROM e0) WHERE rad = top GROUP BY ALL),
e2 AS (SELECT {keys} date, peak, min(CASE WHEN ts >= peak AND rad < {below} THEN ts END) AS evening FROM e0 JOIN e1 USING ({keys} date) GROUP BY ALL)"""


SQL = {
    "clean_series": with_sql(EV, _STEP) + """,
one AS (SELECT customer_id, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS ts, min(conso_kwh) AS v FROM meter_events GROUP BY ALL),
f AS (SELECT customer_id, ts, v FROM grid LEFT JOIN one USING (customer_id, ts)),
near AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS t0, first_value(v IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER a AS t1 FROM f
  WINDOW b AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT customer_id, ts, round(greatest(coalesce(CASE WHEN v IS NOT NULL THEN v WHEN ts - t0 <= INTERVAL 120 MINUTE THEN v0 + (v1 - v0) * epoch(ts - t0) / epoch(t1 - t0) END, 0), 0), 9) AS conso_kwh FROM near""",
    "zscore_by_customer": with_sql(M) + ", s AS (SELECT customer_id, avg(conso_kwh) AS mc, stddev_samp(conso_kwh) AS sc, avg(prod_kwh) AS mp, stddev_samp(prod_kwh) AS sp FROM meter GROUP BY 1) SELECT customer_id, ts, round(CASE WHEN sc > 0 THEN (conso_kwh - mc) / sc ELSE 0 END, 6) AS conso_kwh_norm, round(CASE WHEN sp > 0 THEN (prod_kwh - mp) / sp ELSE 0 END, 6) AS prod_kwh_norm FROM meter JOIN s USING (customer_id)",
    "evening_window": with_sql(M, W) + ", " + _evening("weather", "", 20) + " SELECT * FROM e2 WHERE date IN (SELECT CAST(ts AS DATE) FROM meter)",
    "evening_window_by_customer": with_sql(M, W, AL) + ", " + _evening("aligned", "customer_id,", 150) + " SELECT * FROM e2",
    "day_night_share": with_sql(M, W, AL) + f", a AS (SELECT *, CASE WHEN day(ts) % 3 <> 0 THEN global_rad_w END AS rad FROM aligned) SELECT customer_id, {_PART.format(_DAY, _NIGHT)} AS unknown_is_night, {_PART.format(_DAY, _KNOWN)} AS known_only FROM a GROUP BY 1",
    "first_customers": with_sql(M) + " SELECT customer_id, round(sum(conso_kwh), 6) AS kwh, count(*) AS n FROM meter WHERE customer_id IN (SELECT DISTINCT customer_id FROM meter ORDER BY 1 LIMIT 5) GROUP BY 1",
    "late_merge": _R + """ SELECT customer_id, round(r.prob_battery, 6) AS prob_battery, round(r.sc_share, 6) AS sc_share, a.has_pv, round(a.prob_pv, 6) AS prob_pv, round(b.pv_capacity_kwp, 6) AS pv_capacity_kwp
FROM (SELECT customer_id, prob_battery, sc_share FROM results WHERE CAST(customer_id AS BIGINT) % 3 <> 0) r FULL JOIN (SELECT customer_id, 1.0::DOUBLE AS has_pv, prob_pv FROM results WHERE CAST(customer_id AS BIGINT) % 2 = 0) a USING (customer_id)
FULL JOIN (SELECT customer_id, pv_capacity_kwp FROM results WHERE CAST(customer_id AS BIGINT) % 4 = 0) b USING (customer_id)""",
    "dashboard_points": _R + " SELECT customer_id, round(pv_capacity_kwp, 6) AS kwp, round(yearly_prod, 6) AS kwh FROM results WHERE has_pv AND pv_capacity_kwp IS NOT NULL AND yearly_prod IS NOT NULL",
    "ev_energy_hist": _R + ", a AS (SELECT ev_energy_mwh AS v FROM results WHERE ev_energy_mwh > 0) " + _spread("a", 30),
    "coverage_report": with_sql(M, W) + " SELECT meter_start, meter_end, weather_start, weather_end, CASE WHEN date_diff('day', CAST(meter_start AS DATE), CAST(weather_start AS DATE)) > 30 OR date_diff('day', CAST(weather_end AS DATE), CAST(meter_end AS DATE)) > 30 THEN 1 ELSE 0 END AS short FROM (SELECT min(ts) AS meter_start, max(ts) AS meter_end FROM meter), (SELECT min(ts) AS weather_start, max(ts) AS weather_end FROM weather)",
    "restricted_results": _R + " SELECT customer_id, hp_type, round(hp_energy_kwh, 6) AS hp_energy_kwh FROM results WHERE has_hp AND customer_id IN (SELECT customer_id FROM results ORDER BY 1 LIMIT 200)",
    "day_sets": with_sql(M, W, DAY_SQL) + """, s AS (SELECT CAST(ts AS DATE) AS date FROM meter WHERE customer_id = '4' AND prod_kwh > 0), b AS (SELECT date FROM wday WHERE rad_bucket = 'high' AND year(date) BETWEEN 1996 AND 1997)
SELECT date, 'both' AS part FROM (SELECT * FROM s INTERSECT SELECT * FROM b) UNION ALL SELECT date, 'left' FROM (SELECT * FROM s EXCEPT SELECT * FROM b) UNION ALL SELECT date, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM s)""",
    "user_function": with_sql(M) + """, u AS (SELECT customer_id, ts, coalesce(conso_kwh - lag(conso_kwh) OVER (PARTITION BY customer_id ORDER BY ts) > 1e-9, FALSE) AS up FROM meter),
g AS (SELECT customer_id, up, sum(CASE WHEN up THEN 0 ELSE 1 END) OVER (PARTITION BY customer_id ORDER BY ts) AS run FROM u) SELECT customer_id, CAST(max(n) AS BIGINT) AS longest FROM (SELECT customer_id, run, sum(CASE WHEN up THEN 1 ELSE 0 END) AS n FROM g GROUP BY ALL) GROUP BY 1""",
    "summer_features": _L.replace("FROM aligned)", "FROM aligned WHERE month(ts) IN (6, 7, 8))") + _AC_FEATURES.replace("n_day_rows < 100", "n_day_rows < 50").replace(">= 100 AS used", ">= 50 AS used") + " SELECT * FROM m LEFT JOIN d USING (customer_id) LEFT JOIN h USING (customer_id)",
}
