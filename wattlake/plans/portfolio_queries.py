"""Queries of portfolio statistics and chart tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import slot_of_day
from ..operators import charts as ch
from ..operators import portfolio as pf
from ..operators.weather import weather_day
from ..sources import adapters as A
from .series_queries import DAY_SQL, M, W, rounded, with_sql


def on_results(f):
    return lambda spark, d: rounded(f(A.results(spark, d)))


def high_low_profile(spark, d):
    """Mean load by hour on sunny and dull days."""
    m = A.meter(spark, d).withColumn("date", F.to_date("ts"))
    days = weather_day(A.weather(spark)).where("rad_bucket in ('high', 'low')").select("date", "rad_bucket")
    return rounded(m.join(days, "date").groupBy("rad_bucket", F.hour("ts").alias("hour")).agg(F.avg(F.col("conso_kwh") * 4).alias("mean_kw")))


def heatmap(spark, d):
    """Mean load by month and quarter-hour of the day, a column each four hours."""
    m = A.meter(spark, d).select(F.date_format("ts", "yyyy-MM").alias("month"), F.floor(slot_of_day("ts") / 16).cast("int").alias("part"), "conso_kwh")
    wide = m.groupBy("month").pivot("part", list(range(6))).agg(F.avg("conso_kwh"))
    return rounded(wide.select("month", *[F.col(str(k)).alias(f"p{k}") for k in range(6)]), 9)


QUERIES = {
    "portfolio_aggregate": on_results(pf.portfolio_totals), "segment_fences": on_results(pf.segment_fences), "capacity_flags": on_results(lambda r: pf.capacity_flags(r, pf.segment_fences(r))),
    "yield_gross": on_results(pf.yield_gross), "yield_export": on_results(pf.yield_export), "evaluate_agreement": on_results(pf.evaluate_agreement),
    "battery_summary": on_results(pf.battery_summary), "battery_overview": on_results(pf.battery_overview), "adoption_wilson": on_results(pf.adoption), "cooccurrence": on_results(pf.cooccurrence), "exclusive_pairs": on_results(pf.exclusive_pairs),
    "probability_hist": on_results(lambda r: pf.histogram(pf.long_flags(r), "prob", 0.0, 1.0, 30, ["appliance"])), "capacity_hist": on_results(pf.capacity_histogram), "battery_status_top": on_results(pf.status_breakdown), "battery_box": on_results(pf.box_statistics),
    "hp_mix": on_results(ch.hp_mix), "matched_days_hist": on_results(lambda r: pf.days_histogram(r, "n_matched_sunny_days")),
    "hp_kde": on_results(lambda r: pf.density(r.where("has_hp"), "hp_energy_kwh")), "high_low_profile": high_low_profile, "heatmap": heatmap,
}

_R = with_sql(A.RESULTS_SQL)
_PV = ", pv AS (SELECT * FROM results WHERE has_pv AND pv_capacity_kwp IS NOT NULL)"
_FENCE = _PV + """, sg0 AS (SELECT coalesce(segment, 'unknown') AS segment, pv_capacity_kwp AS c FROM pv WHERE pv_capacity_kwp > 0),
sg AS (SELECT CASE WHEN count(*) OVER (PARTITION BY segment) < 30 THEN 'other' ELSE segment END AS segment, c FROM sg0),
st AS (SELECT segment, count(*) AS n, avg(c) AS mean, quantile_cont(c, 0.5) AS median, quantile_cont(c, 0.25) AS q25, quantile_cont(c, 0.75) AS q75 FROM sg GROUP BY 1),
fences AS (SELECT *, greatest(q25 - 2 * (q75 - q25), 0) AS low_fence, q75 + 2 * (q75 - q25) AS high_fence FROM st)"""
_GROSS = ", y AS (SELECT customer_id, CASE WHEN pv_capacity_kwp > 0 THEN yearly_prod / (1 - least(greatest(coalesce(sc_share, 0), 0), 0.7::DOUBLE)) / pv_capacity_kwp END AS v FROM results WHERE has_pv), g AS (SELECT customer_id, v, CASE WHEN v IS NULL THEN 'no_data' WHEN v < 800 THEN 'too_low' WHEN v > 1200 THEN 'too_high' ELSE 'ok' END AS f FROM y)"
_BAT = ", b AS (SELECT *, coalesce(has_battery, prob_battery >= 0.5) AS d, lower(battery_status) IN ('success', 'ok') AND abs(prob_battery - 0.5) >= 0.15 AS r, coalesce(has_pv, FALSE) AS p, battery_capacity_kwh AS c FROM results)"
_LONG = ", long AS (" + " UNION ALL ".join(f"SELECT '{a}' AS appliance, has_{a} AS has, prob_{a} AS prob FROM results" for a in pf.APPLIANCES) + ")"


def _metrics(source, **cols):
    one = ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS {k}" for k, e in cols.items())
    return f", one AS (SELECT {one} FROM {source}) " + " UNION ALL ".join(f"SELECT '{k}' AS metric, {k} AS value FROM one" for k in cols)


_SE = "((coalesce(pv_ci_upper, pv_capacity_kwp) - coalesce(pv_ci_lower, pv_capacity_kwp)) / (2 * 1.96::DOUBLE))"
_Z = "(sum({s}pv_capacity_kwp) {o} 1.96::DOUBLE * sqrt(sum(" + _SE + " * " + _SE + ")))"
_AGREE = ", x AS (SELECT pv_capacity_floor / pv_capacity_regression AS ratio FROM results WHERE has_pv AND pv_capacity_regression > 0), agree AS (SELECT (SELECT count(*) FROM x) AS n, (SELECT avg(ratio) FROM x) AS mean_ratio, (SELECT quantile_cont(ratio, 0.5) FROM x) AS median_ratio, (SELECT avg(CASE WHEN ratio BETWEEN 0.7 AND 1.3 THEN 1.0::DOUBLE ELSE 0 END) FROM x) AS share_agreeing, (SELECT avg(v) FROM g) AS mean_yield, (SELECT quantile_cont(v, 0.5) FROM g) AS median_yield, (SELECT avg(CASE WHEN f = 'ok' THEN 1.0::DOUBLE ELSE 0 END) FROM g) AS share_plausible)"
SQL = {
    "portfolio_aggregate": _R + _PV + _metrics("pv", n_pv="count(*)", capacity_kwp="sum(pv_capacity_kwp)", capacity_low_all="sum(coalesce(pv_ci_lower, pv_capacity_kwp))", capacity_high_all="sum(coalesce(pv_ci_upper, pv_capacity_kwp))",
        capacity_low_independent=_Z.format(s="", o="-"), capacity_high_independent=_Z.format(s="", o="+"), mean_kwp="avg(pv_capacity_kwp)", median_kwp="quantile_cont(pv_capacity_kwp, 0.5)", q25_kwp="quantile_cont(pv_capacity_kwp, 0.25)", q75_kwp="quantile_cont(pv_capacity_kwp, 0.75)",
        sc_weighted="sum(pv_capacity_kwp * sc_share) FILTER (pv_capacity_kwp > 0) / sum(pv_capacity_kwp) FILTER (pv_capacity_kwp > 0 AND sc_share IS NOT NULL)", sc_weighted_nonzero="sum(pv_capacity_kwp * sc_share) FILTER (pv_capacity_kwp > 0 AND sc_share > 0) / sum(pv_capacity_kwp) FILTER (pv_capacity_kwp > 0 AND sc_share > 0)", yearly_prod="sum(yearly_prod)"),
    "segment_fences": _R + _FENCE + " SELECT segment, n, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("mean", "median", "q25", "q75", "low_fence", "high_fence")) + " FROM fences",
    "capacity_flags": _R + _FENCE + ", rs AS (SELECT customer_id, pv_capacity_kwp, CASE WHEN coalesce(segment, 'unknown') IN (SELECT segment FROM fences) THEN coalesce(segment, 'unknown') ELSE 'other' END AS segment FROM results WHERE has_pv) SELECT customer_id, segment, round(pv_capacity_kwp, 6) AS pv_capacity_kwp, CASE WHEN pv_capacity_kwp IS NULL OR pv_capacity_kwp <= 0 THEN 'no_data' WHEN pv_capacity_kwp < low_fence THEN 'too_low' WHEN pv_capacity_kwp > high_fence THEN 'too_high' ELSE 'ok' END AS capacity_flag FROM rs LEFT JOIN fences USING (segment)",
    "yield_gross": _R + _GROSS + " SELECT customer_id, round(v, 6) AS yield_kwh_kwp, f AS yield_flag FROM g",
    "yield_export": _R + ", y AS (SELECT customer_id, CASE WHEN pv_capacity_kwp > 0 THEN yearly_prod / pv_capacity_kwp END AS v FROM results WHERE has_pv) SELECT customer_id, round(v, 6) AS yield_kwh_kwp, CASE WHEN v IS NULL THEN 'missing' WHEN v < 600 THEN 'low' WHEN v > 1400 THEN 'high' ELSE 'ok' END AS yield_check FROM y",
    "evaluate_agreement": _R + _GROSS + _AGREE + _metrics("agree", n="n", mean_ratio="mean_ratio", median_ratio="median_ratio", share_agreeing="share_agreeing", mean_yield="mean_yield", median_yield="median_yield", share_plausible="share_plausible"),
    "battery_summary": _R + _BAT + _metrics("b", n_customers="count(*)", n_pv="count(*) FILTER (p)", n_detected="count(*) FILTER (d)", n_detected_pv="count(*) FILTER (d AND p)", n_detected_no_pv="count(*) FILTER (d AND NOT p)", n_reliable="count(*) FILTER (r)", n_unreliable="count(*) FILTER (NOT r)", n_detected_reliable="count(*) FILTER (d AND r)",
        share_detected="count(*) FILTER (d) / count(*)::DOUBLE", share_detected_of_pv="count(*) FILTER (d AND p) / count(*) FILTER (p)::DOUBLE", n_with_capacity="count(*) FILTER (d AND c IS NOT NULL)", n_without_capacity="count(*) FILTER (d AND c IS NULL)",
        capacity_kwh="sum(c) FILTER (d)", mean_kwh="avg(c) FILTER (d)", median_kwh="quantile_cont(c, 0.5) FILTER (d)", q25_kwh="quantile_cont(c, 0.25) FILTER (d)", q75_kwh="quantile_cont(c, 0.75) FILTER (d)", mean_prob="avg(prob_battery)", mean_prob_detected="avg(prob_battery) FILTER (d)",
        mean_matched_days_detected="avg(n_matched_sunny_days) FILTER (d)", mean_matched_days_other="avg(n_matched_sunny_days) FILTER (NOT d)"),
    "battery_overview": _R + _BAT + " SELECT CASE WHEN grouping(p) = 1 THEN 'all' WHEN p THEN 'pv' ELSE 'no_pv' END AS segment, count(*) AS n, count(*) FILTER (d) AS n_detected, round(avg(c) FILTER (d), 6) AS mean_kwh, round(quantile_cont(c, 0.5) FILTER (d), 6) AS median_kwh FROM b GROUP BY ROLLUP (p)",
    "adoption_wilson": _R + _LONG + ", a AS (SELECT appliance, count(*) FILTER (has) AS k, count(*) AS n, avg(prob) AS mean_prob FROM long GROUP BY 1), w AS (SELECT *, k / n::DOUBLE AS share, 1 + 1.96::DOUBLE * 1.96::DOUBLE / n AS s, k / n::DOUBLE + 1.96::DOUBLE * 1.96::DOUBLE / 2 / n AS mid, 1.96::DOUBLE * sqrt(k / n::DOUBLE * (1 - k / n::DOUBLE) / n + 1.96::DOUBLE * 1.96::DOUBLE / 4 / n / n) AS half FROM a) SELECT appliance, k, n, round(share, 6) AS share, round(greatest((mid - half) / s, 0), 6) AS low, round(least((mid + half) / s, 1), 6) AS high, round(mean_prob, 6) AS mean_prob FROM w",
    "cooccurrence": _R + " " + " UNION ALL ".join(f"SELECT '{a}' AS first, '{b}' AS second, count(*) FILTER (has_{a} AND has_{b}) AS k, round(count(*) FILTER (has_{a} AND has_{b}) / count(*)::DOUBLE, 6) AS share FROM results" for a in pf.APPLIANCES for b in pf.APPLIANCES),
    "exclusive_pairs": _R + _metrics("results", **{f"{a}_{b}_{n}": f"count(*) FILTER ({c})" for a, b in (("pv", "battery"), ("pv", "ev"), ("ev", "battery")) for n, c in (("first", f"has_{a} AND NOT has_{b}"), ("second", f"has_{b} AND NOT has_{a}"), ("both", f"has_{a} AND has_{b}"))}),
    "probability_hist": _R + _LONG + " SELECT appliance, CAST(least(floor(prob / (1 / 30::DOUBLE)), 29) AS INTEGER) AS bin, count(*) AS n FROM long WHERE prob BETWEEN 0 AND 1 GROUP BY ALL",
    "capacity_hist": _R + _PV + " SELECT CAST(CASE WHEN pv_capacity_kwp > 100 THEN -1 ELSE floor(pv_capacity_kwp / 2) END AS INTEGER) AS bin, count(*) AS n FROM pv GROUP BY 1",
    "battery_status_top": _R + ' SELECT battery_status, count(*) AS "count" FROM results GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12',
    "battery_box": _R + _BAT + ", e AS (SELECT CASE WHEN p THEN 'pv' ELSE 'no_pv' END AS segment, c FROM b WHERE d AND c IS NOT NULL UNION ALL SELECT 'all', c FROM b WHERE d AND c IS NOT NULL) SELECT segment, count(*) AS n, min(c) AS low, round(quantile_cont(c, 0.25), 6) AS q25, round(quantile_cont(c, 0.5), 6) AS median, round(quantile_cont(c, 0.75), 6) AS q75, max(c) AS high FROM e GROUP BY 1",
    "hp_mix": _R + " SELECT hp_type, count(*) AS n FROM results GROUP BY 1",
    "matched_days_hist": _R + _BAT + " SELECT d AS detected, n_matched_sunny_days, count(*) AS n FROM b GROUP BY ALL",
    "hp_kde": _R + ", v AS (SELECT hp_energy_kwh AS v FROM results WHERE has_hp AND hp_energy_kwh > 0), s AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM v), g AS (SELECT lo - 0.5::DOUBLE * (hi - lo) + 2 * (hi - lo) * i / 999 AS x, sd * pow(n, -0.2::DOUBLE) AS h FROM s, range(1000) t(i)) SELECT round(x, 6) AS x, round(avg(exp(-0.5::DOUBLE * pow((x - v) / h, 2)) / (h * 2.5066282746310002::DOUBLE)), 6) AS density FROM g, v GROUP BY x",
    "high_low_profile": with_sql(M, W, DAY_SQL) + " SELECT rad_bucket, CAST(hour(ts) AS INTEGER) AS hour, round(avg(conso_kwh * 4), 6) AS mean_kw FROM meter JOIN wday ON wday.date = CAST(ts AS DATE) WHERE rad_bucket IN ('high', 'low') GROUP BY ALL",
    "heatmap": with_sql(M) + " SELECT strftime(ts, '%Y-%m') AS month, " + ", ".join(f"round(avg(conso_kwh) FILTER (hour(ts) // 4 = {k}), 9) AS p{k}" for k in range(6)) + " FROM meter GROUP BY 1",
}
