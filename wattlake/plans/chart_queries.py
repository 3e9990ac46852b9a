"""Queries of chart tables and summaries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import charts as ch
from ..operators.portfolio import APPLIANCES
from ..sources import adapters as A
from .portfolio_queries import _FENCE, _GROSS, _metrics, on_results
from .series_queries import AL, M, W, aligned, rounded, with_sql


def share_bounds(results):
    """Results with bounds of the own-use share for most customers, as the star schema has none."""
    k = F.col("customer_id").cast("long") % 4 != 0
    return results.withColumns({"sc_ci_lower": F.when(k, F.col("sc_share") * 0.8), "sc_ci_upper": F.when(k, F.col("sc_share") * 1.1)})


def capacity_validation(spark, d):
    kwp = ch.detected_only(A.results(spark, d), "pv").select("customer_id", F.col("pv_capacity_kwp").alias("kwp"))
    return rounded(ch.capacity_validation(aligned(spark, d), kwp), 9)


QUERIES = {
    "battery_metrics": on_results(ch.battery_metrics), "battery_segments": on_results(ch.battery_segments), "population_hist": on_results(ch.population_histograms),
    "battery_capacity_hist": on_results(ch.battery_capacity_histogram), "battery_probability_hist": on_results(ch.battery_probability_histogram),
    "matched_days_means": on_results(lambda r: ch.day_counts_histogram(r, "matched_days")), "dark_days_hist": on_results(lambda r: ch.day_counts_histogram(r, "dark_days", 40)),
    "capacity_pairs": on_results(ch.capacity_pairs), "capacity_production_points": on_results(ch.capacity_production_points), "size_share_points": on_results(ch.size_share_points),
    "evaluation_dashboard": on_results(ch.evaluation_dashboard), "adoption_statistics": on_results(ch.adoption_statistics),
    "portfolio_estimates": on_results(lambda r: ch.portfolio_estimates(share_bounds(r))), "portfolio_evaluation": on_results(ch.portfolio_evaluation),
    "capacity_validation": capacity_validation, "customer_heatmap": lambda spark, d: rounded(ch.customer_heatmap(A.meter(spark, d)), 9),
    "customer_radiation_profile": lambda spark, d: rounded(ch.customer_radiation_profile(aligned(spark, d)), 9),
    "ac_kw_statistics": lambda spark, d: rounded(ch.kw_statistics(A.training(aligned(spark, d)).where("type = 'AC'"), "value_kw_mean"), 6),
}

_R = with_sql(A.RESULTS_SQL)
_J = _R + """, j AS (SELECT customer_id, coalesce(has_battery, FALSE) AS d, (lower(battery_status) = 'ok' OR lower(battery_status) LIKE 'success%') AND abs(prob_battery * 100 / 100 - 0.5::DOUBLE) >= 0.15::DOUBLE AS r,
  coalesce(has_pv, FALSE) AS p, 100 * coalesce(prob_battery, 0) AS pct, battery_capacity_kwh AS kwh, pv_capacity_kwp AS kwp, n_matched_sunny_days AS matched, n_dark_days AS dark FROM results)"""


def _share(k, n):
    return f"round(100::DOUBLE * ({k}) / greatest({n}, 1), 2)"


def _spread(values, bins, label=""):
    """Rows bin, low, high, n, mean of the values v of a table."""
    stat = f"(SELECT {bins} AS bins, min(v) AS lo, max(v) AS hi, avg(v) AS mean FROM {values} WHERE v IS NOT NULL)"
    return f"SELECT {label} bin, round(lo + bin * w, 6) AS low, round(lo + (bin + 1) * w, 6) AS high, n, round(mean, 6) AS mean FROM (SELECT CAST(least(floor((v - lo) / ((hi - lo) / bins)), bins - 1) AS INTEGER) AS bin, lo, (hi - lo) / bins AS w, mean, count(*) AS n FROM {values}, {stat} WHERE v IS NOT NULL GROUP BY ALL)"


def _days(column, step):
    return _J + f", t AS (SELECT d, {column} AS x, avg({column}) OVER (PARTITION BY d) AS mean, {step} AS step, max({column}) OVER () AS most FROM j WHERE {column} IS NOT NULL), u AS (SELECT *, CAST(ceil((most + 2) / step::DOUBLE) - 1 AS BIGINT) AS bins FROM t) SELECT d AS detected, CAST(least(x // step, bins - 1) * step AS INTEGER) AS first_day, CAST(step AS INTEGER) AS days, count(*) AS n, round(mean, 6) AS mean FROM u WHERE x <= bins * step GROUP BY ALL"


def _weighted(name, keep, lo="coalesce(sl, s)", hi="coalesce(sh, s)"):
    w = f"sum(c) FILTER ({keep})"
    mean = f"(sum(c * s) FILTER ({keep}) / {w})"
    half = f"(1.96::DOUBLE * sqrt(sum(pow(c * ({hi} - {lo}) / 3.92::DOUBLE, 2)) FILTER ({keep})) / {w})"
    cut = lambda x: f"least(greatest({x}, 0), 1)"
    return {name: mean, f"{name}_low_all": cut(f"sum(c * {lo}) FILTER ({keep}) / {w}"), f"{name}_high_all": cut(f"sum(c * {hi}) FILTER ({keep}) / {w}"), f"{name}_low_independent": cut(f"{mean} - {half}"), f"{name}_high_independent": cut(f"{mean} + {half}")}


def _wilson(a):
    k, n, z = f"count(*) FILTER (has_{a})", f"count(has_{a})::DOUBLE", "3.8416::DOUBLE"
    mid, half = f"({k} / {n} + {z} / 2 / {n})", f"(1.96::DOUBLE * sqrt({k} / {n} * (1 - {k} / {n}) / {n} + {z} / 4 / {n} / {n}))"
    return {f"{a}_detected": k, f"{a}_share_pct": f"100 * {k} / {n}", f"{a}_low_pct": f"100 * greatest(({mid} - {half}) / (1 + {z} / {n}), 0)", f"{a}_high_pct": f"100 * least(({mid} + {half}) / (1 + {z} / {n}), 1)"}


_KEPT = "SELECT pv_capacity_kwp AS c, sc_share AS s, CASE WHEN CAST(customer_id AS BIGINT) % 4 <> 0 THEN sc_share * 0.8::DOUBLE END AS sl, CASE WHEN CAST(customer_id AS BIGINT) % 4 <> 0 THEN sc_share * 1.1::DOUBLE END AS sh, coalesce(pv_ci_lower, pv_capacity_kwp) AS lo, coalesce(pv_ci_upper, pv_capacity_kwp) AS hi, pv_capacity_regression AS reg, pv_capacity_floor AS flo, yearly_prod FROM results WHERE pv_capacity_kwp > 0"
_SIGMA = "sqrt(sum(pow((hi - lo) / 3.92::DOUBLE, 2)))"
_FLAGS = "rs AS (SELECT pv_capacity_kwp, CASE WHEN coalesce(segment, 'unknown') IN (SELECT segment FROM fences) THEN coalesce(segment, 'unknown') ELSE 'other' END AS segment FROM results WHERE has_pv), fl AS (SELECT CASE WHEN pv_capacity_kwp IS NULL OR pv_capacity_kwp <= 0 THEN 'no_data' WHEN pv_capacity_kwp < low_fence THEN 'too_low' WHEN pv_capacity_kwp > high_fence THEN 'too_high' ELSE 'ok' END AS flag FROM rs LEFT JOIN fences USING (segment))"
SQL = {
    "battery_metrics": _J + _metrics("j", threshold_pct="50", reliability_margin_pct="15", total_customers="count(*)", total_pv_customers="count(*) FILTER (p)", total_non_pv_customers="count(*) FILTER (NOT p)",
        detected_battery_total="count(*) FILTER (d)", detected_battery_pv="count(*) FILTER (d AND p)", detected_battery_non_pv="count(*) FILTER (d AND NOT p)",
        detected_share_of_all_customers_pct=_share("count(*) FILTER (d)", "count(*)"), detected_share_of_pv_customers_pct=_share("count(*) FILTER (d AND p)", "count(*) FILTER (p)"), detected_non_pv_share_of_detected_pct=_share("count(*) FILTER (d AND NOT p)", "count(*) FILTER (d)"),
        reliable_total="count(*) FILTER (r)", reliable_detected="count(*) FILTER (d AND r)", reliable_detected_share_pct=_share("count(*) FILTER (d AND r)", "count(*) FILTER (d)"),
        avg_detected_battery_probability_pct="round(avg(pct) FILTER (d), 2)", median_detected_battery_probability_pct="round(quantile_cont(pct, 0.5) FILTER (d), 2)",
        avg_detected_capacity_kwh="round(avg(kwh) FILTER (d), 3)", median_detected_capacity_kwh="round(quantile_cont(kwh, 0.5) FILTER (d), 3)", p25_detected_capacity_kwh="round(quantile_cont(kwh, 0.25) FILTER (d), 3)", p75_detected_capacity_kwh="round(quantile_cont(kwh, 0.75) FILTER (d), 3)",
        avg_matched_sunny_days="round(avg(matched), 1)", median_matched_sunny_days="round(quantile_cont(matched, 0.5), 1)", avg_dark_reference_days="round(avg(dark), 1)", median_dark_reference_days="round(quantile_cont(dark, 0.5), 1)"),
    "battery_segments": _J + ", s AS (SELECT CASE WHEN p THEN 'PV customers' ELSE 'Non-PV customers' END AS segment, d FROM j UNION ALL SELECT 'Total portfolio', d FROM j) SELECT segment, count(*) AS customers, count(*) FILTER (d) AS detected_battery, count(*) FILTER (NOT d) AS not_detected, " + _share("count(*) FILTER (d)", "count(*)") + " AS detected_share_pct FROM s GROUP BY 1",
    "population_hist": _R + ", a AS (SELECT least(pv_capacity_kwp, 90) AS v FROM results WHERE pv_capacity_kwp IS NOT NULL), b AS (SELECT sc_share AS v FROM results) " + _spread("a", "40", "'pv_capacity_kwp' AS figure,") + " UNION ALL " + _spread("b", "40", "'sc_share' AS figure,"),
    "battery_capacity_hist": _J + ", a AS (SELECT kwh AS v FROM j WHERE d AND kwh > 0) " + _spread("a", "least(greatest(CAST(floor(2 * sqrt(count(*))) AS INTEGER), 12), 30)"),
    "battery_probability_hist": _J + " SELECT d AS detected, CAST(least(floor(pct / 2), 49) AS INTEGER) AS bin, count(*) AS n, round(count(*) / (SELECT count(*)::DOUBLE FROM j), 6) AS share FROM j GROUP BY ALL",
    "matched_days_means": _days("matched", "1"), "dark_days_hist": _days("dark", "greatest(max(dark) OVER () // 40, 1)"),
    "capacity_pairs": _J + " SELECT customer_id, round(kwp, 6) AS kwp, round(kwh, 6) AS kwh FROM j WHERE d AND p AND kwh IS NOT NULL AND kwp IS NOT NULL",
    "capacity_production_points": _R + " SELECT customer_id, round(pv_capacity_kwp, 6) AS pv_capacity_kwp, round(yearly_prod, 6) AS yearly_prod, round(CASE WHEN pv_ci_upper - pv_capacity_kwp < 0 THEN 0 ELSE pv_ci_upper - pv_capacity_kwp END, 6) AS error_above, round(CASE WHEN pv_capacity_kwp - pv_ci_lower < 0 THEN 0 ELSE pv_capacity_kwp - pv_ci_lower END, 6) AS error_below FROM results",
    "size_share_points": _R + " SELECT customer_id, round(greatest(coalesce(pv_capacity_kwp, 0), 0), 6) AS kwp, round(least(greatest(coalesce(sc_share, 0), 0), 1), 6) AS share FROM results WHERE has_pv",
    "evaluation_dashboard": _R + _FENCE + ", " + _FLAGS + ", a AS (SELECT pv_capacity_kwp AS v FROM results), b AS (SELECT sc_share AS v FROM results) SELECT 'capacity' AS panel, CAST(bin AS VARCHAR) AS label, n FROM (" + _spread("a", "40") + ") UNION ALL SELECT 'sc_share', CAST(bin AS VARCHAR), n FROM (" + _spread("b", "40") + ") UNION ALL SELECT 'flags', flag, count(*) FROM fl GROUP BY flag",
    "adoption_statistics": _R + _metrics("results", customers="count(*)", **{k: v for a in APPLIANCES for k, v in _wilson(a).items()}, mean_prob_ac="avg(prob_ac)", mean_prob_ac_detected="avg(prob_ac) FILTER (has_ac)", pv_customers="count(*) FILTER (has_pv)", pv_with_battery="count(*) FILTER (has_pv AND has_battery)", pv_battery_share_pct="100 * (count(*) FILTER (has_pv AND has_battery)) / (count(*) FILTER (has_pv))::DOUBLE"),
    "portfolio_estimates": _R + f", kept AS ({_KEPT})" + _metrics("kept", n_customers="count(*)", total_hybrid_kwp="sum(c)", total_regression_kwp="coalesce(sum(reg), 0)", total_floor_kwp="coalesce(sum(flo), 0)", capacity_low_all="sum(lo)", capacity_high_all="sum(hi)",
        capacity_low_independent=f"greatest(sum(c) - 1.96::DOUBLE * {_SIGMA}, 0)", capacity_high_independent=f"sum(c) + 1.96::DOUBLE * {_SIGMA}", **_weighted("sc", "s IS NOT NULL"), **_weighted("sc_nonzero", "s > 0"), n_nonzero_sc="count(*) FILTER (s > 0)", floor_to_regression="sum(flo) / sum(reg)",
        mean_kwp="avg(c)", median_kwp="quantile_cont(c, 0.5)", std_kwp="stddev_samp(c)", min_kwp="min(c)", max_kwp="max(c)", yearly_prod_kwh="coalesce(sum(yearly_prod), 0)"),
    "portfolio_evaluation": _R + _FENCE + _GROSS + ", " + _FLAGS + """, pr AS (SELECT pv_capacity_floor / pv_capacity_regression AS q FROM results WHERE has_pv AND pv_capacity_regression > 0 AND pv_capacity_floor > 0),
  ev AS (SELECT (SELECT quantile_cont(v, 0.5) FROM g) AS yield_median, (SELECT avg(v) FROM g) AS yield_mean, (SELECT stddev_samp(v) FROM g) AS yield_std, (SELECT quantile_cont(q, 0.5) FROM pr) AS ratio_median, (SELECT avg(q) FROM pr) AS ratio_mean, (SELECT stddev_samp(q) FROM pr) AS ratio_std,
    (SELECT avg(CASE WHEN q > 1 THEN 100::DOUBLE ELSE 0 END) FROM pr) AS pct_floor_gt_regression, (SELECT avg(CASE WHEN q BETWEEN 0.7 AND 1.3 THEN 100::DOUBLE ELSE 0 END) FROM pr) AS pct_within_30pct, (SELECT sum(pv_capacity_kwp) FROM results) AS total_capacity_kwp, (SELECT sum(yearly_prod) FROM results) AS total_yearly_export_kwh)"""
        + _metrics("ev", **{k: k for k in ("yield_median", "yield_mean", "yield_std", "ratio_median", "ratio_mean", "ratio_std", "pct_floor_gt_regression", "pct_within_30pct", "total_capacity_kwp", "total_yearly_export_kwh")}, implied_yield_kwh_kwp="total_yearly_export_kwh / total_capacity_kwp")
        + " UNION ALL SELECT 'yield_' || f, CAST(count(*) AS DOUBLE) FROM g GROUP BY f UNION ALL SELECT 'capacity_' || flag, CAST(count(*) AS DOUBLE) FROM fl GROUP BY flag",
    "capacity_validation": with_sql(M, W, AL, A.RESULTS_SQL) + " SELECT customer_id, ts, round(conso_kwh, 9) AS conso_kwh, round(prod_kwh, 9) AS prod_kwh, round(t_2m_c, 9) AS t_2m_c, round(global_rad_w, 9) AS global_rad_w, round(CASE WHEN global_rad_w < 0 THEN 0 ELSE global_rad_w END / 1000 * pv_capacity_kwp * 0.15::DOUBLE * 0.25::DOUBLE, 9) AS modelled_kwh FROM aligned JOIN results USING (customer_id) WHERE has_pv AND pv_capacity_kwp IS NOT NULL",
    "customer_heatmap": with_sql(M) + " SELECT customer_id, CAST(ts AS DATE) AS date, " + ", ".join(f"round(avg(conso_kwh) FILTER (hour(ts) * 4 + minute(ts) // 15 = {k}), 9) AS q{k}" for k in range(96)) + " FROM meter GROUP BY ALL",
    "customer_radiation_profile": with_sql(M, W, AL) + ", dr AS (SELECT customer_id, CAST(ts AS DATE) AS date, round(avg(global_rad_w), 9) AS rad FROM aligned GROUP BY ALL HAVING rad IS NOT NULL), bd AS (SELECT customer_id, round(quantile_cont(rad, 0.25), 9) AS lo, round(quantile_cont(rad, 0.75), 9) AS hi FROM dr GROUP BY 1), kd AS (SELECT customer_id, date, 'high' AS days FROM dr JOIN bd USING (customer_id) WHERE rad >= hi UNION ALL SELECT customer_id, date, 'low' FROM dr JOIN bd USING (customer_id) WHERE rad <= lo) SELECT a.customer_id, days, CAST(hour(ts) AS INTEGER) AS hour, round(avg(conso_kwh), 9) AS mean_kwh FROM aligned a JOIN kd ON kd.customer_id = a.customer_id AND kd.date = CAST(a.ts AS DATE) GROUP BY ALL",
    "ac_kw_statistics": with_sql(M, W, AL, A.TRAINING_SQL) + ", pc AS (SELECT customer_id, avg(value_kw_mean) AS kw FROM training WHERE type = 'AC' GROUP BY 1)" + _metrics("pc", customers="count(*)", mean_kw="avg(kw)", median_kw="quantile_cont(kw, 0.5)", mean_annual_kwh="avg(kw * 8760)"),
}
