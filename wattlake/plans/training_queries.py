"""Queries of training data: modelled tables, why customers are left out, splits, sources; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import appliances as ap
from ..operators import training as tr
from ..sources import adapters as A
from .load_queries import _AC_FEATURES, _AC_LABEL, _HP_FEATURES, _HP_LABEL, _T, SPARSE, _quality, train
from .series_queries import rounded
from .shipping import materialised


def modelled(spark, d, kind, rows=None):
    """rows: the training rows, written, where they are at hand."""
    return tr.modelled(materialised(train(spark, d)) if rows is None else rows, kind, SPARSE[kind], SPARSE["TOT"])


def numbers(df):
    return df.withColumns({c: F.col(c).cast("double") for c, kind in df.dtypes if kind in ("int", "bigint")})


def ac_modelled(spark, d):
    """Every customer's place in the training data of the air-conditioning detector, numbers as doubles."""
    return rounded(numbers(modelled(spark, d, "AC")))


def hp_modelled(spark, d):
    return rounded(numbers(modelled(spark, d, "HP")))


def skip_reasons(spark, d):
    """How many customers each rule of both tables leaves out."""
    rows = materialised(train(spark, d))
    found = [tr.reasons(modelled(spark, d, kind, rows)).withColumn("kind", F.lit(kind)) for kind in ("AC", "HP")]
    return found[0].unionByName(found[1])


def stratified_holdout(spark, d):
    """Customers of each class of the heat-pump table and how many of them are held out."""
    data = modelled(spark, d, "HP").where("reason = 'ok'")
    fit, test = tr.stratified_split(data, "target_name")
    both = fit.withColumn("test", F.lit(0)).unionByName(test.withColumn("test", F.lit(1)))
    return both.groupBy("target_name").agg(F.count("*").alias("n"), F.sum("test").alias("n_test"))


def first_source(spark, d):
    """The source of each customer's first row of the day, read from rows dealt by time."""
    rows = train(spark, d).withColumn("source", F.when(F.dayofmonth("ts") % 2 == 0, F.concat("source", F.lit("-b"))).when(F.dayofmonth("ts") % 3 != 0, F.col("source")))
    return tr.first_source(rows.repartition(7, "ts"), "ts")


def running_capacity(spark, d):
    """Solar capacity summed up from the smallest system."""
    return rounded(tr.running_capacity(A.results(spark, d)))


QUERIES = {f.__name__: f for f in (ac_modelled, hp_modelled, skip_reasons, stratified_holdout, first_source, running_capacity)}

_QUALITY = "'" + "', '".join(ap.QUALITY) + "'"
_TOTQ = """tq AS (SELECT customer_id, count(*) AS n_rows, count(*) FILTER (month(ts) IN (6, 7, 8)) AS n_summer, count(*) FILTER (month(ts) IN (12, 1, 2)) AS n_winter, coalesce(max(gap), 0) / 86400 AS max_gap_days,
    count(*) / (floor((max(epoch(ts)) - min(epoch(ts))) / 900) + 1) AS coverage FROM (SELECT *, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY customer_id ORDER BY ts) AS gap FROM training WHERE type = 'TOT') GROUP BY 1)"""


def _verdicts(kind):
    low = kind.lower()
    label = "CASE WHEN reason IN ('all_year_corr', 'hot_check', 'summer_mean_positive') THEN 'has_ac' END" if kind == "AC" else "hp_season"
    source = "l" if kind == "AC" else "hp"
    tot = "CASE WHEN q.quality IS DISTINCT FROM 'ok' THEN 'tot_' || coalesce(q.quality, 'too_few_rows') WHEN n_temp < 10 THEN 'tot_too_few_temp_rows' ELSE 'ok' END"
    other = f"CASE WHEN source NOT IN ('dataport', 'eco', 'refit') THEN 'source_without_negatives' ELSE {tot} END" if kind == "AC" else tot
    return (_T + (_AC_LABEL if kind == "AC" else f", {_HP_LABEL}") + f""", {_TOTQ},
who AS (SELECT customer_id, count(*) FILTER (type = '{kind}') AS n_own, count(*) FILTER (type = 'TOT') AS n_tot, count(temp) FILTER (type = 'TOT') AS n_temp, coalesce(min(source), 'UNKNOWN') AS source FROM training GROUP BY 1),
named AS (SELECT customer_id, {label} AS name, CASE WHEN reason IN ({_QUALITY}) THEN '{low}_' || reason ELSE reason END AS why FROM {source}),
v0 AS (SELECT who.*, CASE WHEN n_own > 0 THEN name ELSE 'no_{low}' END AS name,
  CASE WHEN n_own > 0 THEN CASE WHEN name IS NULL THEN why WHEN n_tot = 0 THEN 'no_total_curve' ELSE {tot} END WHEN n_tot > 0 THEN {other} ELSE 'no_curve' END AS reason
  FROM who LEFT JOIN named USING (customer_id) LEFT JOIN {_quality("TOT", "type = 'TOT'")} q USING (customer_id)),
rows AS (SELECT customer_id, ts, value_kw_mean AS load, temp, glob_rad AS rad FROM training JOIN v0 USING (customer_id) WHERE type = 'TOT' AND reason = 'ok')""" + (
        _AC_FEATURES + ", fx AS (SELECT m.* EXCLUDE (n_rows, used_daytime_only), CAST(used_daytime_only AS INTEGER) AS used_daytime_only, n_rows AS n_feature_rows, daytime_share, peak_hour FROM m LEFT JOIN d USING (customer_id) LEFT JOIN h USING (customer_id))" if kind == "AC"
        else _HP_FEATURES + ", fx AS (SELECT *, n_night_rows AS n_feature_rows, 1 AS used_night_only FROM hf)") + """,
v AS (SELECT customer_id, source, CASE WHEN reason = 'ok' AND n_feature_rows IS NULL THEN 'tot_too_few_night_rows' ELSE reason END AS reason, name, fx.* EXCLUDE (customer_id), tq.* EXCLUDE (customer_id)
  FROM v0 LEFT JOIN fx USING (customer_id) LEFT JOIN tq USING (customer_id))""")  # fmt: skip


def _table(kind):
    targets = " ".join(f"WHEN '{k}' THEN {v}" for k, v in tr.TARGETS[kind].items())
    names = {"AC": ["n_day_rows", "n_feature_rows", "used_daytime_only", "corr_all", "corr_hot", "corr_rad_all", "season_balance", "thermal_balance", "autocorr_4", "autocorr_96", "coeff_var", "afternoon_peak_ratio", "summer_ratio", "hot_ratio", "summer_vs_spring", "daytime_share", "peak_hour"],
             "HP": ["n_night_rows", "n_feature_rows", "used_night_only", "corr_all", "corr_hot", "corr_cold", "season_balance", "thermal_balance", "autocorr_1", "autocorr_4", "autocorr_96", "coeff_var"]}[kind]
    cols = [f"CASE WHEN reason = 'ok' THEN CAST({c} AS DOUBLE) END AS {c}" for c in (*names, "n_rows", "n_summer", "n_winter")] + [f"CASE WHEN reason = 'ok' THEN round({c}, 6) END AS {c}" for c in ("max_gap_days", "coverage")]
    return _verdicts(kind) + f" SELECT customer_id, source, reason, CASE WHEN reason = 'ok' THEN name END AS target_name, CASE WHEN reason = 'ok' THEN CAST(CASE name {targets} END AS DOUBLE) END AS target, {', '.join(cols)} FROM v"


SQL = {
    "ac_modelled": _table("AC"),
    "hp_modelled": _table("HP"),
    "skip_reasons": " UNION ALL ".join(f"SELECT * FROM ({_verdicts(k)} SELECT reason, count(*) AS n, '{k}' AS kind FROM v GROUP BY 1)" for k in ("AC", "HP")),
    "stratified_holdout": _verdicts("HP") + " SELECT name AS target_name, count(*) AS n, CAST(round(count(*) * 0.2::DOUBLE) AS BIGINT) AS n_test FROM v WHERE reason = 'ok' GROUP BY 1",
    "first_source": _T + ", s AS (SELECT customer_id, ts, CASE WHEN day(ts) % 2 = 0 THEN source || '-b' WHEN day(ts) % 3 <> 0 THEN source END AS source FROM training) SELECT customer_id, coalesce(first(source ORDER BY ts, source) FILTER (source IS NOT NULL), 'UNKNOWN') AS source FROM s GROUP BY 1",
    "running_capacity": "WITH " + A.RESULTS_SQL + " SELECT customer_id, round(pv_capacity_kwp, 6) AS pv_capacity_kwp, row_number() OVER w AS rank, round(sum(pv_capacity_kwp) OVER w, 6) AS running, round(sum(pv_capacity_kwp) OVER w / sum(pv_capacity_kwp) OVER (), 6) AS share FROM results WHERE pv_capacity_kwp IS NOT NULL WINDOW w AS (ORDER BY pv_capacity_kwp, customer_id)",
}
