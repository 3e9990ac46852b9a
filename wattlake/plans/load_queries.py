"""Queries of electric cars, batteries, air conditioning and heat pumps, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import appliances as ap
from ..operators import battery, ev, pv
from ..sources import adapters as A
from ..sources import readers
from .pipeline import join_scalar as pipeline_join
from .series_queries import AL, CAP_SQL, CDAY_SQL, DAY_SQL, EV, FACTS_SQL, INDICATORS_SQL, M, W, _STEP, aligned, rounded, with_sql
from .shipping import materialised


def rows(spark, d):
    return ap.load_rows(aligned(spark, d))


def train(spark, d):
    return A.training(aligned(spark, d))


def ev_detect(spark, d):
    return rounded(ev.detect_ev(A.meter(spark, d), grid_kw=0.4, least=3, spread=0.6))


def ev_sessions(spark, d):
    return rounded(ev.ev_sessions(A.meter_events(spark, d), step_kwh=0.1, least_minutes=30))


def hp_features(spark, d):
    return rounded(ap.hp_features(rows(spark, d)))


def ac_features(spark, d):
    return rounded(ap.ac_features(rows(spark, d)))


def user_profile_ac(spark, d):
    return rounded(ap.load_profile(rows(spark, d)))


def user_profile_hp(spark, d):
    return rounded(ap.load_profile(rows(spark, d), heat=True))


def disagg_features_ac(spark, d):
    return rounded(ap.disagg_features(rows(spark, d)), 9)


def disagg_features_hp(spark, d):
    return rounded(ap.disagg_features(rows(spark, d), heat=True), 9)


def curve_quality(spark, d):
    return rounded(ap.usable(ap.curve_quality(train(spark, d), ["type", "customer_id"]), 500, 100, 100, 40.0, 0.001))


#: Rules of usability for the meter of the star schema, whose customers have a row each few days.
SPARSE = {"AC": (500, 0, 100, 60.0, 0.001), "HP": (500, 100, 100, 60.0, 0.001), "TOT": (500, 0, 0, 90.0, 0.001)}


def curves(spark, d, kind):
    return train(spark, d).where(F.col("type") == kind).withColumnRenamed("value_kw_mean", "kw")


def ac_label(spark, d):
    return rounded(ap.ac_label(curves(spark, d, "AC"), SPARSE["AC"]))


def hp_label(spark, d):
    return rounded(ap.hp_label(curves(spark, d, "HP"), SPARSE["HP"]))


def align_tot_ac(spark, d):
    return rounded(ap.aligned_pairs(train(spark, d), "AC", SPARSE["TOT"]), 9)


def align_tot_hp(spark, d):
    return rounded(ap.aligned_pairs(train(spark, d), "HP", SPARSE["TOT"], SPARSE["HP"]), 9)


def sample_weights(spark, d):
    """1 / rows of the customer, scaled to a mean of 1."""
    t = ap.row_weights(train(spark, d).where("type = 'TOT'").select("customer_id"))
    return rounded(t.groupBy("customer_id").agg(F.count("*").alias("n"), F.min("sample_weight").alias("sample_weight")))


def f_to_c(spark, d):
    """Customers whose highest temperature is over 55 are taken to be in Fahrenheit."""
    t = rows(spark, d).withColumn("temp", F.when(F.col("customer_id").cast("long") % 2 == 0, F.col("temp") * 9 / 5 + 32).otherwise(F.col("temp")))
    return rounded(ap.in_celsius(t).select("customer_id", "ts", "temp"))


def appliance_manifest(spark, d):
    """Customers with any non-zero appliance curve, one flag each."""
    # a row a reading, each in its own column: flags need no table of times
    own = [F.when(F.col("type") == kind, F.col("value_kw_mean")).alias(kind) for kind in ("AC", "HP")]
    wide = train(spark, d).where("type <> 'TOT'").select(F.lit("r").alias("region"), F.col("customer_id").alias("dataid"), *own)
    found = readers.appliance_households(wide, {"ac": ["AC"], "hp": ["HP"]})
    return found.select(F.col("dataid").alias("customer_id"), "has_ac", "has_hp")


def pv_facts(spark, d):
    m, w = A.meter(spark, d), A.weather(spark)
    facts = pv.detect_pv(m, w).select("customer_id", "has_pv", "prob_pv").join(pv.pv_capacity_point(m, w).select("customer_id", F.when(F.col("hybrid_kwp") >= 0.1, F.col("hybrid_kwp")).alias("pv_capacity_kwp")), "customer_id", "left")
    return materialised(facts)  # one row a customer


def battery_detect(spark, d):
    return rounded(battery.detect_battery(A.meter(spark, d), A.weather(spark), pv_facts(spark, d)), 4)


def rebuilt_load(spark, d):
    """Load of all customers; on every third day of a month the production is unknown."""
    al = aligned(spark, d).withColumn("prod_kwh", F.when(F.dayofmonth("ts") % 3 != 0, F.col("prod_kwh")))
    return rounded(ap.rebuilt_load(al, pv_facts(spark, d).where("has_pv").select("customer_id", "pv_capacity_kwp")))


def join_scalar(spark, d):
    """Scalar results side by side: full outer joins on the customer, the right side's own columns only; flags as numbers."""
    parts = [pv_facts(spark, d), ev.detect_ev(A.meter(spark, d), grid_kw=0.4, least=3, spread=0.6).where("sessions > 0").select("customer_id", "has_ev", "prob_ev"), ap.hp_features(rows(spark, d)).select("customer_id", "n_night_rows"), ap.ac_label(curves(spark, d, "AC"), SPARSE["AC"]).select("customer_id", "has_ac")]
    out = pipeline_join(parts)
    return rounded(out.select("customer_id", *[F.col(c).cast("double").alias(c) for c in out.columns if c != "customer_id"]))


def annual_kwh(spark, d):
    """Energy of each appliance curve by customer."""
    return rounded(ap.annual_energy(train(spark, d).where("type <> 'TOT'"), "value_kw_mean", ["type", "customer_id"]))


QUERIES = {f.__name__: f for f in (ev_detect, ev_sessions, hp_features, ac_features, user_profile_ac, user_profile_hp, disagg_features_ac, disagg_features_hp, curve_quality, ac_label, hp_label, align_tot_ac, align_tot_hp, sample_weights, f_to_c, appliance_manifest, battery_detect, rebuilt_load, join_scalar, annual_kwh)}

_ROWS = """
rows AS (SELECT customer_id, ts, conso_kwh * 4 AS load, t_2m_c AS temp, global_rad_w AS rad FROM aligned)"""
_T = with_sql(M, W, AL, A.TRAINING_SQL.replace("training AS (", "training AS MATERIALIZED ("))
_L = with_sql(M, W, AL, _ROWS)
_BAL = "round(({0} - {1}) / (abs({0}) + abs({1}) + 1e-8), 6)"


def _corr(x, y, where="TRUE", least=10):
    f = f"FILTER ({where} AND {x} IS NOT NULL AND {y} IS NOT NULL)"
    return f"round(CASE WHEN count(*) {f} >= {least} AND min({x}) {f} < max({x}) {f} AND min({y}) {f} < max({y}) {f} THEN corr({x}, {y}) {f} END, 6)"


def _mean(where):
    return f"avg(load) FILTER ({where})"


_S, _WI, _SP = "month(ts) IN (6, 7, 8)", "month(ts) IN (12, 1, 2)", "month(ts) IN (3, 4, 5)"


def _features(third, hot, cold, lags):
    auto = ", ".join(f"CASE WHEN count(*) > {k + 2} THEN {_corr('load', f'lag_{k}', least=2)} END AS autocorr_{k}" for k in lags)
    return f"""{_corr('load', 'temp')} AS corr_all, {_corr('load', 'temp', f'temp > {hot}')} AS corr_hot, {third},
  {_BAL.format(_mean(_S), _mean(_WI))} AS season_balance, {_BAL.format(_mean(f'temp > {hot}'), _mean(f'temp < {cold}'))} AS thermal_balance, {auto},
  round(stddev_samp(load) / (abs(avg(load)) + 1e-8), 6) AS coeff_var"""


_LAGGED = "lagged AS (SELECT *, lag(load, 1) OVER w AS lag_1, lag(load, 4) OVER w AS lag_4, lag(load, 96) OVER w AS lag_96 FROM part WINDOW w AS (PARTITION BY customer_id ORDER BY ts))"
def _profile(sun, kw):
    return f""", q AS (SELECT customer_id, quantile_cont(load, 0.05) AS q05, quantile_cont(load, 0.10) AS q10, quantile_cont(load, 0.50) AS q50, quantile_cont(load, 0.95) AS q95, avg(load) AS mean, stddev_samp(load) AS std,
    avg(load) FILTER (rad <= {sun}) AS night_mean, avg(load) FILTER (rad > {sun}) AS day_mean FROM rows GROUP BY 1),
b AS (SELECT customer_id, avg(CASE WHEN load > q10 + {kw}::DOUBLE THEN 1.0::DOUBLE ELSE 0 END) AS share_above_base FROM rows JOIN q USING (customer_id) GROUP BY 1),
p AS (SELECT q.*, share_above_base, day_mean / (night_mean + 1e-6) AS day_night_ratio, mean / (q95 + 1e-6) AS load_factor, std / (abs(mean) + 1e-6) AS spike, q10 / (mean + 1e-6) AS base_share FROM q JOIN b USING (customer_id)),
s AS (SELECT *, least(greatest(0.5::DOUBLE * least(greatest(coalesce(load_factor, 0), 0), 1) + 0.3::DOUBLE * coalesce(share_above_base, 0) - 0.15::DOUBLE * least(greatest(coalesce(spike, 0) / 2.5::DOUBLE, 0), 1) - 0.05::DOUBLE * least(abs(coalesce(day_night_ratio, 1) - 1), 2) / 2, 0), 1) AS hp_likeness FROM p)"""


_PNAMES = ("q10", "q50", "q95", "mean", "std", "night_mean", "day_mean", "share_above_base", "day_night_ratio", "load_factor", "spike", "base_share")
_PCOLS = ", ".join(f"round({c}, 6) AS {c}" for c in _PNAMES)


def _disagg(sun, kw, extra, more=()):
    past = ", ".join(f"w{k} AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)" for k in (4, 8, 96))
    turns = ", ".join(f"round({f}(2 * pi() * {x} / {n}), 9) AS {c}_{f}" for c, x, n in (("qidx", "(hour(ts) * 4 + minute(ts) // 15)", 96), ("dow", "(isodow(ts) - 1)", 7), ("month", "(month(ts) - 1)", 12)) for f in ("sin", "cos"))
    user = ", ".join([f"round(s.{c}, 9) AS user_{c}" for c in (*_PNAMES, *more)] + [f"round(s.{c}, 9) AS {c}" for c in ("hp_likeness",) if more])
    return _L + _profile(sun, kw) + f""" SELECT customer_id, ts, round(load, 9) AS load, round(temp, 9) AS temp, round(rad, 9) AS rad, {", ".join(f"round(lag(load, {k}) OVER w, 9) AS lag_{k}" for k in (1, 4, 8, 96))},
  {", ".join(f"round(avg(load) OVER w{k}, 9) AS roll_mean_{k}, round(stddev_samp(load) OVER w{k}, 9) AS roll_std_{k}" for k in (4, 8, 96))},
  round(load - lag(load, 1) OVER w, 9) AS diff_1, round(load - lag(load, 4) OVER w, 9) AS diff_4, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, CAST(hour(ts) * 4 + minute(ts) // 15 AS INTEGER) AS quarter_index, CAST(isodow(ts) - 1 AS INTEGER) AS dow, CAST(month(ts) AS INTEGER) AS month,
  {turns}, {extra}, {user}, round(load - s.q10, 9) AS tot_minus_baseline, round(load / (s.mean + 1e-6), 9) AS tot_over_mean, round(load / (s.q95 + 1e-6), 9) AS tot_over_p95
FROM rows JOIN s USING (customer_id) WINDOW w AS (PARTITION BY customer_id ORDER BY ts), {past}"""


_HDD, _CDD = "CASE WHEN temp IS NOT NULL THEN greatest(18 - temp, 0) END", "CASE WHEN temp IS NOT NULL THEN greatest(temp - 28, 0) END"
_NIGHT, _DAY = "(CASE WHEN rad <= 20 THEN 1 ELSE 0 END)", "(CASE WHEN rad > 50 THEN 1 ELSE 0 END)"


def _quality(kind, where):
    rows, winter, summer, gap, coverage = SPARSE[kind]
    return f"""(SELECT customer_id, CASE WHEN n_rows < {rows} THEN 'too_few_rows' WHEN n_winter < {winter} THEN 'too_few_winter_rows' WHEN n_summer < {summer} THEN 'too_few_summer_rows' WHEN max_gap_days > {gap} THEN 'gap_too_long' WHEN coverage < {coverage} THEN 'coverage_too_low' ELSE 'ok' END AS quality
  FROM (SELECT customer_id, count(*) AS n_rows, count(*) FILTER (month(ts) IN (12, 1, 2)) AS n_winter, count(*) FILTER (month(ts) IN (6, 7, 8)) AS n_summer, coalesce(max(gap), 0) / 86400 AS max_gap_days, count(*) / (floor((max(epoch(ts)) - min(epoch(ts))) / 900) + 1) AS coverage
    FROM (SELECT *, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY customer_id ORDER BY ts) AS gap FROM training WHERE {where}) GROUP BY 1))"""


_HP_LABEL = f"""hp0 AS (SELECT customer_id, {_corr('value_kw_mean', 'temp')} AS corr_all, {_corr('value_kw_mean', 'temp', 'temp > 28')} AS corr_hot, {_corr('value_kw_mean', 'temp', 'temp < 10')} AS corr_cold FROM training WHERE type = 'HP' GROUP BY 1),
hp1 AS (SELECT hp0.*, CASE WHEN quality <> 'ok' THEN quality WHEN abs(corr_all) >= 0.2 THEN 'all_year_corr' WHEN corr_cold <= -0.2 AND corr_hot >= 0.2 AND abs(corr_cold) >= abs(corr_hot) THEN 'cold_check_stronger_than_hot' WHEN corr_cold <= -0.2 AND corr_hot >= 0.2 THEN 'hot_check_stronger_than_cold'
    WHEN corr_cold <= -0.2 THEN 'cold_check' WHEN corr_hot >= 0.2 THEN 'hot_check' ELSE 'weak_after_temperature_checks' END AS reason FROM hp0 JOIN {_quality("HP", "type = 'HP'")} USING (customer_id)),
hp AS (SELECT *, CASE WHEN reason = 'all_year_corr' THEN CASE WHEN corr_all < 0 THEN 'winter_hp' ELSE 'summer_hp' END WHEN reason IN ('cold_check_stronger_than_hot', 'cold_check') THEN 'winter_hp' WHEN reason IN ('hot_check_stronger_than_cold', 'hot_check') THEN 'summer_hp' END AS hp_season FROM hp1)"""

_AC_LABEL = f""", a AS (SELECT customer_id, {_corr('value_kw_mean', 'temp')} AS corr_all, {_corr('value_kw_mean', 'temp', 'temp > 25')} AS corr_hot, round(avg(value_kw_mean) FILTER (month(ts) IN (6, 7, 8)), 6) AS summer_mean FROM training WHERE type = 'AC' GROUP BY 1),
l AS (SELECT a.*, CASE WHEN quality <> 'ok' THEN quality WHEN corr_all >= 0.2 THEN 'all_year_corr' WHEN corr_hot >= 0.2 THEN 'hot_check' WHEN summer_mean > 0.05 THEN 'summer_mean_positive' ELSE 'weak_ac_signal' END AS reason FROM a JOIN {_quality("AC", "type = 'AC'")} USING (customer_id))"""


def _pairs(kind, kw, more):
    n = kind.lower()
    return f""", own AS MATERIALIZED (SELECT customer_id, ts, min(value_kw_mean) AS kw FROM training WHERE type = '{kind}' GROUP BY ALL),
fine AS MATERIALIZED (SELECT customer_id FROM {_quality("TOT", "type = 'TOT'")} WHERE quality = 'ok'),
tot AS MATERIALIZED (SELECT customer_id, ts, value_kw_mean AS kw, temp, glob_rad FROM training WHERE type = 'TOT' AND abs(value_kw_mean) > 1e-6 AND customer_id IN (SELECT customer_id FROM fine) AND customer_id IN (SELECT customer_id FROM own))
SELECT t.customer_id, t.ts, round(t.kw, 9) AS tot_kw, round(t.temp, 9) AS temp, round(t.glob_rad, 9) AS rad, round(a.kw, 9) AS {n}_kw, CASE WHEN a.kw >= {kw} THEN 1 ELSE 0 END AS {n}_on, round(least(greatest(a.kw / (t.kw + 1e-6), 0), 1), 9) AS {n}_ratio
FROM tot t JOIN own a ON t.customer_id = a.customer_id AND t.ts = a.ts WHERE TRUE{more}"""


#: From rows to m, d and h, whose join holds the air-conditioning features.
_AC_FEATURES = f""", n AS (SELECT customer_id, count(*) FILTER (rad > 50) AS n_day_rows FROM rows GROUP BY 1), part AS (SELECT * FROM rows JOIN n USING (customer_id) WHERE n_day_rows < 100 OR rad > 50), {_LAGGED},
m AS (SELECT customer_id, first(n_day_rows) AS n_day_rows, count(*) AS n_rows, first(n_day_rows) >= 100 AS used_daytime_only, {_features(_corr('load', 'rad') + ' AS corr_rad_all', 25, 10, (4, 96))}, round({_mean('hour(ts) BETWEEN 14 AND 18')} / (abs(avg(load)) + 1e-8), 6) AS afternoon_peak_ratio, round({_mean(_S)} / (abs(avg(load)) + 1e-8), 6) AS summer_ratio, round({_mean('temp > 25')} / (abs(avg(load)) + 1e-8), 6) AS hot_ratio, round({_mean(_S)} / ({_mean(_SP)} + 1e-8), 6) AS summer_vs_spring FROM lagged GROUP BY 1),
d AS (SELECT customer_id, {_BAL.format(_mean('rad > 50'), _mean('rad <= 50'))} AS daytime_share FROM rows WHERE rad IS NOT NULL GROUP BY 1),
h AS (SELECT customer_id, CAST(h AS INTEGER) AS peak_hour FROM (SELECT customer_id, hour(ts) AS h, round(avg(load), 9) AS m FROM part WHERE month(ts) IN (6, 7, 8) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY m DESC, h) = 1)"""
_HP_FEATURES = f", part AS (SELECT * FROM rows WHERE rad <= 20), {_LAGGED}, hf AS (SELECT customer_id, count(*) AS n_night_rows, {_features(_corr('load', 'temp', 'temp < 10') + ' AS corr_cold', 28, 10, (1, 4, 96))} FROM lagged GROUP BY customer_id HAVING count(*) >= 100)"
_EV = with_sql(M) + """,
kw AS (SELECT customer_id, ts, conso_kwh / 0.25::DOUBLE AS kw, prod_kwh / 0.25::DOUBLE AS pv, conso_kwh / 0.25::DOUBLE - prod_kwh / 0.25::DOUBLE AS net FROM meter),
bl AS (SELECT customer_id, median(net) AS base FROM kw WHERE hour(ts) BETWEEN 1 AND 3 GROUP BY 1),
a AS (SELECT kw.*, net - coalesce(base, 0) AS active, pv - lag(pv) OVER w AS dp, CASE WHEN count(net) OVER w4 = 4 THEN stddev_samp(net) OVER w4 END AS std4 FROM kw LEFT JOIN bl USING (customer_id)
  WINDOW w AS (PARTITION BY customer_id ORDER BY ts), w4 AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
f AS (SELECT 'grid' AS kind, customer_id, ts, active AS v, active >= 0.4 AS m FROM a UNION ALL SELECT 'pv', customer_id, ts, net, coalesce(dp < -0.5 AND std4 < 0.25 AND net > 0.8, FALSE) FROM a),
g AS (SELECT *, CASE WHEN m IS DISTINCT FROM lag(m) OVER (PARTITION BY kind, customer_id ORDER BY ts) THEN 1 ELSE 0 END AS new FROM f),
h AS (SELECT *, sum(new) OVER (PARTITION BY kind, customer_id ORDER BY ts) AS run FROM g),
s AS (SELECT customer_id, kind, min(ts) AS start, count(*) AS n, avg(v) AS mean FROM h WHERE m GROUP BY kind, customer_id, run HAVING count(*) >= 3 AND avg(v) > 0 AND coalesce(stddev_samp(v), 0) / avg(v) <= 0.6),
w AS (SELECT customer_id, max(k) AS per_week FROM (SELECT customer_id, date_trunc('week', start) AS wk, count(*) AS k FROM s GROUP BY ALL) GROUP BY 1),
o AS (SELECT customer_id, count(*) AS sessions, count(*) FILTER (kind = 'grid') AS ng, count(*) FILTER (kind = 'pv') AS np, avg(mean) AS kw, avg(mean * n * 0.25::DOUBLE) AS kwh, stddev_samp(mean * n * 0.25::DOUBLE) / (avg(mean * n * 0.25::DOUBLE) + 1e-6) AS uneven FROM s GROUP BY 1),
y AS (SELECT customer_id, sum(conso_kwh) / 1000 AS yearly_mwh FROM meter GROUP BY 1),
x AS (SELECT y.*, sessions, ng, np, yearly_mwh >= 100 AS filtered, 0.30::DOUBLE / (1 + exp(-0.4::DOUBLE * (sessions - 8))) + 0.25::DOUBLE / (1 + exp(-1.2::DOUBLE * (per_week - 2))) + 0.20::DOUBLE * least(greatest((kw - 0.8::DOUBLE) / 1.7::DOUBLE, 0), 1)
  + 0.15::DOUBLE * least(greatest((kwh - 4) / 16, 0), 1) + 0.10::DOUBLE * (CASE WHEN uneven IS NULL THEN 1 ELSE least(greatest(1 - uneven, 0), 1) END) AS score FROM y LEFT JOIN o USING (customer_id) LEFT JOIN w USING (customer_id)),
ev AS (SELECT customer_id, yearly_mwh, filtered, CAST(CASE WHEN filtered THEN 0 ELSE coalesce(sessions, 0) END AS BIGINT) AS sessions, CAST(CASE WHEN filtered THEN 0 ELSE coalesce(ng, 0) END AS BIGINT) AS grid_sessions, CAST(CASE WHEN filtered THEN 0 ELSE coalesce(np, 0) END AS BIGINT) AS pv_sessions, CASE WHEN filtered OR sessions IS NULL THEN 0.0::DOUBLE ELSE round(least(greatest(score, 0), 1), 3) END AS prob_ev FROM x)"""
_FACTS = with_sql(M, W, AL, DAY_SQL, CDAY_SQL, INDICATORS_SQL, CAP_SQL, FACTS_SQL)
_BATTERY = _FACTS + """,
bm AS (SELECT m.*, w.t_2m_c AS temp, w.global_rad_w AS rad FROM meter m ASOF LEFT JOIN weather w ON m.ts >= w.ts),
b0 AS (SELECT customer_id, pv_capacity_kwp AS kwp, bm.ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS ts, conso_kwh, prod_kwh, temp, rad, rad * 0.00025 AS radk FROM bm JOIN pvf USING (customer_id) WHERE has_pv),
b1 AS (SELECT *, CAST(ts AS DATE) AS date, hour(ts) * 4 + minute(ts) // 15 AS slot FROM b0),
bday AS (SELECT customer_id, date, coalesce(sum(radk), 0) AS radk, coalesce(sum(prod_kwh), 0) AS prod, max(rad) >= 100 AS sunny FROM b1 GROUP BY ALL HAVING avg(temp) IS NOT NULL AND max(rad) IS NOT NULL),
b2 AS (SELECT b1.*, sunny FROM b1 JOIN bday USING (customer_id, date)),
bst AS (SELECT customer_id, max(s) AS start FROM (SELECT customer_id, sunny, coalesce(min(slot) FILTER (slot >= 56 AND m < 12), 72) AS s FROM (SELECT customer_id, sunny, slot, avg(rad) AS m FROM b2 GROUP BY ALL) GROUP BY ALL) GROUP BY 1),
bev AS (SELECT b2.* FROM b2 JOIN bst USING (customer_id) WHERE slot BETWEEN start AND 95),
be AS (SELECT customer_id, kwp, date, sunny, coalesce(sum(conso_kwh), 0) AS conso, coalesce(sum(prod_kwh), 0) AS prod, coalesce(sum(radk), 0) AS radk, round_even(avg(temp) / 2, 0) * 2 AS bin FROM bev GROUP BY ALL HAVING avg(temp) IS NOT NULL),
bbase AS (SELECT customer_id, bin, avg(conso) AS baseline FROM be WHERE NOT sunny GROUP BY ALL),
bmt AS (SELECT *, greatest(baseline - conso, 0) AS gap, greatest(coalesce(kwp, 5) * radk * 0.85::DOUBLE, 0) AS potential FROM be JOIN bbase USING (customer_id, bin) WHERE sunny),
bmm AS (SELECT *, CASE WHEN baseline > 0 THEN gap / baseline ELSE 0 END AS gap_ratio, least(gap, greatest(potential - prod, 0)) AS shift FROM bmt),
bcnt AS (SELECT customer_id, count(*) FILTER (NOT sunny) AS n_dark_days, count(*) FILTER (sunny) AS n_sunny_days, avg(radk) FILTER (sunny) AS radk_sunny, avg(prod) FILTER (sunny) AS prod_sunny FROM bday GROUP BY 1),
bevn AS (SELECT customer_id, count(*) FILTER (NOT sunny) AS dark_evenings, count(*) FILTER (sunny) AS sunny_evenings FROM be GROUP BY 1),
bper AS (SELECT customer_id, count(*) AS matched, median(gap_ratio) AS gap_ratio, avg(CASE WHEN round(gap, 9) > 0.4 THEN 1.0::DOUBLE ELSE 0 END) AS consistency, median(CASE WHEN potential > 0 THEN shift / potential END) AS shift_ratio FROM bmm GROUP BY 1),
bpr0 AS (SELECT v.customer_id, v.slot, avg(v.conso_kwh) FILTER (NOT v.sunny) AS dark, avg(v.conso_kwh) FILTER (k.hit) AS sun FROM bev v LEFT JOIN (SELECT customer_id, date, TRUE AS hit FROM bmm) k ON v.customer_id = k.customer_id AND v.date = k.date GROUP BY ALL),
bpr AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY slot) AS pos FROM bpr0 WHERE dark IS NOT NULL AND sun IS NOT NULL),
bsh AS (SELECT customer_id, (sum(dark) - (arg_min(dark, slot) + arg_max(dark, slot)) / 2) - (sum(sun) - (arg_min(sun, slot) + arg_max(sun, slot)) / 2) AS avg_gap,
  greatest(first(pos ORDER BY round(sun, 9) DESC, pos) - first(pos ORDER BY round(dark, 9) DESC, pos), 0) * 15 AS peak_shift FROM bpr GROUP BY 1),
byr AS (SELECT customer_id, CASE WHEN floor(epoch(max(ts) - min(ts)) / 86400) >= 30 THEN sum(conso_kwh) / floor(epoch(max(ts) - min(ts)) / 86400) * 365 END AS annual FROM meter GROUP BY 1),
bx AS (SELECT pvf.customer_id, pv_capacity_kwp AS kwp, n_dark_days, n_sunny_days, radk_sunny, prod_sunny, dark_evenings, sunny_evenings, matched, gap_ratio, consistency, shift_ratio, avg_gap, peak_shift, annual,
    coalesce(pv_capacity_kwp, 5) * radk_sunny * 0.85::DOUBLE AS high, greatest(pv_capacity_kwp, annual * 0.001::DOUBLE) AS anchor
  FROM pvf LEFT JOIN bcnt USING (customer_id) LEFT JOIN bevn USING (customer_id) LEFT JOIN bper USING (customer_id) LEFT JOIN bsh USING (customer_id) LEFT JOIN byr USING (customer_id) WHERE has_pv),
bz AS (SELECT *, CASE WHEN coalesce(n_dark_days, 0) < 2 THEN 'REJECTED: No Baseline' WHEN coalesce(n_sunny_days, 0) < 2 THEN 'REJECTED: No Sunny Match' WHEN dark_evenings IS NULL THEN 'REJECTED: No Evening Features' WHEN dark_evenings < 2 THEN 'REJECTED: No Baseline'
    WHEN sunny_evenings < 2 THEN 'REJECTED: No Sunny Match' WHEN coalesce(matched, 0) < 2 THEN 'REJECTED: No Temp-Matched Sunny' WHEN avg_gap IS NULL THEN 'REJECTED: No Matched Profiles' ELSE 'Success' END AS status,
  -2.5::DOUBLE + 0.04::DOUBLE * peak_shift + 6.2::DOUBLE * gap_ratio + 2 * (0.6::DOUBLE - CASE WHEN high <= 0.1 THEN 1 ELSE least(greatest(prod_sunny / high, 0), 2) END) + 1.1::DOUBLE * least(greatest(consistency, 0), 1)
    + 0.7::DOUBLE * least(greatest(coalesce(shift_ratio, 0), 0), 1) - CASE WHEN matched < 7 THEN 0.5::DOUBLE ELSE 0 END AS z FROM bx),
bp AS (SELECT *, CASE WHEN status = 'Success' THEN round_even(100 / (1 + exp(-least(greatest(z, -20), 20))) * CASE WHEN avg_gap < 2 OR avg_gap > 30 THEN 0.4::DOUBLE ELSE 1 END * CASE WHEN high > 0 AND avg_gap > 1.5::DOUBLE * high THEN 0.7::DOUBLE ELSE 1 END, 2) / 100 ELSE 0 END AS p FROM bz),
bc AS (SELECT customer_id, quantile_cont(c, 0.9) AS c90, quantile_cont(c, 0.25) AS c25, quantile_cont(c, 0.75) AS c75 FROM (SELECT bmm.customer_id, CASE WHEN anchor IS NULL THEN shift / 0.4::DOUBLE ELSE 0.45::DOUBLE * shift / 0.4::DOUBLE + 0.55::DOUBLE * anchor END AS c FROM bmm JOIN bx USING (customer_id) WHERE shift >= 0) GROUP BY 1),
bf AS (SELECT bp.*, least(coalesce(c90, anchor), most) AS est, least(coalesce(c25, anchor), most) AS low, least(coalesce(c75, anchor), most) AS upp FROM (SELECT *, CASE WHEN kwp IS NULL THEN 30 ELSE greatest(2 * kwp, 5) END AS most FROM bp) bp LEFT JOIN bc USING (customer_id))
SELECT customer_id, p >= 0.5 AS has_battery, round(p, 4) AS prob_battery, status, coalesce(matched, 0) AS n_matched_sunny_days, coalesce(n_dark_days, 0) AS n_dark_days, round(CASE WHEN status = 'Success' AND est >= 5 THEN least(est, 30) END, 4) AS battery_capacity_kwh,
  round(CASE WHEN status = 'Success' AND est >= 5 THEN least(greatest(low, 5), 30) END, 4) AS batt_ci_lower, round(CASE WHEN status = 'Success' AND est >= 5 THEN least(greatest(upp, 5), 30) END, 4) AS batt_ci_upper FROM bf
UNION ALL SELECT customer_id, FALSE, 0.0, 'skipped_no_pv', 0, 0, NULL, NULL, NULL FROM pvf WHERE NOT has_pv"""
SQL = {
    "battery_detect": _BATTERY,
    "rebuilt_load": _FACTS + """, x AS (SELECT a.*, CASE WHEN has_pv AND pv_capacity_kwp > 0 THEN pv_capacity_kwp ELSE 0 END AS kwp FROM (SELECT customer_id, ts, conso_kwh, CASE WHEN day(ts) % 3 <> 0 THEN prod_kwh END AS prod_kwh, t_2m_c, global_rad_w FROM aligned) a LEFT JOIN pvf USING (customer_id))
SELECT customer_id, ts, round(CASE WHEN kwp > 0 THEN greatest(coalesce(conso_kwh, 0) - coalesce(prod_kwh, 0) + greatest(coalesce(global_rad_w, 0), 0) / 1000 * kwp * 0.25::DOUBLE, 0) ELSE coalesce(conso_kwh, 0) END * 4, 6) AS load, round(t_2m_c, 6) AS temp, round(global_rad_w, 6) AS rad FROM x""",
    "join_scalar": "SELECT customer_id, has_pv::INT::DOUBLE AS has_pv, round(prob_pv, 6) AS prob_pv, round(pv_capacity_kwp, 6) AS pv_capacity_kwp, has_ev::INT::DOUBLE AS has_ev, prob_ev, n_night_rows::DOUBLE AS n_night_rows, has_ac::INT::DOUBLE AS has_ac FROM (" + _FACTS + " SELECT * FROM pvf) FULL JOIN (" + _EV
    + " SELECT customer_id, prob_ev >= 0.8 AS has_ev, prob_ev FROM ev WHERE sessions > 0) USING (customer_id) FULL JOIN (" + _L + _HP_FEATURES + " SELECT customer_id, n_night_rows FROM hf) USING (customer_id) FULL JOIN ("
    + _T + _AC_LABEL + " SELECT customer_id, reason IN ('all_year_corr', 'hot_check', 'summer_mean_positive') AS has_ac FROM l) USING (customer_id)",
    "ev_detect": _EV + " SELECT customer_id, round(yearly_mwh, 6) AS yearly_mwh, filtered, sessions, grid_sessions, pv_sessions, prob_ev, prob_ev >= 0.8 AS has_ev FROM ev",
    "ev_sessions": with_sql(EV, _STEP) + """,
g AS (SELECT customer_id, ts, coalesce(total, 0) AS c, coalesce(total, 0) - lag(coalesce(total, 0)) OVER (PARTITION BY customer_id ORDER BY ts) AS diff, lag(coalesce(total, 0)) OVER (PARTITION BY customer_id ORDER BY ts) AS before FROM filled),
n AS (SELECT *, min(CASE WHEN diff < -0.1 THEN ts END) OVER (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS fall FROM g),
e AS (SELECT customer_id, ts AS start, fall AS "end" FROM n WHERE diff > 0.1 AND fall IS NOT NULL),
k AS (SELECT e.customer_id, start, "end", sum(c) AS energy_kwh, min(c) AS least FROM e JOIN g ON g.customer_id = e.customer_id AND g.ts >= start AND g.ts < "end" GROUP BY ALL)
SELECT k.customer_id, start, "end", CAST(date_diff('minute', start, "end") AS INTEGER) AS minutes, round(date_diff('minute', start, "end") / 60, 6) AS duration_h, round(g1.before, 6) AS before_start_kwh, round(g1.c, 6) AS start_kwh, round(g2.before, 6) AS before_end_kwh, round(g2.c, 6) AS end_kwh, round(energy_kwh, 6) AS energy_kwh, strftime(start + to_hours(1), '%d.%m.%Y %H:%M') AS start_local, strftime("end" + to_hours(1), '%d.%m.%Y %H:%M') AS end_local, strftime(start + to_hours(1), '%Y-%m-%d') AS date_local
FROM k JOIN g g1 ON g1.customer_id = k.customer_id AND g1.ts = start JOIN g g2 ON g2.customer_id = k.customer_id AND g2.ts = "end" WHERE least >= 0.1 AND date_diff('minute', start, "end") >= 30""",
    "hp_features": _L + _HP_FEATURES + " SELECT * FROM hf",
    "ac_features": _L + _AC_FEATURES + " SELECT * FROM m LEFT JOIN d USING (customer_id) LEFT JOIN h USING (customer_id)",
    "user_profile_ac": _L + _profile(50, 0.30) + f" SELECT customer_id, {_PCOLS} FROM p",
    "user_profile_hp": _L + _profile(20, 0.20) + f" SELECT customer_id, round(q05, 6) AS q05, {_PCOLS}, round(hp_likeness, 6) AS hp_likeness, CASE WHEN hp_likeness >= 0.6 THEN 'scientific_like' WHEN hp_likeness <= 0.35 THEN 'dataport_like' ELSE 'uncertain' END AS hp_class FROM s",
    "disagg_features_ac": _disagg(50, 0.30, f"round({_CDD}, 9) AS cdd_28, {_DAY} AS is_day, CASE WHEN month(ts) IN (6, 7, 8) THEN 1 ELSE 0 END AS is_summer, round({_CDD} * CASE WHEN hour(ts) BETWEEN 14 AND 17 THEN 1 ELSE 0 END, 9) AS cdd28_x_afternoon, round({_CDD} * {_DAY}, 9) AS cdd28_x_day"),
    "disagg_features_hp": _disagg(20, 0.20, f"round({_HDD}, 9) AS hdd_18, {_NIGHT} AS is_night, round({_HDD} * {_NIGHT}, 9) AS hdd_x_night", ("q05",)),
    "curve_quality": _T + """, g AS (SELECT *, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY type, customer_id ORDER BY ts) AS gap FROM training),
c AS (SELECT type, customer_id, count(*) AS n_rows, count(*) FILTER (month(ts) IN (12, 1, 2)) AS n_winter, count(*) FILTER (month(ts) IN (6, 7, 8)) AS n_summer, coalesce(max(gap), 0) / 86400 AS max_gap_days,
  count(*) / (floor((max(epoch(ts)) - min(epoch(ts))) / 900) + 1) AS coverage, min(ts) AS start, max(ts) AS "end" FROM g GROUP BY ALL)
SELECT type, customer_id, n_rows, n_winter, n_summer, round(max_gap_days, 6) AS max_gap_days, round(coverage, 6) AS coverage, start, "end",
  CASE WHEN n_rows < 500 THEN 'too_few_rows' WHEN n_winter < 100 THEN 'too_few_winter_rows' WHEN n_summer < 100 THEN 'too_few_summer_rows' WHEN max_gap_days > 40 THEN 'gap_too_long' WHEN coverage < 0.001 THEN 'coverage_too_low' ELSE 'ok' END AS reason FROM c""",
    "ac_label": _T + _AC_LABEL + " SELECT *, reason IN ('all_year_corr', 'hot_check', 'summer_mean_positive') AS has_ac FROM l",
    "hp_label": _T + f", {_HP_LABEL} SELECT * FROM hp",
    "align_tot_ac": _T + _pairs("AC", 0.30, ""),
    "align_tot_hp": _T + f", {_HP_LABEL}" + _pairs("HP", 0.20, " AND t.customer_id IN (SELECT customer_id FROM hp WHERE hp_season = 'winter_hp') AND t.customer_id NOT IN (SELECT customer_id FROM training WHERE type = 'TOT' GROUP BY 1 HAVING avg(CASE WHEN value_kw_mean < -0.1 THEN 1.0::DOUBLE ELSE 0 END) >= 0.03)"),
    "sample_weights": _T + ", n AS (SELECT customer_id, count(*) AS n FROM training WHERE type = 'TOT' GROUP BY 1) SELECT customer_id, n, round((SELECT sum(n) FROM n) / (SELECT count(*) FROM n)::DOUBLE / n, 6) AS sample_weight FROM n",
    "f_to_c": _L + ", t AS (SELECT customer_id, ts, CASE WHEN CAST(customer_id AS BIGINT) % 2 = 0 THEN temp * 9 / 5 + 32 ELSE temp END AS temp FROM rows), x AS (SELECT *, max(temp) OVER (PARTITION BY customer_id) AS top FROM t) SELECT customer_id, ts, round(CASE WHEN top > 55 THEN (temp - 32) * 5 / 9 ELSE temp END, 6) AS temp FROM x",
    "appliance_manifest": _T + " SELECT * FROM (SELECT customer_id, bool_or(type = 'AC' AND value_kw_mean <> 0) AS has_ac, bool_or(type = 'HP' AND value_kw_mean <> 0) AS has_hp FROM training WHERE type <> 'TOT' GROUP BY 1) WHERE has_ac OR has_hp",
    "annual_kwh": _T + " SELECT type, customer_id, round(sum(value_kw_mean) * 0.25, 6) AS kwh, round(avg(value_kw_mean), 6) AS mean_kw FROM training WHERE type <> 'TOT' GROUP BY ALL",
}
