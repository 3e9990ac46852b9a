"""Queries of the time-series kernel, weather and photovoltaics, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import slope, slope_error
from ..operators import pv, timeseries, weather as wx
from ..sources import adapters as A
from .pipeline import cohort as pipeline_cohort

R = 6


def rounded(df, digits=R):
    """Doubles to six digits, so that both engines' orders of summation agree."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def with_sql(*parts: str) -> str:
    return "WITH " + ",".join(parts)


W, M, AL, EV = A.WEATHER_SQL, A.METER_SQL, A.ALIGNED_SQL, A.EVENTS_SQL
DAY_SQL = """
wday0 AS (SELECT CAST(ts AS DATE) AS date, sum(global_rad_w) AS g_daily_raw_sum, sum(CASE WHEN hour(ts) BETWEEN 10 AND 15 THEN global_rad_w END) AS g_midday_raw_sum FROM weather GROUP BY 1),
wq AS (SELECT date_trunc('month', date) AS month, quantile_cont(g_midday_raw_sum, 0.2) AS lo, quantile_cont(g_midday_raw_sum, 0.8) AS hi FROM wday0 GROUP BY 1),
wday AS (SELECT date, g_daily_raw_sum, g_midday_raw_sum, CASE WHEN g_midday_raw_sum IS NULL THEN 'unknown' WHEN g_midday_raw_sum <= lo THEN 'low' WHEN g_midday_raw_sum >= hi THEN 'high' ELSE 'medium' END AS rad_bucket
  FROM wday0 JOIN wq ON wq.month = date_trunc('month', date))"""
CDAY_SQL = """
cday AS (SELECT customer_id, CAST(ts AS DATE) AS date, sum(prod_kwh) AS prod_day, sum(conso_kwh) AS conso_day,
    sum(CASE WHEN hour(ts) BETWEEN 10 AND 15 THEN prod_kwh END) AS prod_midday, sum(CASE WHEN hour(ts) BETWEEN 10 AND 15 THEN conso_kwh END) AS conso_midday
  FROM aligned GROUP BY ALL)"""
INDICATORS_SQL = """
ind_day AS (SELECT customer_id, avg(prod_midday) FILTER (rad_bucket = 'high') - avg(prod_midday) FILTER (rad_bucket = 'low') AS delta_prod,
    avg(conso_midday - prod_midday) FILTER (rad_bucket = 'high') - avg(conso_midday - prod_midday) FILTER (rad_bucket = 'low') AS delta_net,
    sum(prod_day) AS yearly_prod_kwh, sum(conso_day) AS yearly_conso_kwh FROM cday LEFT JOIN wday USING (date) GROUP BY customer_id),
ind_row AS (SELECT customer_id, CASE WHEN min(prod_kwh) FILTER (global_rad_w IS NOT NULL) < max(prod_kwh) FILTER (global_rad_w IS NOT NULL) AND min(global_rad_w) < max(global_rad_w) THEN corr(prod_kwh, global_rad_w) END AS corr_prod_rad,
    CASE WHEN min(prod_kwh) FILTER (global_rad_w IS NOT NULL) < max(prod_kwh) FILTER (global_rad_w IS NOT NULL) AND min(global_rad_w) < max(global_rad_w) THEN regr_slope(prod_kwh, global_rad_w) ELSE 0 END AS beta_regression FROM aligned GROUP BY customer_id),
ind AS (SELECT * FROM ind_day JOIN ind_row USING (customer_id))"""


def aligned(spark, d):
    return timeseries.asof_join(A.meter(spark, d), A.weather(spark), 3600)


def pv_detect(spark, d):
    out = pv.detect_pv(A.meter(spark, d), A.weather(spark))
    return rounded(out.select("customer_id", "has_pv", "prob_pv", "yearly_prod_kwh", "corr_prod_rad", "delta_prod", "delta_net", "beta_regression"))


def pv_indicators(spark, d):
    return rounded(pv.pv_indicators(aligned(spark, d), A.weather(spark)))


def weather_day_bucket(spark, d):
    # the days that the meter table covers
    days = A.meter(spark, d).select(F.to_date("ts").alias("date")).distinct()
    return rounded(wx.weather_day(A.weather(spark)).join(days, "date", "left_semi"))


def daily_radiation_class(spark, d):
    days = A.meter(spark, d).select(F.to_date("ts").alias("date")).distinct()
    return rounded(wx.radiation_class(A.weather(spark)).join(days, "date", "left_semi"))


def weather_day_stats(spark, d):
    days = A.meter(spark, d).select(F.to_date("ts").alias("date")).distinct()
    return rounded(wx.weather_day_stats(A.weather(spark)).join(days, "date", "left_semi"))


def customer_day(spark, d):
    return rounded(pv.customer_day(aligned(spark, d)))


def cohort(spark, d, cap=600.0):
    """Customers of a segment whose consumption over all rows is at most cap."""
    m = A.meter(spark, d)
    own = m.join(pipeline_cohort(m, A.customers(spark, d), "Particuliers", cap), "customer_id", "left_semi")
    return rounded(own.groupBy("customer_id").agg(F.sum("conso_kwh").alias("total_kwh")))


def asof(seconds, direction):
    def query(spark, d):
        return rounded(timeseries.asof_join(A.meter(spark, d).select("customer_id", "ts"), A.weather(spark), seconds, direction))

    return query


def grid_fill(spark, d):
    e = A.meter_events(spark, d).groupBy("customer_id", timeseries.floor_time("ts").alias("ts")).agg(F.avg("conso_kwh").alias("conso_kwh"))
    return rounded(timeseries.reindex(e))


def interpolate_limit(spark, d):
    e = A.meter_events(spark, d).groupBy("customer_id", timeseries.floor_time("ts").alias("ts")).agg(F.avg("conso_kwh").alias("conso_kwh"))
    full = timeseries.fill_grid(e, ["conso_kwh"], limit=8)
    # values are multiples of 0.0001 over small whole numbers: nine digits keep clear of halves
    return rounded(full.select("customer_id", "ts", F.greatest(F.coalesce("conso_kwh", F.lit(0.0)), F.lit(0.0)).alias("conso_kwh")), 9)


def resample_15m(spark, d):
    return rounded(timeseries.resample_sum(A.meter_events(spark, d), "conso_kwh"))


def dedupe_first(spark, d):
    e = A.meter_events(spark, d).withColumn("day", F.to_date("ts"))
    return rounded(timeseries.dedupe(e, ["customer_id", "day"], ["ts", "conso_kwh"]))


def lag_features(spark, d):
    return rounded(timeseries.lags(A.meter(spark, d).select("customer_id", "ts", "conso_kwh"), "conso_kwh", [1, 4, 8, 96]))


def rolling_features(spark, d):
    return rounded(timeseries.rolling(A.meter(spark, d).select("customer_id", "ts", "conso_kwh"), "conso_kwh", [4, 8, 96]), 9)


def runs(spark, d):
    return rounded(timeseries.runs(A.meter(spark, d).withColumn("kw", F.col("conso_kwh") * 4), F.col("kw") >= 0.5, "kw", 3, 0.6, digits=9))


def calendar_features(spark, d):
    return rounded(wx.calendar(A.meter(spark, d).select("customer_id", "ts")))


def degree_values(spark, d):
    return rounded(wx.temperature_bands(aligned(spark, d).select("customer_id", "ts", "t_2m_c")))


def ols_slope_se(spark, d):
    a = aligned(spark, d)
    return rounded(a.groupBy("customer_id").agg(slope("conso_kwh", "t_2m_c").alias("slope"), slope_error("conso_kwh", "t_2m_c").alias("slope_se")))


def demand_rad_correction(spark, d):
    a = aligned(spark, d)
    night = (F.hour("ts") >= 22) | (F.hour("ts") < 5)
    s = lambda y, x, m: F.when(F.count(F.when(m & F.col(x).isNotNull(), 1)) >= 30, slope(F.when(m, F.col(y)), F.when(m, F.col(x))))
    return rounded(a.groupBy("customer_id").agg(F.coalesce(s("conso_kwh", "t_2m_c", night) * s("t_2m_c", "global_rad_w", wx.midday()), F.lit(0.0)).alias("correction")))


def pv_capacity_point(spark, d):
    return rounded(pv.pv_capacity_point(A.meter(spark, d), A.weather(spark)))


def pv_capacity_bootstrap(spark, d):
    return rounded(pv.pv_capacity(A.meter(spark, d), A.weather(spark), draws=20), 4)


def pv_capacity_blocks(spark, d):
    """The bootstrap in blocks of three days."""
    return rounded(pv.pv_capacity(A.meter(spark, d), A.weather(spark), draws=20, block=3), 4)


def zscore(spark, d):
    return rounded(timeseries.zscore(A.meter(spark, d), ["conso_kwh"]).select("customer_id", "ts", F.col("conso_kwh_norm").alias("z")))


QUERIES = {
    "pv_detect": pv_detect, "pv_indicators": pv_indicators, "weather_day_bucket": weather_day_bucket, "weather_day_stats": weather_day_stats, "daily_radiation_class": daily_radiation_class, "customer_day": customer_day, "cohort": cohort,
    "asof_backward_15m": asof(900, "backward"), "asof_backward_1h": asof(3600, "backward"), "asof_nearest_16m": asof(960, "nearest"), "asof_carry": asof(None, "backward"),
    "grid_fill": grid_fill, "interpolate_limit": interpolate_limit, "resample_15m": resample_15m, "dedupe_first": dedupe_first, "lag_features": lag_features, "rolling_features": rolling_features, "runs": runs,
    "calendar_features": calendar_features, "degree_values": degree_values, "ols_slope_se": ols_slope_se, "demand_rad_correction": demand_rad_correction, "pv_capacity_point": pv_capacity_point, "pv_capacity_bootstrap": pv_capacity_bootstrap, "pv_capacity_blocks": pv_capacity_blocks, "zscore": zscore,
}

_BACK = "SELECT m.customer_id, m.ts, CASE WHEN m.ts - w.ts <= INTERVAL {0} THEN round(w.t_2m_c, 6) END AS t_2m_c, CASE WHEN m.ts - w.ts <= INTERVAL {0} THEN round(w.global_rad_w, 6) END AS global_rad_w FROM meter m ASOF LEFT JOIN weather w ON m.ts >= w.ts"
_STEP = """
step AS (SELECT customer_id, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS ts, avg(conso_kwh) AS conso_kwh, sum(conso_kwh) AS total FROM meter_events GROUP BY ALL),
grid AS (SELECT customer_id, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTE)) AS ts FROM step GROUP BY customer_id),
filled AS (SELECT g.customer_id, g.ts, s.conso_kwh, s.total FROM grid g LEFT JOIN step s USING (customer_id, ts))"""
_DAYS = "date IN (SELECT CAST(ts AS DATE) FROM meter)"
_N = "nullif(isnan({0})::INT, 1)"
CAP_SQL = """
near AS (SELECT m.*, w.t_2m_c, w.global_rad_w, CAST(m.ts AS DATE) AS date FROM meter m JOIN weather w
  ON w.ts = CASE WHEN m.ts - date_trunc('hour', m.ts) <= INTERVAL 16 MINUTE THEN date_trunc('hour', m.ts) WHEN date_trunc('hour', m.ts) + INTERVAL 1 HOUR - m.ts <= INTERVAL 16 MINUTE THEN date_trunc('hour', m.ts) + INTERVAL 1 HOUR END),
lit AS (SELECT near.*, coalesce(wday.rad_bucket, 'unknown') AS rad_bucket FROM near LEFT JOIN wday USING (date)),
s AS (SELECT customer_id, CASE WHEN count(*) FILTER (rad_bucket = 'high' AND hour(ts) BETWEEN 10 AND 15) >= 3 THEN regr_slope(conso_kwh - prod_kwh, global_rad_w) FILTER (rad_bucket = 'high' AND hour(ts) BETWEEN 10 AND 15) END AS bh, count(*) FILTER (rad_bucket = 'high' AND hour(ts) BETWEEN 10 AND 15) AS nh,
    CASE WHEN count(*) >= 3 THEN regr_slope(conso_kwh - prod_kwh, global_rad_w) END AS ba,
    CASE WHEN count(*) FILTER (hour(ts) >= 22 OR hour(ts) < 5) >= 30 AND count(*) FILTER (hour(ts) BETWEEN 10 AND 15) >= 30 THEN
      regr_slope(conso_kwh, t_2m_c) FILTER (hour(ts) >= 22 OR hour(ts) < 5) * regr_slope(t_2m_c, global_rad_w) FILTER (hour(ts) BETWEEN 10 AND 15) ELSE 0 END AS fix,
    quantile_cont(prod_kwh * 4, 0.95) AS p95 FROM lit GROUP BY customer_id),
g AS (SELECT customer_id, avg(global_rad_w) AS g_ref FROM lit JOIN s USING (customer_id) WHERE p95 > 0 AND prod_kwh * 4 >= 0.9::DOUBLE * p95 GROUP BY 1),
c AS (SELECT customer_id, greatest(greatest(-CASE WHEN nh > 0 THEN coalesce(bh, 0) ELSE coalesce(ba, 0) END, 0) - fix, 0) * 4000 AS regression_kwp, CASE WHEN p95 > 0 AND g_ref > 0 THEN p95 * 1000 / g_ref ELSE 0 END AS floor_kwp FROM s LEFT JOIN g USING (customer_id)),
dd AS (SELECT customer_id, date, rad_bucket, sum(CASE WHEN hour(ts) BETWEEN 10 AND 15 THEN conso_kwh END) AS cm, sum(CASE WHEN hour(ts) BETWEEN 10 AND 15 THEN prod_kwh END) AS pm FROM lit GROUP BY ALL),
h AS (SELECT customer_id, greatest(round(avg(cm) FILTER (rad_bucket = 'low') - avg(cm) FILTER (rad_bucket = 'high'), 9), 0) AS own, greatest(avg(pm) FILTER (rad_bucket = 'high'), 0) AS out FROM dd GROUP BY 1),
capacity AS (SELECT customer_id, regression_kwp, floor_kwp, CASE WHEN regression_kwp >= 0.7::DOUBLE * floor_kwp THEN regression_kwp ELSE floor_kwp END AS hybrid_kwp, CASE WHEN own + out > 0 THEN own / (own + out) END AS sc_share FROM c LEFT JOIN h USING (customer_id))"""
#: Solar customers and their capacity.
FACTS_SQL = """
pvi AS (SELECT *, coalesce(yearly_prod_kwh, 0) > 1 OR coalesce(corr_prod_rad, 0) > 0.3 OR coalesce(delta_prod, 0) > 0.01 OR coalesce(delta_net, 0) < -0.1 AS has_pv FROM ind),
pvf AS (SELECT customer_id, has_pv, CASE WHEN has_pv THEN least(greatest((coalesce(corr_prod_rad, 0) - 0.1::DOUBLE) / 0.4::DOUBLE, 0), 1) ELSE 0.0::DOUBLE END AS prob_pv, CASE WHEN hybrid_kwp >= 0.1 THEN hybrid_kwp END AS pv_capacity_kwp FROM pvi LEFT JOIN capacity USING (customer_id))"""


def _boot(block, draws=20):
    """The bootstrap in SQL: the same hashes choose the days."""
    def fit(y, x, where):
        # slopes of weighted rows from their sums
        s = lambda e: f"sum(w * ({e})) FILTER ({where})"
        return f"CASE WHEN sum(w) FILTER ({where}) >= 3 THEN ({s('1')} * {s(f'{x} * ({y})')} - {s(x)} * {s(y)}) / nullif({s('1')} * {s(f'{x} * {x}')} - {s(x)} * {s(x)}, 0) END"

    noon, dark, high = "hour(ts) BETWEEN 10 AND 15", "(hour(ts) >= 22 OR hour(ts) < 5)", "rad_bucket = 'high' AND hour(ts) BETWEEN 10 AND 15"
    net = "conso_kwh - prod_kwh"
    return with_sql(M, W, DAY_SQL, CAP_SQL) + f""",
bd0 AS (SELECT customer_id, date, strftime(date, '%Y-%m') AS month FROM (SELECT DISTINCT customer_id, date FROM lit) WHERE customer_id IN (SELECT customer_id FROM lit GROUP BY 1 HAVING count(DISTINCT date) >= 3)),
bd AS (SELECT *, row_number() OVER (PARTITION BY customer_id, month ORDER BY date) - 1 AS k, count(*) OVER (PARTITION BY customer_id, month) AS n FROM bd0),
br AS (SELECT *, CASE WHEN n > {block} THEN {block} ELSE 1 END AS run FROM bd, range(1, {draws + 1}) t(replicate)),
bp AS (SELECT customer_id, month, replicate, CAST('0x' || substr(md5('1|' || customer_id || '|' || month || '|' || replicate || '|' || (k // run)), 1, 12) AS BIGINT) % (n - run + 1) + k % run AS pick FROM br),
bw AS (SELECT bd.customer_id, replicate, date, count(*) AS w FROM bp JOIN bd ON bd.customer_id = bp.customer_id AND bd.month = bp.month AND bd.k = bp.pick GROUP BY ALL),
bl AS MATERIALIZED (SELECT lit.*, replicate, w FROM lit JOIN bw USING (customer_id, date)),
bx AS (SELECT *, unnest(range(w)) AS copy FROM bl),
bs AS (SELECT customer_id, replicate, {fit(net, 'global_rad_w', high)} AS bh, coalesce(sum(w) FILTER ({high}), 0) AS nh, {fit(net, 'global_rad_w', 'TRUE')} AS ba,
  CASE WHEN sum(w) FILTER ({dark}) >= 30 AND sum(w) FILTER ({noon}) >= 30 THEN {fit('conso_kwh', 't_2m_c', dark)} * {fit('t_2m_c', 'global_rad_w', noon)} ELSE 0 END AS fix FROM bl GROUP BY ALL),
bq AS (SELECT customer_id, replicate, quantile_cont(prod_kwh * 4, 0.95) AS p95 FROM bx GROUP BY ALL),
bg AS (SELECT customer_id, replicate, sum(w * global_rad_w) / sum(w) AS g_ref FROM bl JOIN bq USING (customer_id, replicate) WHERE p95 > 0 AND prod_kwh * 4 >= 0.9::DOUBLE * p95 GROUP BY ALL),
bc AS (SELECT customer_id, replicate, greatest(greatest(-CASE WHEN nh > 0 THEN coalesce(bh, 0) ELSE coalesce(ba, 0) END, 0) - fix, 0) * 4000 AS reg, CASE WHEN p95 > 0 AND g_ref > 0 THEN p95 * 1000 / g_ref ELSE 0 END AS flo FROM bs LEFT JOIN bq USING (customer_id, replicate) LEFT JOIN bg USING (customer_id, replicate)),
bh AS (SELECT customer_id, replicate, greatest(sum(w * cm) FILTER (rad_bucket = 'low') / sum(w) FILTER (rad_bucket = 'low' AND cm IS NOT NULL) - sum(w * cm) FILTER (rad_bucket = 'high') / sum(w) FILTER (rad_bucket = 'high' AND cm IS NOT NULL), 0) AS own,
  greatest(sum(w * pm) FILTER (rad_bucket = 'high') / sum(w) FILTER (rad_bucket = 'high' AND pm IS NOT NULL), 0) AS out FROM dd JOIN bw USING (customer_id, date) GROUP BY ALL),
ball AS (SELECT customer_id, CASE WHEN reg >= 0.7::DOUBLE * flo THEN reg ELSE flo END AS cap, CASE WHEN own + out > 0 THEN own / (own + out) END AS sc FROM bc LEFT JOIN bh USING (customer_id, replicate)),
bb AS (SELECT customer_id, quantile_cont(cap, 0.05) AS lo, quantile_cont(cap, 0.95) AS hi, quantile_cont(sc, 0.5) AS sc, quantile_cont(sc, 0.05) AS sclo, quantile_cont(sc, 0.95) AS schi FROM ball GROUP BY 1)
SELECT customer_id, round(CASE WHEN hybrid_kwp >= 0.1 THEN hybrid_kwp END, 4) AS pv_capacity_kwp, round(lo, 4) AS pv_ci_lower, round(hi, 4) AS pv_ci_upper, round(coalesce(sc, sc_share), 4) AS sc_share, round(sclo, 4) AS sc_ci_lower, round(schi, 4) AS sc_ci_upper,
  round(regression_kwp, 4) AS pv_capacity_regression, round(floor_kwp, 4) AS pv_capacity_floor FROM capacity LEFT JOIN bb USING (customer_id)"""


SQL = {
    "pv_detect": with_sql(M, W, AL, DAY_SQL, CDAY_SQL, INDICATORS_SQL) + """
SELECT customer_id, has_pv, round(CASE WHEN has_pv THEN least(greatest((coalesce(corr_prod_rad, 0) - 0.1::DOUBLE) / 0.4::DOUBLE, 0), 1) ELSE 0 END, 6) AS prob_pv,
  round(yearly_prod_kwh, 6) AS yearly_prod_kwh, round(corr_prod_rad, 6) AS corr_prod_rad, round(delta_prod, 6) AS delta_prod, round(delta_net, 6) AS delta_net, round(beta_regression, 6) AS beta_regression
FROM (SELECT *, coalesce(yearly_prod_kwh, 0) > 1 OR coalesce(corr_prod_rad, 0) > 0.3 OR coalesce(delta_prod, 0) > 0.01 OR coalesce(delta_net, 0) < -0.1 AS has_pv FROM ind)""",
    "pv_indicators": with_sql(M, W, AL, DAY_SQL, CDAY_SQL, INDICATORS_SQL) + """
SELECT customer_id, round(delta_prod, 6) AS delta_prod, round(delta_net, 6) AS delta_net, round(yearly_prod_kwh, 6) AS yearly_prod_kwh, round(yearly_conso_kwh, 6) AS yearly_conso_kwh, round(corr_prod_rad, 6) AS corr_prod_rad, round(beta_regression, 6) AS beta_regression FROM ind""",
    "weather_day_bucket": with_sql(M, W, DAY_SQL) + f" SELECT date, round(g_daily_raw_sum, 6) AS g_daily_raw_sum, round(g_midday_raw_sum, 6) AS g_midday_raw_sum, rad_bucket FROM wday WHERE {_DAYS}",
    "weather_day_stats": with_sql(M, W) + f" SELECT * FROM (SELECT CAST(ts AS DATE) AS date, round(avg(global_rad_w) * 24 / 1000, 6) AS rad_kwh_m2, round(max(global_rad_w), 6) AS rad_max, round(avg(t_2m_c), 6) AS t_mean, round(max(t_2m_c), 6) AS t_max, round(min(t_2m_c), 6) AS t_min FROM weather GROUP BY 1) WHERE {_DAYS}",
    "daily_radiation_class": with_sql(M, W) + f" SELECT date, round(rad_sum, 6) AS rad_sum, round(rad_max, 6) AS rad_max, CASE WHEN rad_max <= 100 THEN 0 WHEN rad_max <= 400 THEN 1 ELSE 2 END AS rad_class FROM (SELECT CAST(ts AS DATE) AS date, sum(global_rad_w) AS rad_sum, max(global_rad_w) AS rad_max FROM weather GROUP BY 1) WHERE {_DAYS}",
    "customer_day": with_sql(M, W, AL, CDAY_SQL) + " SELECT customer_id, date, round(prod_day, 6) AS prod_day, round(conso_day, 6) AS conso_day, round(prod_midday, 6) AS prod_midday, round(conso_midday, 6) AS conso_midday, round(conso_day - prod_day, 6) AS net_day, round(conso_midday - prod_midday, 6) AS net_midday FROM cday",
    "cohort": with_sql(M, A.CUSTOMERS_SQL) + " SELECT customer_id, round(sum(conso_kwh), 6) AS total_kwh FROM meter WHERE customer_id IN (SELECT customer_id FROM customers WHERE segment = 'Particuliers') GROUP BY 1 HAVING sum(conso_kwh) <= 600",
    "asof_backward_15m": with_sql(M, W) + " " + _BACK.format("15 MINUTE"),
    "asof_backward_1h": with_sql(M, W) + " " + _BACK.format("1 HOUR"),
    "asof_carry": with_sql(M, W) + " SELECT m.customer_id, m.ts, round(w.t_2m_c, 6) AS t_2m_c, round(w.global_rad_w, 6) AS global_rad_w FROM meter m ASOF LEFT JOIN weather w ON m.ts >= w.ts",
    "asof_nearest_16m": with_sql(M, W) + """
SELECT m.customer_id, m.ts, round(w.t_2m_c, 6) AS t_2m_c, round(w.global_rad_w, 6) AS global_rad_w FROM meter m LEFT JOIN weather w
  ON w.ts = CASE WHEN m.ts - date_trunc('hour', m.ts) <= INTERVAL 16 MINUTE THEN date_trunc('hour', m.ts) WHEN date_trunc('hour', m.ts) + INTERVAL 1 HOUR - m.ts <= INTERVAL 16 MINUTE THEN date_trunc('hour', m.ts) + INTERVAL 1 HOUR END""",
    "grid_fill": with_sql(EV, _STEP) + " SELECT customer_id, ts, round(conso_kwh, 6) AS conso_kwh FROM filled",
    "interpolate_limit": with_sql(EV, _STEP) + """,
near AS (SELECT *, last_value(conso_kwh IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN conso_kwh IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS t0,
  first_value(conso_kwh IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN conso_kwh IS NOT NULL THEN ts END IGNORE NULLS) OVER a AS t1 FROM filled
  WINDOW b AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT customer_id, ts, round(greatest(coalesce(CASE WHEN conso_kwh IS NOT NULL THEN conso_kwh WHEN ts - t0 <= INTERVAL 120 MINUTE THEN v0 + (v1 - v0) * epoch(ts - t0) / epoch(t1 - t0) END, 0), 0), 9) AS conso_kwh FROM near""",
    "resample_15m": with_sql(EV, _STEP) + " SELECT customer_id, ts, round(coalesce(total, 0), 6) AS conso_kwh FROM filled",
    "dedupe_first": with_sql(EV) + " SELECT customer_id, ts, round(conso_kwh, 6) AS conso_kwh, CAST(ts AS DATE) AS day FROM meter_events QUALIFY row_number() OVER (PARTITION BY customer_id, CAST(ts AS DATE) ORDER BY ts, conso_kwh) = 1",
    "lag_features": with_sql(M) + " SELECT customer_id, ts, round(conso_kwh, 6) AS conso_kwh, " + ", ".join(f"round(lag(conso_kwh, {k}) OVER w, 6) AS conso_kwh_lag_{k}" for k in (1, 4, 8, 96)) + " FROM meter WINDOW w AS (PARTITION BY customer_id ORDER BY ts)",
    "rolling_features": with_sql(M) + " SELECT customer_id, ts, round(conso_kwh, 9) AS conso_kwh, " + ", ".join(f"round(avg(conso_kwh) OVER w{k}, 9) AS conso_kwh_roll_mean_{k}, round(stddev_samp(conso_kwh) OVER w{k}, 9) AS conso_kwh_roll_std_{k}" for k in (4, 8, 96)) + " FROM meter WINDOW " + ", ".join(f"w{k} AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)" for k in (4, 8, 96)),
    "runs": with_sql(M) + """, k AS (SELECT customer_id, ts, conso_kwh * 4 AS kw, conso_kwh * 4 >= 0.5 AS m FROM meter),
n AS (SELECT *, CASE WHEN m IS DISTINCT FROM lag(m) OVER (PARTITION BY customer_id ORDER BY ts) THEN 1 ELSE 0 END AS new FROM k),
r AS (SELECT *, sum(new) OVER (PARTITION BY customer_id ORDER BY ts) AS run FROM n)
SELECT customer_id, min(ts) AS start, count(*) AS n, round(avg(kw), 6) AS mean, round(coalesce(stddev_samp(kw), 0), 6) AS std FROM r WHERE m GROUP BY customer_id, run HAVING count(*) >= 3 AND avg(kw) > 0 AND round(coalesce(stddev_samp(kw), 0) / avg(kw), 9) <= 0.6""",
    "calendar_features": with_sql(M) + " SELECT customer_id, ts, " + ", ".join(f"round({f}(2 * pi() * ({x})), 6) AS {k}_{f}" for k, x in (("hour", "hour(ts) / 24::DOUBLE"), ("dow", "(isodow(ts) - 1) / 7::DOUBLE"), ("month", "(month(ts) - 1) / 12::DOUBLE")) for f in ("sin", "cos")) + " FROM meter",
    "degree_values": with_sql(M, W, AL) + " SELECT customer_id, ts, round(t_2m_c, 6) AS t_2m_c, t_2m_c > 25 AS is_hot, t_2m_c < 10 AS is_cold, CASE WHEN t_2m_c IS NOT NULL THEN round(greatest(t_2m_c - 18, 0), 6) END AS cdd, CASE WHEN t_2m_c IS NOT NULL THEN round(greatest(18 - t_2m_c, 0), 6) END AS hdd FROM aligned",
    "ols_slope_se": with_sql(M, W, AL) + " SELECT customer_id, round(CASE WHEN regr_count(conso_kwh, t_2m_c) >= 3 AND regr_sxx(conso_kwh, t_2m_c) > 0 THEN regr_slope(conso_kwh, t_2m_c) ELSE 0 END, 6) AS slope, round(sqrt((regr_syy(conso_kwh, t_2m_c) - regr_sxy(conso_kwh, t_2m_c) ** 2 / regr_sxx(conso_kwh, t_2m_c)) / (regr_count(conso_kwh, t_2m_c) - 2) / regr_sxx(conso_kwh, t_2m_c)), 6) AS slope_se FROM aligned GROUP BY customer_id",
    "demand_rad_correction": with_sql(M, W, AL) + """ SELECT customer_id, round(coalesce(CASE WHEN count(t_2m_c) FILTER (hour(ts) >= 22 OR hour(ts) < 5) >= 30 THEN regr_slope(conso_kwh, t_2m_c) FILTER (hour(ts) >= 22 OR hour(ts) < 5) END
  * CASE WHEN count(global_rad_w) FILTER (hour(ts) BETWEEN 10 AND 15) >= 30 THEN regr_slope(t_2m_c, global_rad_w) FILTER (hour(ts) BETWEEN 10 AND 15) END, 0), 6) AS correction FROM aligned GROUP BY customer_id""",
    "zscore": with_sql(M) + " SELECT customer_id, ts, round((conso_kwh - (SELECT avg(conso_kwh) FROM meter)) / (SELECT stddev_samp(conso_kwh) FROM meter), 6) AS z FROM meter",
    "pv_capacity_point": with_sql(M, W, DAY_SQL, CAP_SQL) + """ SELECT customer_id, round(regression_kwp, 6) AS regression_kwp, round(floor_kwp, 6) AS floor_kwp, round(hybrid_kwp, 6) AS hybrid_kwp, round(sc_share, 6) AS sc_share FROM capacity""",
    "pv_capacity_bootstrap": _boot(1),
    "pv_capacity_blocks": _boot(3),
}
