"""The tables of the domain, derived from the star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, ts, conso_kwh, prod_kwh of quarter-hours; (customer_id, ts) is a key."""
    quarter = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey"), F.lit(96)).cast("int")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("customer_id"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), quarter * 15)).alias("ts"),
        (F.col("l_quantity") / F.when(F.col("l_suppkey") % 3 == 0, 50.0).otherwise(250.0)).alias("conso"),
        "l_suppkey", "l_discount",
    )
    h = F.hour("ts")
    prod = F.when((F.col("l_suppkey") % 2 == 0) & h.between(7, 17), (0.2 + 8 * F.col("l_discount")) * (h - 6) * (18 - h) / 36).otherwise(0.0)
    return rows.groupBy("customer_id", "ts").agg(F.sum("conso").alias("conso_kwh"), F.sum(prod).alias("prod_kwh"))


def weather(spark: SparkSession) -> DataFrame:
    """ts, t_2m_c, global_rad_w: one region, hourly, 1995-01-01 to 2001-12-01."""
    hours = spark.range(2526 * 24).select((F.lit("1995-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("ts"))
    d, h, doy = F.unix_date(F.to_date("ts")), F.hour("ts"), F.dayofyear("ts")
    c, v = F.pmod(d * 37, F.lit(11)), F.pmod(d * 37, F.lit(7))
    rad = F.greatest((h - 6) * (18 - h), F.lit(0)) / 36 * (0.2 + 0.8 * (1 - F.abs(doy - 183) / 183)) * (0.3 + 0.7 * c / 10) * 800
    return hours.select("ts", (-2 + 28 * (1 - F.abs(doy - 198) / 198) + (h - 12) / 4 + v - 3).alias("t_2m_c"), rad.alias("global_rad_w"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, segment of the meter table's customers."""
    segment = F.when(F.col("s_nationkey") % 2 == 0, "Particuliers").otherwise("Entreprises")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("customer_id"), segment.alias("segment"))


def meter_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, ts, conso_kwh at irregular times of one month."""
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("customer_id"), "ts", (F.col("value") / 100).alias("conso_kwh"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a customer: what detection and estimation give, for portfolio reports."""
    k = F.col("c_custkey")
    pv = k % 2 == 0
    cap = F.when(pv, F.abs("c_acctbal") / 500)
    battery = pv & (k % 6 == 0)
    status = F.when(k % 4 == 0, "Success").when(k % 4 == 1, "ok").when(k % 4 == 2, "REJECTED: No Baseline").otherwise("skipped_no_pv")
    return table(spark, sf_dir, "customer").select(
        k.cast("string").alias("customer_id"), F.col("c_mktsegment").alias("segment"), pv.alias("has_pv"), cap.alias("pv_capacity_kwp"),
        cap.alias("pv_capacity_regression"), (cap * (0.5 + (k % 13) / 10)).alias("pv_capacity_floor"),
        F.when(k % 7 != 0, 0.9 * cap).alias("pv_ci_lower"), (1.15 * cap).alias("pv_ci_upper"),
        F.when(pv, (k % 101) / 100).alias("sc_share"), (cap * (500 + (k % 11) * 100)).alias("yearly_prod"),
        F.when(pv, 0.9).otherwise((k % 50) / 100).alias("prob_pv"),
        battery.alias("has_battery"), ((k % 97) / 96).alias("prob_battery"), F.when(k % 5 != 0, 5 + k % 26).cast("double").alias("battery_capacity_kwh"), status.alias("battery_status"),
        (k % 40).cast("int").alias("n_matched_sunny_days"), (k % 60).cast("int").alias("n_dark_days"),
        (k % 5 == 0).alias("has_ac"), ((k % 89) / 88).alias("prob_ac"), (k % 3 != 0).alias("has_hp"), ((k % 83) / 82).alias("prob_hp"),
        F.when(k % 3 == 0, "no_hp").when(k % 3 == 1, "winter_hp").otherwise("summer_hp").alias("hp_type"),
        (k % 7 == 0).alias("has_ev"), ((k % 79) / 78).alias("prob_ev"), ((k % 31) / 10).alias("ev_energy_mwh"),
        F.when(k % 3 == 1, 150.0 * (k % 37)).alias("hp_energy_kwh"),
    )


#: The same tables as DuckDB common table expressions.
METER_SQL = """
meter_rows AS (SELECT CAST(l_suppkey AS VARCHAR) AS customer_id, l_suppkey, l_discount,
    l_shipdate + to_minutes(CAST(15 * ((l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 96) AS INTEGER)) AS ts,
    l_quantity / CASE WHEN l_suppkey % 3 = 0 THEN 50.0::DOUBLE ELSE 250.0::DOUBLE END AS conso FROM lineitem),
meter AS (SELECT customer_id, ts, sum(conso) AS conso_kwh,
    sum(CASE WHEN l_suppkey % 2 = 0 AND hour(ts) BETWEEN 7 AND 17 THEN (0.2::DOUBLE + 8 * l_discount) * (hour(ts) - 6) * (18 - hour(ts)) / 36 ELSE 0.0::DOUBLE END) AS prod_kwh
  FROM meter_rows GROUP BY ALL)"""
WEATHER_SQL = """
hours AS (SELECT TIMESTAMP '1995-01-01' + to_hours(CAST(i AS INTEGER)) AS ts FROM range(2526 * 24) t(i)),
weather_parts AS (SELECT ts, hour(ts) AS h, dayofyear(ts) AS doy, (date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 37) % 11 AS c, (date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 37) % 7 AS v FROM hours),
weather AS (SELECT ts, -2 + 28::DOUBLE * (1 - abs(doy - 198) / 198::DOUBLE) + (h - 12) / 4::DOUBLE + v - 3 AS t_2m_c,
    greatest((h - 6) * (18 - h), 0) / 36::DOUBLE * (0.2::DOUBLE + 0.8::DOUBLE * (1 - abs(doy - 183) / 183::DOUBLE)) * (0.3::DOUBLE + 0.7::DOUBLE * c / 10) * 800 AS global_rad_w FROM weather_parts)"""
CUSTOMERS_SQL = """
customers AS (SELECT CAST(s_suppkey AS VARCHAR) AS customer_id, CASE WHEN s_nationkey % 2 = 0 THEN 'Particuliers' ELSE 'Entreprises' END AS segment FROM supplier)"""
EVENTS_SQL = """
meter_events AS (SELECT CAST(user_id AS VARCHAR) AS customer_id, ts, value / 100 AS conso_kwh FROM events)"""
RESULTS_SQL = """
results AS (SELECT CAST(k AS VARCHAR) AS customer_id, c_mktsegment AS segment, pv AS has_pv, cap AS pv_capacity_kwp, cap AS pv_capacity_regression,
    cap * (0.5::DOUBLE + (k % 13) / 10::DOUBLE) AS pv_capacity_floor, CASE WHEN k % 7 <> 0 THEN 0.9::DOUBLE * cap END AS pv_ci_lower, 1.15::DOUBLE * cap AS pv_ci_upper,
    CASE WHEN pv THEN (k % 101) / 100::DOUBLE END AS sc_share, cap * (500 + (k % 11) * 100) AS yearly_prod,
    CASE WHEN pv THEN 0.9::DOUBLE ELSE (k % 50) / 100::DOUBLE END AS prob_pv,
    pv AND k % 6 = 0 AS has_battery, (k % 97) / 96::DOUBLE AS prob_battery, CASE WHEN k % 5 <> 0 THEN CAST(5 + k % 26 AS DOUBLE) END AS battery_capacity_kwh,
    CASE k % 4 WHEN 0 THEN 'Success' WHEN 1 THEN 'ok' WHEN 2 THEN 'REJECTED: No Baseline' ELSE 'skipped_no_pv' END AS battery_status,
    CAST(k % 40 AS INTEGER) AS n_matched_sunny_days, CAST(k % 60 AS INTEGER) AS n_dark_days,
    k % 5 = 0 AS has_ac, (k % 89) / 88::DOUBLE AS prob_ac, k % 3 <> 0 AS has_hp, (k % 83) / 82::DOUBLE AS prob_hp,
    CASE k % 3 WHEN 0 THEN 'no_hp' WHEN 1 THEN 'winter_hp' ELSE 'summer_hp' END AS hp_type,
    k % 7 = 0 AS has_ev, (k % 79) / 78::DOUBLE AS prob_ev, (k % 31) / 10::DOUBLE AS ev_energy_mwh,
    CASE WHEN k % 3 = 1 THEN 150.0::DOUBLE * (k % 37) END AS hp_energy_kwh
  FROM (SELECT c_custkey AS k, c_mktsegment, c_custkey % 2 = 0 AS pv, CASE WHEN c_custkey % 2 = 0 THEN abs(c_acctbal) / 500 END AS cap FROM customer))"""
#: Meter rows with the last weather row at most an hour older.
ALIGNED_SQL = """
aligned AS (SELECT m.*, CASE WHEN m.ts - w.ts <= INTERVAL 1 HOUR THEN w.t_2m_c END AS t_2m_c, CASE WHEN m.ts - w.ts <= INTERVAL 1 HOUR THEN w.global_rad_w END AS global_rad_w
  FROM meter m ASOF LEFT JOIN weather w ON m.ts >= w.ts)"""


def training(aligned: DataFrame) -> DataFrame:
    """type, source, customer_id, ts, value_kw_mean, temp, glob_rad: total and appliance curves."""
    k = F.col("customer_id").cast("long")
    base = aligned.where("t_2m_c is not null").withColumn("source", F.when(k % 5 == 0, "dataport").when(k % 5 == 1, "eco").otherwise("other"))

    def kind(name, value, where):
        return F.when(where, F.struct(F.lit(name).alias("type"), value.alias("value_kw_mean")))

    c, t = F.col("conso_kwh"), F.col("t_2m_c")
    ac = kind("AC", c * F.greatest(t - 5, F.lit(0.0)) / 20, k % 4 == 1)
    hp = kind("HP", c * F.greatest(25 - t, F.lit(0.0)) / 20, k % 4 == 3)
    # one pass over the meter: each reading gives its own curves' rows
    curves = base.withColumn("__c", F.explode(F.array(kind("TOT", c * 4, F.lit(True)), ac, hp))).where("__c is not null")
    return curves.select("__c.type", "source", "customer_id", "ts", "__c.value_kw_mean", F.col("t_2m_c").alias("temp"), F.col("global_rad_w").alias("glob_rad"))


TRAINING_SQL = """
base AS (SELECT *, CAST(customer_id AS BIGINT) AS k, CASE CAST(customer_id AS BIGINT) % 5 WHEN 0 THEN 'dataport' WHEN 1 THEN 'eco' ELSE 'other' END AS source FROM aligned WHERE t_2m_c IS NOT NULL),
training AS (SELECT 'TOT' AS type, source, customer_id, ts, conso_kwh * 4 AS value_kw_mean, t_2m_c AS temp, global_rad_w AS glob_rad FROM base
  UNION ALL SELECT 'AC', source, customer_id, ts, conso_kwh * greatest(t_2m_c - 5, 0) / 20, t_2m_c, global_rad_w FROM base WHERE k % 4 = 1
  UNION ALL SELECT 'HP', source, customer_id, ts, conso_kwh * greatest(25 - t_2m_c, 0) / 20, t_2m_c, global_rad_w FROM base WHERE k % 4 = 3)"""
