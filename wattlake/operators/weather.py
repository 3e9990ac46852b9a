"""Weather by day: radiation sums and buckets, day classes, calendar and degree columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import degrees_above, degrees_below


def midday(ts: str = "ts"):
    return (F.hour(ts) >= 10) & (F.hour(ts) < 16)


def weather_day(weather: DataFrame) -> DataFrame:
    """date, g_daily_raw_sum, g_midday_raw_sum, rad_bucket by the month's 20 and 80 % quantiles."""
    day = weather.groupBy(F.to_date("ts").alias("date")).agg(F.coalesce(F.sum("global_rad_w"), F.lit(0.0)).alias("g_daily_raw_sum"), F.sum(F.when(midday(), F.coalesce("global_rad_w", F.lit(0.0)))).alias("g_midday_raw_sum"))
    month = Window.partitionBy(F.date_trunc("month", "date"))
    q = lambda p: F.percentile("g_midday_raw_sum", F.lit(p)).over(month)
    day = day.withColumns({"__lo": q(0.2), "__hi": q(0.8)})
    x = F.col("g_midday_raw_sum")
    bucket = F.when(x.isNull(), "unknown").when(x <= F.col("__lo"), "low").when(x >= F.col("__hi"), "high").otherwise("medium")
    return day.select("date", "g_daily_raw_sum", "g_midday_raw_sum", bucket.alias("rad_bucket"))


def weather_day_stats(weather: DataFrame) -> DataFrame:
    """date, rad_kwh_m2, rad_max, t_mean, t_max, t_min."""
    return weather.groupBy(F.to_date("ts").alias("date")).agg((F.avg("global_rad_w") * 24 / 1000).alias("rad_kwh_m2"), F.max("global_rad_w").alias("rad_max"), F.avg("t_2m_c").alias("t_mean"), F.max("t_2m_c").alias("t_max"), F.min("t_2m_c").alias("t_min"))


def radiation_class(weather: DataFrame) -> DataFrame:
    """date, rad_sum, rad_max, rad_class: 0 up to a daily maximum of 100, 1 up to 400, 2 beyond."""
    day = weather.groupBy(F.to_date("ts").alias("date")).agg(F.sum("global_rad_w").alias("rad_sum"), F.max("global_rad_w").alias("rad_max"))
    m = F.col("rad_max")
    return day.withColumn("rad_class", F.when(m <= 100, 0).when(m <= 400, 1).when(m > 400, 2))


def calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Sines and cosines of the hour, the weekday (Monday 0) and the month."""
    turn = {"hour": F.hour(ts) / 24, "dow": F.weekday(ts) / 7, "month": (F.month(ts) - 1) / 12}
    return df.withColumns({f"{k}_{n}": f(2 * math.pi * x) for k, x in turn.items() for n, f in (("sin", F.sin), ("cos", F.cos))})


def temperature_bands(df: DataFrame, temp: str = "t_2m_c", hot: float = 25.0, cold: float = 10.0) -> DataFrame:
    return df.withColumns({"is_hot": F.col(temp) > hot, "is_cold": F.col(temp) < cold, "cdd": degrees_above(temp), "hdd": degrees_below(temp)})


def evening_start(rows: DataFrame, by: list[str] | None = None, below: float = 20.0, ts: str = "ts", rad: str = "global_rad_w") -> DataFrame:
    """by, date, peak, evening: the first time of a day's highest radiation, and the first time from there on at which it
    lies under `below` (null on days that stay above). Days without radiation have no row."""
    keys = [*(by or []), "date"]
    day = Window.partitionBy(*keys)
    # the ordered window first: all share its sort, and no table of days is held
    seen = rows.where(F.col(rad).isNotNull()).withColumn("date", F.to_date(ts)).withColumn("__n", F.row_number().over(day.orderBy(ts)))
    seen = seen.withColumn("__top", F.max(rad).over(day))
    seen = seen.withColumn("__peak", F.min(F.when(F.col(rad) == F.col("__top"), F.col(ts))).over(day))
    late = (F.col(ts) >= F.col("__peak")) & (F.col(rad) < below)
    seen = seen.withColumn("__evening", F.min(F.when(late, F.col(ts))).over(day)).where("__n = 1")
    return seen.select(*keys, F.col("__peak").alias("peak"), F.col("__evening").alias("evening"))
