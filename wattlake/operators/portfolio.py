"""Portfolio statistics and the tables behind charts, from one row a customer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clip, wilson

APPLIANCES = ("pv", "battery", "ac", "hp", "ev")


def unpivoted(row: DataFrame, names: list[str] | None = None) -> DataFrame:
    """metric, value of a one-row table of numbers."""
    names = names or row.columns
    return row.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "metric", "value")


def portfolio_totals(results: DataFrame, z: float = 1.96) -> DataFrame:
    """Capacity totals and the capacity-weighted self-consumption share with intervals."""
    pv = results.where("has_pv and pv_capacity_kwp is not null")
    lo, hi = F.coalesce("pv_ci_lower", "pv_capacity_kwp"), F.coalesce("pv_ci_upper", "pv_capacity_kwp")
    se = (hi - lo) / (2 * z)
    q = lambda p: F.percentile("pv_capacity_kwp", F.lit(p))
    fine = F.col("sc_share").isNotNull() & (F.col("pv_capacity_kwp") > 0)
    cap, sc = F.when(fine, F.col("pv_capacity_kwp")), F.when(fine, F.col("sc_share"))
    busy = fine & (F.col("sc_share") > 0)
    row = pv.agg(
        F.count("*").alias("n_pv"), F.sum("pv_capacity_kwp").alias("capacity_kwp"), F.sum(lo).alias("capacity_low_all"), F.sum(hi).alias("capacity_high_all"),
        (F.sum("pv_capacity_kwp") - z * F.sqrt(F.sum(se * se))).alias("capacity_low_independent"), (F.sum("pv_capacity_kwp") + z * F.sqrt(F.sum(se * se))).alias("capacity_high_independent"),
        F.avg("pv_capacity_kwp").alias("mean_kwp"), q(0.5).alias("median_kwp"), q(0.25).alias("q25_kwp"), q(0.75).alias("q75_kwp"),
        F.try_divide(F.sum(cap * sc), F.sum(cap)).alias("sc_weighted"), F.try_divide(F.sum(F.when(busy, cap * sc)), F.sum(F.when(busy, cap))).alias("sc_weighted_nonzero"), F.sum("yearly_prod").alias("yearly_prod"),
    )
    return unpivoted(row)


def segment_fences(results: DataFrame, least: int = 30) -> DataFrame:
    """Capacity statistics and fences of 2 interquartile ranges by segment; small segments go to `other`."""
    pv = results.where("has_pv and pv_capacity_kwp > 0").withColumn("segment", F.coalesce("segment", F.lit("unknown")))
    n = F.count("*").over(Window.partitionBy("segment"))
    s = pv.withColumn("segment", F.when(n < least, "other").otherwise(F.col("segment")))
    q = lambda p: F.percentile("pv_capacity_kwp", F.lit(p))
    g = s.groupBy("segment").agg(F.count("*").alias("n"), F.avg("pv_capacity_kwp").alias("mean"), q(0.5).alias("median"), q(0.25).alias("q25"), q(0.75).alias("q75"))
    iqr = F.col("q75") - F.col("q25")
    return g.withColumns({"low_fence": F.greatest(F.col("q25") - 2 * iqr, F.lit(0.0)), "high_fence": F.col("q75") + 2 * iqr})


def capacity_flags(results: DataFrame, fences: DataFrame) -> DataFrame:
    """How each capacity lies to the fences of its segment; segments without fences are held against those of `other`."""
    c = F.col("pv_capacity_kwp")
    flag = F.when(c.isNull() | (c <= 0), "no_data").when(c < F.col("low_fence"), "too_low").when(c > F.col("high_fence"), "too_high").otherwise("ok")
    bounds = fences.select("segment", "low_fence", "high_fence")
    rows = results.where("has_pv").withColumn("segment", F.coalesce("segment", F.lit("unknown")))
    # one row a segment
    rows = rows.join(F.broadcast(bounds.select("segment", F.lit(True).alias("__own"))), "segment", "left")
    rows = rows.withColumn("segment", F.when(F.col("__own").isNull(), "other").otherwise(F.col("segment"))).join(F.broadcast(bounds), "segment", "left")
    return rows.select("customer_id", "segment", "pv_capacity_kwp", flag.alias("capacity_flag"))


def yield_gross(results: DataFrame, low: float = 800.0, high: float = 1200.0) -> DataFrame:
    """Yearly kWh per kWp with own use put back (share clipped to 0 to 0.7)."""
    y = F.try_divide(F.col("yearly_prod") / (1 - clip(F.coalesce("sc_share", F.lit(0.0)), 0.0, 0.7)), F.when(F.col("pv_capacity_kwp") > 0, F.col("pv_capacity_kwp")))
    return results.where("has_pv").select("customer_id", y.alias("yield_kwh_kwp"), F.when(y.isNull(), "no_data").when(y < low, "too_low").when(y > high, "too_high").otherwise("ok").alias("yield_flag"))


def yield_export(results: DataFrame, low: float = 600.0, high: float = 1400.0) -> DataFrame:
    y = F.try_divide(F.col("yearly_prod"), F.when(F.col("pv_capacity_kwp") > 0, F.col("pv_capacity_kwp")))
    return results.where("has_pv").select("customer_id", y.alias("yield_kwh_kwp"), F.when(y.isNull(), "missing").when(y < low, "low").when(y > high, "high").otherwise("ok").alias("yield_check"))


def evaluate_agreement(results: DataFrame) -> DataFrame:
    """How regression and floor estimates agree, and yield statistics."""
    x = results.where("has_pv and pv_capacity_regression > 0").withColumn("ratio", F.col("pv_capacity_floor") / F.col("pv_capacity_regression"))
    y = yield_gross(results)
    a = x.agg(F.count("*").alias("n"), F.avg("ratio").alias("mean_ratio"), F.percentile("ratio", F.lit(0.5)).alias("median_ratio"), F.avg(F.when(F.col("ratio").between(0.7, 1.3), 1.0).otherwise(0.0)).alias("share_agreeing"))
    b = y.agg(F.avg("yield_kwh_kwp").alias("mean_yield"), F.percentile("yield_kwh_kwp", F.lit(0.5)).alias("median_yield"), F.avg(F.when(F.col("yield_flag") == "ok", 1.0).otherwise(0.0)).alias("share_plausible"))
    return unpivoted(a).unionByName(unpivoted(b))


def battery_columns(results: DataFrame, threshold: float = 0.5, margin: float = 0.15) -> DataFrame:
    known = F.lower("battery_status").isin("success", "ok")
    return results.withColumns({"detected": F.coalesce(F.col("has_battery"), F.col("prob_battery") >= threshold), "reliable": known & (F.abs(F.col("prob_battery") - threshold) >= margin), "is_pv": F.coalesce("has_pv", F.lit(False))})


def battery_summary(results: DataFrame) -> DataFrame:
    b = battery_columns(results)
    n = lambda *c: F.count_if(reduce(lambda a, x: a & x, c))
    d, r, p, cap = F.col("detected"), F.col("reliable"), F.col("is_pv"), F.col("battery_capacity_kwh")
    q = lambda p_: F.percentile(F.when(d, cap), F.lit(p_))
    return unpivoted(b.agg(
        F.count("*").alias("n_customers"), n(p).alias("n_pv"), n(d).alias("n_detected"), n(d, p).alias("n_detected_pv"), n(d, ~p).alias("n_detected_no_pv"), n(r).alias("n_reliable"), n(~r).alias("n_unreliable"), n(d, r).alias("n_detected_reliable"),
        F.try_divide(n(d), F.count("*")).alias("share_detected"), F.try_divide(n(d, p), n(p)).alias("share_detected_of_pv"), n(d, cap.isNotNull()).alias("n_with_capacity"), n(d, cap.isNull()).alias("n_without_capacity"),
        F.sum(F.when(d, cap)).alias("capacity_kwh"), F.avg(F.when(d, cap)).alias("mean_kwh"), q(0.5).alias("median_kwh"), q(0.25).alias("q25_kwh"), q(0.75).alias("q75_kwh"), F.avg("prob_battery").alias("mean_prob"), F.avg(F.when(d, F.col("prob_battery"))).alias("mean_prob_detected"),
        F.avg(F.when(d, F.col("n_matched_sunny_days"))).alias("mean_matched_days_detected"), F.avg(F.when(~d, F.col("n_matched_sunny_days"))).alias("mean_matched_days_other"),
    ))


def battery_overview(results: DataFrame) -> DataFrame:
    """Rows for customers with solar, without, and all."""
    b = battery_columns(results)
    g = b.rollup("is_pv").agg(F.grouping("is_pv").alias("total"), F.count("*").alias("n"), F.count_if("detected").alias("n_detected"), F.avg(F.when(F.col("detected"), F.col("battery_capacity_kwh"))).alias("mean_kwh"), F.percentile(F.when(F.col("detected"), F.col("battery_capacity_kwh")), F.lit(0.5)).alias("median_kwh"))
    return g.select(F.when(F.col("total") == 1, "all").when(F.col("is_pv"), "pv").otherwise("no_pv").alias("segment"), "n", "n_detected", "mean_kwh", "median_kwh")


def long_flags(results: DataFrame) -> DataFrame:
    """customer_id, appliance, has, prob."""
    pairs = ", ".join(f"'{a}', has_{a}, prob_{a}" for a in APPLIANCES)
    return results.select("customer_id", F.expr(f"stack({len(APPLIANCES)}, {pairs}) as (appliance, has, prob)"))


def adoption(results: DataFrame) -> DataFrame:
    g = long_flags(results).groupBy("appliance").agg(F.count_if("has").alias("k"), F.count("*").alias("n"), F.avg("prob").alias("mean_prob"))
    lo, hi = wilson("k", "n")
    return g.select("appliance", "k", "n", F.try_divide("k", "n").alias("share"), lo.alias("low"), hi.alias("high"), "mean_prob")


def cooccurrence(results: DataFrame) -> DataFrame:
    """Customers with both of every two appliances, from one pass of conditional counts."""
    flags = {a: F.coalesce(F.col(f"has_{a}"), F.lit(False)) for a in APPLIANCES}
    row = results.agg(F.count("*").alias("n"), *[F.count_if(flags[a] & flags[b]).alias(f"{a}:{b}") for a in APPLIANCES for b in APPLIANCES])
    names = [c for c in row.columns if c != "n"]
    out = row.unpivot(["n"], names, "pair", "k")
    return out.select(F.split_part("pair", F.lit(":"), F.lit(1)).alias("first"), F.split_part("pair", F.lit(":"), F.lit(2)).alias("second"), "k", F.try_divide("k", "n").alias("share"))


def exclusive_pairs(results: DataFrame) -> DataFrame:
    """Of (pv, battery), (pv, ev), (ev, battery): only the first, only the second, both."""
    f = {a: F.coalesce(F.col(f"has_{a}"), F.lit(False)) for a in APPLIANCES}
    pairs = (("pv", "battery"), ("pv", "ev"), ("ev", "battery"))
    row = results.agg(*[F.count_if(c).alias(f"{a}_{b}_{n}") for a, b in pairs for n, c in (("first", f[a] & ~f[b]), ("second", f[b] & ~f[a]), ("both", f[a] & f[b]))])
    return unpivoted(row)


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts of equal bins from low to high (the last one closed); values outside are left out."""
    x = F.col(value)
    b = F.least(F.floor((x - low) / ((high - low) / bins)).cast("int"), F.lit(bins - 1)).alias("bin")
    return rows.where((x >= low) & (x <= high)).groupBy(*(by or []), b).agg(F.count("*").alias("n"))


def capacity_histogram(results: DataFrame, width: float = 2.0, most: float = 100.0) -> DataFrame:
    """Capacity bins; bin -1 counts what lies beyond."""
    c = F.col("pv_capacity_kwp")
    return results.where("has_pv and pv_capacity_kwp is not null").groupBy(F.when(c > most, -1).otherwise(F.floor(c / width).cast("int")).alias("bin")).agg(F.count("*").alias("n"))


def status_breakdown(results: DataFrame, top: int = 12) -> DataFrame:
    return results.groupBy("battery_status").count().orderBy(F.desc("count"), "battery_status").limit(top)


def box_statistics(results: DataFrame) -> DataFrame:
    """Quartiles of battery capacity for customers with solar, without, and all."""
    b = battery_columns(results).where("detected and battery_capacity_kwh is not null").withColumn("segment", F.explode(F.array(F.when(F.col("is_pv"), "pv").otherwise("no_pv"), F.lit("all"))))
    q = lambda p: F.percentile("battery_capacity_kwh", F.lit(p))
    return b.groupBy("segment").agg(F.count("*").alias("n"), F.min("battery_capacity_kwh").alias("low"), q(0.25).alias("q25"), q(0.5).alias("median"), q(0.75).alias("q75"), F.max("battery_capacity_kwh").alias("high"))


def days_histogram(results: DataFrame, column: str) -> DataFrame:
    """Counts of a day count by whether a battery was detected."""
    return battery_columns(results).groupBy("detected", column).agg(F.count("*").alias("n"))


def density(values: DataFrame, value: str, points: int = 1000, fine: int = 256) -> DataFrame:
    """x, density: Gaussian kernel density of the positive values at `points` places over their range widened by half of it
    on both sides, Scott's bandwidth. Values are first counted in bins of a `fine`-th of the bandwidth, each at its mean,
    and a bin meets the places within nine bandwidths only, beyond which the kernel is under 1e-17."""
    values = values.where(F.col(value) > 0)
    s = values.agg(F.count("*").alias("n"), F.stddev_samp(value).alias("sd"), F.min(value).alias("lo"), F.max(value).alias("hi")).where("sd > 0")  # one row
    span = F.col("hi") - F.col("lo")
    s = F.broadcast(s.select("n", "lo", (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h"), (F.col("lo") - 0.5 * span).alias("start"), (2 * span / (points - 1)).alias("step")))
    bins = values.crossJoin(s).groupBy(F.floor((F.col(value) - F.col("lo")) / F.col("h") * fine).alias("bin")).agg(F.avg(value).alias("v"), F.count("*").alias("times")).crossJoin(s)
    place = lambda v: (v - F.col("start")) / F.col("step")
    first, last = F.greatest(F.ceil(place(F.col("v") - 9 * F.col("h"))), F.lit(0)), F.least(F.floor(place(F.col("v") + 9 * F.col("h"))), F.lit(points - 1))
    near = bins.where(first <= last).withColumn("i", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    k = F.exp(-0.5 * F.pow((F.col("start") + F.col("step") * F.col("i") - F.col("v")) / F.col("h"), F.lit(2))) / (F.col("h") * 2.5066282746310002)
    dense = near.groupBy("i").agg((F.sum(k * F.col("times")) / F.first("n")).alias("d"))
    grid = s.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    return grid.join(dense, "i", "left").select((F.col("start") + F.col("step") * F.col("i")).alias("x"), F.coalesce("d", F.lit(0.0)).alias("density"))
