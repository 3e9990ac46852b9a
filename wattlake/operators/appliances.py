"""Air conditioning and heat pumps: feature vectors, load profiles, labels, disaggregation features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EPS, balance, clip, degrees_above, degrees_below, micros, safe_corr, season, slot_of_day

SUMMER, WINTER, SPRING, AUTUMN = (6, 7, 8), (12, 1, 2), (3, 4, 5), (9, 10, 11)
LAGS = (1, 4, 96)
#: Disaggregation: lags and windows in rows, radiation that parts day and night, kW from which an appliance runs.
ROW_LAGS, WINDOWS = (1, 4, 8, 96), (4, 8, 96)
DAYLIGHT = {"AC": 50.0, "HP": 20.0}
RUNNING_KW = {"AC": 0.30, "HP": 0.20}
TINY = 1e-6
QUANTILES = (0.05, 0.10, 0.50, 0.95)
#: When a curve can be used: rows, winter rows, summer rows, longest gap in days, coverage.
USABLE = {"AC": (500, 0, 200, 21.0, 0.30), "HP": (1000, 500, 500, 21.0, 0.50), "TOT": (500, 0, 0, 90.0, 0.10)}


def load_rows(aligned: DataFrame) -> DataFrame:
    """customer_id, ts, load (kW), temp, rad."""
    return aligned.select("customer_id", "ts", (F.col("conso_kwh") * 4).alias("load"), F.col("t_2m_c").alias("temp"), F.col("global_rad_w").alias("rad"))


def with_row_lags(rows: DataFrame, steps=LAGS) -> DataFrame:
    """Adds lag_k: the load k rows earlier in the customer's rows that have a load."""
    w = Window.partitionBy("customer_id").orderBy("ts")
    return rows.where("load is not null").withColumns({f"lag_{k}": F.lag("load", k).over(w) for k in steps})


def autocorr(k: int):
    x = F.when(F.col(f"lag_{k}").isNotNull(), F.col("load"))
    return F.when(F.count("load") > k + 2, safe_corr(x, f"lag_{k}", 2))


def hp_features(rows: DataFrame, most_rad: float = 20.0, least_rows: int = 100, hot: float = 28.0, cold: float = 10.0) -> DataFrame:
    """Features of the dark rows; customers with fewer than least_rows of them give no row."""
    night = with_row_lags(rows.where(F.col("rad") <= most_rad))
    on = lambda m, c="load": F.avg(F.when(m, F.col(c)))
    t = F.col("temp")
    return night.groupBy("customer_id").agg(
        F.count("*").alias("n_night_rows"), safe_corr("load", "temp").alias("corr_all"),
        safe_corr(F.when(t > hot, F.col("load")), F.when(t > hot, t)).alias("corr_hot"), safe_corr(F.when(t < cold, F.col("load")), F.when(t < cold, t)).alias("corr_cold"),
        balance(on(season("ts", SUMMER)), on(season("ts", WINTER))).alias("season_balance"), balance(on(t > hot), on(t < cold)).alias("thermal_balance"),
        *[autocorr(k).alias(f"autocorr_{k}") for k in LAGS], (F.stddev_samp("load") / (F.abs(F.avg("load")) + EPS)).alias("coeff_var"),
    ).where(F.col("n_night_rows") >= least_rows)


def ac_features(rows: DataFrame, least_rad: float = 50.0, least_rows: int = 100, hot: float = 25.0, cold: float = 10.0) -> DataFrame:
    """Features of the sunny rows (of all rows where those are fewer than least_rows)."""
    known = rows.where("load is not null")
    days = known.groupBy("customer_id").agg(F.count_if(F.col("rad") > least_rad).alias("n_day_rows"))
    part = known.join(days, "customer_id").where((F.col("n_day_rows") < least_rows) | (F.col("rad") > least_rad))
    on = lambda m, c="load": F.avg(F.when(m, F.col(c)))
    t, total = F.col("temp"), F.abs(F.avg("load")) + EPS
    main = with_row_lags(part, (4, 96)).groupBy("customer_id").agg(
        F.first("n_day_rows").alias("n_day_rows"), F.count("*").alias("n_rows"), (F.first("n_day_rows") >= least_rows).alias("used_daytime_only"),
        safe_corr("load", "temp").alias("corr_all"), safe_corr(F.when(t > hot, F.col("load")), F.when(t > hot, t)).alias("corr_hot"), safe_corr("load", "rad").alias("corr_rad_all"),
        balance(on(season("ts", SUMMER)), on(season("ts", WINTER))).alias("season_balance"), balance(on(t > hot), on(t < cold)).alias("thermal_balance"),
        *[autocorr(k).alias(f"autocorr_{k}") for k in (4, 96)], (F.stddev_samp("load") / total).alias("coeff_var"),
        (on(season("ts", SUMMER)) / total).alias("summer_ratio"), (on(t > hot) / total).alias("hot_ratio"), (on(season("ts", SUMMER)) / (on(season("ts", SPRING)) + EPS)).alias("summer_vs_spring"),
        (on(F.hour("ts").between(14, 18)) / total).alias("afternoon_peak_ratio"),
    )
    share = known.where("rad is not null").groupBy("customer_id").agg(balance(F.avg(F.when(F.col("rad") > least_rad, F.col("load"))), F.avg(F.when(F.col("rad") <= least_rad, F.col("load")))).alias("daytime_share"))
    hour = part.where(season("ts", SUMMER)).groupBy("customer_id", F.hour("ts").alias("h")).agg(F.avg("load").alias("m"))
    top = hour.groupBy("customer_id").agg(F.min_by("h", F.struct(-F.round("m", 9), F.col("h"))).alias("peak_hour"))
    return main.join(share, "customer_id", "left").join(top, "customer_id", "left")


def load_profile(rows: DataFrame, heat: bool = False) -> DataFrame:
    """Quantiles and ratios of a customer's load (rows: customer_id, ts, load, rad), day and night by radiation;
    for heat pumps with how much the profile is like theirs."""
    kind = "HP" if heat else "AC"
    part = lambda m: F.avg(F.when(m, F.col("load")))
    # one table of values for all quantiles
    p = rows.groupBy("customer_id").agg(
        F.percentile("load", F.array(*map(F.lit, QUANTILES))).alias("__q"), F.avg("load").alias("mean"), F.stddev_samp("load").alias("std"),
        part(F.col("rad") <= DAYLIGHT[kind]).alias("night_mean"), part(F.col("rad") > DAYLIGHT[kind]).alias("day_mean"),
    )
    p = p.select("customer_id", *[F.col("__q")[i].alias(c) for i, c in enumerate(("q05", "q10", "q50", "q95"))], "mean", "std", "night_mean", "day_mean")
    above = rows.join(p.select("customer_id", "q10"), "customer_id").groupBy("customer_id").agg(F.avg(F.when(F.col("load") > F.col("q10") + RUNNING_KW[kind], 1.0).otherwise(0.0)).alias("share_above_base"))
    p = p.join(above, "customer_id").withColumns({
        "day_night_ratio": F.col("day_mean") / (F.col("night_mean") + TINY), "load_factor": F.col("mean") / (F.col("q95") + TINY),
        "spike": F.col("std") / (F.abs("mean") + TINY), "base_share": F.col("q10") / (F.col("mean") + TINY),
    })
    if not heat:
        return p.drop("q05")
    known = lambda c, other: F.coalesce(F.col(c), F.lit(other))
    s = 0.5 * clip(known("load_factor", 0.0), 0.0, 1.0) + 0.3 * known("share_above_base", 0.0) - 0.15 * clip(known("spike", 0.0) / 2.5, 0.0, 1.0) - 0.05 * clip(F.abs(known("day_night_ratio", 1.0) - 1), 0.0, 2.0) / 2
    return p.withColumn("hp_likeness", clip(s, 0.0, 1.0)).withColumn("hp_class", F.when(F.col("hp_likeness") >= 0.60, "scientific_like").when(F.col("hp_likeness") <= 0.35, "dataport_like").otherwise("uncertain"))


def disagg_features(rows: DataFrame, heat: bool = False) -> DataFrame:
    """Lags, rolling statistics of the rows before, differences, calendar, weather and the customer's profile of load rows."""
    kind = "HP" if heat else "AC"
    w = Window.partitionBy("customer_id").orderBy("ts")
    past = lambda k: w.rowsBetween(-k, -1)
    out = rows.withColumns({f"lag_{k}": F.lag("load", k).over(w) for k in ROW_LAGS} | {f"roll_mean_{k}": F.avg("load").over(past(k)) for k in WINDOWS} | {f"roll_std_{k}": F.stddev_samp("load").over(past(k)) for k in WINDOWS})
    out = out.withColumns({"diff_1": F.col("load") - F.col("lag_1"), "diff_4": F.col("load") - F.col("lag_4"), "hour": F.hour("ts"), "minute": F.minute("ts"), "quarter_index": slot_of_day("ts"), "dow": F.weekday("ts"), "month": F.month("ts")})
    turn = lambda c, n: 2 * math.pi * F.col(c) / n
    out = out.withColumns({"qidx_sin": F.sin(turn("quarter_index", 96)), "qidx_cos": F.cos(turn("quarter_index", 96)), "dow_sin": F.sin(turn("dow", 7)), "dow_cos": F.cos(turn("dow", 7)), "month_sin": F.sin(2 * math.pi * (F.col("month") - 1) / 12), "month_cos": F.cos(2 * math.pi * (F.col("month") - 1) / 12)})
    if heat:
        night = F.coalesce(F.col("rad") <= DAYLIGHT[kind], F.lit(False)).cast("int")
        out = out.withColumns({"hdd_18": degrees_below("temp"), "is_night": night, "hdd_x_night": degrees_below("temp") * night})
    else:
        day = F.coalesce(F.col("rad") > DAYLIGHT[kind], F.lit(False)).cast("int")
        hot = degrees_above("temp", 28.0)
        out = out.withColumns({"cdd_28": hot, "is_day": day, "is_summer": season("ts", SUMMER).cast("int"), "cdd28_x_afternoon": hot * F.hour("ts").between(14, 17).cast("int"), "cdd28_x_day": hot * day})
    profile = load_profile(rows, heat)
    profile = profile.select("customer_id", *[F.col(c).alias(f"user_{c}") for c in profile.columns if c not in ("customer_id", "hp_likeness", "hp_class")], *[c for c in ("hp_likeness",) if heat])
    out = out.join(profile, "customer_id")
    return out.withColumns({"tot_minus_baseline": F.col("load") - F.col("user_q10"), "tot_over_mean": F.col("load") / (F.col("user_mean") + TINY), "tot_over_p95": F.col("load") / (F.col("user_q95") + TINY)})


def rebuilt_load(aligned: DataFrame, capacity: DataFrame) -> DataFrame:
    """Load in kW with the forecast of own solar production put back; capacity: customer_id, pv_capacity_kwp. Absent
    consumption, production and radiation count as 0; only customers with a capacity are kept from falling below 0."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    kwp = zero(F.when(F.col("pv_capacity_kwp") > 0, F.col("pv_capacity_kwp")))
    sun = F.greatest(zero("global_rad_w"), F.lit(0.0)) / 1000 * kwp * 0.25
    total = F.when(kwp > 0, F.greatest(zero("conso_kwh") - zero("prod_kwh") + sun, F.lit(0.0))).otherwise(zero("conso_kwh")) * 4
    return aligned.join(capacity, "customer_id", "left").select("customer_id", "ts", total.alias("load"), F.col("t_2m_c").alias("temp"), F.col("global_rad_w").alias("rad"))


def curve_quality(curves: DataFrame, by: list[str]) -> DataFrame:
    """Times, winter and summer ones, longest gap in days, coverage, start and end of each curve (ts, ...); a repeated
    time counts once."""
    w = Window.partitionBy(*by).orderBy("ts")
    c = curves.withColumn("__s", micros("ts")).withColumn("__g", F.col("__s") - F.lag("__s").over(w))
    first = F.coalesce(F.col("__g") > 0, F.lit(True))
    day = 86_400_000_000
    return c.groupBy(*by).agg(
        F.count_if(first).alias("n_rows"), F.count_if(first & season("ts", WINTER)).alias("n_winter"), F.count_if(first & season("ts", SUMMER)).alias("n_summer"),
        (F.coalesce(F.max("__g"), F.lit(0)) / day).alias("max_gap_days"), (F.count_if(first) / (F.floor((F.max("__s") - F.min("__s")) / 900_000_000) + 1)).alias("coverage"), F.min("ts").alias("start"), F.max("ts").alias("end"),
    )


#: Reasons of `usable`.
QUALITY = ("too_few_rows", "too_few_winter_rows", "too_few_summer_rows", "gap_too_long", "coverage_too_low")


def usable(quality: DataFrame, rows: int, winter: int, summer: int, gap_days: float, coverage: float) -> DataFrame:
    """Adds reason: the first rule that fails, or ok."""
    reason = F.when(F.col("n_rows") < rows, "too_few_rows").when(F.col("n_winter") < winter, "too_few_winter_rows").when(F.col("n_summer") < summer, "too_few_summer_rows").when(F.col("max_gap_days") > gap_days, "gap_too_long").when(F.col("coverage") < coverage, "coverage_too_low").otherwise("ok")
    return quality.withColumn("reason", reason)


def ac_label(curves: DataFrame, rules: tuple = USABLE["AC"], least: float = 0.2, hot: float = 25.0) -> DataFrame:
    """customer_id, has_ac, reason of air-conditioning curves (customer_id, ts, kw, temp): of a usable curve the first
    test that passes decides, correlation with temperature, that of hot rows, the mean of summer."""
    rows = curves.where("ts is not null")
    t = F.col("temp")
    a = rows.groupBy("customer_id").agg(safe_corr("kw", "temp").alias("corr_all"), safe_corr(F.when(t > hot, F.col("kw")), F.when(t > hot, t)).alias("corr_hot"), F.avg(F.when(season("ts", SUMMER), F.col("kw"))).alias("summer_mean"))
    a = a.join(usable(curve_quality(rows, ["customer_id"]), *rules).select("customer_id", F.col("reason").alias("quality")), "customer_id")
    reason = F.when(F.col("quality") != "ok", F.col("quality")).when(F.col("corr_all") >= least, "all_year_corr").when(F.col("corr_hot") >= least, "hot_check").when(F.col("summer_mean") > 0.05, "summer_mean_positive").otherwise("weak_ac_signal")
    return a.withColumn("reason", reason).withColumn("has_ac", F.col("reason").isin("all_year_corr", "hot_check", "summer_mean_positive")).drop("quality")


def hp_label(curves: DataFrame, rules: tuple = USABLE["HP"], least: float = 0.2, hot: float = 28.0, cold: float = 10.0) -> DataFrame:
    """customer_id, hp_season (winter_hp, summer_hp or null), reason of heat-pump curves (customer_id, ts, kw, temp): a
    usable curve that falls with temperature heats, one that rises cools, over all rows or else over cold and hot ones."""
    rows = curves.where("ts is not null")
    t = F.col("temp")
    a = rows.groupBy("customer_id").agg(safe_corr("kw", "temp").alias("corr_all"), safe_corr(F.when(t > hot, F.col("kw")), F.when(t > hot, t)).alias("corr_hot"), safe_corr(F.when(t < cold, F.col("kw")), F.when(t < cold, t)).alias("corr_cold"))
    a = a.join(usable(curve_quality(rows, ["customer_id"]), *rules).select("customer_id", F.col("reason").alias("quality")), "customer_id")
    heats, cools = F.coalesce(F.col("corr_cold") <= -least, F.lit(False)), F.coalesce(F.col("corr_hot") >= least, F.lit(False))
    stronger = F.abs("corr_cold") >= F.abs("corr_hot")
    reason = (F.when(F.col("quality") != "ok", F.col("quality")).when(F.abs("corr_all") >= least, "all_year_corr").when(heats & cools & stronger, "cold_check_stronger_than_hot")
              .when(heats & cools, "hot_check_stronger_than_cold").when(heats, "cold_check").when(cools, "hot_check").otherwise("weak_after_temperature_checks"))
    season_ = F.when(F.col("reason") == "all_year_corr", F.when(F.col("corr_all") < 0, "winter_hp").otherwise("summer_hp")).when(F.col("reason").isin("cold_check_stronger_than_hot", "cold_check"), "winter_hp").when(F.col("reason").isin("hot_check_stronger_than_cold", "hot_check"), "summer_hp")
    return a.withColumn("reason", reason).withColumn("hp_season", season_).drop("quality")


def exports(curves: DataFrame, below: float = -0.1, share: float = 0.03) -> DataFrame:
    """customer_id of the curves (customer_id, kw) of which that share of readings at least lies below `below`."""
    return curves.where("kw is not null").groupBy("customer_id").agg(F.avg((F.col("kw") < below).cast("double")).alias("s")).where(F.col("s") >= share).select("customer_id")


def aligned_pairs(training: DataFrame, kind: str, rules: tuple = USABLE["TOT"], label_rules: tuple | None = None) -> DataFrame:
    """The rows that disaggregation of `kind` (AC or HP) learns from: a usable total beside the appliance's own curve at
    the same time, with whether it runs and its share of the total. Of repeated times the first row by value counts.
    Heat pumps: only winter ones, and no customers that export. training: type, customer_id, ts, value_kw_mean, temp, glob_rad."""
    tot = training.where("type = 'TOT' and ts is not null").select("customer_id", "ts", F.col("value_kw_mean").alias("kw"), "temp", F.col("glob_rad").alias("rad"))
    part = training.where((F.col("type") == kind) & F.col("ts").isNotNull()).select("customer_id", "ts", F.col("value_kw_mean").alias("kw"), "temp")
    fine = usable(curve_quality(tot, ["customer_id"]), *rules).where("reason = 'ok'").select("customer_id")
    if kind == "HP":
        fine = fine.join(exports(tot), "customer_id", "left_anti")
        fine = fine.join(hp_label(part, label_rules or USABLE["HP"]).where("hp_season = 'winter_hp'").select("customer_id"), "customer_id", "left_semi")
    first = lambda df, *cols: df.groupBy("customer_id", "ts").agg(F.min(F.struct("kw", *cols)).alias("r")).select("customer_id", "ts", "r.*")
    name = kind.lower()
    both = first(tot, "temp", "rad").withColumnRenamed("kw", "tot_kw").join(first(part).withColumnRenamed("kw", f"{name}_kw"), ["customer_id", "ts"]).join(fine, "customer_id", "left_semi").where(F.abs("tot_kw") > TINY)
    return both.withColumns({f"{name}_on": (F.col(f"{name}_kw") >= RUNNING_KW[kind]).cast("int"), f"{name}_ratio": clip(F.col(f"{name}_kw") / (F.col("tot_kw") + TINY), 0.0, 1.0)})


def row_weights(rows: DataFrame) -> DataFrame:
    """rows with sample_weight: one over the customer's rows, scaled to a mean of 1."""
    n = rows.groupBy("customer_id").agg(F.count("*").alias("__n"))
    total = n.agg((F.sum("__n") / F.count("*")).alias("__mean"))  # one row
    return rows.join(n.crossJoin(F.broadcast(total)), "customer_id").withColumn("sample_weight", F.col("__mean") / F.col("__n")).drop("__n", "__mean")


def in_celsius(rows: DataFrame, temp: str = "temp", above: float = 55.0) -> DataFrame:
    """rows with the temperatures of customers whose highest is over `above` taken as Fahrenheit."""
    top = F.max(temp).over(Window.partitionBy("customer_id"))
    return rows.withColumn("__top", top).withColumn(temp, F.when(F.col("__top") > above, (F.col(temp) - 32) * 5 / 9).otherwise(F.col(temp))).drop("__top")


def annual_energy(rows: DataFrame, kw: str, by: list[str]) -> DataFrame:
    """kWh of quarter-hour kW and their mean by `by`."""
    return rows.groupBy(*by).agg((F.sum(kw) * 0.25).alias("kwh"), F.avg(kw).alias("mean_kw"))
