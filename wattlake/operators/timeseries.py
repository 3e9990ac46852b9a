"""Time-series operators: as-of joins, grids, interpolation, runs, lags and rolling windows.

All work is keyed; windows run within one key's series (35,040 quarter-hours a year at most).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import from_micros, micros

QUARTER = 15 * 60
#: Seconds of the buckets of an as-of join without a tolerance.
CARRY = 3600


def asof_join(left: DataFrame, right: DataFrame, tolerance: int | None, direction: str = "backward", ts: str = "ts") -> DataFrame:
    """left with the columns of the right row that is last at or before each time (or nearest to it,
    the earlier one at equal distance) within `tolerance` seconds; unmatched rows keep nulls. Each left row
    meets the right rows of its time bucket in one equi-join, never a range join. tolerance None carries
    the last row before, over any gap, by hours of the calendar. Equal right times: the row greatest by its columns is taken."""
    cols = [c for c in right.columns if c != ts]
    rows = right.where(F.col(ts).isNotNull()).groupBy(F.col(ts).alias("__r")).agg(F.max(F.struct(*cols)).alias("__row")).withColumn("__ru", micros("__r"))
    if tolerance is None:
        # a row for each hour of the calendar: the right rows of the hour after the last one before it; left is read once
        # and meets the row of its hour, or the last one of all
        step = CARRY * 1_000_000
        end = lambda x: F.try_element_at(x, F.lit(-1))
        w = Window.orderBy("__b")
        hours = rows.groupBy(F.floor(F.col("__ru") / step).alias("__b")).agg(F.array_sort(F.collect_list(F.struct("__ru", "__row"))).alias("__near"))
        hours = hours.select("__b", "__near", F.lag("__near").over(w).alias("__before"), F.lead("__b").over(w).alias("__next"))
        upto = F.when(F.col("__before").isNull(), F.col("__near")).otherwise(F.concat(F.array(end(F.col("__before"))), F.col("__near")))
        spread = hours.withColumn("__at", F.explode(F.sequence("__b", F.coalesce(F.col("__next") - 1, F.col("__b")))))
        spread = spread.select(F.col("__at").alias("__b"), F.when(F.col("__at") == F.col("__b"), upto).otherwise(F.array(end(F.col("__near")))).alias("__near"))
        final = rows.agg(F.max("__ru").alias("__end"), F.max_by("__row", "__ru").alias("__final"))
        out = left.withColumn("__lu", micros(ts)).withColumn("__at", F.floor(F.col("__lu") / step)).join(spread, F.col("__at") == F.col("__b"), "left").join(F.broadcast(final))
        best = end(F.filter("__near", lambda x: x["__ru"] <= F.col("__lu")))["__row"]
        out = out.withColumn("__best", F.when(F.col("__lu") >= F.col("__end"), F.col("__final")).otherwise(best))
        return out.select(*left.columns, *[F.col(f"__best.{c}").alias(c) for c in cols])
    # the right rows that a bucket of left times can reach, in order: left is read once and meets one row a bucket
    tol = tolerance * 1_000_000
    bucket = F.floor(F.col("__ru") / tol)
    reach = [bucket, bucket + 1] if direction == "backward" else [bucket - 1, bucket, bucket + 1]
    spread = rows.withColumn("__b", F.explode(F.array(*reach))).groupBy("__b").agg(F.array_sort(F.collect_list(F.struct("__ru", "__row"))).alias("__near"))
    out = left.withColumn("__lu", micros(ts)).withColumn("__at", F.floor(F.col("__lu") / tol)).join(spread, F.col("__at") == F.col("__b"), "left")
    gap = lambda x: F.col("__lu") - x["__ru"]
    fits = (lambda x: (gap(x) >= 0) & (gap(x) <= tol)) if direction == "backward" else (lambda x: F.abs(gap(x)) <= tol)
    fine = F.filter("__near", fits)
    if direction == "backward":
        best = F.try_element_at(fine, F.lit(-1))
    else:
        best = F.array_min(F.transform(fine, lambda x: F.struct(F.abs(gap(x)).alias("far"), (-gap(x)).alias("late"), x["__row"].alias("__row"))))
    return out.withColumn("__best", best["__row"]).select(*left.columns, *[F.col(f"__best.{c}").alias(c) for c in cols])


def dedupe(df: DataFrame, keys: list[str], order: list, keep: str = "first") -> DataFrame:
    """One row for each key: the first (or last) in `order`."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    if keep == "last":
        order = [c.desc() for c in order]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def floor_time(ts, seconds: int = QUARTER):
    """A time floored to a grid counted from 1970-01-01."""
    us = seconds * 1_000_000
    return from_micros(F.floor(micros(ts) / us) * us)


def regular_grid(df: DataFrame, by: str = "customer_id", ts: str = "ts", seconds: int = QUARTER) -> DataFrame:
    """by, ts: every grid time from each key's first to its last time."""
    us = seconds * 1_000_000
    ends = df.groupBy(by).agg(micros(F.min(ts)).alias("__lo"), micros(F.max(ts)).alias("__hi"))
    steps = ends.select(by, F.explode(F.sequence("__lo", "__hi", F.lit(us))).alias("__us"))
    return steps.select(by, from_micros("__us").alias(ts))


def spread_steps(df: DataFrame, by: str = "customer_id", ts: str = "ts", seconds: int = QUARTER) -> DataFrame:
    """df on each key's full grid from its first time on, with `__gap`: false for the rows of df that lie on the grid (the
    others fall away), true for the absent steps, which copy the row before them. Each row spreads over the steps up to the
    next one, so the grid is neither shuffled nor sorted nor joined. Rows without a time take no part."""
    us = seconds * 1_000_000
    key = Window.partitionBy(by)
    rows = df.where(F.col(ts).isNotNull()).withColumn("__us", micros(ts)).withColumns({"__lo": F.min("__us").over(key), "__hi": F.max("__us").over(key)})
    rows = rows.where((F.col("__us") - F.col("__lo")) % us == 0)
    end = F.col("__lo") + F.floor((F.col("__hi") - F.col("__lo")) / us) * us + us
    rows = rows.withColumn("__next", F.coalesce(F.lead("__us").over(key.orderBy("__us")), end))
    # rows of one time: the last one spreads
    steps = F.when(F.col("__next") > F.col("__us"), F.sequence("__us", F.col("__next") - us, F.lit(us))).otherwise(F.array("__us"))
    out = rows.withColumn("__at", F.explode(steps)).withColumn("__gap", F.col("__at") > F.col("__us"))
    return out.select(by, from_micros("__at").alias(ts), *[c for c in df.columns if c not in (by, ts)], "__gap")


def reindex(df: DataFrame, by: str = "customer_id", ts: str = "ts", seconds: int = QUARTER) -> DataFrame:
    """df on each key's full grid; off-grid rows fall away, absent steps are null, as are all values without a key."""
    known = ~F.col("__gap") & F.col(by).isNotNull()
    return spread_steps(df, by, ts, seconds).select(by, ts, *[F.when(known, F.col(c)).alias(c) for c in df.columns if c not in (by, ts)])


def fill_grid(df: DataFrame, cols: list[str], by: str = "customer_id", ts: str = "ts", limit: int | None = None, seconds: int = QUARTER) -> DataFrame:
    """by, ts and cols: interpolate(reindex(df)) for one row a key and grid time. What lies around a gap is found on the rows
    of df, before they spread over the grid; rows off the grid must not be among them."""
    back = Window.partitionBy(by).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(by).orderBy(F.desc(ts)).rowsBetween(Window.unboundedPreceding, -1)
    near = lambda c, w: F.last(F.when(F.col(c).isNotNull() & F.col(by).isNotNull(), F.struct(F.col(c).alias("v"), micros(ts).alias("t"))), True).over(w)
    rows = df.where(F.col(ts).isNotNull()).select(by, ts, *cols, *[near(c, back).alias(f"__a_{c}") for c in cols])
    rows = rows.select("*", *[near(c, ahead).alias(f"__b_{c}") for c in cols])
    grid = spread_steps(rows, by, ts, seconds)
    us = micros(ts)

    def value(c):
        (v0, t0), (v1, t1) = ((F.col(f"__{k}_{c}.v"), F.col(f"__{k}_{c}.t")) for k in "ab")
        line = F.when(v1.isNull(), v0).otherwise(v0 + (v1 - v0) * (us - t0) / (t1 - t0))
        return F.when(~F.col("__gap") & F.col(c).isNotNull() & F.col(by).isNotNull(), F.col(c)).when(F.lit(True) if limit is None else (us - t0) <= limit * seconds * 1_000_000, line).alias(c)

    return grid.select(by, ts, *map(value, cols))


def interpolate(df: DataFrame, cols: list[str], by: str = "customer_id", ts: str = "ts", limit: int | None = None, seconds: int = QUARTER) -> DataFrame:
    """Linear in time between values; at most `limit` steps after a value; trailing gaps carry the last
    value under the same limit, leading ones stay null."""
    back = Window.partitionBy(by).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    # running frames in both directions: a frame to the end of the series would be summed anew for each row
    ahead = Window.partitionBy(by).orderBy(F.desc(ts)).rowsBetween(Window.unboundedPreceding, 0)
    us = micros(ts)
    out = df
    for c in cols:
        t = F.when(F.col(c).isNotNull(), us)
        v0, t0 = F.last(c, True).over(back), F.last(t, True).over(back)
        v1, t1 = F.last(c, True).over(ahead), F.last(t, True).over(ahead)
        value = F.when(v1.isNull(), v0).otherwise(v0 + (v1 - v0) * (us - t0) / (t1 - t0))
        near = F.lit(True) if limit is None else (us - t0) <= limit * seconds * 1_000_000
        out = out.withColumn(f"__{c}", F.when(F.col(c).isNotNull(), F.col(c)).when(near, value))
    for c in cols:
        out = out.drop(c).withColumnRenamed(f"__{c}", c)
    return out


def clean_and_resample(df: DataFrame, cols: list[str], order: list, limit: int = 8) -> DataFrame:
    """First row a time, full quarter-hour grid, limited interpolation, the rest 0, nothing negative."""
    one = dedupe(df, ["customer_id", "ts"], order).select("customer_id", "ts", *cols)
    # rows off the first time's grid fall away before they count as neighbours
    first = one.withColumn("__lo", F.min(micros("ts")).over(Window.partitionBy("customer_id")))
    full = fill_grid(first.where((micros("ts") - F.col("__lo")) % (QUARTER * 1_000_000) == 0).drop("__lo"), cols, limit=limit)
    return full.select("customer_id", "ts", *[F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)).alias(c) for c in cols])


def resample_sum(df: DataFrame, value: str, by: str = "customer_id", ts: str = "ts", seconds: int = QUARTER) -> DataFrame:
    """Sums of grid steps on each key's full grid; steps without rows are 0."""
    sums = df.groupBy(by, floor_time(ts, seconds).alias(ts)).agg(F.sum(value).alias(value))
    return reindex(sums, by, ts, seconds).select(by, ts, F.coalesce(value, F.lit(0.0)).alias(value))


def lags(df: DataFrame, value: str, steps: list[int], by: str = "customer_id", ts: str = "ts") -> DataFrame:
    w = Window.partitionBy(by).orderBy(ts)
    return df.withColumns({f"{value}_lag_{k}": F.lag(value, k).over(w) for k in steps})


def rolling(df: DataFrame, value: str, widths: list[int], by: str = "customer_id", ts: str = "ts") -> DataFrame:
    """Mean and sample deviation over the last w rows with the current one."""
    out = {}
    for k in widths:
        w = Window.partitionBy(by).orderBy(ts).rowsBetween(-(k - 1), 0)
        out |= {f"{value}_roll_mean_{k}": F.avg(value).over(w), f"{value}_roll_std_{k}": F.stddev_samp(value).over(w)}
    return df.withColumns(out)


def runs(df: DataFrame, mask, value: str, least: int, most_spread: float, by: str = "customer_id", ts: str = "ts", digits: int | None = None) -> DataFrame:
    """Runs of consecutive rows where mask holds: by, start, n, mean, std; those of at least `least` rows,
    a positive mean and std / mean of at most `most_spread` (a lone row's std counts as 0), to so many digits where given,
    so that runs at the limit do not depend on the order of summation."""
    w = Window.partitionBy(by).orderBy(ts)
    rows = df.withColumn("__m", F.coalesce(mask, F.lit(False))).withColumn("__new", (F.col("__m") != F.coalesce(F.lag("__m").over(w), ~F.col("__m"))).cast("int"))
    rows = rows.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("__m")
    out = rows.groupBy(by, "__run").agg(F.min(ts).alias("start"), F.count("*").alias("n"), F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"))
    spread = F.try_divide("std", "mean")
    spread = spread if digits is None else F.round(spread, digits)
    return out.where((F.col("n") >= least) & (F.col("mean") > 0) & (spread <= most_spread)).drop("__run")


def zscore(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """df with {col}_norm: distance to the mean in sample deviations, over all rows or within `by`; 0 where a column does
    not vary. Statistics are aggregates that meet the rows again, not windows over a whole group."""
    stats = [f(c).alias(f"__{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    if by:
        one = df.groupBy(*by).agg(*stats)
        both = df.join(one.select(*[F.col(k).alias(f"__k_{k}") for k in by], *[c for c in one.columns if c not in by]), [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in by])
    else:
        both = df.crossJoin(F.broadcast(df.agg(*stats)))  # one row
    norm = {f"{c}_norm": F.when(F.col(f"__s_{c}") > 0, (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}")).otherwise(0.0) for c in cols}
    return both.withColumns(norm).select(*df.columns, *norm)


def first_keys(df: DataFrame, n: int, by: str = "customer_id") -> DataFrame:
    """The rows of the n smallest keys."""
    few = df.select(by).where(F.col(by).isNotNull()).distinct().orderBy(by).limit(n)
    return df.join(few, by, "left_semi")


def set_parts(left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows of both tables (of the same columns) with part: both, left or right."""
    parts = {"both": left.intersect(right), "left": left.subtract(right), "right": right.subtract(left)}
    named = [rows.withColumn("part", F.lit(part)) for part, rows in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])
