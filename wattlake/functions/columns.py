"""Column functions: guarded statistics, balances, unit conversions, time of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a timestamp_ntz, without regard to the session's time zone."""
    ts = col(ts)
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return F.unix_date(F.to_date(ts)).cast("long") * 86_400_000_000 + F.hour(ts).cast("long") * 3_600_000_000 + F.minute(ts).cast("long") * 60_000_000 + second


def from_micros(us) -> Column:
    """The timestamp_ntz of microseconds since 1970-01-01."""
    us = col(us)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.floor(us / 86_400_000_000).cast("int"), F.lit(0), F.lit(0), (F.pmod(us, F.lit(86_400_000_000)) / 1_000_000).cast("decimal(18,6)"))


def slot_of_day(ts) -> Column:
    """The quarter of an hour of the day, 0 to 95."""
    return F.hour(col(ts)) * 4 + F.floor(F.minute(col(ts)) / 15).cast("int")


def safe_corr(x, y, least: int = 10) -> Column:
    """Aggregate: Pearson correlation over rows with both; null below `least` rows or for a constant side."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    fine = (F.count(a) >= least) & (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when(fine, F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b)))


def slope(y, x) -> Column:
    """Aggregate: least-squares slope of y on x over rows with both; 0 below 3 rows or for a constant x."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.when((F.count(a) >= 3) & (F.min(a) < F.max(a)), F.try_divide(F.covar_samp(a, b), F.var_samp(a))).otherwise(0.0)


def slope_error(y, x) -> Column:
    """Aggregate: the slope's standard error; null below 3 rows or for a constant x."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    n = F.count(a)
    sxx, syy, sxy = F.var_pop(a) * n, F.var_pop(b) * n, F.covar_pop(a, b) * n
    left = F.greatest(syy - F.try_divide(sxy * sxy, sxx), F.lit(0.0))
    return F.when((n >= 3) & (sxx > 0), F.sqrt(F.try_divide(F.try_divide(left, n - 2), sxx)))


def balance(a, b) -> Column:
    """(a - b) / (|a| + |b| + 1e-8); null where a side is."""
    a, b = col(a), col(b)
    return (a - b) / (F.abs(a) + F.abs(b) + EPS)


def clip(x, lo: float, hi: float) -> Column:
    """x within lo and hi; null stays null."""
    x = col(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def logistic(x, middle: float, steepness: float) -> Column:
    return 1 / (1 + F.exp(-steepness * (col(x) - middle)))


def degrees_above(temp, base: float = 18.0) -> Column:
    return F.when(col(temp).isNotNull(), F.greatest(col(temp) - base, F.lit(0.0)))


def degrees_below(temp, base: float = 18.0) -> Column:
    return F.when(col(temp).isNotNull(), F.greatest(base - col(temp), F.lit(0.0)))


def to_bin(x, width: float) -> Column:
    """x to the next multiple of width, halves to even."""
    return F.rint(col(x) / width) * width


def flag(x) -> Column:
    """Truth of a flag given as a boolean, number or text (true, 1, yes, y)."""
    text = F.lower(F.trim(col(x).cast("string")))
    return F.coalesce(text.isin("true", "1", "yes", "y") | (F.expr(f"try_cast({x} as double)") > 0 if isinstance(x, str) else F.lit(False)), F.lit(False))


def wilson(k, n, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval of k successes in n; null for n = 0."""
    k, n = col(k).cast("double"), col(n).cast("double")
    p = F.try_divide(k, n)
    mid = p + F.try_divide(F.lit(z * z / 2), n)
    half = z * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z / 4), n * n))
    scale = 1 + F.try_divide(F.lit(z * z), n)
    return F.greatest((mid - half) / scale, F.lit(0.0)), F.least((mid + half) / scale, F.lit(1.0))


def season(ts, months: tuple[int, ...]) -> Column:
    return F.month(col(ts)).isin(*months)


def day_night_balance(load, rad, threshold: float = 50.0, unknown_is_night: bool = True) -> Column:
    """Aggregate: balance of the mean load by day (radiation over the threshold) and by night; rows without radiation
    are night, or take no part."""
    load, rad = col(load), col(rad)
    day = F.coalesce(rad > threshold, F.lit(False))
    night = ~day if unknown_is_night else F.coalesce(rad <= threshold, F.lit(False))
    return balance(F.avg(F.when(day, load)), F.avg(F.when(night, load)))
