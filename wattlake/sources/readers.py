"""Readers and writers of meter, metadata, weather, sub-meter and charging-station files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.timeseries import interpolate, reindex

METER = "customer_id string, ts timestamp_ntz, conso_kwh double, prod_kwh double"
WEATHER = "ts timestamp_ntz, t_2m_c double, global_rad_w double"
OHMIC_VOLTS = 208.0


def number(name: str) -> Column:
    """A double; what is no number, or NaN, is null."""
    x = F.expr(f"try_cast(`{name}` as double)")
    return F.when(~F.isnan(x), x)


def utc(name: str, dtype: str) -> Column:
    """A timestamp without zone, in UTC."""
    c = F.col(name)
    if dtype == "timestamp":
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    return c.cast("timestamp_ntz")


def read_meter(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """customer_id, ts, conso_kwh, prod_kwh of all data files under path (metadata files are left out); production may be
    absent. ids: customer_id to keep. Unreadable files, and rows of files that lack an id or a time, are left out; where no
    file has the columns, or there is none, the table is empty."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("mergeSchema", "true")
    try:
        raw = reader.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], METER)
    raw = raw.where(~F.lower(F.col("_metadata.file_name")).contains("metadata"))
    kinds = dict(raw.dtypes)
    if {"ID", "DT_UTC", "CONSO_KWH"} - set(kinds):
        return spark.createDataFrame([], METER)
    raw = raw.where("ID is not null and DT_UTC is not null")
    prod = number("PROD_KWH") if "PROD_KWH" in kinds else F.lit(None).cast("double")
    rows = raw.select(F.col("ID").cast("string").alias("customer_id"), utc("DT_UTC", kinds["DT_UTC"]).alias("ts"), number("CONSO_KWH").alias("conso_kwh"), prod.alias("prod_kwh"))
    return rows if ids is None else rows.join(ids.select("customer_id"), "customer_id", "left_semi")


def read_metadata(spark: SparkSession, path: str, segment: str | None = None, strict: bool = False) -> DataFrame | None:
    """customer_id, segment. Lenient: a missing file is no filter (None). Strict: it raises, as do missing
    columns and a segment without rows."""
    try:
        raw = spark.read.parquet(path)
    except AnalysisException:
        if strict:
            raise
        return None
    if strict and not {"ID", "TYPE_PARTENAIRE_LIBELLE"} <= set(raw.columns):
        raise ValueError("metadata lacks ID or TYPE_PARTENAIRE_LIBELLE")
    rows = raw.select(F.col("ID").cast("string").alias("customer_id"), F.col("TYPE_PARTENAIRE_LIBELLE").alias("segment"))
    rows = rows.where(F.col("segment") == segment) if segment else rows
    if strict and rows.isEmpty():
        raise ValueError(f"no customer of segment {segment}")
    return rows


def one_customer(meter: DataFrame, customer_id: str) -> DataFrame:
    return meter.where(F.col("customer_id") == customer_id).orderBy("ts")


def _quarter_hours(hourly: DataFrame) -> DataFrame:
    one = hourly.withColumn("customer_id", F.lit("weather"))
    return interpolate(reindex(one), ["t_2m_c", "global_rad_w"]).drop("customer_id")


def read_station_weather(spark: SparkSession, path: str) -> DataFrame:
    """Station files (`;`, dd.MM.yyyy HH:mm): the stations' mean, quarter-hourly between on-grid points."""
    raw = spark.read.option("sep", ";").option("header", "true").csv(path)
    rows = raw.select(F.to_timestamp("reference_timestamp", "dd.MM.yyyy HH:mm").cast("timestamp_ntz").alias("ts"), number("tre200s0").alias("t_2m_c"), number("gre000z0").alias("global_rad_w"))
    return _quarter_hours(rows.groupBy("ts").agg(F.avg("t_2m_c").alias("t_2m_c"), F.avg("global_rad_w").alias("global_rad_w")))


def read_archive_weather(spark: SparkSession, path: str, fahrenheit: bool = False) -> DataFrame:
    """Hourly JSON with parallel arrays, interpolated to quarter-hours."""
    schema = "hourly struct<time: array<string>, temperature_2m: array<double>, shortwave_radiation: array<double>>"
    raw = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode(F.arrays_zip("hourly.time", "hourly.temperature_2m", "hourly.shortwave_radiation")).alias("x"))
    t = F.col("x.temperature_2m")
    rows = raw.select(F.col("x.time").cast("timestamp_ntz").alias("ts"), ((t - 32) * 5 / 9 if fahrenheit else t).alias("t_2m_c"), F.col("x.shortwave_radiation").alias("global_rad_w"))
    return _quarter_hours(rows.dropDuplicates(["ts"]))


def read_weather(spark: SparkSession, path: str, kind: str = "parquet", required: bool = True) -> DataFrame:
    """ts, t_2m_c, global_rad_w of a parquet table, station CSV or archive JSON; without a file an empty
    table unless it is required."""
    try:
        if kind == "station":
            return read_station_weather(spark, path)
        if kind == "archive":
            return read_archive_weather(spark, path)
        raw = spark.read.parquet(path)
        kinds = dict(raw.dtypes)
        return raw.select(utc("dt_utc", kinds["dt_utc"]).alias("ts"), number("t_2m_C").alias("t_2m_c"), number("global_rad_W").alias("global_rad_w"))
    except AnalysisException:
        if required:
            raise
        return spark.createDataFrame([], WEATHER)


def read_circuits(spark: SparkSession, paths: dict[str, str], ids: list[int] | None = None, circuits: list[str] | None = None) -> DataFrame:
    """region, dataid, ts and circuit columns of each region's table; nulls are 0, a trailing offset of the
    local time falls away. Columns that a region lacks are null."""
    out = None
    for region, path in sorted(paths.items()):
        raw = spark.read.parquet(path)
        raw = raw.where(F.col("dataid").isin(ids)) if ids else raw
        names = [c for c in raw.columns if c not in ("region", "dataid", "local_15min") and (not circuits or c in circuits)]
        time = F.regexp_replace(F.col("local_15min").cast("string"), r"([+-]\d{2})$", "").cast("timestamp_ntz")
        part = raw.select(F.lit(region).alias("region"), "dataid", time.alias("ts"), *[F.coalesce(number(c), F.lit(0.0)).alias(c) for c in names])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def appliance_households(circuits: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """region, dataid and a flag for each group of circuits that is ever not zero; only those with any."""
    flags = [F.bool_or(F.greatest(*[F.abs(F.coalesce(c, F.lit(0.0))) for c in (cols if len(cols) > 1 else cols * 2)]) > 0).alias(f"has_{name}") for name, cols in groups.items()]
    found = circuits.groupBy("region", "dataid").agg(*flags)
    return found.where(" or ".join(f"has_{name}" for name in groups))


def read_station_sessions(spark: SparkSession, path: str, zone: str = "America/Los_Angeles") -> DataFrame:
    """type, source, customer_id, ts (local), value_kw_mean: charging currents of session pages as
    quarter-hourly kW by parking space."""
    schema = "_items array<struct<spaceID: string, timezone: string, chargingCurrent: struct<timestamps: array<string>, current: array<double>>>>"
    item = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("_items").alias("s"))
    x = item.select("s.spaceID", F.coalesce("s.timezone", F.lit(zone)).alias("zone"), F.explode(F.arrays_zip("s.chargingCurrent.timestamps", "s.chargingCurrent.current")).alias("x"))
    kw = x.select("spaceID", "zone", F.to_timestamp(F.regexp_replace("x.timestamps", "^[A-Za-z]{3}, | GMT$", ""), "dd MMM yyyy HH:mm:ss").alias("at"), (F.col("x.current") * OHMIC_VOLTS / 1000).alias("kw"))
    q = kw.groupBy("spaceID", "zone", F.window("at", "15 minutes")["start"].alias("at")).agg(F.avg("kw").alias("value_kw_mean"))
    return q.select(F.lit("EV").alias("type"), F.lit("station").alias("source"), F.col("spaceID").alias("customer_id"), F.from_utc_timestamp("at", F.col("zone")).alias("ts"), "value_kw_mean")


#: Fixed value: how the files of a region's circuits are named.
REGION_FILE = r"15minute_data_([^/.]+)"


def available_regions(spark: SparkSession, path: str) -> DataFrame:
    """region, file of every circuit table under path. Files are listed by Spark, and their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    region = F.regexp_extract("path", REGION_FILE, 1)
    return listed.select(region.alias("region"), F.regexp_extract("path", rf"^(.*{REGION_FILE}[^/]*)", 1).alias("file")).where("region <> ''").distinct()


def read_regions(spark: SparkSession, path: str, regions: list[str] | None = None, ids: list[int] | None = None, circuits: list[str] | None = None) -> DataFrame:
    """read_circuits of the regions found under path, or of those asked for; one that is absent fails. Files of other
    regions are never opened."""
    found = {r.region: r.file for r in available_regions(spark, path).collect()}  # a row a region
    missing = set(regions or ()) - set(found)
    if missing or not found:
        raise FileNotFoundError(f"no circuits of {sorted(missing) or 'any region'} under {path}")
    return read_circuits(spark, {r: f for r, f in found.items() if not regions or r in regions}, ids, circuits)


def read_vehicles(spark: SparkSession, path: str) -> DataFrame:
    """The table of electric vehicles (CSV with a header), with types as its values have them; a missing file fails."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def read_hourly_weather(spark: SparkSession, path: str, time: str = "localhour") -> DataFrame:
    """The sub-meter sites' hourly weather (CSV with a header): ts from the local hour, whose offset falls away, and all
    other columns, as numbers where all their values are."""
    reader = spark.read.option("header", "true")
    kinds = reader.option("inferSchema", "true").csv(path).dtypes
    # the time as text: as a timestamp its offset would be applied
    raw = reader.schema(", ".join(f"`{c}` {'string' if c == time else kind}" for c, kind in kinds)).csv(path)
    ts = F.to_timestamp(F.regexp_replace(F.col(time), r"([+-]\d{2})(:?\d{2})?$", "")).cast("timestamp_ntz")
    return raw.select(ts.alias("ts"), *[F.col(f"`{c}`") for c in raw.columns if c != time])


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """type, source, customer_id, ts, value_kw_mean, temp, glob_rad and ordinal (file and row, which order the input) of a
    training table; FileNotFoundError without one, ValueError where it lacks columns."""
    try:
        raw = spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no training table at {path}") from e
    kinds = dict(raw.dtypes)
    who, when = ("id_customer" if "id_customer" in kinds else "customer_id"), ("dt_utc" if "dt_utc" in kinds else "ts")
    missing = {"type", "source", who, when, "value_kw_mean", "temp", "glob_rad"} - set(kinds)
    if missing:
        raise ValueError(f"the training table lacks {sorted(missing)}")
    ordinal = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return raw.select("type", "source", F.col(who).cast("string").alias("customer_id"), utc(when, kinds[when]).alias("ts"), number("value_kw_mean").alias("value_kw_mean"), number("temp").alias("temp"), number("glob_rad").alias("glob_rad"), ordinal.alias("ordinal"))


def cached_weather(spark: SparkSession, path: str, fetch: Callable[[date, date], DataFrame], start: date, end: date) -> DataFrame:
    """ts, t_2m_c, global_rad_w of the days start to end from a table at path that keeps what was fetched before.

    fetch(first, last) gives these columns for whole days; it is called once for each run of days that the table lacks. Days
    are partitions, and a day is written anew as a whole, so that a fetch that broke off is repeated without harm; days
    that the source has no rows for are remembered as fetched."""
    rows, days = f"{path}/rows", f"{path}/days"

    def stored(where: str, schema: str) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(where)
        except AnalysisException:
            return spark.createDataFrame([], schema)

    wanted = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    lacking = wanted.join(stored(days, "date date"), "date", "left_anti")
    run = F.date_sub("date", F.row_number().over(Window.orderBy("date")))  # a row a day of the window
    for gap in lacking.withColumn("run", run).groupBy("run").agg(F.min("date").alias("first"), F.max("date").alias("last")).orderBy("first").collect():
        found = fetch(gap.first, gap.last).select("ts", "t_2m_c", "global_rad_w").withColumn("date", F.to_date("ts")).where(F.col("date").between(F.lit(gap.first), F.lit(gap.last)))
        found.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(rows)
        spark.range(1).select(F.explode(F.sequence(F.lit(gap.first), F.lit(gap.last))).alias("date")).coalesce(1).write.mode("append").parquet(days)
    return stored(rows, f"{WEATHER}, date date").where(F.col("date").between(F.lit(start), F.lit(end))).select("ts", "t_2m_c", "global_rad_w")


def write_step(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_series(df: DataFrame, path: str) -> None:
    """A time series clustered by customer, so that one customer's rows are a few row groups."""
    df.repartitionByRange("customer_id").sortWithinPartitions("customer_id", "ts").write.mode("overwrite").parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A summary of a few rows as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
