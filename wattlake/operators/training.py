"""Training data: modelled tables with reasons, exact stratified splits, and the trainers of all four components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shipping import materialised
from . import appliances as ap
from . import models as ml
from .prefix import running
from .timeseries import asof_join

#: Sources whose customers without an air-conditioning curve are known to have none.
NEGATIVE_SOURCES = ("dataport", "eco", "refit")
#: Number of each label.
TARGETS = {"AC": {"no_ac": 0, "has_ac": 1}, "HP": {"no_hp": 0, "winter_hp": 1, "summer_hp": 2}}
LEAST_TEMPERATURES = 10
COMPONENTS = ("ac_detector", "hp_detector", "ac_disaggregator", "hp_disaggregator")


def arranged(training: DataFrame, partitions: int | None = None) -> DataFrame:
    """training with each customer's rows in one partition, sorted by customer, type and time."""
    dealt = training.repartition(partitions, "customer_id") if partitions else training.repartition("customer_id")
    return dealt.sortWithinPartitions("customer_id", "type", "ts")


def first_source(training: DataFrame, ordinal: str | None = None) -> DataFrame:
    """customer_id, source: the customer's first source that is not null by `ordinal` (a column that orders the input), or
    the smallest where there is none; UNKNOWN without any. The same under any partitioning."""
    known = F.when(F.col("source").isNotNull(), F.col(ordinal)) if ordinal else None
    found = F.min_by("source", F.struct(known.isNull(), known, "source")) if ordinal else F.min("source")
    return training.groupBy("customer_id").agg(F.coalesce(found, F.lit("UNKNOWN")).alias("source"))


def total_rows(training: DataFrame) -> DataFrame:
    """customer_id, ts, load, temp, rad of the total curves; of repeated times the first row by value."""
    tot = training.where("type = 'TOT' and ts is not null")
    return tot.groupBy("customer_id", "ts").agg(F.min(F.struct(F.col("value_kw_mean").alias("load"), "temp", F.col("glob_rad").alias("rad"))).alias("r")).select("customer_id", "ts", "r.*")


def modelled(training: DataFrame, kind: str, rules: tuple | None = None, tot_rules: tuple = ap.USABLE["TOT"], ordinal: str | None = None) -> DataFrame:
    """One row for every customer of training: source, reason, target_name, target, and the features of its total curve.

    The first rule that fails is the reason; those without one are `ok` and have a target and features, all others have
    neither. Customers with a curve of `kind` (AC or HP) must have a usable, labelled one and a usable total curve; those
    without are negatives if their total curve is usable and, for AC, their source is one of NEGATIVE_SOURCES."""
    low = kind.lower()
    rows = training.where(F.col("type").isin(kind, "TOT"))
    own, timed = F.col("type") == kind, F.col("ts").isNotNull()
    who = training.groupBy("customer_id").agg(
        F.count_if(own).alias("n_own"), F.count_if(own & timed).alias("n_timed"), F.count_if(F.col("type") == "TOT").alias("n_tot"),
        F.count_if((F.col("type") == "TOT") & timed & F.col("temp").isNotNull()).alias("n_temp"),
    ).join(first_source(training, ordinal), "customer_id")
    curve = rows.where(own).withColumnRenamed("value_kw_mean", "kw")
    label = ap.ac_label(curve, rules or ap.USABLE["AC"]) if kind == "AC" else ap.hp_label(curve, rules or ap.USABLE["HP"])
    name = F.when(F.col("has_ac"), F.lit("has_ac")) if kind == "AC" else F.col("hp_season")
    label = label.select("customer_id", name.alias("name"), F.when(F.col("reason").isin(*ap.QUALITY), F.concat(F.lit(f"{low}_"), "reason")).otherwise(F.col("reason")).alias("why"))
    tot = total_rows(training)
    quality = ap.usable(ap.curve_quality(tot, ["customer_id"]), *tot_rules).select("customer_id", "n_rows", "n_summer", "n_winter", "max_gap_days", "coverage", F.col("reason").alias("tot"))
    tot_reason = F.when(F.coalesce("tot", F.lit("too_few_rows")) != "ok", F.concat(F.lit("tot_"), F.coalesce("tot", F.lit("too_few_rows")))).when(F.col("n_temp") < LEAST_TEMPERATURES, "tot_too_few_temp_rows").otherwise("ok")
    labelled = F.when(F.col("n_timed") == 0, f"empty_{low}_curve").when(F.col("name").isNull(), F.col("why")).when(F.col("n_tot") == 0, "no_total_curve").otherwise(tot_reason)
    negative = F.when(~F.lower("source").isin(*NEGATIVE_SOURCES), "source_without_negatives").otherwise(tot_reason) if kind == "AC" else tot_reason
    reason = F.when(F.col("n_own") > 0, labelled).when(F.col("n_tot") > 0, negative).otherwise("no_curve")
    none = f"no_{low}"
    said = materialised(who.join(label, "customer_id", "left").join(quality, "customer_id", "left").withColumn("reason", reason).withColumn("name", F.when(F.col("n_own") > 0, F.col("name")).otherwise(none)))
    fine = tot.join(said.where("reason = 'ok'").select("customer_id"), "customer_id", "left_semi")
    feats = ap.ac_features(fine).withColumnRenamed("n_rows", "n_feature_rows").withColumn("used_daytime_only", F.col("used_daytime_only").cast("int")) if kind == "AC" else ap.hp_features(fine).withColumns({"n_feature_rows": F.col("n_night_rows"), "used_night_only": F.lit(1)})
    out = said.join(feats, "customer_id", "left")
    # heat pumps: customers with too few dark rows have no features
    reason = F.when((F.col("reason") == "ok") & F.col("n_feature_rows").isNull(), "tot_too_few_night_rows" if kind == "HP" else "tot_without_features").otherwise(F.col("reason"))
    ok = F.col("reason") == "ok"
    target = F.create_map(*[F.lit(x) for pair in TARGETS[kind].items() for x in pair])
    out = out.withColumn("reason", reason).withColumn("target_name", F.when(ok, F.col("name"))).withColumn("target", F.try_element_at(target, F.col("target_name")))
    return out.select("customer_id", "source", "reason", "target_name", "target", *[F.when(ok, F.col(c)).alias(c) for c in (*[c for c in feats.columns if c != "customer_id"], "n_rows", "n_summer", "n_winter", "max_gap_days", "coverage")])


def reasons(table: DataFrame) -> DataFrame:
    """reason, n of a modelled table."""
    return table.groupBy("reason").agg(F.count("*").alias("n"))


def feature_table(training: DataFrame, kind: str, rules: tuple | None = None, tot_rules: tuple = ap.USABLE["TOT"], ordinal: str | None = None) -> DataFrame:
    """Raw training rows to the modelled table of a detector: total and own curves, temperatures in Celsius."""
    raw = training.where(F.col("type").isin(kind, "TOT"))
    # written: modelled reads them in several branches
    return modelled(materialised(ap.in_celsius(raw)), kind, rules, tot_rules, ordinal)


def series_features(meter: DataFrame, weather: DataFrame, kind: str, months: tuple[int, ...] = (), least_rows: int | None = None) -> DataFrame:
    """What a detector sees of meter rows (one customer's or all), of some months only where any are given."""
    rows = meter.where("ts is not null")
    rows = ap.load_rows(asof_join(rows.where(F.month("ts").isin(*months)) if months else rows, weather, 3600))
    return ap.ac_features(rows, least_rows=least_rows or 50) if kind == "AC" else ap.hp_features(rows, least_rows=least_rows or 100)


def stratified_split(df: DataFrame, label: str, test_share: float = 0.2, seed: int = 1, key: str = "customer_id") -> tuple[DataFrame, DataFrame]:
    """Training and test rows. Of each class the test part has exactly its rounded share: the rows first by the hash of
    their key. The rank in a class is a running count over ranges, so no task holds a class."""
    hashed = df.withColumn("__h", F.xxhash64(F.lit(seed), key))
    ranked = running(hashed.withColumn("__one", F.lit(1)), [label], ["__h", key], "__one", "__rank")
    size = ranked.groupBy(F.col(label).alias("__class")).agg(F.round(F.count("*") * test_share).alias("__n"))  # a row a class
    both = materialised(ranked.join(F.broadcast(size), F.col(label).eqNullSafe(F.col("__class"))).withColumn("__test", F.col("__rank") <= F.col("__n")))
    names = df.columns
    return both.where("not __test").select(names), both.where("__test").select(names)


def fit_detector(table: DataFrame, kind: str, trees: int = 400, test_share: float = 0.2) -> tuple:
    """The forest of a modelled table and its scores on the held-out part: one row with f1, n_train, n_test, and counts of
    each class predicted and held out."""
    data = materialised(table.where("reason = 'ok'"))
    fit, test = stratified_split(data, "target_name", test_share)
    features = ml.AC_FEATURES if kind == "AC" else ml.HP_FEATURES
    model = ml.fit_forest(fit, features, "target_name", trees=trees)
    return model, ml.forest_report(model, test, features, "target_name").withColumn("n_train", F.lit(fit.count()))


def disaggregation_rows(training: DataFrame, kind: str, tot_rules: tuple = ap.USABLE["TOT"], label_rules: tuple | None = None, ordinal: str | None = None) -> DataFrame:
    """Learning rows of a disaggregator: aligned pairs with features and the customer's profile made of these rows alone,
    targets kw, on, ratio, and source."""
    raw = materialised(ap.in_celsius(training.where(F.col("type").isin(kind, "TOT") & F.col("ts").isNotNull())))
    name = kind.lower()
    pairs = materialised(ap.aligned_pairs(raw, kind, tot_rules, label_rules))
    feats = ap.disagg_features(pairs.select("customer_id", "ts", F.col("tot_kw").alias("load"), "temp", "rad"), heat=kind == "HP")
    targets = pairs.select("customer_id", "ts", F.col(f"{name}_kw").alias("kw"), F.col(f"{name}_on").cast("double").alias("on"), F.col(f"{name}_ratio").alias("ratio"))
    return feats.join(targets, ["customer_id", "ts"]).join(first_source(raw, ordinal), "customer_id")


def fit_disaggregator(rows: DataFrame, kind: str, test_share: float = 0.2, **sizes) -> tuple:
    """The two-stage model of disaggregation_rows, split by customer, and its scores on held-out customers."""
    data = materialised(rows)
    fit, test = ml.split_by_customer(data, test_share)
    model = ml.TwoStage(ml.AC_ROW_FEATURES if kind == "AC" else ml.HP_ROW_FEATURES, kind).fit(ap.row_weights(fit), **sizes)
    seen = model.predict(test)
    kw = (ml.ac_kw(seen, 1.0) if kind == "AC" else ml.hp_kw(seen)).withColumnRenamed(f"{kind.lower()}_on_prob", "p").withColumnRenamed(f"{kind.lower()}_kw_pred", "pred")
    scores = ml.disagg_scores(test.select("customer_id", "ts", "on", "kw").join(kw, ["customer_id", "ts"]))
    counts = [F.lit(x.select("customer_id").distinct().count()).alias(c) for x, c in ((fit, "n_train"), (test, "n_test"))]
    return model, scores.select("*", *counts)


def train(training: DataFrame, components: tuple[str, ...] = COMPONENTS, path: str | None = None, rules: dict | None = None, trees: int = 400, ordinal: str | None = None, **sizes) -> tuple[dict, DataFrame]:
    """Trains any subset of the four components from one table of training rows, which is arranged and written once.

    Returns the models by component and a table of held-out scores: component, metric, value. path: where models are
    saved. rules: usability rules by kind (AC, HP, TOT). An unknown component fails before anything runs."""
    unknown = set(components) - set(COMPONENTS)
    if unknown:
        raise ValueError(f"unknown components {sorted(unknown)}; known are {COMPONENTS}")
    rules = ap.USABLE | (rules or {})
    rows = materialised(arranged(training))
    found, scores = {}, []
    for component in components:
        kind = component[:2].upper()
        if component.endswith("detector"):
            model, score = fit_detector(feature_table(rows, kind, rules[kind], rules["TOT"], ordinal), kind, trees)
        else:
            model, score = fit_disaggregator(disaggregation_rows(rows, kind, rules["TOT"], rules["HP"], ordinal), kind, **sizes)
        found[component] = model
        if path:
            model.save(f"{path}/{component}") if hasattr(model, "features") else model.write().overwrite().save(f"{path}/{component}")
        scores.append(score.select(F.lit(component).alias("component"), F.stack(F.lit(len(score.columns)), *[x for c in score.columns for x in (F.lit(c), F.col(c).cast("double"))]).alias("metric", "value")))
    out = scores[0]
    for s in scores[1:]:
        out = out.unionByName(s)
    return found, out


def running_capacity(results: DataFrame, value: str = "pv_capacity_kwp", key: str = "customer_id") -> DataFrame:
    """Customers with a capacity in rising order: key, value, rank, running sum and share of the whole."""
    rows = results.where(F.col(value).isNotNull()).select(key, value).withColumn("__one", F.lit(1))
    out = running(rows, [], [value, key], value, "running", extra={"rank": "__one"})
    total = rows.agg(F.sum(value).alias("__all"))  # one row
    return out.crossJoin(F.broadcast(total)).select(key, value, "rank", "running", F.try_divide("running", "__all").alias("share"))
