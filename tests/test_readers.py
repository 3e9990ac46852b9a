import json

import pandas as pd
import pytest

from wattlake.sources import readers


def test_meter_files(spark, tmp_path):
    ts = pd.date_range("2024-01-01", periods=3, freq="15min")
    pd.DataFrame({"ID": [1, 1, 2], "DT_UTC": ts, "CONSO_KWH": [0.1, float("nan"), 0.3]}).to_parquet(tmp_path / "a.parquet", coerce_timestamps="us")
    pd.DataFrame({"ID": ["1"], "TYPE_PARTENAIRE_LIBELLE": ["Particuliers"]}).to_parquet(tmp_path / "metadata.parquet")
    rows = readers.read_meter(spark, str(tmp_path / "a.parquet")).orderBy("ts").collect()
    assert [r.customer_id for r in rows] == ["1", "1", "2"] and rows[1].conso_kwh is None and rows[0].prod_kwh is None
    people = readers.read_metadata(spark, str(tmp_path / "metadata.parquet"), "Particuliers", strict=True)
    assert readers.read_meter(spark, str(tmp_path / "a.parquet"), people).count() == 2
    assert readers.read_metadata(spark, str(tmp_path / "none.parquet")) is None
    with pytest.raises(ValueError):
        readers.read_metadata(spark, str(tmp_path / "metadata.parquet"), "nobody", strict=True)


def test_weather_kinds(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [0.0, 4.0], "shortwave_radiation": [0.0, 8.0]}}))
    got = readers.read_weather(spark, str(tmp_path / "w.json"), "archive").orderBy("ts").collect()
    assert [r.t_2m_c for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert readers.read_weather(spark, str(tmp_path / "no"), required=False).count() == 0


def test_circuits_and_sessions(spark, tmp_path):
    pd.DataFrame({"dataid": [1, 2], "local_15min": ["2024-01-01 00:00:00-06", "2024-01-01 00:15:00-06"], "air1": [1.5, None]}).to_parquet(tmp_path / "x.parquet")
    c = readers.read_circuits(spark, {"austin": str(tmp_path / "x.parquet")})
    assert [r.air1 for r in c.orderBy("dataid").collect()] == [1.5, 0.0]
    assert [r.dataid for r in readers.appliance_households(c, {"ac": ["air1"]}).collect()] == [1]
    page = {"_items": [{"spaceID": "s", "timezone": "UTC", "chargingCurrent": {"timestamps": ["Mon, 01 Jan 2024 00:01:00 GMT", "Mon, 01 Jan 2024 00:02:00 GMT"], "current": [10.0, 20.0]}}]}
    (tmp_path / "s.json").write_text(json.dumps(page))
    got = readers.read_station_sessions(spark, str(tmp_path / "s.json")).collect()
    assert len(got) == 1 and abs(got[0].value_kw_mean - 15 * 0.208) < 1e-9


def test_meter_files_without_columns_are_an_empty_table(spark, tmp_path):
    pd.DataFrame({"ID": [1], "x": [2]}).to_parquet(tmp_path / "a.parquet")
    got = readers.read_meter(spark, str(tmp_path))
    assert got.columns == ["customer_id", "ts", "conso_kwh", "prod_kwh"] and got.count() == 0
    assert readers.read_meter(spark, str(tmp_path / "nowhere")).count() == 0
    ts = pd.date_range("2024-01-01", periods=2, freq="15min")
    pd.DataFrame({"ID": ["7", "7"], "DT_UTC": ts, "CONSO_KWH": [0.1, 0.2], "PROD_KWH": [1.0, 2.0]}).to_parquet(tmp_path / "b.parquet", coerce_timestamps="us")
    pd.DataFrame({"DT_UTC": ts, "CONSO_KWH": [9.0, 9.0]}).to_parquet(tmp_path / "c.parquet", coerce_timestamps="us")
    (tmp_path / "d.parquet").write_bytes(b"no parquet at all")
    (tmp_path / "a.parquet").unlink()
    assert sorted(r.prod_kwh for r in readers.read_meter(spark, str(tmp_path)).collect()) == [1.0, 2.0]


def test_regions_are_found_by_their_files(spark, tmp_path):
    for region, value in (("austin", 1.0), ("newyork", 2.0)):
        pd.DataFrame({"dataid": [1], "local_15min": ["2024-01-01 00:00:00-06"], "air1": [value]}).to_parquet(tmp_path / f"15minute_data_{region}.parquet")
    (tmp_path / "15minute_data_california.parquet").mkdir()
    pd.DataFrame({"dataid": [5], "local_15min": ["2024-01-01 00:00:00-08"], "car1": [3.0]}).to_parquet(tmp_path / "15minute_data_california.parquet" / "part-0.parquet")
    (tmp_path / "readme.txt").write_text("x")
    assert sorted(r.region for r in readers.available_regions(spark, str(tmp_path)).collect()) == ["austin", "california", "newyork"]
    both = {r.region: (r.air1, r.car1) for r in readers.read_regions(spark, str(tmp_path)).collect()}
    assert both == {"austin": (1.0, None), "newyork": (2.0, None), "california": (None, 3.0)}
    one = readers.read_regions(spark, str(tmp_path), ["newyork"])
    assert [r.region for r in one.collect()] == ["newyork"] and not any("austin" in f for f in one.inputFiles())
    with pytest.raises(FileNotFoundError):
        readers.read_regions(spark, str(tmp_path), ["texas"])


def test_vehicles_and_hourly_weather(spark, tmp_path):
    (tmp_path / "v.csv").write_text("dataid,model,kwh\n1,leaf,24.5\n2,,\n")
    got = readers.read_vehicles(spark, str(tmp_path / "v.csv")).orderBy("dataid").collect()
    assert (got[0].model, got[0].kwh, got[1].model, got[1].kwh) == ("leaf", 24.5, None, None)
    (tmp_path / "w.csv").write_text("localhour,temperature,city\n2024-01-01 00:00:00-06,30.5,austin\n2024-01-01 01:00:00,,austin\n")
    w = readers.read_hourly_weather(spark, str(tmp_path / "w.csv")).orderBy("ts").collect()
    assert [(str(r.ts), r.temperature, r.city) for r in w] == [("2024-01-01 00:00:00", 30.5, "austin"), ("2024-01-01 01:00:00", None, "austin")]
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        readers.read_vehicles(spark, str(tmp_path / "none.csv"))


def test_training_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_training(spark, str(tmp_path / "none.parquet"))
    ts = pd.date_range("2024-01-01", periods=3, freq="15min")
    table = pd.DataFrame({"type": "TOT", "source": [None, "b", "a"], "id_customer": [1, 1, 1], "dt_utc": ts, "value_kw_mean": [1.0, 2.0, 3.0], "temp": 1.0, "glob_rad": [0.0, float("nan"), 2.0]})
    table.to_parquet(tmp_path / "t.parquet", coerce_timestamps="us")
    rows = readers.read_training(spark, str(tmp_path / "t.parquet"))
    from wattlake.operators import training

    assert [r.source for r in training.first_source(rows.repartition(3, "ts"), "ordinal").collect()] == ["b"]
    assert rows.where("glob_rad is null").count() == 1
    table.drop(columns="temp").to_parquet(tmp_path / "u.parquet", coerce_timestamps="us")
    with pytest.raises(ValueError):
        readers.read_training(spark, str(tmp_path / "u.parquet"))


def test_weather_is_fetched_once(spark, tmp_path):
    from datetime import date

    asked = []

    def fetch(first, last):
        asked.append((first, last))
        days = pd.date_range(first, last, freq="12h")
        days = days[days.date != date(2024, 1, 4)]  # the source has nothing for this day
        return spark.createDataFrame([(t.to_pydatetime(), float(t.day), 0.0) for t in days], readers.WEATHER)

    def window(a, b):
        return readers.cached_weather(spark, str(tmp_path / "w"), fetch, date(2024, 1, a), date(2024, 1, b))

    assert window(2, 5).count() == 5 and asked == [(date(2024, 1, 2), date(2024, 1, 5))]
    got = window(1, 8).orderBy("ts").collect()
    assert asked[1:] == [(date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 6), date(2024, 1, 8))]
    assert [r.ts.day for r in got] == [1, 2, 2, 3, 3, 5, 6, 6, 7, 7, 8]
    assert window(3, 4).count() == 2 and len(asked) == 3


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "customer_id string, v double").selectExpr("customer_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "v")
    readers.write_series(rows, str(tmp_path / "s"))
    readers.write_step(rows, str(tmp_path / "t"))
    readers.write_summary(rows, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).orderBy("v").first().v == "1.0"
    assert [r.v for r in readers.one_customer(spark.read.parquet(str(tmp_path / "s")), "b").collect()] == [2.0]
