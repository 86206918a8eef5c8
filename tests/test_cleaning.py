from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stintframe.functions.casts import clean_value
from stintframe.operators.cleaning import (
    MissingColumnError,
    TableRegistry,
    TableSpec,
    registry,
    unfit_sessions,
)
from stintframe.schemas import ALL_TABLES, table_schema

KEYS = {"year": 2023, "round_number": 1, "session_type": "R"}
INFO = {
    "Type": "Qualifying",
    "Meeting": {"Circuit": {"ShortName": "Northloop"}, "Country": {"Name": "Freedonia"}, "Name": "Harbour Trophy"},
    "GmtOffset": "-04:30:00",
    "StartDate": "2022-08-14T09:20:00",
    "EndDate": "2022-08-14T10:35:00",
}


def types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def info_frame(spark, record):
    return spark.createDataFrame([(2023, 1, "R", json.dumps(record))], "year int, round_number int, session_type string, session_info string")


def laps_frame(spark):
    return spark.sql(
        """SELECT 2023 AS year, 1 AS round_number, 'R' AS session_type, num AS DriverNumber, lap AS LapNumber, 1.0D AS Stint,
             t AS LapTime, IF(num = '44.0', NULL, INTERVAL '27.45' SECOND) AS Sector1Time, CAST(NULL AS bigint) AS PitInTime, 3.0D AS TyreLife, 5.0D AS Position,
             'WET' AS Compound, TRUE AS FreshTyre, timestamp_ntz'2022-08-14 09:26:30' AS LapStartDate
           FROM VALUES ('1', 1.0D, INTERVAL '1:12.640' MINUTE TO SECOND), ('44.0', 2.0D, NULL), ('x', 3.0D, INTERVAL '1:15.075' MINUTE TO SECOND) AS v(num, lap, t)"""
    )


def test_session_info_is_flattened_and_typed(spark):
    out = registry.get("session_info").clean(info_frame(spark, INFO))
    row = out.first()
    assert row["Meeting.Circuit.ShortName"] == "Northloop" and row["Meeting.Country.Name"] == "Freedonia"
    assert row["StartDate"] == dt.datetime(2022, 8, 14, 9, 20)
    assert dict(out.dtypes)["StartDate"] == "timestamp_ntz"
    assert types(out.schema) == types(table_schema("session_info"))


def test_session_info_missing_optional_parts_are_null(spark):
    record = {**INFO, "Meeting": {"Name": "Harbour Trophy"}}
    del record["GmtOffset"]
    row = registry.get("session_info").clean(info_frame(spark, record)).first()
    assert row["Type"] == "Qualifying" and row["GmtOffset"] is None and row["Meeting.Circuit.ShortName"] is None


def test_drivers_are_exploded(spark):
    drivers = [
        {"DriverNumber": "58", "DriverId": "quill", "TeamName": "Tern"},
        {"DriverNumber": "72", "DriverId": "marsh", "TeamName": "Tern"},
    ]
    raw = spark.createDataFrame([(2023, 1, "R", json.dumps(drivers))], "year int, round_number int, session_type string, drivers string")
    out = registry.get("driver_info").clean(raw)
    assert {(r.DriverNumber, r.DriverId) for r in out.collect()} == {(58, "quill"), (72, "marsh")}
    assert dict(out.dtypes)["DriverNumber"] == "tinyint" and out.first()["CountryCode"] is None


def test_records_may_be_native_structs(spark):
    raw = spark.sql("SELECT 2023 AS year, 1 AS round_number, 'R' AS session_type, array(named_struct('DriverNumber', '7')) AS drivers")
    assert registry.get("driver_info").clean(raw).first()["DriverNumber"] == 7


def test_results_keep_non_numeric_classification(spark):
    raw = spark.createDataFrame(
        [("58", 4.0, 7.0, "4", 4_812_500_000_000, 12.0, 61.0), ("72", 19.0, 5.0, "W", None, 0.0, 8.0)],
        "DriverNumber string, Position double, GridPosition double, ClassifiedPosition string, Time bigint, Points double, Laps double",
    ).withColumns({k: F.lit(v) for k, v in KEYS.items()})
    out = registry.get("session_results").clean(raw)
    by = {r.DriverNumber: r for r in out.collect()}
    assert by[72].ClassifiedPosition == "W" and by[72].Time is None and by[58].Time == 4812.5
    assert dict(out.dtypes)["Points"] == "float" and by[58].Q1 is None


def test_laps_casts(spark):
    out = registry.get("laps").clean(laps_frame(spark))
    by = {r.LapNumber: r for r in out.collect()}
    assert by[1].LapTime == pytest.approx(72.64) and by[1].Sector1Time == pytest.approx(27.45)
    assert by[2].LapTime is None and by[2].DriverNumber == 44 and by[3].DriverNumber is None
    assert types(out.schema) == types(table_schema("laps")) and by[1].Team is None and by[1].FreshTyre is True


def test_weather_casts(spark):
    raw = spark.createDataFrame([(42_500_000_000, 16.7, 71, False), (None, float("nan"), None, True)], "Time bigint, AirTemp double, WindDirection int, Rainfall boolean")
    raw = raw.withColumns({k: F.lit(v) for k, v in KEYS.items()})
    got = sorted(registry.get("weather").clean(raw).collect(), key=lambda r: r.Rainfall)
    assert got[0].Time == 42.5 and got[0].WindDirection == 71 and got[0].AirTemp == pytest.approx(16.7, rel=1e-6)
    assert got[1].AirTemp is None and got[1].Time is None


@pytest.mark.parametrize("raw,expected,unfit", [("44.0", 44, False), ("x", None, False), ("300", None, True), ("1.7", None, True), (None, None, False)])
def test_narrow_integers(spark, raw, expected, unfit):
    df = spark.createDataFrame([(raw, 2023, 1, "R")], "DriverNumber string, year int, round_number int, session_type string")
    assert df.select(clean_value(df, "DriverNumber", "tiny")).first()[0] == expected
    assert (unfit_sessions(df, "driver_info").count() == 1) is unfit


def test_missing_required_column_fails_the_table(spark):
    raw = spark.createDataFrame([(1, 2023, 1, "R")], "Stint int, year int, round_number int, session_type string")
    with pytest.raises(MissingColumnError, match="DriverNumber"):
        registry.get("laps").clean(raw)


def test_registry_errors():
    own = TableRegistry()
    spec = TableSpec("laps")
    own.register("laps", spec)
    with pytest.raises(ValueError, match="already registered"):
        own.register("laps", spec)
    with pytest.raises(TypeError):
        own.register("other", object())
    with pytest.raises(KeyError, match="laps"):
        own.get("nothing")
    own.all().clear()
    assert own.get("laps") is spec
    assert sorted(registry.all()) == sorted(ALL_TABLES)
