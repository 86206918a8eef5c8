"""Bounds that keep jobs in proportion to their input, on rows built here."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stintframe.operators import frame as fr
from stintframe.operators.history import add_history
from stintframe.plans.features import lagged_frame
from stintframe.schemas import CIRCUIT, TARGET
from stintframe.sources import sinks


def _plan(df, kind: str = "optimizedPlan") -> str:
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_files_of_a_season_store_are_bounded(spark, tmp_path):
    df = spark.range(100, numPartitions=1).select((F.col("id") % 2 + 2000).cast("int").alias("year"), "id")
    path = sinks.write_seasons(df, str(tmp_path / "seasons"), rows_per_file=20)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "seasons").glob("year=*/*.parquet")]
    assert max(sizes) <= 20 and sum(sizes) == 100
    assert {r.id for r in sinks.read_seasons(spark, path, df.schema).collect()} == set(range(100))


def test_files_of_plain_parquet_are_bounded_if_asked(spark, tmp_path):
    sinks.write_parquet(spark.range(100, numPartitions=1), str(tmp_path / "plain"), rows_per_file=20)
    assert [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "plain").glob("*.parquet")] == [20] * 5


def _tables(spark):
    keys = "year int, round_number int, session_type string, DriverNumber bigint"
    starts = [(2000 + y, r, "R", d) for y in range(2) for r in (1, 2, 3) for d in (1, 2)] + [(2001, 3, "R", None)]
    info = spark.createDataFrame([(*s[:3], "Round", "Here") for s in starts], f"{keys.rsplit(',', 1)[0]}, `Meeting.Name` string, `{CIRCUIT}` string")
    drivers = spark.createDataFrame([(*s, f"d{s[3]}", "Name", f"T{s[3]}") for s in starts], f"{keys}, DriverId string, FullName string, TeamName string")
    results = spark.createDataFrame([(*s, 1.0, float(s[1] + (s[3] or 5)), 9.0, "x") for s in starts], f"{keys}, GridPosition double, Position double, Time double, Status string")
    laps = spark.createDataFrame([(s[3], float(s[0] + s[1] * k)) for s in starts for k in (1, 2)], "DriverNumber bigint, LapTime double")
    return {"session_info": info.distinct(), "driver_info": drivers, "session_results": results, "laps": laps}


def test_joins_of_the_race_frame_run_once(spark):
    wanted = ["DriverId", "DriverNumber", "year", "round_number", TARGET, "DriverFinish_ewm", "TeamFinish_ewm", "LapStd_lag1"]
    tables = _tables(spark)
    narrow = lagged_frame(tables, lap_keys=["DriverNumber"], check_boundary=False, columns=wanted)
    assert narrow.columns == wanted
    assert "stddev" not in _plan(narrow)  # laps were aggregated when the frame was stored
    whole = lagged_frame(tables, lap_keys=["DriverNumber"], check_boundary=False)
    rows = lambda df: sorted(map(tuple, df.select(*wanted).collect()), key=str)
    assert rows(narrow) == rows(whole) and len(rows(whole)) == 13


def test_absent_car_numbers_match_without_a_text_key(spark):
    t = _tables(spark)
    out = fr.race_frame(t["session_info"], t["driver_info"], t["session_results"], t["laps"], lap_keys=["DriverNumber"])
    assert {(r.DriverNumber, r.DriverId) for r in out.collect()} == {(1, "d1"), (2, "d2"), (None, "dNone")}
    assert fr.CAR not in _plan(out)


def test_short_histories_need_one_sort(spark):
    rows = [(e, 2000 + i // 4, i % 4, float(i * 7 % 5) if i % 3 else None) for e in ("a", "b", None) for i in range(12)]
    df = spark.createDataFrame(rows, "entity string, year int, round int, x double")
    options = {"lags": {"lag": "x"}, "rolls": {"roll": ("x", 3)}, "ewms": {"ewm": ("x", 5)}}
    short = add_history(df, "entity", ["year", "round"], **options)
    general = add_history(df, "entity", ["year", "round"], hot_rows=None, **options)
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(short) == order(general)
    assert len(re.findall(r"\bSort \[", _plan(short, "executedPlan"))) < len(re.findall(r"\bSort \[", _plan(general, "executedPlan")))
