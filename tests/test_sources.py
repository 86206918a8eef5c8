from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stintframe.plans.features import run_feature_engineering, run_modules, split_by_season, split_train_test
from stintframe.plans.ingest import run_ingestion
from stintframe.sources import sinks, tables

RESULT_COLUMNS = "DriverNumber string, Position double, GridPosition double, Points double, Laps double"


def landing(spark, root, number="1"):
    """Two sessions of results; the second holds ``number``."""
    raw = spark.createDataFrame([("44.0", 1.0, 1.0, 25.0, 57.0)], RESULT_COLUMNS).withColumn("round_number", F.lit(1))
    raw = raw.unionByName(spark.createDataFrame([(number, 2.0, 2.0, 18.0, 57.0)], RESULT_COLUMNS).withColumn("round_number", F.lit(2)))
    raw = raw.withColumns({"year": F.lit(2024), "session_type": F.lit("R")})
    sinks.write_parquet(raw, f"{root}/session_results")
    info = json.dumps({"Type": "Race", "StartDate": "2024-03-05T15:00:00", "EndDate": "2024-03-05T17:00:00"})
    sinks.write_parquet(spark.createDataFrame([(2024, 1, "R", info)], "year int, round_number int, session_type string, session_info string"), f"{root}/session_info")


def test_scan_counts_and_year_filter(spark, clean_root):
    found = tables.load_sources(spark, clean_root)
    assert [found[t].count() for t in tables.CORE_TABLES] == [6, 12, 12, 24]
    one = tables.load_sources(spark, clean_root, years=[2024])
    assert [one[t].count() for t in tables.CORE_TABLES] == [3, 6, 6, 12]


def test_missing_years_and_folders_raise(spark, clean_root, tmp_path):
    with pytest.raises(FileNotFoundError, match="1999"):
        tables.load_sources(spark, clean_root, years=[1999])
    with pytest.raises(FileNotFoundError):
        tables.load_sources(spark, str(tmp_path))


def test_partition_filters_reach_the_scan(spark, clean_root):
    df = tables.read_table(spark, clean_root, "laps", years=[2024]).select("LapTime")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session" in plan and "year#" in plan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<LapTime:double>" in plan


def test_incomplete_partition_is_left_out_and_reported(spark, clean_root, tmp_path):
    root = str(tmp_path / "partial")
    for t in tables.CORE_TABLES:
        df = tables.read_table(spark, clean_root, t).drop("round", "session")
        sinks.write_table(df if t != "laps" else df.where("not (year = 2025 and round_number = 3)"), root, t)
    found = tables.load_sources(spark, root)
    assert found["session_results"].count() == 10
    raw = {t: tables.read_table(spark, root, t) for t in tables.CORE_TABLES}
    assert [tuple(r) for r in tables.incomplete_partitions(raw).collect()] == [(2025, 3, "R", ["laps"])]
    assert tables.latest_complete_round(raw) == (2025, 2)


def test_session_folder_layout(spark, tmp_path):
    """One file per table inside each session folder, with differing columns."""
    import pandas as pd

    for rnd in (1, 2):
        folder = tmp_path / "year=2024" / f"round=0{rnd}" / "session=R"
        folder.mkdir(parents=True)
        frame = pd.DataFrame({"year": [2024], "round_number": [rnd], "session_type": ["R"], "LapTime": [90.0], "DriverNumber": [44]})
        frame = frame.astype({"year": "int32", "round_number": "int8", "DriverNumber": "int8"})
        if rnd == 2:
            frame["Compound"] = "SOFT"
        frame.to_parquet(folder / "laps.parquet", index=False)
        frame.to_parquet(folder / "weather.parquet", index=False)
    df = tables.read_table(spark, str(tmp_path), "laps", layout="session")
    assert rows(df, "round", "LapTime") == [(1, 90.0), (2, 90.0)]
    assert {r["round_number"]: r["Compound"] for r in df.collect()} == {1: None, 2: "SOFT"}


def test_sources_from_session_folders(spark, clean_root, tmp_path):
    """Whole load from the one-file-per-session layout; a session without laps is left out."""
    for t in tables.CORE_TABLES:
        frame = tables.read_table(spark, clean_root, t).drop(*tables.PATH_COLUMNS).toPandas()
        for (y, r), part in frame.groupby(["year", "round_number"]):
            folder = tmp_path / f"year={y}" / f"round={r:02d}" / "session=R"
            folder.mkdir(parents=True, exist_ok=True)
            if not (t == "laps" and (y, r) == (2025, 3)):
                kept = part.dropna(axis=1, how="all").astype({"round_number": "int8"})
                if "DriverNumber" in kept:
                    kept = kept.astype({"DriverNumber": "int8"})
                kept.to_parquet(folder / f"{t}.parquet", index=False)
    found = tables.load_sources(spark, str(tmp_path), layout="session")
    assert [found[t].count() for t in tables.CORE_TABLES] == [5, 10, 10, 20]
    raw = {t: tables.read_table(spark, str(tmp_path), t, layout="session") for t in tables.CORE_TABLES}
    assert tables.latest_complete_round(raw) == (2025, 2)
    path = run_feature_engineering(spark, str(tmp_path), str(tmp_path / "out" / "features"), layout="session", years=[2024])
    assert spark.read.parquet(path).count() == 6


def test_sink_layout_round_trip_and_replacement(spark, clean_root, tmp_path):
    df = tables.read_table(spark, clean_root, "session_results").drop("round", "session")
    path = sinks.write_table(df, str(tmp_path), "session_results")
    sinks.write_table(df.where("year = 2024"), str(tmp_path), "session_results")
    assert (tmp_path / "session_results" / "year=2024" / "round=01" / "session=R").is_dir()
    back = tables.read_table(spark, str(tmp_path), "session_results")
    assert path.endswith("session_results") and back.count() == 12
    assert {(r["round"], r["round_number"]) for r in back.collect()} == {(1, 1), (2, 2), (3, 3)}


def test_skipped_sessions(spark):
    schedule = spark.createDataFrame([(2024, 1)], "year int, round_number int")
    landed = spark.createDataFrame([(2024, 1, "R"), (2024, 1, "Q")], "year int, round_number int, session_type string")
    assert rows(tables.skipped_sessions(schedule, landed), "session_type") == [("FP1",), ("FP2",), ("FP3",), ("S",), ("SQ",)]


@pytest.mark.parametrize("args,years", [(["2024"], [2024]), (["2022", "2021"], [2021, 2022]), (["2021-2023", "2023", "2020"], [2020, 2021, 2022, 2023]), ([], [])])
def test_parse_years(args, years):
    assert tables.parse_years(args) == years


@pytest.mark.parametrize("bad", ["abc", "2024-2021", "20x-2024", "2020-2021-2022"])
def test_parse_years_rejects(bad):
    with pytest.raises(ValueError):
        tables.parse_years([bad])


def test_load_modes():
    assert tables.tables_for_mode("ml") == tables.tables_for_mode("viz")
    with pytest.raises(ValueError, match="ml, viz"):
        tables.tables_for_mode("all")


def test_ingestion_isolates_tables_and_sessions(spark, tmp_path):
    landing(spark, str(tmp_path / "in"), number="300")
    out = str(tmp_path / "out")
    status = run_ingestion(spark, str(tmp_path / "in"), out, active=["session_info", "session_results", "weather"])
    got = {r["table"]: r for r in status.collect()}
    assert got["session_info"]["status"] == "ok" and got["session_info"]["rows"] == 1
    assert got["session_results"]["status"] == "partial" and got["session_results"]["rejected_sessions"] == 1
    assert got["weather"]["status"] == "error"
    assert rows(tables.read_table(spark, out, "session_results"), "round", "DriverNumber") == [(1, 44)]


def test_ingestion_fails_fast_on_unknown_table(spark, tmp_path):
    with pytest.raises(KeyError, match="nothing"):
        run_ingestion(spark, str(tmp_path), str(tmp_path), active=["nothing"])


def test_report_stores(spark, tmp_path):
    metric = spark.createDataFrame([("a", 1.5, 0.25, 0.125)], sinks.METRIC_SCHEMA)
    assert sinks.read_csv(spark, sinks.write_csv(metric, str(tmp_path / "c"))).collect() == metric.collect()
    assert sinks.read_json(spark, sinks.write_json(metric, str(tmp_path / "j")), metric.schema).collect() == metric.collect()


def test_feature_run_and_split(spark, clean_root, tmp_path):
    path = run_feature_engineering(spark, clean_root, str(tmp_path / "features"), preprocessors_path=str(tmp_path / "prep"))
    train, test = split_train_test(spark, path, str(tmp_path), test_year=2025)
    assert train.count() == 6 and test.count() == 6 and train.columns == test.columns
    assert (tmp_path / "prep" / "encoders").is_dir() and (tmp_path / "prep" / "numeric_params").is_dir()


def test_modules_end_to_end(spark, clean_root, tmp_path):
    """Ingestion of raw rows, features and split in one call."""
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    keys = "year, CAST(round_number AS int) AS round_number, session_type"
    for t in ("session_results", "laps"):
        raw = tables.read_table(spark, clean_root, t).drop(*tables.PATH_COLUMNS)
        durations = [c for c in ("LapTime", "PitInTime") if c in raw.columns]
        raw = raw.withColumns({c: (F.col(c) * 1e9).cast("long") for c in durations}).withColumn("DriverNumber", F.col("DriverNumber").cast("string"))
        sinks.write_parquet(raw, f"{land}/{t}")
    info = tables.read_table(spark, clean_root, "session_info")
    record = F.to_json(F.struct(F.struct(F.struct(F.col("`Meeting.Circuit.ShortName`").alias("ShortName")).alias("Circuit")).alias("Meeting")))
    sinks.write_parquet(info.withColumn("session_info", record).selectExpr(*keys.split(", "), "session_info"), f"{land}/session_info")
    drivers = tables.read_table(spark, clean_root, "driver_info")
    one = F.to_json(F.array(F.struct(F.col("DriverNumber").cast("string").alias("DriverNumber"), "DriverId", "TeamName")))
    sinks.write_parquet(drivers.withColumn("drivers", one).selectExpr(*keys.split(", "), "drivers"), f"{land}/driver_info")
    run_modules(spark, land, out, years=[2024, 2025])
    train, test = spark.read.parquet(f"{out}/train"), spark.read.parquet(f"{out}/test")
    assert train.count() == 6 and test.count() == 6
    want = tables.load_sources(spark, clean_root)["laps"].select("LapTime", "DriverNumber")
    assert sorted(tables.load_sources(spark, out)["laps"].select("LapTime", "DriverNumber").collect()) == sorted(want.collect())
    with pytest.raises(ValueError, match="all, data, fe"):
        run_modules(spark, land, out, module="x")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_season_store_prunes_files_and_keeps_the_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, 2023, "a"), (2, 2024, None), (3, 2024, "c"), (4, 2025, "d"), (5, None, "e")], "id int, year int, `x.y` string")
    path = sinks.write_seasons(df, str(tmp_path / "store"))
    back = sinks.read_seasons(spark, path, df.schema)
    assert back.columns == df.columns and back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    train, test = split_by_season(back, 2024)
    assert rows(train, "id") == [(1,), (4,)] and rows(test, "id") == [(2,), (3,)]
    for part in (train, test):
        assert "PartitionFilters: [isnotnull(year" in plan_of(part) and "DataFilters: []" in plan_of(part)
    assert len(list((tmp_path / "store" / "year=2024").glob("*.parquet"))) == 1


def test_feature_run_writes_a_season_store(spark, clean_root, tmp_path):
    path = run_feature_engineering(spark, clean_root, str(tmp_path / "features"))
    train, test = split_train_test(spark, path, str(tmp_path), test_year=2025)
    for root, seasons in ((path, {"2024", "2025"}), (f"{tmp_path}/train", {"2024"}), (f"{tmp_path}/test", {"2025"})):
        assert {p.name.removeprefix("year=") for p in Path(root).glob("year=*")} == seasons
    assert "PartitionFilters: [isnotnull(year" in plan_of(split_by_season(spark.read.parquet(path), 2025)[0])
    assert train.dtypes == test.dtypes
    assert split_train_test(spark, path, str(tmp_path / "none"), test_year=1990)[1].count() == 0


def test_split_takes_later_seasons_into_training(spark):
    df = spark.createDataFrame([(y,) for y in (2023, 2023, 2024, 2024, 2025, 2025)], "year int")
    train, test = split_by_season(df, 2024)
    assert rows(train.distinct(), "year") == [(2023,), (2025,)] and test.count() == 2
    assert split_by_season(df, 2030)[1].isEmpty()


def test_completeness_is_read_from_manifests_alone(spark, clean_root):
    manifest = tables.partition_manifest(spark, clean_root, tables.CORE_TABLES)
    for df in (tables.complete_in(manifest, tables.CORE_TABLES), tables.missing_in(manifest, tables.CORE_TABLES)):
        files = df.inputFiles()
        assert files and all("/_manifest/" in f for f in files)
        assert "/_manifest/" in df._jdf.queryExecution().executedPlan().toString()
    assert tables.complete_in(manifest, tables.CORE_TABLES).count() == 6
    assert {r["table"]: r["n"] for r in manifest.groupBy("table").agg(F.sum("n").alias("n")).collect()} == {
        "session_info": 6, "driver_info": 12, "session_results": 12, "laps": 24
    }


def test_manifest_follows_writes_and_may_be_absent(spark, clean_root, tmp_path):
    root, core = str(tmp_path / "grown"), tables.CORE_TABLES
    laps = tables.read_table(spark, clean_root, "laps").drop("round", "session")
    sinks.write_table(laps.where("year = 2024"), root, "laps")
    sinks.write_table(laps.where("year = 2025 and round_number = 1"), root, "laps")
    held = tables.partition_manifest(spark, root, ["laps"])
    assert held.count() == 4 and tables.partition_manifest(spark, root, ["laps"], years=[2025]).count() == 1
    plain = str(tmp_path / "plain")
    spark.read.parquet(f"{clean_root}/laps").write.partitionBy("year", "round", "session").parquet(f"{plain}/laps")
    both = tables.partition_manifest(spark, plain, ["laps", "weather"])
    assert both.count() == 6 and tables.complete_in(both, ["laps", "weather"]).isEmpty()
    assert {tuple(r["missing"]) for r in tables.missing_in(both, ["laps", "weather"]).collect()} == {("weather",)}
    full = tables.partition_manifest(spark, clean_root, core)
    assert tuple(tables.latest_complete(full, core).first()) == (2025, 3)
    assert tables.latest_complete(full.where("n < 0"), core).isEmpty()


def test_small_side_is_broadcast_within_both_bounds(spark):
    from stintframe.session import small_side

    big = spark.range(100)
    side = spark.range(50).withColumnRenamed("id", "k")
    held = small_side(side)
    assert held.count() == 50 and "Parquet" in plan_of(held)
    hinted = lambda **bounds: "strategy=broadcast" in small_side(side, **bounds)._jdf.queryExecution().analyzed().toString()
    assert hinted() and not hinted(max_rows=49) and not hinted(max_bytes=10)
    assert "BroadcastHashJoin" in plan_of(big.join(held, big.id == F.col("k")))
