from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stintframe.operators import frame as fr
from stintframe.operators import prep
from stintframe.plans.features import build_features, build_inference_features, drop_from_race
from stintframe.schemas import (
    CATEGORICAL_FEATURES,
    CIRCUIT,
    FEATURE_COLUMNS,
    NUMERIC_SCALE_FEATURES,
    TARGET,
    TEAM_RENAMES,
)
from stintframe.sources.tables import load_sources

KEYED = "year int, round_number int, session_type string, DriverNumber long"


@pytest.fixture(scope="module")
def built(spark, clean_root):
    return build_features(load_sources(spark, clean_root))


def test_lap_spread(spark):
    laps = spark.createDataFrame([(2024, 1, "R", 44, 90.0), (2024, 1, "R", 44, 91.0), (2024, 1, "R", 1, 90.0), (2024, 1, "R", None, 1.0)], KEYED + ", LapTime double")
    got = dict(rows(fr.lap_spread(laps), "DriverNumber", "LapTime_std"))
    assert got[44] == pytest.approx(0.5**0.5) and got[1] is None and set(got) == {1, 44}


def test_left_joins_keep_rows_and_match_absent_numbers(spark):
    results = spark.createDataFrame([(2024, 1, "R", 44, 1.0, "x"), (2024, 1, "R", None, 2.0, "x"), (2024, 1, "R", 7, 3.0, "x")], KEYED + ", Position double, TeamName string")
    drivers = spark.createDataFrame([(2024, 1, "R", 44, "ham", "A"), (2024, 1, "R", None, "who", "B")], KEYED + ", DriverId string, TeamName string")
    info = spark.createDataFrame([(2024, 1, "R", "Baku")], f"year int, round_number int, session_type string, `{CIRCUIT}` string")
    laps = spark.createDataFrame([], KEYED + ", LapTime double, PitInTime double")
    out = fr.race_frame(info, drivers, results, laps)
    assert sorted(((r.RacePosition, r.DriverId, r.TeamName) for r in out.collect())) == [(1.0, "ham", "A"), (2.0, "who", "B"), (3.0, None, None)]
    weather = spark.createDataFrame([(2024, 1, "R", True), (2024, 1, "R", False)], "year int, round_number int, session_type string, Rainfall boolean").withColumns(
        {c: F.lit(1.0) for c in ("TrackTemp", "Humidity", "Pressure", "AirTemp", "WindSpeed")}
    )
    wide = fr.race_frame(info, drivers, results, laps, weather)
    assert rows(wide, "RainRisk") == [(0.5,)] * 3 and {"LapTime_mean", "PitCount"} <= set(wide.columns)


@pytest.mark.parametrize("old,new", [*TEAM_RENAMES.items(), ("Ferrari", "Ferrari"), (None, None)])
def test_team_names(spark, old, new):
    df = spark.createDataFrame([(old,)], "TeamName string")
    assert fr.normalise_teams(df).first()[0] == new


def test_matrix_end_to_end(spark, built):
    df, fitted = built
    assert df.columns == [*FEATURE_COLUMNS, "round_raw"] and df.count() == 12
    pdf = df.toPandas()
    assert not pdf[NUMERIC_SCALE_FEATURES].isna().any().any()
    assert (pdf[NUMERIC_SCALE_FEATURES].mean().abs() < 1e-10).all()
    spread = pdf[NUMERIC_SCALE_FEATURES].std(ddof=0)
    assert all(s == pytest.approx(1.0) or s == 0.0 for s in spread)
    assert sorted(pdf["TeamName"].unique()) == [0, 1] and sorted(pdf[CIRCUIT].unique()) == [0, 1, 2]
    assert sorted(pdf["round_raw"].unique()) == [1, 2, 3]
    assert rows(fitted.encoders.where("`column` = 'TeamName'"), "class", "code") == [("Mercedes", 0), ("Red Bull Racing", 1)]


def test_null_target_rows_inform_encoders_only(spark, clean_root):
    tables = load_sources(spark, clean_root)
    retired = (F.col("DriverNumber") == 1) & (F.col("round_number") == 3)
    tables["session_results"] = tables["session_results"].withColumn("Position", F.when(~retired, F.col("Position")))
    df, fitted = build_features(tables)
    assert df.count() == 10
    assert fitted.numeric["GridPosition"][0] == 2.0


def test_train_scope_ignores_the_test_season(spark, clean_root):
    tables = load_sources(spark, clean_root)
    late = F.col("year") == 2025
    tables["session_results"] = tables["session_results"].withColumn("GridPosition", F.when(late, F.lit(20.0)).otherwise(F.col("GridPosition")).cast("float"))
    _, everything = build_features(tables)
    _, train_only = build_features(tables, fit_scope="train", test_year=2025)
    assert everything.numeric["GridPosition"][1] > 10 > train_only.numeric["GridPosition"][1]


def test_parameters_survive_a_round_trip(spark, built, tmp_path):
    _, fitted = built
    fitted.write(str(tmp_path))
    back = prep.Preprocessors.read(spark, str(tmp_path))
    assert back.numeric == fitted.numeric
    assert sorted(back.encoders.collect()) == sorted(fitted.encoders.collect())


def test_encode_null_class_and_strictness(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    codes = prep.fit_encoders(df, ["c"])
    assert rows(codes, "class", "code") == [("<NA>", 0), ("a", 1), ("b", 2)]
    assert sorted(r[0] for r in prep.encode(df, codes, ["c"]).collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="zz"):
        prep.encode(spark.createDataFrame([("zz",)], "c string"), codes, ["c"], strict=True)
    back = prep.decode(prep.encode(df, codes, ["c"]), codes, "c", "text")
    assert {r.text for r in back.collect()} == {"<NA>", "a", "b"}


def test_impute_and_scale_edge_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (None, 5.0, None), (4.0, 5.0, None)], "a double, k double, n double")
    fitted = prep.fit_numeric(df, ["a", "k", "n"])
    assert fitted["a"][0] == 2.5 and fitted["k"] == (5.0, 5.0, 1.0) and fitted["n"] == (None, None, None)
    out = prep.scale(prep.impute(df, fitted), fitted).toPandas()
    assert out["a"].mean() == pytest.approx(0) and out["a"].std(ddof=0) == pytest.approx(1)
    assert (out["k"] == 0).all() and out["n"].isna().all()
    back = prep.unscale(prep.scale(prep.impute(df, fitted), fitted), fitted, ["a"]).toPandas()["a"]
    assert sorted(back) == pytest.approx([1.0, 2.5, 4.0])


def test_inference_equals_the_training_row(spark, clean_root, built):
    """Masking the target race changes nothing for that race's own features."""
    df, fitted = built
    race = build_inference_features(load_sources(spark, clean_root), 2025, 3, fitted)
    want = df.where("year = 2025 and round_raw = 3").toPandas().set_index("DriverId").sort_index()
    got = race.toPandas().set_index("DriverId").sort_index()
    assert TARGET not in got.columns and len(got) == 2
    for c in [*NUMERIC_SCALE_FEATURES, *CATEGORICAL_FEATURES]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), err_msg=c)


def test_inference_debut_race_is_strict_about_nulls(spark, clean_root, built):
    _, fitted = built
    tables = load_sources(spark, clean_root)
    with pytest.raises(ValueError, match="DriverFinish_lag1"):
        build_inference_features(tables, 2024, 1, fitted)
    filled = build_inference_features(tables, 2024, 1, fitted, strict=False).toPandas()
    assert not filled[NUMERIC_SCALE_FEATURES].isna().any().any()
    left = build_inference_features(tables, 2024, 1, fitted, strict=False, fill=False).toPandas()
    assert left["DriverFinish_lag1"].isna().all()


def test_inference_unknown_race_and_unseen_class(spark, clean_root, built):
    _, fitted = built
    tables = load_sources(spark, clean_root)
    with pytest.raises(ValueError, match="no race data"):
        build_inference_features(tables, 2025, 9, fitted)
    tables["driver_info"] = tables["driver_info"].withColumn("TeamName", F.lit("Brand New"))
    with pytest.raises(ValueError, match="Brand New"):
        build_inference_features(tables, 2025, 3, fitted, strict=False)


def test_leak_guard(built):
    df, _ = built
    kept = drop_from_race(df, 2025, 2)
    assert rows(kept.groupBy("year").count(), "year", "count") == [(2024, 6), (2025, 2)]


def test_null_report(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (None, None, "b")], "x double, y double, k string")
    assert rows(prep.null_report(df, ["x", "y", "k"]), "column", "nulls", "status") == [("k", 0, "OK"), ("x", 1, "WARNING: 1 nulls"), ("y", 2, "WARNING: 2 nulls")]
    assert rows(prep.rows_with_nulls(df, ["x"], ["k"]), "k") == [("b",)]
