from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stintframe.operators import models
from stintframe.plans.features import build_features, split_by_season
from stintframe.plans.inference import fit_before_race, predict_race, predicted_winner, race_error
from stintframe.plans.reports import baseline_results, error_frame, error_segments, model_study

RNG = np.random.default_rng(5)


@pytest.fixture(scope="module")
def seasons(spark):
    """Four seasons of ten races with eight drivers in four teams."""
    n = 4 * 10 * 8
    pdf = pd.DataFrame({"i": np.arange(n)})
    pdf["year"], pdf["round"], pdf["d"] = 2021 + pdf.i // 80, pdf.i // 8 % 10 + 1, pdf.i % 8
    noise = pd.Series(RNG.normal(size=n))
    pdf["pos"] = (pdf.d + noise).groupby([pdf.year, pdf["round"]]).rank()
    pdf["grid"] = (pdf.d + pd.Series(RNG.normal(size=n))).groupby([pdf.year, pdf["round"]]).rank()
    raw = spark.createDataFrame([tuple(float(v) for v in r) for r in pdf.to_numpy()], ", ".join(f"{c} double" for c in pdf))
    base = raw.select(
        F.col("year").cast("int").alias("year"), F.col("round").cast("int").alias("round_number"), F.lit("R").alias("session_type"),
        (F.col("d") + 1).cast("int").alias("DriverNumber"), "d", "pos", "grid",
    ).cache()
    keys = ["year", "round_number", "session_type"]
    name = F.concat(F.lit("driver"), F.col("DriverNumber").cast("string"))
    return {
        "session_info": base.select(*keys).distinct().withColumn("Meeting.Circuit.ShortName", F.when(F.col("round_number") < 4, "Baku").otherwise("Monza")),
        "driver_info": base.select(*keys, "DriverNumber", name.alias("DriverId"), name.alias("FullName"), F.concat(F.lit("team"), F.floor(F.col("d") / 2).cast("string")).alias("TeamName")),
        "session_results": base.select(*keys, "DriverNumber", F.col("grid").alias("GridPosition"), F.col("pos").alias("Position")),
        "laps": base.select(*keys, "DriverNumber", F.explode(F.array(F.col("d") + 90.0, F.col("pos") + 90.0)).alias("LapTime")),
    }


@pytest.fixture(scope="module")
def study(seasons):
    matrix, fitted = build_features(seasons, test_year=2024)
    matrix = matrix.cache()
    return matrix, fitted, *split_by_season(matrix, 2024)


def boosted():
    return models.boosted_trees({"max_depth": 3, "learning_rate": 0.3}, max_iter=6)


def test_baselines(study):
    _, _, train, test = study
    got = {r.model: r for r in baseline_results(train, test).collect()}
    mean = train.agg(F.avg("RacePosition")).first()[0]
    assert got["DummyRegressor"].Spearman_rho == 0.0
    assert got["DummyRegressor"].MAE == pytest.approx(test.agg(F.avg(F.abs(F.col("RacePosition") - mean))).first()[0])
    assert got["GridPosition"].Spearman_rho > 0.5 and got["GridPosition"].MAE > 3


def test_model_study(study):
    _, _, train, test = study
    out = model_study(train, test, boosted, "Boosted")
    assert rows(out["cv"], "fold", "val_year") == [(1, 2022), (2, 2023)]
    assert rows(out["overfit"], "dataset") == [("cv_mean",), ("test",), ("train",)]
    assert out["comparison"].count() == 4 and out["selection"].count() == 10
    test_row = out["test_row"].first()
    assert test_row.model == "Boosted" and test_row.MAE < baseline_results(train, test).where("model = 'DummyRegressor'").first().MAE
    none = {r.feature: r.VIF for r in out["selection"].collect()}
    assert none["TeamName"] is None and none["GridPosition"] > 1


def test_race_prediction(seasons, study):
    matrix, fitted, _, _ = study
    model = fit_before_race(matrix, 2024, 6, boosted)
    out = predict_race(seasons, model, fitted, 2024, 6)
    got = out.collect()
    assert [r.PredictedRank for r in got] == list(range(1, 9))
    assert [r.PredictedPosition for r in got] == sorted(r.PredictedPosition for r in got)
    assert all(r.FullName == r.DriverId and r.TeamName_raw.startswith("team") for r in got)
    assert predicted_winner(out).first().DriverId == got[0].DriverId
    want = np.mean([abs(r.PredictedPosition - r.ActualPosition) for r in got])
    assert race_error(out).first().MAE == pytest.approx(want)


def test_error_report(spark, study):
    _, fitted, train, test = study
    weather = spark.createDataFrame([(2024, 1, True), (2024, 1, False), (2024, 2, False), (2023, 3, True)], "year int, round_number int, Rainfall boolean")
    scored = test.withColumn("prediction", F.col("RacePosition") + 1)
    analysis = error_frame(train, scored, fitted, weather, 2024)
    assert analysis.count() == 80
    first = {r.DriverId: r.prior_races for r in analysis.where("round_number = 1").collect()}
    assert set(first.values()) == {30}
    got = {(r.segment, r.group): r for r in error_segments(analysis, rookie_races=35).collect()}
    assert got[("circuit_type", "Street")].n == 24 and got[("circuit_type", "Permanent")].n == 56
    assert got[("rain_gt_0", "Rain")].n == 8 and got[("rain_gt_0.05", "Dry")].n == 72
    assert got[("experience", "Rookie")].n == 40
    assert all(r.MAE == 1.0 and r.bias == 1.0 for r in got.values())
    assert sum(r.n for (s, _), r in got.items() if s == "position_tier") == 80
