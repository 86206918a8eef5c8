"""Report jobs: baselines, model study, error segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    RAIN_THRESHOLDS,
    ROOKIE_RACES,
    experience_flag,
    membership_flag,
    position_tier,
    threshold_flag,
)
from ..operators import audit, metrics, models
from ..operators.frame import rain_by_round
from ..operators.metrics import METRICS
from ..operators.prep import Preprocessors, decode, raw_round
from ..operators.segments import prior_races, segment_summary
from ..schemas import CATEGORICAL_FEATURES, CIRCUIT, FINAL_FEATURES, STREET_CIRCUITS, TARGET
from ..session import durable, small_side


def baseline_results(train: DataFrame, test: DataFrame) -> DataFrame:
    """(model, metrics) of the grid rule and of the training mean.

    The rule scores the grid column as the matrix holds it, that is standardised;
    unscale the column first for the natural scale.
    """
    rules = {
        "GridPosition": metrics.grid_baseline(test),
        "DummyRegressor": metrics.mean_baseline(train, test, TARGET),
    }
    parts = [df.select(F.lit(name).alias("model"), F.col(TARGET).alias("actual"), "prediction") for name, df in rules.items()]
    return metrics.score(durable(parts[0].unionByName(parts[1])), "actual", "prediction", ["model"])


def model_study(
    train: DataFrame,
    test: DataFrame,
    make_model: models.MakeModel,
    name: str,
    features: Sequence[str] = FINAL_FEATURES,
) -> dict[str, DataFrame]:
    """Tables of one model: folds, overfit check, importance, selection, reduced refit."""

    def run(chosen: Sequence[str]):
        rows = [models.model_input(df, chosen).select("year", TARGET, "features").persist() for df in (train, test)]
        cv = models.cross_validate(rows[0], make_model)
        model = make_model().fit(rows[0])
        scores = models.score_model(model, *rows, name)
        for df in rows:
            df.unpersist()
        return cv, model, scores

    cv, model, scores = run(features)
    numeric = [f for f in features if f not in CATEGORICAL_FEATURES]
    importance = models.feature_importance(model, features, train.sparkSession)
    vif = audit.inflation_factors(train, numeric)
    selection = durable(audit.select_features(importance, vif))
    kept = {r["feature"] for r in selection.where("not drop").collect()}
    chosen = [f for f in features if f in kept]
    reduced_cv, _, reduced_scores = (cv, model, scores) if chosen == list(features) else run(chosen)

    def labelled(table: DataFrame, label: str) -> DataFrame:
        return table.select(F.lit(label).alias("variant"), *METRICS)

    variants = [
        labelled(metrics.fold_summary(cv).where("stat = 'mean'"), "all features, CV mean"),
        labelled(metrics.fold_summary(reduced_cv).where("stat = 'mean'"), "reduced features, CV mean"),
        labelled(scores.where("dataset = 'test'"), "all features, test"),
        labelled(reduced_scores.where("dataset = 'test'"), "reduced features, test"),
    ]
    comparison = variants[0]
    for v in variants[1:]:
        comparison = comparison.unionByName(v)
    return {
        "cv": cv,
        "cv_summary": metrics.fold_summary(cv),
        "overfit": models.overfit_table(scores, cv),
        "importance": importance,
        "vif": vif,
        "selection": selection,
        "reduced_cv": reduced_cv,
        "comparison": comparison,
        "test_row": reduced_scores.where("dataset = 'test'").select("model", *METRICS),
    }


def error_frame(
    train: DataFrame,
    scored: DataFrame,
    preprocessors: Preprocessors,
    weather: DataFrame,
    season: int,
) -> DataFrame:
    """Scored test rows with real-world values, rain risk and experience.

    Calendar round and circuit are recovered with the stored parameters. Prior
    races count the rows of training and test history before each start.
    """
    keys = ["DriverId", "year", "round_number", "DriverNumber"]

    def raw(df: DataFrame) -> DataFrame:
        return raw_round(df, preprocessors.numeric, "round_number")

    history = raw(train).select(*keys).unionByName(raw(scored).select(*keys))
    counted = prior_races(history).where(F.col("year") == season)
    rows = decode(raw(scored), preprocessors.encoders, CIRCUIT, "circuit").select(
        *keys, "circuit", F.col(TARGET).alias("actual"), F.col("prediction").alias("pred")
    )
    rows = rows.join(small_side(rain_by_round(weather, season)), "round_number", "left")
    return metrics.with_errors(rows.join(counted, keys, "left"))


def error_segments(
    analysis: DataFrame,
    street: Sequence[str] = tuple(STREET_CIRCUITS),
    rookie_races: int = ROOKIE_RACES,
) -> DataFrame:
    """(group, n, MAE, bias, segment) of all segmentations in one pass."""
    segments: dict[str, Column] = {
        "circuit_type": membership_flag(F.col("circuit"), street, "Street", "Permanent")
    }
    for threshold in RAIN_THRESHOLDS:
        segments[f"rain_gt_{threshold:g}"] = threshold_flag(F.col("RainRisk"), threshold)
    segments["experience"] = experience_flag(F.col("prior_races"), rookie_races)
    segments["position_tier"] = position_tier(F.col("actual"))
    return segment_summary(analysis, segments)
