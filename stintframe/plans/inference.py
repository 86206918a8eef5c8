"""Prediction of one race from its past, and its check against the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.models import MakeModel, model_input
from ..operators.ordering import global_rank
from ..operators.prep import Preprocessors
from ..schemas import FINAL_FEATURES
from ..session import small_side
from .features import build_inference_features, drop_from_race


def fit_before_race(
    train: DataFrame,
    year: int,
    round_number: int,
    make_model: MakeModel,
    features: Sequence[str] = FINAL_FEATURES,
):
    """Model fitted without the target race and the rest of its season."""
    return make_model().fit(model_input(drop_from_race(train, year, round_number), features))


def predict_race(
    tables: Mapping[str, DataFrame],
    model,
    preprocessors: Preprocessors,
    year: int,
    round_number: int,
    features: Sequence[str] = FINAL_FEATURES,
    **options,
) -> DataFrame:
    """Ranked predictions of a race with driver names and, if known, the result.

    The score is continuous; ``PredictedRank`` is the predicted order.
    """
    race = build_inference_features(
        tables, year, round_number, preprocessors, **{"strict": False, **options}
    )
    scored = model.transform(model_input(race, features)).select(
        "DriverId", "DriverNumber", F.col("prediction").alias("PredictedPosition")
    )
    ranked = global_rank(scored, ["PredictedPosition", "DriverNumber"], out="PredictedRank")
    here = (F.col("year") == year) & (F.col("round_number") == round_number)
    names = tables["driver_info"].where(here).select(
        F.col("DriverNumber").alias("__named"), "FullName", F.col("TeamName").alias("TeamName_raw")
    )
    actual = tables["session_results"].where(here).select(
        F.col("DriverNumber").alias("__raced"), F.col("Position").alias("ActualPosition")
    )
    out = ranked.join(small_side(names), F.col("DriverNumber") == F.col("__named"), "left")
    out = out.join(small_side(actual), F.col("DriverNumber") == F.col("__raced"), "left")
    return out.drop("__named", "__raced").orderBy("PredictedRank")


def predicted_winner(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy("PredictedRank").limit(1)


def race_error(predictions: DataFrame) -> DataFrame:
    """MAE over the drivers with a known result."""
    error = F.abs(F.col("PredictedPosition") - F.col("ActualPosition"))
    return predictions.agg(F.avg(error).alias("MAE"))
