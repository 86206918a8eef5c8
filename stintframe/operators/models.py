"""Regression models, temporal cross-validation and hyper-parameter search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import year_label
from ..schemas import FINAL_FEATURES, TARGET, quoted
from ..session import durable, path_exists, scratch_path
from ..sources.sinks import read_seasons, write_seasons
from .metrics import METRICS, mean_absolute_error, score
from .search import STARTUP_TRIALS, WARMUP_STEPS, run_study

# ---- fixed values: search space and best parameters of the published study --
SEARCH_SPACE = {
    "n_estimators": ("int", 50, 1000),
    "num_leaves": ("int", 7, 63),
    "max_depth": ("int", 2, 8),
    "learning_rate": ("log", 0.003, 0.3),
    "min_child_samples": ("int", 5, 50),
    "reg_alpha": ("log", 1e-8, 10.0),
    "reg_lambda": ("log", 1e-8, 10.0),
    "subsample": ("float", 0.4, 1.0),
    "colsample_bytree": ("float", 0.4, 1.0),
}
BEST_PARAMS = {
    "n_estimators": 614,
    "num_leaves": 40,
    "max_depth": 3,
    "learning_rate": 0.00838,
    "min_child_samples": 17,
    "reg_alpha": 0.456,
    "reg_lambda": 0.0172,
    "subsample": 0.831,
    "colsample_bytree": 0.713,
}
# -----------------------------------------------------------------------------

PARAMS_SCHEMA = "struct<" + ",".join(
    f"{k}:{'int' if kind == 'int' else 'double'}" for k, (kind, _, _) in SEARCH_SPACE.items()
) + ">"
BEST_SCHEMA = f"cv_mae double, params {PARAMS_SCHEMA}"

MakeModel = Callable[[], Estimator]


def plain_name(column: str) -> str:
    """Column name without dots, as the ML stages need it."""
    return column.replace(".", "_")


def model_input(df: DataFrame, features: Sequence[str] = FINAL_FEATURES) -> DataFrame:
    """Add a ``features`` vector; rows keep their other columns."""
    names = [plain_name(c) for c in features]
    extra = {n: F.col(quoted(c)).cast("double") for n, c in zip(names, features) if n not in df.columns}
    return VectorAssembler(inputCols=names, outputCol="features").transform(df.withColumns(extra)).drop(*extra)


def random_forest(
    trees: int = 100, max_depth: int = 30, seed: int = 42, label: str = TARGET, **extra
) -> RandomForestRegressor:
    """Bagged regression trees that may use every feature at each split."""
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=max_depth, featureSubsetStrategy="all", seed=seed, **extra
    )


def boosted_trees(
    params: dict | None = None, seed: int = 42, label: str = TARGET, max_iter: int | None = None
) -> GBTRegressor:
    """Gradient boosting from study parameters.

    Tree count, depth, step, leaf size, row and column sampling carry over; the
    leaf-wise limits and L1/L2 terms have no counterpart in Spark ML.
    """
    params = {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1, **(params or {})}
    return GBTRegressor(
        labelCol=label,
        maxIter=max_iter or int(params["n_estimators"]),
        maxDepth=int(params["max_depth"]),
        stepSize=float(params["learning_rate"]),
        minInstancesPerNode=int(params.get("min_child_samples", 1)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy=str(float(params.get("colsample_bytree", 1.0))),
        seed=seed,
    )


def season_list(df: DataFrame) -> list[int]:
    """Sorted seasons; a handful of values."""
    return [r["year"] for r in df.select("year").distinct().orderBy("year").collect()]


def fold_store(data: DataFrame, label: str = TARGET) -> DataFrame:
    """Feature vectors and label of ``data`` in a season store of the shared folder."""
    narrow = data.select(F.col("year").cast("int").alias("year"), F.col(quoted(label)), "features")
    path = write_seasons(narrow, scratch_path(data.sparkSession, "folds"))
    return read_seasons(data.sparkSession, path, narrow.schema)


def expanding_folds(df: DataFrame) -> DataFrame:
    """(fold, train_years, val_year, n_train, n_val): fold i validates season i on all before."""
    per_year = df.groupBy("year").agg(F.count("*").alias("n"))
    by_year = Window.partitionBy(F.lit(0)).orderBy("year")  # one row per season
    before = by_year.rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_year.select(
            (F.row_number().over(by_year) - 1).alias("fold"),
            year_label(F.min("year").over(before), F.max("year").over(before)).alias("train_years"),
            F.col("year").alias("val_year"),
            F.sum("n").over(before).alias("n_train"),
            F.col("n").alias("n_val"),
        )
        .where("fold >= 1")
        .orderBy("fold")
    )


def cross_validate(data: DataFrame, make_model: MakeModel, label: str = TARGET, parallel: int = 2) -> DataFrame:
    """Fold table of an expanding-window validation over the seasons.

    ``data`` holds the feature vector. Vectors and label are written once, by season,
    so a fold opens the files of its seasons only. Each fold is an independent Spark
    fit, submitted from a small thread pool. All folds are scored together in one
    grouped pass.
    """
    data = fold_store(data, label)
    years = season_list(data)

    def run(i: int) -> DataFrame:
        model = make_model().fit(data.where(F.col("year") < years[i]))
        scored = model.transform(data.where(F.col("year") == years[i]))
        return scored.select(
            F.lit(i).alias("fold"),
            F.lit(f"{years[0]}-{years[i - 1]}" if i > 1 else str(years[0])).alias("train_years"),
            F.lit(years[i]).alias("val_year"),
            F.col(quoted(label)).alias("actual"),
            "prediction",
        )

    with ThreadPool(parallel) as pool:
        parts = pool.map(run, range(1, len(years)))
    keys = ["fold", "train_years", "val_year"]
    scored = durable(reduce(DataFrame.unionByName, parts))  # each metric reads it
    return score(scored, "actual", "prediction", keys).orderBy("fold")


def score_model(model, train: DataFrame, test: DataFrame, name: str, label: str = TARGET) -> DataFrame:
    """Scores of a fitted model on its training rows and on the held-out rows."""
    parts = [
        model.transform(part).select(
            F.lit(name).alias("model"),
            F.lit(where).alias("dataset"),
            F.col(quoted(label)).alias("actual"),
            "prediction",
        )
        for where, part in (("train", train), ("test", test))
    ]
    scored = durable(parts[0].unionByName(parts[1]))
    return score(scored, "actual", "prediction", ["model", "dataset"])


def fit_and_score(train: DataFrame, test: DataFrame, make_model: MakeModel, name: str, label: str = TARGET) -> DataFrame:
    return score_model(make_model().fit(train), train, test, name, label)


def feature_importance(model, features: Sequence[str], spark: SparkSession) -> DataFrame:
    rows = list(zip(features, (float(v) for v in model.featureImportances.toArray())))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def overfit_table(train_test: DataFrame, cv: DataFrame) -> DataFrame:
    """Training, cross-validation mean and test scores, one row each."""
    means = cv.agg(*[F.avg(m).alias(m) for m in METRICS]).withColumn("dataset", F.lit("cv_mean"))
    return train_test.select("dataset", *METRICS).unionByName(means.select("dataset", *METRICS))


def append_model_row(comparison: DataFrame, model: str, scores: DataFrame) -> DataFrame:
    return comparison.unionByName(scores.select(F.lit(model).alias("model"), *METRICS))


def load_or_fit(spark: SparkSession, path: str, fit: Callable[[], object]):
    """Saved model at ``path``, or the fitted one, which is then saved."""
    if path_exists(spark, path):
        return PipelineModel.load(path)
    model = PipelineModel([fit()])
    model.write().overwrite().save(path)
    return model


def sample_params(rng: random.Random, space: dict = SEARCH_SPACE) -> dict:
    """One draw from the search space."""
    out = {}
    for name, (kind, low, high) in space.items():
        if kind == "int":
            out[name] = rng.randint(low, high)
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            out[name] = rng.uniform(low, high)
    return out


def random_search(
    data: DataFrame,
    trials: int = 50,
    seed: int = 42,
    label: str = TARGET,
    space: dict = SEARCH_SPACE,
    warmup: int = WARMUP_STEPS,
    startup: int = STARTUP_TRIALS,
    parallel: int = 4,
    study: str | None = None,
) -> DataFrame:
    """Trial table of a seeded random search with median pruning over the seasons.

    Every trial is fitted with the parameters that are logged for it; ``space``
    sets their ranges. ``parallel`` trials are one wave. ``study`` is the folder of
    the log, from which an interrupted search goes on.
    """
    spark, years = data.sparkSession, season_list(data)

    def evaluate(proposals, fold: int) -> dict[int, float]:
        def error(params: dict) -> float:
            model = boosted_trees(params, label=label).fit(data.where(F.col("year") < years[fold]))
            scored = model.transform(data.where(F.col("year") == years[fold]))
            return mean_absolute_error(scored, label, "prediction").first()["MAE"]

        with ThreadPool(parallel) as pool:
            return dict(zip(proposals, pool.map(error, proposals.values())))

    return run_study(
        spark,
        study or scratch_path(spark, "study"),
        lambda trial: sample_params(random.Random(f"{seed}:{trial}"), space),
        evaluate,
        len(years) - 1,
        trials,
        PARAMS_SCHEMA,
        wave=parallel,
        startup=startup,
        warmup=warmup,
    )
