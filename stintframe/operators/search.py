"""Resumable hyper-parameter search: a durable step log, median pruning, a trial table.

A study is a folder with two append-only tables. ``steps`` has one row for every
fold that a trial has been scored on, with its error and the running mean so far;
``finished`` has one row for every trial that ended. A restarted driver reads
both, skips finished trials and finished folds, and goes on: parameters depend on
the seed and the trial's number alone, and a pruning decision on the log alone,
so an interrupted study ends like an undisturbed one.

Trials run in waves: those of one wave advance fold by fold together (their fits
are independent Spark jobs) and are compared with complete trials of earlier
waves. Waves of one trial give the sequential study.

The log has one row per trial and fold, whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import path_exists

# ---- fixed values: the median pruner of the published study -----------------
STARTUP_TRIALS = 5
WARMUP_STEPS = 2
# -----------------------------------------------------------------------------

FINISHED = "trial int, wave int, state string, ended timestamp"

#: Errors of the given trials (number -> parameters) on one fold.
Evaluate = Callable[[Mapping[int, dict], int], Mapping[int, float]]


def steps_schema(params: str) -> str:
    """Schema of the step log; ``params`` is the type of the parameters."""
    return f"trial int, wave int, step int, error double, value double, started timestamp, ended timestamp, params {params}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _append(spark: SparkSession, path: str, schema: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def read_study(spark: SparkSession, study: str, params: str) -> tuple[DataFrame, DataFrame]:
    """(steps, finished) as logged so far."""
    return _read(spark, f"{study}/steps", steps_schema(params)), _read(spark, f"{study}/finished", FINISHED)


def pruning_decisions(
    steps: DataFrame, finished: DataFrame, startup: int = STARTUP_TRIALS, warmup: int = WARMUP_STEPS
) -> DataFrame:
    """(trial, wave, step, value, best, median, n_complete, pruned) for every logged step.

    A trial is pruned at a step from ``warmup`` on, once ``startup`` trials of
    earlier waves are complete, if its best running mean so far is worse than the
    median of their running means at that step. One window per step over the
    trials in wave order, one per trial over its steps.
    """
    complete = finished.where("state = 'COMPLETE'").select("trial", F.lit(True).alias("complete"))
    so_far = Window.partitionBy("trial").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("step").orderBy("wave").rangeBetween(Window.unboundedPreceding, -1)
    reference = F.when(F.col("complete"), F.col("value"))
    out = steps.join(complete, "trial", "left").select(
        "trial",
        "wave",
        "step",
        "value",
        F.min("value").over(so_far).alias("best"),
        F.percentile(reference, F.lit(0.5)).over(earlier).alias("median"),
        F.count(reference).over(earlier).alias("n_complete"),
    )
    late = (F.col("n_complete") >= startup) & (F.col("step") >= warmup)
    return out.withColumn("pruned", F.coalesce(late & (F.col("best") > F.col("median")), F.lit(False)))


def run_study(
    spark: SparkSession,
    study: str,
    propose: Callable[[int], dict],
    evaluate: Evaluate,
    folds: int,
    trials: int,
    params: str,
    *,
    wave: int = 1,
    startup: int = STARTUP_TRIALS,
    warmup: int = WARMUP_STEPS,
) -> DataFrame:
    """Run or resume the study up to ``trials`` trials; returns its trial table.

    Errors are rounded to nine digits as they are logged, so that equal trials
    tie whatever the order of a sum was.
    """
    steps, finished = read_study(spark, study, params)
    known: dict[int, dict[int, float]] = {}
    for r in steps.select("trial", "step", "error").collect():
        known.setdefault(r["trial"], {})[r["step"]] = r["error"]
    state = {r["trial"]: r["state"] for r in finished.collect()}
    for first in range(0, trials, wave):
        number = first // wave
        alive = [t for t in range(first, min(first + wave, trials)) if t not in state]
        for step in range(1, folds + 1):
            todo = {t: propose(t) for t in alive if step not in known.get(t, {})}
            if todo:
                started = datetime.now(timezone.utc)
                errors = evaluate(todo, step)
                ended = datetime.now(timezone.utc)
                rows = []
                for t, p in todo.items():
                    mine = known.setdefault(t, {})
                    mine[step] = round(errors[t], 9)
                    mean = round(sum(mine[k] for k in range(1, step + 1)) / step, 9)
                    rows.append((t, number, step, mine[step], mean, started, ended, p))
                _append(spark, f"{study}/steps", steps_schema(params), rows)
            cut = set()
            complete = sum(s == "COMPLETE" and t < first for t, s in state.items())
            if alive and step >= warmup and complete >= startup:
                log, done = read_study(spark, study, params)
                decided = pruning_decisions(log, done, startup, warmup).where(F.col("pruned") & (F.col("step") == step))
                cut = {r["trial"] for r in decided.where(F.col("trial").isin(alive)).collect()}
            over = [(t, "PRUNED") for t in alive if t in cut]
            over += [(t, "COMPLETE") for t in alive if t not in cut and step == folds]
            if over:
                now = datetime.now(timezone.utc)
                _append(spark, f"{study}/finished", FINISHED, [(t, number, s, now) for t, s in over])
                state.update(over)
            alive = [t for t in alive if t not in state]
    return trial_table(*read_study(spark, study, params))


def trial_table(steps: DataFrame, finished: DataFrame) -> DataFrame:
    """One row per trial: value, folds, parameters, state, start, end and duration in seconds."""
    grouped = steps.groupBy(F.col("trial").alias("number")).agg(
        F.max_by("value", "step").alias("value"),
        F.count("*").cast("int").alias("folds"),
        F.any_value("params").alias("params"),
        F.min("started").alias("started"),
    )
    ends = finished.select(F.col("trial").alias("number"), "state", "ended")
    seconds = F.col("ended").cast("double") - F.col("started").cast("double")
    return (
        grouped.join(ends, "number", "left")
        .withColumn("state", F.coalesce("state", F.lit("RUNNING")))
        .withColumn("duration", seconds)
        .select("number", "value", "folds", "params", "state", "started", "ended", "duration")
    )


def trial_report(trials: DataFrame) -> DataFrame:
    """The trial table with one column per parameter, as it is written to CSV."""
    names = trials.schema["params"].dataType.names
    return trials.select(
        "number",
        "value",
        F.col("started").alias("datetime_start"),
        F.col("ended").alias("datetime_complete"),
        "duration",
        *[F.col(f"params.{n}").alias(f"params_{n}") for n in names],
        "state",
    ).orderBy("number")


def best_trial(trials: DataFrame) -> DataFrame:
    """Lowest mean error among the complete trials, as (cv_mae, params)."""
    return trials.where("state = 'COMPLETE'").agg(
        F.min("value").alias("cv_mae"), F.min_by("params", F.struct("value", "number")).alias("params")
    )
