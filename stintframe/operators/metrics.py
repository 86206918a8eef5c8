"""Scores of predictions: MAE, bias, safe Spearman correlation, macro F1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import position_class
from ..schemas import quoted
from ..session import durable
from .ordering import average_ranks

_ALL = "__all"
METRICS = ["MAE", "Spearman_rho", "Macro_F1"]


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(by)) if by else (df.withColumn(_ALL, F.lit(0)), [_ALL])


def mean_absolute_error(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.col(quoted(predicted)) - F.col(quoted(actual))
    return df.groupBy(*by).agg(F.avg(F.abs(error)).alias("MAE"), F.avg(error).alias("bias"))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = (), safe: bool = True) -> DataFrame:
    """Rank correlation with average ties over the rows where both are present.

    Rows are counted per (x, y) first; ranks are running sums over the distinct
    values, so no task ranks a whole group. ``safe`` gives 0 for a constant x.
    """
    df, keys = _grouped(df, by)
    pairs = durable(
        df.select(
            *[F.col(quoted(k)) for k in keys],
            F.col(quoted(x)).cast("double").alias("x"),
            F.col(quoted(y)).cast("double").alias("y"),
        )
        .where("x is not null and y is not null")
        .groupBy(*keys, "x", "y")
        .agg(F.count("*").alias("n"))
    )
    ranks = {}
    for v in ("x", "y"):
        counts = pairs.groupBy(*keys, v).agg(F.sum("n").alias("n"))
        ranks[v] = average_ranks(counts, keys, v).select(*keys, v, F.col("centred").alias(f"r{v}"))
    ranked = pairs.join(ranks["x"], [*keys, "x"]).join(ranks["y"], [*keys, "y"])
    cross, vx, vy = (
        F.sum(F.col("n") * F.col(a) * F.col(b)) for a, b in (("rx", "ry"), ("rx", "rx"), ("ry", "ry"))
    )
    sums = ranked.groupBy(*keys).agg(
        F.sum("n").alias("n"), cross.alias("__xy"), vx.alias("__xx"), vy.alias("__yy")
    )
    flat = F.lit(0.0) if safe else F.lit(None).cast("double")
    rho = (
        F.when(F.col("__xx") == 0, flat)
        .when(F.col("__yy") == 0, F.lit(None).cast("double"))
        .otherwise(F.col("__xy") / F.sqrt(F.col("__xx") * F.col("__yy")))
    )
    return sums.select(*by, rho.alias("Spearman_rho"), "n")


def macro_f1(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean F1 over the classes seen in truth or prediction.

    Each row adds one truth and one prediction to its class; the classes are the
    positions 1 to 20, so the aggregate is tiny whatever the table.
    """
    df, keys = _grouped(df, by)
    truth = F.col(quoted(actual)).cast("int")
    guess = position_class(F.col(quoted(predicted)))
    cells = (
        df.where(F.col(quoted(actual)).isNotNull() & F.col(quoted(predicted)).isNotNull())
        .select(*[F.col(quoted(k)) for k in keys], truth.alias("t"), guess.alias("p"))
        .groupBy(*keys, "t", "p")
        .agg(F.count("*").alias("n"))
    )
    sides = F.array(
        F.struct(F.col("t").alias("cls"), F.lit(1).alias("true"), F.lit(0).alias("pred")),
        F.struct(F.col("p").alias("cls"), F.lit(0).alias("true"), F.lit(1).alias("pred")),
    )
    per_class = (
        cells.select(*keys, "n", (F.col("t") == F.col("p")).cast("int").alias("hit"), F.explode(sides).alias("s"))
        .groupBy(*keys, "s.cls")
        .agg(
            F.sum(F.col("n") * F.col("hit") * F.col("s.true")).alias("tp"),
            F.sum("n").alias("members"),
        )
    )
    score = F.col("tp") * 2.0 / F.col("members")
    return per_class.groupBy(*keys).agg(F.avg(score).alias("Macro_F1")).select(*by, "Macro_F1")


def score(df: DataFrame, actual: str, predicted: str, by: Sequence[str]) -> DataFrame:
    """MAE, Spearman_rho and Macro_F1 per group of ``by``.

    The three small tables are stacked and folded, which needs no join.
    """
    mae = mean_absolute_error(df, actual, predicted, by).select(*by, "MAE")
    rho = spearman(df, predicted, actual, by).select(*by, "Spearman_rho")
    f1 = macro_f1(df, actual, predicted, by)
    stacked = mae.unionByName(rho, allowMissingColumns=True).unionByName(f1, allowMissingColumns=True)
    return stacked.groupBy(*by).agg(*[F.max(m).alias(m) for m in METRICS])


def fold_summary(cv: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample deviation of each metric over the folds, as two rows."""
    agg = cv.groupBy(*by).agg(
        F.struct(F.lit("mean").alias("stat"), *[F.avg(m).alias(m) for m in METRICS]).alias("a"),
        F.struct(F.lit("std").alias("stat"), *[F.stddev_samp(m).alias(m) for m in METRICS]).alias("b"),
    )
    return agg.select(*by, F.explode(F.array("a", "b")).alias("s")).select(*by, "s.*")


def grid_baseline(df: DataFrame, out: str = "prediction") -> DataFrame:
    """Rule: finish where you start."""
    return df.withColumn(out, F.col("GridPosition").cast("double"))


def mean_baseline(train: DataFrame, test: DataFrame, target: str, out: str = "prediction") -> DataFrame:
    """Predict the training mean, one scalar for every row."""
    return test.withColumn(out, train.agg(F.avg(target)).scalar())


def with_errors(df: DataFrame, actual: str = "actual", predicted: str = "pred") -> DataFrame:
    signed = F.col(quoted(predicted)) - F.col(quoted(actual))
    return df.withColumns({"signed_error": signed, "abs_error": F.abs(signed)})


def metric_deltas(table: DataFrame, base: str, other: str, label: str = "dataset") -> DataFrame:
    """Difference other - base of each metric between two labelled rows."""
    signed = F.when(F.col(label) == other, 1).when(F.col(label) == base, -1)
    return table.where(F.col(label).isin(base, other)).agg(
        *[F.sum(signed * F.col(m)).alias(f"{m}_delta") for m in METRICS]
    )


def best_and_worst(df: DataFrame, error: str, columns: Sequence[str]) -> DataFrame:
    """The rows of least and greatest error, ties by the listed columns."""
    row = F.struct(*[F.col(quoted(c)) for c in columns])
    low = F.min(F.struct(F.col(error), row.alias("row")))
    high = F.max(F.struct(F.col(error), row.alias("row")))
    both = df.agg(low.alias("best"), high.alias("worst"))
    labelled = F.array(
        *[
            F.struct(
                F.lit(k).alias("kind"), F.col(f"{k}.{error}").alias(error), F.col(f"{k}.row").alias("row")
            )
            for k in ("best", "worst")
        ]
    )
    return both.select(F.explode(labelled).alias("v")).select("v.kind", f"v.{error}", "v.row.*")
