"""Error segments: groups of rows, their size, MAE and bias."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import TIER_ORDER
from .history import HOT_ROWS, add_history


def prior_races(
    history: DataFrame,
    order: Sequence[str] = ("year", "round_number", "DriverNumber"),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Number of earlier rows of the same driver."""
    return add_history(history, "DriverId", list(order), prior="prior_races", hot_rows=hot_rows)


def segment_summary(df: DataFrame, segments: Mapping[str, Column | str], digits: int = 3) -> DataFrame:
    """One row per (segment, group) with n, MAE and bias, all in one pass.

    Each row is emitted once per segment with its group label and is combined
    on the map side, so a segment that holds most rows costs no more.
    """
    labelled = [
        F.struct(F.lit(name).alias("segment"), (F.col(c) if isinstance(c, str) else c).alias("group"))
        for name, c in segments.items()
    ]
    return (
        df.select("abs_error", "signed_error", F.explode(F.array(*labelled)).alias("s"))
        .groupBy("s.group", "s.segment")
        .agg(
            F.count("*").alias("n"),
            F.bround(F.avg("abs_error"), digits).alias("MAE"),
            F.bround(F.avg("signed_error"), digits).alias("bias"),
        )
        .select("group", "n", "MAE", "bias", "segment")
    )


def in_fixed_order(summary: DataFrame, labels: Sequence[str] = TIER_ORDER, column: str = "group") -> DataFrame:
    """Rows in the order of ``labels``; an absent label gives an empty row."""
    order = summary.sparkSession.createDataFrame(
        [(label, i) for i, label in enumerate(labels)], f"`{column}` string, position int"
    )
    return F.broadcast(order).join(summary, column, "left").orderBy("position")


def flagged_entities(df: DataFrame, flag: str, value: str, entity: str = "DriverId") -> DataFrame:
    return df.where(F.col(flag) == value).select(entity).distinct().orderBy(entity)


def union_labelled(parts: Mapping[str, DataFrame], label: str = "segment") -> DataFrame:
    """Union of tables with a label column; absent columns become null."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(label, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
