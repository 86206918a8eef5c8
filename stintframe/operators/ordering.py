"""Global order without a global task: range chunks, running sums, quantiles.

A window over a whole table, or over one hot group, would run in a single task.
Here the rows are range-partitioned by Spark on (group, order), the chunk number
is stored durably with the rows, and running totals are computed inside the
chunks and shifted by the totals of the chunks before. The only window that is
not split sees one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import quoted
from ..session import durable, small_side, stored

CHUNK = "__chunk"

#: Accuracy of the quantile sketch: its rank error is at most the row count over this.
SKETCH = 10_000


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def range_chunks(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows spread by range of ``order``, with a stored chunk number.

    The number of chunks follows the shuffle partitions; adaptive execution
    merges neighbours on small tables, which keeps the order.
    """
    ranged = df.repartitionByRange(*_cols(order))
    return durable(ranged.withColumn(CHUNK, F.spark_partition_id()))


def running_before(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    weight: str | None = None,
) -> DataFrame:
    """Add ``before`` (weight of earlier rows of the group) and ``total``.

    ``order`` must be unique within the group; group columns must not be null.
    Without ``weight`` every row counts one.
    """
    if weight is None:
        df, weight = df.withColumn("__one", F.lit(1).cast("long")), "__one"
    chunks = range_chunks(df, [*group, *order])
    by_group = Window.partitionBy(*(_cols(group) or [F.lit(0)]))
    earlier = by_group.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunks.groupBy(*_cols(group), CHUNK)
        .agg(F.sum(weight).alias("__sum"))
        .withColumn("__offset", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("__sum").over(by_group))
        .drop("__sum")
    )
    inside = (
        Window.partitionBy(*_cols(group), CHUNK)
        .orderBy(*_cols(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        chunks.withColumn("__upto", F.sum(weight).over(inside))
        .join(offsets, [*group, CHUNK])
        .withColumn("before", F.col("__upto") - F.col(weight) + F.col("__offset"))
        .drop("__one", "__upto", "__offset", CHUNK)
    )


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """``running_before`` for several weights at once: adds ``before_<w>`` and ``total_<w>`` for each."""
    chunks = range_chunks(df, [*group, *order])
    by_group = Window.partitionBy(*_cols(group))
    earlier = by_group.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.groupBy(*_cols(group), CHUNK).agg(*[F.sum(w).alias(f"__sum_{w}") for w in weights])
    offsets = offsets.select(
        *_cols(group),
        CHUNK,
        *[F.coalesce(F.sum(f"__sum_{w}").over(earlier), F.lit(0)).alias(f"__offset_{w}") for w in weights],
        *[F.sum(f"__sum_{w}").over(by_group).alias(f"total_{w}") for w in weights],
    )
    inside = (
        Window.partitionBy(*_cols(group), CHUNK)
        .orderBy(*_cols(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        chunks.select("*", *[F.sum(w).over(inside).alias(f"__upto_{w}") for w in weights])
        .join(offsets, [*group, CHUNK])
        .withColumns({f"before_{w}": F.col(f"__upto_{w}") - F.col(w) + F.col(f"__offset_{w}") for w in weights})
        .drop(CHUNK, *[f"__{k}_{w}" for k in ("upto", "offset") for w in weights])
    )


def sorted_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each text column with their 0-based sorted rank."""
    melted = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("class"))
                    for c in columns
                ]
            )
        ).alias("__v")
    ).select("__v.*")
    ranked = running_before(melted.distinct(), ["column"], ["class"])
    return ranked.select("column", "class", F.col("before").cast("long").alias("code"))


def value_counts(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(group, column, value, n) over the non-null values, in one pass."""
    melted = df.select(
        *_cols(group),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"), F.col(quoted(c)).cast("double").alias("value")
                    )
                    for c in columns
                ]
            )
        ).alias("__v"),
    ).select(*_cols(group), "__v.*")
    return (
        melted.where(F.col("value").isNotNull())
        .groupBy(*_cols(group), "column", "value")
        .agg(F.count("*").alias("n"))
    )


def quantile_brackets(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """(group, __ends_<i>): values around each probability of column ``i``, low ends first, then high ends.

    One pass with a mergeable quantile sketch per (group, column). The ends lie two
    sketch errors off the probability, so the exact quantile is between them.
    """
    margin = 2.0 / SKETCH
    at = [min(1.0, max(0.0, p + shift)) for shift in (-margin, margin) for p in probs]
    return df.groupBy(*_cols(group)).agg(
        *[
            F.percentile_approx(F.col(quoted(c)).cast("double"), at, SKETCH).alias(f"__ends_{i}")
            for i, c in enumerate(columns)
        ]
    )


def bracketed_counts(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """(group, column, at, run, n, least, most): values inside a bracket singly, those between as one run.

    A run stands right after the bracket below it (``at``), so (at, run) is the order
    of the values. Per (group, column) a map task sends at most the distinct values
    inside the brackets and one row per run.
    """
    brackets = quantile_brackets(df, columns, probs, group)
    if group:
        # Parquet, so that Spark knows its size and chooses the join by it.
        df = df.join(stored(brackets, "brackets"), list(group))
        ends = [F.col(f"__ends_{i}") for i in range(len(columns))]
    else:
        row = brackets.first()
        ends = [F.lit(row[i]).cast("array<double>") for i in range(len(columns))]
    k = len(probs)
    melted = []
    for c, e in zip(columns, ends):
        value = F.col(quoted(c)).cast("double")
        single = F.lit(False)
        for j in range(k):
            single = single | value.between(F.get(e, F.lit(j)), F.get(e, F.lit(k + j)))
        below = [F.when(value > F.get(e, F.lit(k + j)), F.get(e, F.lit(k + j))) for j in range(k)]
        at = F.when(single, value).otherwise(F.greatest(F.lit(float("-inf")), *below))
        melted.append(
            F.struct(F.lit(c).alias("column"), value.alias("value"), at.alias("at"), (~single).alias("run"))
        )
    return (
        df.select(*_cols(group), F.explode(F.array(*melted)).alias("__v"))
        .select(*_cols(group), "__v.*")
        .where("value is not null")
        .groupBy(*_cols(group), "column", "at", "run")
        .agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: dict[str, float],
    group: Sequence[str] = (),
) -> DataFrame:
    """Exact linearly interpolated quantiles per (group, column).

    ``probs`` maps an output name to its probability. Two passes over ``df``: a
    sketch brackets each quantile, then rows are counted outside the brackets and
    value by value inside, so only values near a quantile are sorted. Should a
    quantile lie outside its bracket, all values are counted singly.
    """
    keys = [*group, "column"]
    found = _selected(bracketed_counts(df, columns, list(probs.values()), group), keys, probs)
    if group:
        found = durable(found)
        lost = not found.where(" or ".join(f"{quoted(name)} is null" for name in probs)).isEmpty()
    else:  # a row per column
        rows = found.collect()
        lost = any(r[name] is None for r in rows for name in probs)
        found = df.sparkSession.createDataFrame(rows, found.schema)
    if lost:
        value = F.col("value")
        counts = value_counts(df, group, columns).select(
            *_cols(keys), value.alias("at"), F.lit(False).alias("run"), "n", value.alias("least"), value.alias("most")
        )
        found = _selected(counts, keys, probs)
    return found


def _selected(counts: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Quantiles from ordered runs of values; null where one lies inside a run."""
    placed = running_before(counts, keys, ["at", "run"], "n")
    ranks = {name: F.lit(float(p)) * (F.col("total") - 1) for name, p in probs.items()}

    def value_at(index: Column) -> Column:
        first = F.when(index == F.col("before"), F.col("least"))
        return F.max(F.coalesce(first, F.when(index == F.col("before") + F.col("n") - 1, F.col("most"))))

    def single_at(index: Column) -> Column:
        here = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
        return F.max(F.when(here & (F.col("least") == F.col("most")), F.col("least")))

    picked = placed.groupBy(*_cols(keys)).agg(
        F.max("total").alias("n"),
        *[F.coalesce(value_at(F.floor(h)), single_at(F.floor(h))).alias(f"__lo_{name}") for name, h in ranks.items()],
        *[F.coalesce(value_at(F.ceil(h)), single_at(F.ceil(h))).alias(f"__hi_{name}") for name, h in ranks.items()],
    )
    out = [*_cols(keys), F.col("n")]
    for name, p in probs.items():
        h = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((low + (high - low) * (h - F.floor(h))).alias(name))
    return picked.select(*out)


def average_ranks(counts: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Average-tie rank of each (group, value), centred on the group's mean rank.

    ``counts`` has one row per (group, value) with its row count ``n``. The mean
    rank is known exactly, so the centred rank loses no precision on long tables.
    """
    placed = running_before(counts, group, [value], "n")
    rank = F.col("before") + (F.col("n") + 1) / F.lit(2.0)
    centre = (F.col("total") + 1) / F.lit(2.0)
    return placed.select(
        *_cols(group), F.col(quoted(value)), "n", rank.alias("rank"), (rank - centre).alias("centred")
    )


def global_rank(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """1-based row number in the order given, for any group size."""
    ranked = running_before(df, group, order)
    return ranked.withColumn(out, (F.col("before") + 1).cast("long")).drop("before", "total")


def stored_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``sorted_codes``, materialised and marked for broadcast if small."""
    return small_side(sorted_codes(df, columns))
