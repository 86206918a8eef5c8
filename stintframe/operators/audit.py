"""Data audit: nulls, coverage, distributions, correlation, collinearity."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import correlation_p_value, significance_marker
from ..schemas import LEAKAGE_REGISTRY, quoted
from ..session import small_side, stored
from .metrics import spearman
from .ordering import exact_quantiles, running_sums

MIN_PAIRS = 30
HIGH_CORRELATION = 0.85
VIF_LIMIT = 5.0
#: Share of a variance that counts as none, above the rounding of the sums.
EXACT = 1e-10


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("year", "round_number", "RacePosition")) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def null_audit(df: DataFrame) -> DataFrame:
    """(column, dtype, null_pct, n_unique), most nulls first.

    Values are counted per (column, value) before they are counted as distinct,
    so a frequent value is combined on the map side.
    """
    fields = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col(quoted(f.name)).cast("string").alias("value"),
            )
            for f in df.schema.fields
        ]
    )
    counted = (
        df.select(F.explode(fields).alias("v"))
        .groupBy("v.column", "v.dtype", "v.value")
        .agg(F.count("*").alias("n"))
    )
    nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    return (
        counted.groupBy("column", "dtype")
        .agg(
            F.bround(nulls * 100.0 / F.sum("n"), 1).alias("null_pct"),
            F.count("value").alias("n_unique"),
        )
        .orderBy(F.desc("null_pct"), "column")
    )


def coverage(df: DataFrame) -> DataFrame:
    """Distinct rounds per season."""
    return df.groupBy("year").agg(F.countDistinct("round_number").alias("n_rounds"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    c = quoted(column)
    return df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c)


def ordered_counts(df: DataFrame, column: str) -> DataFrame:
    c = F.col(quoted(column))
    return df.where(c.isNotNull()).groupBy(c).agg(F.count("*").alias("n")).orderBy(c)


def box_statistics(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles and 1.5 IQR whisker ends (furthest value inside the fences)."""
    q = exact_quantiles(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by])
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    fences = small_side(q.select(by, "q1", "median", "q3", low.alias("__low"), high.alias("__high")))
    value = F.col("__value")
    counts = (
        df.select(by, F.col(quoted(column)).cast("double").alias("__value"))
        .where(value.isNotNull())
        .groupBy(by, "__value")
        .agg(F.count("*").alias("n"))
    )
    inside = value.between(F.col("__low"), F.col("__high"))
    return (
        counts.join(fences, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
        )
    )


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram of each column; the last bin is closed.

    The bounds of all columns are one aggregate row; binning is a second pass
    that counts on the map side.
    """
    bounds = df.agg(
        *[F.min(F.col(quoted(c)).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(quoted(c)).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    cells = []
    for i, c in enumerate(columns):
        low, high = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        value = F.col(quoted(c)).cast("double")
        place = F.floor((value - F.lit(low)) * F.lit(float(bins)) / F.lit(high - low))
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.when(value.isNotNull(), F.least(place, F.lit(bins - 1)).cast("int")).alias("bin"),
            )
        )
    return (
        df.select(F.explode(F.array(*cells)).alias("v"))
        .where("v.bin is not null")
        .groupBy("v.column", "v.bin")
        .agg(F.count("*").alias("n"))
    )


def _melt_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    cells = [
        F.struct(
            F.lit(a).alias("c1"),
            F.lit(b).alias("c2"),
            F.col(quoted(a)).cast("double").alias("x"),
            F.col(quoted(b)).cast("double").alias("y"),
        )
        for a, b in pairs
    ]
    return df.select(F.explode(F.array(*cells)).alias("v")).select("v.*")


def spearman_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Spearman matrix, upper triangle, as (c1, c2, rho, n).

    A value's rank depends on the partner column, whose nulls leave rows out. So
    each (column, value) is counted once for every partner, in one pass, and the
    running sums of these counts rank it against all partners at once. The rows
    then meet the rank vectors of their values in one join, and one aggregate
    adds up the products of all pairs. The number of shuffles does not depend on
    the number of columns. Pairs without a common row are left out.
    """
    k, pairs = len(columns), list(combinations(range(len(columns)), 2))
    values = [F.col(quoted(c)).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    narrow = stored(df.select(F.monotonically_increasing_id().alias("row"), *values), "columns")
    here = F.array(*[F.col(f"v{i}").isNotNull().cast("long") for i in range(k)])
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("v")) for i in range(k)])
    melted = narrow.select("row", here.alias("here"), F.explode(cells).alias("x")).select("row", "here", "x.c", "x.v")
    melted = melted.where("v is not null")
    weights = [f"n{j}" for j in range(k)]
    counts = melted.groupBy("c", "v").agg(*[F.sum(F.get("here", F.lit(j))).alias(w) for j, w in enumerate(weights)])
    rank = lambda w: F.col(f"before_{w}") + (F.col(w) - F.col(f"total_{w}")) / F.lit(2.0)
    ranks = running_sums(counts, ["c"], ["v"], weights).select(
        "c", "v", F.array(*[rank(w) for w in weights]).alias("r"), *weights, *[f"total_{w}" for w in weights]
    )
    ranks = stored(ranks, "ranks")
    spread = lambda j: F.sum(F.col(f"n{j}") * F.pow(F.get("r", F.lit(j)), 2))
    spreads = ranks.groupBy("c").agg(
        F.array(*[spread(j) for j in range(k)]).alias("s"), F.array(*[F.first(f"total_n{j}") for j in range(k)]).alias("t")
    )
    sides = spreads.agg(F.map_from_entries(F.collect_list(F.struct("c", F.struct("s", "t")))).alias("side"))  # k entries
    vectors = melted.join(ranks.select("c", "v", "r"), ["c", "v"]).groupBy("row")
    vectors = vectors.agg(F.map_from_entries(F.collect_list(F.struct("c", "r"))).alias("of"))  # at most k entries
    at = lambda i, j: F.get(F.element_at("of", F.lit(i)), F.lit(j))
    gram = vectors.agg(*[F.sum(at(i, j) * at(j, i)).alias(f"x{p}") for p, (i, j) in enumerate(pairs)])

    def cell(p: int, i: int, j: int) -> Column:
        a, b = F.element_at("side", F.lit(i)), F.element_at("side", F.lit(j))
        both = F.sqrt(F.get(a["s"], F.lit(j)) * F.get(b["s"], F.lit(i)))
        return F.struct(
            F.lit(columns[i]).alias("c1"),
            F.lit(columns[j]).alias("c2"),
            F.when(both > 0, F.col(f"x{p}") / both).alias("rho"),
            F.get(a["t"], F.lit(j)).alias("n"),
        )

    out = gram.join(F.broadcast(sides))  # one row each
    out = out.select(F.explode(F.array(*[cell(p, i, j) for p, (i, j) in enumerate(pairs)])).alias("v")).select("v.*")
    return out.where("n > 0")


def high_correlations(pairs: DataFrame, limit: float = HIGH_CORRELATION) -> DataFrame:
    return pairs.where(F.abs("rho") > limit).orderBy(F.desc(F.abs("rho")), "c1", "c2")


@F.pandas_udf(T.DoubleType())
def _p_value(rho: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([correlation_p_value(None if pd.isna(r) else r, int(k)) for r, k in zip(rho, n)])


def target_correlations(df: DataFrame, columns: Sequence[str], target: str, keep_small: bool = True) -> DataFrame:
    """Spearman rho, p-value and marker of each feature against the target.

    The p-value is worked out on the report rows, one per feature. Features with
    fewer than 30 complete rows get nulls, or are left out.
    """
    melted = _melt_pairs(df, [(c, target) for c in columns])
    found = spearman(melted, "x", "y", ["c1"], safe=False)
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    table = F.broadcast(names).join(found, F.col("feature") == F.col("c1"), "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    enough = n >= MIN_PAIRS
    out = table.select(
        "feature",
        F.when(enough, F.col("Spearman_rho")).alias("spearman_rho"),
        F.when(enough, _p_value("Spearman_rho", n)).alias("p_value"),
        n.alias("n"),
    )
    out = out if keep_small else out.where(enough)
    return out.withColumns(
        {"abs_rho": F.abs("spearman_rho"), "marker": significance_marker(F.col("p_value"))}
    ).orderBy(F.desc_nulls_last("abs_rho"), "feature")


def correlation_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (n, matrix): correlations over the complete rows, all pairs in one aggregate.

    Constant columns have zeros, on the diagonal too.
    """
    k = len(columns)
    complete = df.select(*[F.col(quoted(c)).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]).dropna()
    pairs = list(combinations(range(k), 2))
    sums = complete.agg(
        F.count("*").alias("n"),
        *[F.var_pop(f"v{i}").alias(f"s{i}") for i in range(k)],
        *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs],
    )

    def cell(i: int, j: int) -> Column:
        if i == j:
            return F.when(F.col(f"s{i}") > 0, 1.0).otherwise(0.0)
        both = F.sqrt(F.col(f"s{i}")) * F.sqrt(F.col(f"s{j}"))
        return F.when(both > 0, F.col(f"c{min(i, j)}_{max(i, j)}") / both).otherwise(0.0)

    return sums.select("n", F.array(*[F.array(*[cell(i, j) for j in range(k)]) for i in range(k)]).alias("matrix"))


def swept(matrix: Column, pivot: Column) -> Column:
    """The symmetric ``matrix`` with the part that column ``pivot`` explains taken out of every cell.

    A pivot whose own rest is below ``EXACT`` is explained by earlier ones (or
    constant) and takes nothing out.
    """
    row_of = lambda m: F.get(m, pivot)
    rest = F.get(row_of(matrix), pivot)
    taken = F.transform(
        matrix,
        lambda row: F.transform(row, lambda x, c: x - F.get(row, pivot) * F.get(row_of(matrix), c) / rest),
    )
    return F.when(rest > EXACT, taken).otherwise(matrix)


def inflation_factors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """VIF of each column: ``1 / (1 - R^2)`` of its regression on the others.

    The correlations are one row; for each column all others are swept out of the
    k x k matrix, and what is left on its diagonal is the unexplained share. A
    column that the others determine has infinity, also if some of the others are
    collinear among themselves. A constant column has null and no part in the
    others' factors; without complete rows (as with an all-null column) every
    factor is null.
    """
    k = len(columns)
    numbers = F.sequence(F.lit(0), F.lit(k - 1))

    def unexplained(i: Column) -> Column:
        others = F.filter(numbers, lambda j: j != i)
        done = F.aggregate(others, F.col("matrix"), swept)
        return F.get(F.get(done, i), i)

    own = F.transform(
        numbers, lambda i: F.struct(i.alias("i"), F.get(F.get("matrix", i), i).alias("own"), unexplained(i).alias("rest"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    factor = F.when((F.col("n") == 0) | (F.col("x.own") == 0), F.lit(None).cast("double"))
    factor = factor.when(F.col("x.rest") > EXACT, 1.0 / F.col("x.rest")).otherwise(float("inf"))
    out = correlation_row(df, columns).select("n", F.explode(own).alias("x"))
    return out.select(F.get(names, F.col("x.i")).alias("feature"), factor.alias("VIF")).orderBy(F.desc("VIF"), "feature")


def importance_share(importance: DataFrame) -> DataFrame:
    """Share of the total importance, one row per feature; 0 where the total is 0."""
    total = importance.agg(F.sum("importance")).scalar()
    return importance.withColumn(
        "importance_share", F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("importance"), total))
    )


def select_features(importance: DataFrame, vif: DataFrame) -> DataFrame:
    """Drop a feature only if its share is below 1/k and its VIF is high.

    The tables are outer-joined: a feature that only one of them has is kept.
    """
    k = importance.agg(F.count("*")).scalar()
    shared = importance_share(importance)
    weak = F.coalesce(F.col("importance_share") < F.lit(1.0) / k, F.lit(False))
    high = F.coalesce(F.col("VIF") > VIF_LIMIT, F.lit(False))
    return (
        shared.join(vif, "feature", "full")
        .withColumns({"near_zero_importance": weak, "high_vif": high, "drop": weak & high})
        .orderBy(F.desc_nulls_last("importance_share"), "feature")
    )


def check_registry(columns: Sequence[str], allowed: Sequence[str] = ("keep",)) -> None:
    """Raise if a model input is not classified as allowed."""
    disposition = {c: d for c, _, _, d in LEAKAGE_REGISTRY}
    wrong = {c: disposition.get(c, "unclassified") for c in columns if disposition.get(c) not in allowed}
    if wrong:
        raise ValueError(f"columns not cleared as features: {wrong}")


def assert_no_overlap(train: DataFrame, test: DataFrame, column: str = "year") -> None:
    shared = train.select(column).intersect(test.select(column)).limit(5).collect()
    if shared:
        raise ValueError(f"{column} overlap between train and test: {[r[0] for r in shared]}")
