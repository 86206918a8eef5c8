"""Encode, impute, scale: fitted on one table, applied to another."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CATEGORICAL_FEATURES, NUMERIC_SCALE_FEATURES, TARGET, quoted
from ..session import small_side
from .ordering import exact_quantiles, stored_codes

NULL_CLASS = "<NA>"

NUMERIC_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("median", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("scale", T.DoubleType()),
    ]
)


@dataclass
class Preprocessors:
    """Fitted parameters: a table of class codes and a few numbers per column."""

    encoders: DataFrame
    numeric: dict[str, tuple[float | None, float | None, float | None]] = field(default_factory=dict)

    def numeric_table(self) -> DataFrame:
        rows = [(c, *values) for c, values in self.numeric.items()]
        return self.encoders.sparkSession.createDataFrame(rows, NUMERIC_SCHEMA)

    def write(self, path: str) -> None:
        self.encoders.write.mode("overwrite").parquet(f"{path}/encoders")
        self.numeric_table().write.mode("overwrite").parquet(f"{path}/numeric_params")

    @staticmethod
    def read(spark: SparkSession, path: str) -> "Preprocessors":
        rows = spark.read.schema(NUMERIC_SCHEMA).parquet(f"{path}/numeric_params").collect()
        return Preprocessors(
            small_side(spark.read.parquet(f"{path}/encoders")),
            {r["column"]: (r["median"], r["mean"], r["scale"]) for r in rows},
        )


def as_classes(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Categorical columns as text; a null is a class of its own."""
    return df.withColumns(
        {c: F.coalesce(F.col(quoted(c)).cast("string"), F.lit(NULL_CLASS)) for c in columns}
    )


def fit_encoders(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """(column, class, code) with codes in text order."""
    return stored_codes(as_classes(df, columns), columns)


def unseen_classes(df: DataFrame, encoders: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Values without a fitted code, as (column, class)."""
    melted = as_classes(df, columns).select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("class")) for c in columns])
        ).alias("__v")
    )
    return melted.select("__v.*").distinct().join(encoders, ["column", "class"], "left_anti")


def encode(
    df: DataFrame,
    encoders: DataFrame,
    columns: Sequence[str] = CATEGORICAL_FEATURES,
    strict: bool = False,
) -> DataFrame:
    """Replace each categorical column by its code.

    ``strict`` raises, with the values, if any class was not seen in fitting.
    """
    if strict:
        unseen = [tuple(r) for r in unseen_classes(df, encoders, columns).limit(20).collect()]
        if unseen:
            raise ValueError(f"values unseen during training: {sorted(unseen)}")
    out = as_classes(df, columns)
    order = [F.col(quoted(c)) for c in df.columns]
    for i, c in enumerate(columns):
        codes = encoders.where(F.col("column") == c).select(
            F.col("class").alias(f"__class{i}"), F.col("code").alias(f"__code{i}")
        )
        out = out.join(codes, F.col(quoted(c)) == F.col(f"__class{i}"), "left")
        out = out.withColumn(c, F.col(f"__code{i}")).drop(f"__class{i}", f"__code{i}")
    return out.select(*order)


def decode(df: DataFrame, encoders: DataFrame, column: str, out: str) -> DataFrame:
    """Class text of an encoded column."""
    classes = encoders.where(F.col("column") == column).select(
        F.col("code").alias("__code"), F.col("class").alias(out)
    )
    return df.join(classes, F.col(quoted(column)).cast("long") == F.col("__code"), "left").drop("__code")


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median per column; a column without values has none."""
    rows = exact_quantiles(df, columns, {"median": 0.5}).collect()
    found = {r["column"]: r["median"] for r in rows}
    return {c: found.get(c) for c in columns}


def fit_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_SCALE_FEATURES) -> dict:
    """Median, then mean and population deviation of the imputed column."""
    medians = fit_medians(df, columns)
    filled = {c: F.coalesce(F.col(quoted(c)).cast("double"), F.lit(medians[c]).cast("double")) for c in columns}
    row = df.agg(
        *[F.avg(filled[c]).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(filled[c]).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    out = {}
    for i, c in enumerate(columns):
        mean, scale = row[f"m{i}"], row[f"s{i}"]
        if scale is not None and scale <= 10 * 2.2e-16 * max(abs(mean), 1e-300):
            scale = 1.0
        out[c] = (medians[c], mean, scale)
    return out


def impute(df: DataFrame, numeric: dict) -> DataFrame:
    """Fill nulls of each column with its fitted median."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(quoted(c)).cast("double"), F.lit(median).cast("double"))
            for c, (median, _, _) in numeric.items()
            if c in df.columns
        }
    )


def scale(df: DataFrame, numeric: dict) -> DataFrame:
    """Zero mean and unit population deviation by the fitted parameters."""
    return df.withColumns(
        {
            c: (F.col(quoted(c)).cast("double") - F.lit(mean)) / F.lit(sd)
            for c, (_, mean, sd) in numeric.items()
            if c in df.columns
        }
    )


def unscale(df: DataFrame, numeric: dict, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Inverse of ``scale``; with a suffix the scaled column stays."""
    return df.withColumns(
        {
            f"{c}{suffix}": F.col(quoted(c)) * F.lit(numeric[c][2]) + F.lit(numeric[c][1])
            for c in columns
        }
    )


def raw_round(df: DataFrame, numeric: dict, out: str = "round_raw") -> DataFrame:
    """Calendar round from the standardised feature."""
    _, mean, sd = numeric["round_number"]
    return df.withColumn(out, F.rint(F.col("round_number") * F.lit(sd) + F.lit(mean)).cast("int"))


def drop_unplaced(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows without a target cannot be trained on."""
    return df.where(F.col(quoted(target)).isNotNull())


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls, status) in one pass."""
    sums = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(columns)]
    )
    return sums.select(F.explode(pairs).alias("v")).select(
        "v.column",
        "v.nulls",
        F.when(F.col("v.nulls") == 0, "OK")
        .otherwise(F.concat(F.lit("WARNING: "), F.col("v.nulls").cast("string"), F.lit(" nulls")))
        .alias("status"),
    )


def rows_with_nulls(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Keys of the rows with a null in any of the columns."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(quoted(c)).isNull()
    return df.where(missing).select(*[F.col(quoted(k)) for k in keys])
