"""Writers and readers of tables, feature matrices, parameters and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITION_FIELDS, quoted

MANIFEST = "_manifest"
#: Rows of one file in a season store or a table of vectors. A scan packs whole files
#: into a task (at most 32 of them: each counts 4 MB or more of 128 MB), so a task's
#: rows are bounded however large the table is and however it was written.
ROWS_PER_FILE = 16_384
PARTITION_SCHEMA = T.StructType([T.StructField("year", T.IntegerType()), *PARTITION_FIELDS])
MANIFEST_SCHEMA = T.StructType([*PARTITION_SCHEMA, T.StructField("n", T.LongType())])

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("MAE", T.DoubleType()),
        T.StructField("Spearman_rho", T.DoubleType()),
        T.StructField("Macro_F1", T.DoubleType()),
    ]
)


def write_table(df: DataFrame, root: str, table: str) -> str:
    """Hive-partitioned Parquet; only the partitions present in ``df`` are replaced.

    The path columns ``round`` and ``session`` are copies, so the files keep
    ``round_number`` and ``session_type``. Rows are rebalanced by partition:
    small sessions become one file each, a huge one is split over tasks. The
    table's manifest is written anew.
    """
    path = f"{root}/{table}"
    keyed = df.withColumns(
        {
            "round": F.lpad(F.col("round_number").cast("string"), 2, "0"),
            "session": F.col("session_type"),
        }
    )
    (
        keyed.hint("rebalance", "year", "round", "session")
        .write.partitionBy("year", "round", "session")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .parquet(path)
    )
    write_manifest(df.sparkSession, root, table)
    return path


def manifest_path(root: str, table: str) -> str:
    return f"{root}/{MANIFEST}/{table}"


def partition_counts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(year, round, session, n) of a table, from partition values and file footers: no column is read."""
    keys = spark.read.schema(PARTITION_SCHEMA).parquet(f"{root}/{table}")
    return keys.groupBy("year", "round", "session").agg(F.count("*").alias("n"))


def write_manifest(spark: SparkSession, root: str, table: str) -> None:
    """Store the partitions of a table and their row counts beside the tables, one row a partition."""
    counts = partition_counts(spark, root, table)
    counts.write.mode("overwrite").option("compression", "snappy").parquet(manifest_path(root, table))


def write_parquet(df: DataFrame, path: str, rows_per_file: int = 0) -> str:
    """Plain Parquet; with ``rows_per_file`` a task writes several files of at most so many rows."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


def write_seasons(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Season store: Parquet with a folder per season, so that season filters prune files.

    Rows are rebalanced by season: a small one becomes one file, a huge one is split
    over tasks and into files of at most ``rows_per_file`` rows.
    """
    writer = df.hint("rebalance", "year").write.partitionBy("year").mode("overwrite").option("compression", "snappy")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


def read_seasons(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A season store, with the columns and their order as in ``schema`` if given."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*[F.col(quoted(c)) for c in schema.names])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Report table with a header; reports are a few rows, written as one file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str = METRIC_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
