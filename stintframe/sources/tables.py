"""Scan of the clean session tables and of the landing zone."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (
    ALL_TABLES,
    CORE_TABLES,
    RACE_SESSION,
    SESSION_KEYS,
    SESSION_TYPES,
    table_schema,
)
from ..session import path_exists, small_side
from .sinks import MANIFEST_SCHEMA, manifest_path, partition_counts

# Tables wanted by each load mode. The visual mode would add telemetry, which no
# clean table stores, so both read the same tables.
LOAD_MODES = {"ml": ALL_TABLES, "viz": ALL_TABLES}


# Columns that exist in the path only; the files carry round_number and session_type.
PATH_COLUMNS = ["round", "session"]


def tables_for_mode(mode: str = "ml") -> list[str]:
    if mode not in LOAD_MODES:
        raise ValueError(f"invalid mode {mode!r}; choose from: {', '.join(sorted(LOAD_MODES))}")
    return list(LOAD_MODES[mode])


def parse_years(args: Sequence[str]) -> list[int]:
    """``["2020", "2022-2024"]`` to sorted distinct years."""
    years: set[int] = set()
    for arg in args:
        first, dash, last = arg.partition("-")
        is_range = bool(dash and first and "-" not in last)
        try:
            low = int(first if is_range else arg)
            high = int(last) if is_range else low
        except ValueError:
            kind = "range" if is_range else "year or range"
            raise ValueError(f"{arg!r} is not a valid {kind}") from None
        if low > high:
            raise ValueError(f"range start ({low}) must be <= end ({high})")
        years.update(range(low, high + 1))
    return sorted(years)


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    years: Iterable[int] | None = None,
    session: str | None = RACE_SESSION,
    schema: T.StructType | None = None,
    layout: str = "table",
) -> DataFrame:
    """One clean table with partition pruning on season and session.

    ``layout="table"`` reads ``root/<table>/year=/round=/session=/``;
    ``layout="session"`` reads one ``<table>.parquet`` per session folder under
    ``root/year=/round=/session=/``. The schema is explicit: columns that some
    partitions lack come out as typed nulls, so the union of all partitions
    tolerates differing files.
    """
    schema = schema or table_schema(table, partitions=True)
    reader = spark.read.schema(schema)
    if layout == "session":
        df = reader.option("pathGlobFilter", f"{table}.parquet").parquet(root)
    else:
        df = reader.parquet(f"{root}/{table}")
    if session is not None:
        df = df.where(F.col("session") == session)
    if years is not None:
        df = df.where(F.col("year").isin(list(years)))
    return df


def partition_manifest(
    spark: SparkSession,
    root: str,
    tables: Sequence[str],
    years: Iterable[int] | None = None,
    session: str | None = RACE_SESSION,
) -> DataFrame:
    """(table, year, round, session, n): the partitions of the tables, read from their manifests.

    A table written by other means has no manifest; its partitions are then
    counted from its folders and file footers. A table without a folder has none.
    """
    parts = []
    for name in tables:
        if path_exists(spark, manifest_path(root, name)):
            found = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path(root, name))
        elif path_exists(spark, f"{root}/{name}"):
            found = partition_counts(spark, root, name)
        else:
            found = spark.createDataFrame([], MANIFEST_SCHEMA)
        parts.append(found.withColumn("table", F.lit(name)))
    out = reduce(DataFrame.unionByName, parts).where("n > 0")
    if session is not None:
        out = out.where(F.col("session") == session)
    if years is not None:
        out = out.where(F.col("year").isin(list(years)))
    return out.select("table", "year", "round", "session", "n")


def complete_in(manifest: DataFrame, tables: Sequence[str]) -> DataFrame:
    """(year, round, session) for which the manifest has every one of the tables."""
    wanted = manifest.where(F.col("table").isin(list(tables)))
    grouped = wanted.groupBy("year", "round", "session").agg(F.count("*").alias("have"))
    return grouped.where(F.col("have") == len(tables)).drop("have")


def missing_in(manifest: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Partitions that lack one of the tables, with the list of those they lack."""
    names = F.array(*[F.lit(t) for t in tables])
    have = F.collect_set("table")  # at most one entry per table name
    grouped = manifest.groupBy("year", "round", "session").agg(F.array_except(names, have).alias("missing"))
    return grouped.where(F.size("missing") > 0)


def latest_complete(manifest: DataFrame, tables: Sequence[str]) -> DataFrame:
    """The greatest (year, round) that has every table, as one row."""
    best = complete_in(manifest, tables).agg(F.max(F.struct("year", "round")).alias("m"))
    return best.where("m is not null").select("m.year", "m.round")


def partition_keys(df: DataFrame) -> DataFrame:
    return df.select("year", "round", "session").distinct()


def complete_partitions(tables: dict[str, DataFrame]) -> DataFrame:
    """(year, round, session) present in every one of the tables."""
    return reduce(
        lambda left, right: left.join(right, ["year", "round", "session"], "left_semi"),
        [partition_keys(df) for df in tables.values()],
    )


def incomplete_partitions(tables: dict[str, DataFrame]) -> DataFrame:
    """Partitions that lack a table, with the list of the missing ones."""
    seen = reduce(
        DataFrame.unionByName,
        [partition_keys(df).withColumn("table", F.lit(name)) for name, df in tables.items()],
    )
    names = F.array(*[F.lit(n) for n in tables])
    have = F.collect_set("table")  # at most one entry per table name
    return (
        seen.groupBy("year", "round", "session")
        .agg(F.array_except(names, have).alias("missing"))
        .where(F.size("missing") > 0)
    )


def load_sources(
    spark: SparkSession,
    root: str,
    years: Iterable[int] | None = None,
    *,
    tables: Sequence[str] = tuple(CORE_TABLES),
    complete: bool = True,
    layout: str = "table",
    schemas: dict[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Race-session tables, restricted to partitions that have all of them.

    Which partitions those are is read from the manifests, not from the tables.
    The path columns are dropped once they have done their work.

    Raises ``FileNotFoundError`` if nothing matches.
    """
    schemas = schemas or {}
    years = None if years is None else sorted(set(years))
    where = f"under {root}" + (f" for years {years}" if years is not None else "")
    folders = [root] if layout == "session" else [f"{root}/{t}" for t in tables]
    if not all(path_exists(spark, f) for f in folders):
        raise FileNotFoundError(f"no race-session partitions {where}")
    found = {t: read_table(spark, root, t, years, schema=schemas.get(t), layout=layout) for t in tables}
    if not complete:
        if all(df.isEmpty() for df in found.values()):
            raise FileNotFoundError(f"no race-session partitions {where}")
        return {t: df.drop(*PATH_COLUMNS) for t, df in found.items()}
    if layout == "session":
        keys = small_side(complete_partitions(found))
    else:
        keys = small_side(complete_in(partition_manifest(spark, root, tables, years), tables))
    if keys.isEmpty():
        raise FileNotFoundError(f"no complete race-session partitions {where}")
    return {
        t: df.join(keys, ["year", *PATH_COLUMNS], "left_semi").drop(*PATH_COLUMNS)
        for t, df in found.items()
    }


def latest_complete_round(tables: dict[str, DataFrame]) -> tuple[int, int]:
    """Greatest (year, round) that has every table."""
    best = complete_partitions(tables).agg(F.max(F.struct("year", "round")).alias("m")).first()["m"]
    if best is None:
        raise FileNotFoundError("no complete race-session partitions")
    return best["year"], best["round"]


def read_landing(spark: SparkSession, root: str, table: str, years: Iterable[int] | None = None) -> DataFrame:
    """Raw rows of a table for all sessions at once."""
    if not path_exists(spark, f"{root}/{table}"):
        raise FileNotFoundError(f"nothing landed for {table} under {root}")
    df = spark.read.parquet(f"{root}/{table}")
    return df if years is None else df.where(F.col("year").isin(list(years)))


def expected_sessions(schedule: DataFrame) -> DataFrame:
    """Every round of the schedule with each of the session types."""
    types = F.explode(F.array(*[F.lit(t) for t in SESSION_TYPES]))
    return schedule.select("year", "round_number").distinct().withColumn("session_type", types)


def skipped_sessions(schedule: DataFrame, landed: DataFrame) -> DataFrame:
    """Scheduled sessions for which nothing was landed."""
    return expected_sessions(schedule).join(landed.select(*SESSION_KEYS).distinct(), SESSION_KEYS, "left_anti")
