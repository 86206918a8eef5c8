"""Registered queries over the stand-in tables, each with its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import quoted

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; the check SQL is left out where SQL cannot express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is already registered")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Integers as long and fractions rounded, so both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.FractionalType):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def cells(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select with renaming, for columns whose names hold dots."""
    return tidy(df.select(*[F.col(quoted(c)).alias(out) for out, c in columns.items()]))
