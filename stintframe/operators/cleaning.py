"""Cleaning: raw landing tables to typed tables, all sessions in one job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import clean_value, overflows
from ..schemas import KEY_FIELDS, SESSION_KEYS, TABLE_COLUMNS, quoted
from ..session import durable

SESSION_INFO_JSON = T.StructType(
    [
        T.StructField(
            "Meeting",
            T.StructType(
                [
                    T.StructField("Name", T.StringType()),
                    T.StructField("Country", T.StructType([T.StructField("Name", T.StringType())])),
                    T.StructField("Circuit", T.StructType([T.StructField("ShortName", T.StringType())])),
                ]
            ),
        ),
        T.StructField("Type", T.StringType()),
        T.StructField("StartDate", T.StringType()),
        T.StructField("EndDate", T.StringType()),
        T.StructField("GmtOffset", T.StringType()),
    ]
)

DRIVER_JSON = T.ArrayType(
    T.StructType([T.StructField(c, T.StringType()) for c in TABLE_COLUMNS["driver_info"]])
)


class MissingColumnError(ValueError):
    """A required raw column is absent, so the table cannot be cleaned."""


def _leaves(path: str, dtype: T.DataType):
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaves(f"{path}.{f.name}" if path else f.name, f.dataType)
    else:
        yield path


def flatten(df: DataFrame, column: str, schema: T.StructType = SESSION_INFO_JSON) -> DataFrame:
    """Nested record (JSON text or struct) to dotted columns, other columns kept."""
    record = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, T.StringType):
        df = df.withColumn(column, F.from_json(record, schema))
    else:
        schema = df.schema[column].dataType
    rest = [F.col(quoted(c)) for c in df.columns if c != column]
    leaves = []
    for path in _leaves("", schema):
        field = F.col(quoted(column))
        for part in path.split("."):
            field = field.getField(part)
        leaves.append(field.alias(path))
    return df.select(*rest, *leaves)


def explode_records(df: DataFrame, column: str, schema: T.ArrayType = DRIVER_JSON) -> DataFrame:
    """List of records (JSON text or array of structs) to one row per record."""
    records = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, T.StringType):
        records = F.from_json(records, schema)
    rest = [F.col(quoted(c)) for c in df.columns if c != column]
    return df.select(*rest, F.explode(records).alias("__r")).select(
        *[F.col(quoted(c)) for c in df.columns if c != column], "__r.*"
    )


def as_is(df: DataFrame) -> DataFrame:
    return df


def project(df: DataFrame, table: str) -> DataFrame:
    """Typed target columns plus keys.

    Raises if a required column is absent; an absent optional one becomes null.
    """
    spec = TABLE_COLUMNS[table]
    missing = [c for c, (_, required) in spec.items() if required and c not in df.columns]
    if missing:
        raise MissingColumnError(f"{table}: required columns missing: {missing}")
    body = [clean_value(df, c, kind) for c, (kind, _) in spec.items()]
    keys = [F.col(f.name).cast(f.dataType).alias(f.name) for f in KEY_FIELDS]
    return df.select(*body, *keys)


def unfit_sessions(df: DataFrame, table: str) -> DataFrame:
    """Sessions with a number that a narrow integer column cannot hold.

    Such a value is an error of its session's table, never a silent truncation.
    """
    unfit = F.lit(False)
    for c, (kind, _) in TABLE_COLUMNS[table].items():
        if kind in ("tiny", "short") and c in df.columns:
            unfit = unfit | overflows(F.col(quoted(c)), kind)
    return df.where(unfit).select(*SESSION_KEYS).distinct()


@dataclass(frozen=True)
class TableSpec:
    """How one raw table is read: a shape step, then the typed projection."""

    name: str
    shape: Callable[[DataFrame], DataFrame] = as_is

    def raw_rows(self, landing: DataFrame) -> DataFrame:
        return self.shape(landing)

    def clean(self, landing: DataFrame) -> DataFrame:
        return project(self.shape(landing), self.name)

    def clean_valid(self, landing: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Clean rows of the sessions that fit, and the keys of those that do not.

        The keys are found once, by a pass over the narrow integer columns alone,
        and written; cleaning and counting read them from there.
        """
        rows = self.shape(landing)
        clean = project(rows, self.name)
        bad = durable(unfit_sessions(rows, self.name))
        return clean.join(bad, SESSION_KEYS, "left_anti"), bad


class TableRegistry:
    """Named table specs; new tables are added by registering a spec."""

    def __init__(self) -> None:
        self._specs: dict[str, TableSpec] = {}

    def register(self, name: str, spec: TableSpec) -> None:
        if not isinstance(spec, TableSpec):
            raise TypeError(f"{spec!r} is not a TableSpec")
        if name in self._specs:
            raise ValueError(f"table {name!r} is already registered")
        self._specs[name] = spec

    def get(self, name: str) -> TableSpec:
        if name not in self._specs:
            known = ", ".join(sorted(self._specs)) or "none"
            raise KeyError(f"no table {name!r}; registered: {known}")
        return self._specs[name]

    def all(self) -> dict[str, TableSpec]:
        return dict(self._specs)


registry = TableRegistry()
registry.register(
    "session_info", TableSpec("session_info", lambda d: flatten(d, "session_info"))
)
registry.register("driver_info", TableSpec("driver_info", lambda d: explode_records(d, "drivers")))
for _name in ("session_results", "laps", "weather"):
    registry.register(_name, TableSpec(_name))
