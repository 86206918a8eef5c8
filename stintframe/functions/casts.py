"""Tolerant casts from raw session values to the clean types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGER_RANGE = {"tiny": (-128, 127), "short": (-32768, 32767)}


def as_number(col: Column) -> Column:
    """Numeric value or null; text such as ``"44.0"`` counts, NaN becomes null."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def as_integer(col: Column, kind: str) -> Column:
    """Narrow integer, null where the value is not a number or does not fit."""
    low, high = _INTEGER_RANGE[kind]
    number = as_number(col)
    fits = (number == F.rint(number)) & number.between(low, high)
    return F.when(fits, number.try_cast("tinyint" if kind == "tiny" else "smallint"))


def overflows(col: Column, kind: str) -> Column:
    """True for a number that the narrow integer type cannot hold exactly."""
    return as_number(col).isNotNull() & as_integer(col, kind).isNull()


def as_seconds(col: Column, dtype: T.DataType) -> Column:
    """Duration to double seconds: intervals, or integer nanoseconds."""
    if isinstance(dtype, T.DayTimeIntervalType):
        epoch = F.lit("1970-01-01 00:00:00Z").cast("timestamp")
        return F.unix_micros(epoch + col) / F.lit(1e6)
    if isinstance(dtype, T.IntegralType):
        return col / F.lit(1e9)
    return as_number(col)


def as_naive_time(col: Column) -> Column:
    """ISO text or timestamp to a timestamp without zone."""
    return col.try_cast("timestamp_ntz")


def clean_value(df: DataFrame, name: str, kind: str) -> Column:
    """Cast column ``name`` of ``df`` to its clean ``kind``; typed null if absent."""
    from ..schemas import quoted, spark_type

    if name not in df.columns:
        return F.lit(None).cast(spark_type(kind)).alias(name)
    raw = F.col(quoted(name))
    if kind in _INTEGER_RANGE:
        out = as_integer(raw, kind)
    elif kind == "float":
        out = as_number(raw).cast("float")
    elif kind == "seconds":
        out = as_seconds(raw, df.schema[name].dataType)
    elif kind == "time":
        out = as_naive_time(raw)
    elif kind == "flag":
        out = raw.try_cast("boolean")
    else:
        out = raw.cast("string")
    return out.alias(name)
