"""Session tables derived from the TPC-H-like test tables.

A customer plays the driver, an order one start of that driver, the order month
the race, the customer's nation the team, order lines the laps, and events the
weather readings. Everything is a row-local rule or an aggregate over the whole
table, so the work grows with the tables given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ALL_TABLES, CIRCUIT, FEATURE_COLUMNS, KEY_FIELDS, PARTITION_FIELDS
from ..session import scratch_path
from ..sources.sinks import read_seasons, write_parquet, write_seasons, write_table
from .features import build_features, lagged_frame

RENAMES = {f"NATION_{i}": f"NATION_{i - 20}" for i in range(20, 25)}
STREET = [f"NATION_{i}" for i in range(1, 25, 4)]
TEST_YEAR = 2001
LAP_KEYS = ["DriverNumber"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its file listing and schema are looked up once."""
    return _once(spark, sf_dir, name, lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("round_number"),
        F.lit("R").alias("session_type"),
        F.col("o_orderkey").alias("DriverNumber"),
        F.col("o_custkey").cast("string").alias("DriverId"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )


def session_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _starts(spark, sf_dir)
    price = F.col("o_totalprice")
    retired = (F.col("o_orderstatus") == "P") & (F.col("priority") == 5)
    no_grid = (F.col("o_orderstatus") == "O") & (F.col("priority") == 4)
    grid = F.ceil(F.lit(0.75) * price / F.lit(25000.0) + F.col("priority")).cast("double")
    return o.select(
        "year",
        "round_number",
        "session_type",
        "DriverNumber",
        F.when(~no_grid, grid).alias("GridPosition"),
        F.when(~retired, F.ceil(price / F.lit(25000.0)).cast("double")).alias("Position"),
        F.when(retired, "R").otherwise(F.ceil(price / F.lit(25000.0)).cast("string")).alias("ClassifiedPosition"),
        (price / F.lit(100.0)).alias("Time"),
        F.col("o_orderstatus").alias("Status"),
        (F.lit(21.0) - F.ceil(price / F.lit(25000.0))).alias("Points"),
    )


def driver_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation")
    teams = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    o = _starts(spark, sf_dir).select("year", "round_number", "session_type", "DriverNumber", "DriverId", "o_custkey")
    return o.join(teams, o.o_custkey == teams.c_custkey).select(
        "year",
        "round_number",
        "session_type",
        "DriverNumber",
        "DriverId",
        F.col("c_name").alias("FullName"),
        F.col("n_name").alias("TeamName"),
    )


def driver_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver of every start, for the cheap hot-entity check."""
    return _starts(spark, sf_dir).select("DriverId")


def session_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    sessions = _starts(spark, sf_dir).select("year", "round_number", "session_type").distinct()
    place = (F.col("round_number") * 7 + F.col("year")) % 25
    return sessions.join(nation, nation.n_nationkey == place, "left").select(
        "year",
        "round_number",
        "session_type",
        F.concat(F.lit("Round "), F.col("round_number").cast("string")).alias("Meeting.Name"),
        F.col("n_name").alias(CIRCUIT),
    )


def laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("DriverNumber"),
        F.col("l_linenumber").alias("LapNumber"),
        (F.col("l_quantity") + F.lit(60.0)).alias("LapTime"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).alias("PitInTime"),
    )


def weather(spark: SparkSession, sf_dir: str, session: str | None = "R") -> DataFrame:
    """Readings of rounds 1 to 11; sign-ups are practice-session readings."""
    e = _read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    out = e.select(
        (F.lit(1995) + F.hour("ts") % 7).alias("year"),
        (F.lit(1) + (F.day("ts") - 1) % 11).alias("round_number"),
        F.when(F.col("event_type") == "signup", "FP1").otherwise("R").alias("session_type"),
        F.col("value").alias("AirTemp"),
        k.cast("double").alias("Humidity"),
        (F.lit(1000.0) + F.col("value") / F.lit(10.0)).alias("Pressure"),
        (F.col("event_type") == "error").alias("Rainfall"),
        (F.col("value") * F.lit(1.5)).alias("TrackTemp"),
        (k * F.lit(3)).alias("WindDirection"),
        (F.col("value") / F.lit(7.0)).alias("WindSpeed"),
    )
    return out if session is None else out.where(F.col("session_type") == session)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "session_info": session_info(spark, sf_dir),
        "driver_info": driver_info(spark, sf_dir),
        "session_results": session_results(spark, sf_dir),
        "laps": laps(spark, sf_dir),
    }


LAG_OPTIONS = {"renames": RENAMES, "lap_keys": LAP_KEYS, "check_boundary": False}


#: Columns that the queries read of the race table.
RACE_COLUMNS = [*FEATURE_COLUMNS, "LapTime_std"]


def race_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Race frame with every lag feature, its keys and the target, written once."""
    return _race_table(spark, sf_dir, "race_table", columns=RACE_COLUMNS)


def whole_race_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The race table with every column of its sources."""
    return _race_table(spark, sf_dir, "whole_race_table")


def _race_table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    make = lambda: spark.read.parquet(write_parquet(lagged(spark, sf_dir, **options), scratch_path(spark, "race")))
    return _once(spark, sf_dir, name, make)


def lagged(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return lagged_frame(tables(spark, sf_dir), **{**LAG_OPTIONS, **options})


# ---- tables written once per application and reused by several queries ------

_WRITTEN: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = make()
    return _WRITTEN[key]


LAP_ROUNDS = 11  # laps of the twelfth round are not landed


def landed_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A stand-in table with its session keys, as it is landed."""
    if table == "weather":
        return weather(spark, sf_dir, session=None)
    if table == "laps":
        keys = _starts(spark, sf_dir).select("year", "round_number", "session_type", "DriverNumber")
        return laps(spark, sf_dir).join(keys, "DriverNumber").where(F.col("round_number") <= LAP_ROUNDS)
    return tables(spark, sf_dir)[table]


def landed_root(spark: SparkSession, sf_dir: str, wanted=tuple(ALL_TABLES)) -> str:
    """Folder with the wanted tables in the partitioned layout; each is written once."""
    root = _once(spark, sf_dir, "landed", lambda: scratch_path(spark, "tables"))
    for t in wanted:
        _once(spark, sf_dir, f"landed-{t}", lambda t=t: write_table(landed_table(spark, sf_dir, t), root, t))
    return root


def landed_schema(df: DataFrame) -> T.StructType:
    """Schema of a stand-in table as written: its columns plus the path columns."""
    body = [f for f in df.schema.fields if f.name not in {k.name for k in KEY_FIELDS}]
    keys = [f for f in df.schema.fields if f.name in {k.name for k in KEY_FIELDS}]
    return T.StructType([*body, *keys, *PARTITION_FIELDS])


def landed_schemas(spark: SparkSession, sf_dir: str) -> dict[str, T.StructType]:
    return {t: landed_schema(landed_table(spark, sf_dir, t)) for t in ALL_TABLES}


def matrix(spark: SparkSession, sf_dir: str):
    """Written feature matrix and its preprocessors."""

    def make():
        df, fitted = build_features(tables(spark, sf_dir), test_year=TEST_YEAR, **LAG_OPTIONS)
        path = write_seasons(df, scratch_path(spark, "matrix"))
        return read_seasons(spark, path, df.schema), fitted

    return _once(spark, sf_dir, "matrix", make)
