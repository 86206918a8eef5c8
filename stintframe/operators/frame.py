"""Race frame: aggregates of laps and weather, and the left joins around results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import mapped
from ..schemas import DRIVER_KEYS, SESSION_KEYS, TARGET, TEAM_RENAMES, quoted
from ..session import durable, small_side
from .history import HOT_ROWS, add_history

WEATHER_MEANS = {
    "RainRisk": "Rainfall",
    "TrackTemp": "TrackTemp",
    "Humidity": "Humidity",
    "Pressure": "Pressure",
    "AirTemp": "AirTemp",
    "WindSpeed": "WindSpeed",
}


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all present; a group-by drops the others."""
    for key in keys:
        df = df.where(F.col(quoted(key)).isNotNull())
    return df


def lap_spread(laps: DataFrame, keys: Sequence[str] = DRIVER_KEYS) -> DataFrame:
    """Sample standard deviation of the lap time per driver and race."""
    return _known(laps, keys).groupBy(*keys).agg(F.stddev_samp("LapTime").alias("LapTime_std"))


def lap_summary(laps: DataFrame, keys: Sequence[str] = DRIVER_KEYS) -> DataFrame:
    """Mean and spread of the lap time, and the number of pit entries."""
    return (
        _known(laps, keys)
        .groupBy(*keys)
        .agg(
            F.avg("LapTime").alias("LapTime_mean"),
            F.stddev_samp("LapTime").alias("LapTime_std"),
            F.count("PitInTime").alias("PitCount"),
        )
    )


def weather_summary(weather: DataFrame, keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """Session means of the weather readings; rain becomes a fraction."""
    means = [F.avg(F.col(c).cast("double")).alias(out) for out, c in WEATHER_MEANS.items()]
    return _known(weather, keys).groupBy(*keys).agg(*means)


def rain_by_round(weather: DataFrame, season: int) -> DataFrame:
    """Rain fraction of each round of one season, wettest first."""
    return (
        weather.where(F.col("year") == season)
        .groupBy("round_number")
        .agg(F.avg(F.col("Rainfall").cast("double")).alias("RainRisk"))
        .orderBy(F.desc("RainRisk"), "round_number")
    )


def prepare_results(results: DataFrame) -> DataFrame:
    """Rename the outcome columns and drop those that driver_info also has."""
    return results.withColumnsRenamed({"Position": TARGET, "Time": "RaceTime"}).drop(
        "FullName", "TeamName", "Abbreviation"
    )


CAR = "__car"


def with_car(df: DataFrame) -> DataFrame:
    """Join key of the car number in which an absent number equals an absent one."""
    return df.withColumn(CAR, F.coalesce(F.col("DriverNumber").cast("string"), F.lit("<none>")))


def join_drivers(results: DataFrame, drivers: DataFrame) -> DataFrame:
    """Left join on the driver keys; an absent car number matches an absent one."""
    right = with_car(drivers).drop("DriverNumber")
    return with_car(results).join(right, [*SESSION_KEYS, CAR], "left").drop(CAR)


def race_frame(
    session_info: DataFrame,
    driver_info: DataFrame,
    results: DataFrame,
    laps: DataFrame,
    weather: DataFrame | None = None,
    lap_keys: Sequence[str] = DRIVER_KEYS,
) -> DataFrame:
    """One row per driver and race. ``laps`` and ``weather`` are aggregated here.

    Laps shrink to driver-race level and weather to session level before they
    meet the results. Drivers and laps join on the same key, so the results are
    shuffled once for both; session-level sides are broadcast if measured small.
    """
    lap_side = lap_spread(laps, lap_keys) if weather is None else lap_summary(laps, lap_keys)
    by_session = list(lap_keys) == DRIVER_KEYS
    results = prepare_results(results)
    if not by_session and results.schema["DriverNumber"].dataType == driver_info.schema["DriverNumber"].dataType:
        # No later join shares the text key, so it need not travel through the shuffle.
        right = driver_info.withColumnsRenamed({k: f"__{k}" for k in DRIVER_KEYS})
        same = [F.col(k) == F.col(f"__{k}") for k in SESSION_KEYS]
        same.append(F.col("DriverNumber").eqNullSafe(F.col("__DriverNumber")))
        frame = results.join(right, same, "left").drop(*[f"__{k}" for k in DRIVER_KEYS])
    else:
        frame = with_car(results).join(with_car(driver_info).drop("DriverNumber"), [*SESSION_KEYS, CAR], "left")
    if by_session:
        frame = frame.join(with_car(lap_side).drop("DriverNumber"), [*SESSION_KEYS, CAR], "left")
    else:
        frame = frame.join(lap_side, list(lap_keys), "left")
    frame = frame.drop(CAR).join(small_side(session_info), SESSION_KEYS, "left")
    if weather is not None:
        frame = frame.join(small_side(weather_summary(weather)), SESSION_KEYS, "left")
    return frame


def normalise_teams(df: DataFrame, renames: Mapping[str, str] = TEAM_RENAMES) -> DataFrame:
    return df.withColumn("TeamName", mapped(F.col("TeamName"), renames))


#: What the histories read of a race frame.
HISTORY_COLUMNS = ["DriverId", "TeamName", "year", "round_number", "DriverNumber", TARGET, "LapTime_std"]


def team_race_mean(df: DataFrame) -> DataFrame:
    """Mean finish of a team in a race."""
    keys = ["TeamName", "year", "round_number"]
    return _known(df, keys).groupBy(*keys).agg(F.avg(TARGET).alias("TeamAvgPosition"))


def team_history(team_race: DataFrame, ewm_span: float = 5, roll_window: int = 3) -> DataFrame:
    """Team form on team-race level: at most one row per team and race."""
    return add_history(
        team_race,
        "TeamName",
        ["year", "round_number"],
        rolls={"TeamFinish_roll3_inseason": ("TeamAvgPosition", roll_window)},
        ewms={"TeamFinish_ewm": ("TeamAvgPosition", ewm_span)},
        hot_rows=None,
    )


def driver_history(
    df: DataFrame,
    ewm_span: float = 5,
    roll_window: int = 3,
    tie_break: Sequence[str] = ("DriverNumber",),
    key_source: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Driver form: last finish, EWM, season rolling mean, last lap spread."""
    return add_history(
        df,
        "DriverId",
        ["year", "round_number", *tie_break],
        lags={"DriverFinish_lag1": TARGET, "LapStd_lag1": "LapTime_std"},
        rolls={"DriverFinish_roll3_inseason": (TARGET, roll_window)},
        ewms={"DriverFinish_ewm": (TARGET, ewm_span)},
        key_source=key_source,
        hot_rows=hot_rows,
    )


def add_lag_features(
    df: DataFrame,
    *,
    ewm_span: float = 5,
    roll_window: int = 3,
    tie_break: Sequence[str] = ("DriverNumber",),
    key_source: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
    check_boundary: bool = True,
    starters: DataFrame | None = None,
) -> DataFrame:
    """All lag features of drivers and teams.

    The team table is aggregated to team-race level before it is lagged, so a
    team mate's result of the same race cannot leak in. The frame is stored first:
    both histories read it, its joins run once, and rows per driver are counted on it.
    """
    df = durable(df)
    team_keys = ["TeamName", "year", "round_number"]
    teams = small_side(team_history(team_race_mean(df), ewm_span, roll_window).drop("TeamAvgPosition"))
    if starters is not None:
        listed = small_side(starters.select(F.col("DriverId").alias("__starter")))
        df = df.join(listed, F.col("DriverId").eqNullSafe(F.col("__starter")), "left_semi")
    out = driver_history(df, ewm_span, roll_window, tie_break, key_source, hot_rows)
    out = out.join(teams, team_keys, "left")
    return guard_season_boundary(out) if check_boundary else out


IN_SEASON = ["DriverFinish_roll3_inseason", "TeamFinish_roll3_inseason"]


def season_leaks(df: DataFrame, first: str = "round_number = 1") -> DataFrame:
    """Rows at a season's start that already carry an in-season value."""
    carried = F.coalesce(*[F.col(c) for c in IN_SEASON]).isNotNull()
    return df.where(F.expr(first) & carried)


def guard_season_boundary(df: DataFrame) -> DataFrame:
    """Fail the job if a first-round row carries an in-season value.

    The check is part of the projection, so it needs no pass of its own.
    """
    guarded = {}
    for c in IN_SEASON:
        leak = (F.col("round_number") == 1) & F.col(c).isNotNull()
        message = F.raise_error(F.lit(f"season boundary leak in {c}")).cast("double")
        guarded[c] = F.when(leak, message).otherwise(F.col(c))
    return df.withColumns(guarded)
