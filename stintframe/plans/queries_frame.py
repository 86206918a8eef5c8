"""Joins, aggregates, windows and feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import mapped
from ..operators import frame as fr
from ..operators import prep
from ..operators.history import add_history
from ..operators.ordering import average_ranks, exact_quantiles, global_rank
from ..operators.segments import prior_races
from ..schemas import CIRCUIT, NUMERIC_SCALE_FEATURES, SESSION_KEYS, TARGET
from ..session import small_side
from . import standin as st
from .catalog import cells, query, tidy
from .oracle import NUMERIC, masked_lagged, melted, with_parts
from .features import build_features, build_inference_features, drop_from_race, split_by_season

KEYS = {"year": "year", "round_number": "round_number", "driver_number": "DriverNumber", "driver_id": "DriverId"}
SQL_KEYS = "year, round_number, dn AS driver_number, did AS driver_id"


def _rounded(*names: str) -> str:
    """``a=b`` pairs to rounded select items."""
    return ", ".join(f"round({b}, 6) + 0e0 AS {a}" for a, b in (n.split("=") for n in names))


# ---- joins ------------------------------------------------------------------


@query("j1_results_drivers", with_parts("ord team", f"SELECT {SQL_KEYS}, pos AS race_position, raw_team AS team FROM ord LEFT JOIN team ON o_custkey = c_custkey"))
def j1(spark, sf):
    out = fr.join_drivers(fr.prepare_results(st.session_results(spark, sf)), st.driver_info(spark, sf))
    return cells(out, {**KEYS, "race_position": TARGET, "team": "TeamName"})


@query("j2_results_session", with_parts("ord", "SELECT year, round_number, dn AS driver_number, n_name AS circuit FROM ord LEFT JOIN nation ON n_nationkey = (round_number * 7 + year) % 25"))
def j2(spark, sf):
    results = st.session_results(spark, sf)
    out = results.join(small_side(st.session_info(spark, sf)), SESSION_KEYS, "left")
    return cells(out, {"year": "year", "round_number": "round_number", "driver_number": "DriverNumber", "circuit": CIRCUIT})


@query("j3_results_laps", with_parts("ord lap", f"SELECT year, round_number, dn AS driver_number, {_rounded('lap_std=lapstd')} FROM ord LEFT JOIN lap ON l_orderkey = dn"))
def j3(spark, sf):
    out = st.session_results(spark, sf).join(fr.lap_spread(st.laps(spark, sf), st.LAP_KEYS), st.LAP_KEYS, "left")
    return cells(out, {"year": "year", "round_number": "round_number", "driver_number": "DriverNumber", "lap_std": "LapTime_std"})


@query("j4_results_weather", with_parts("ord wx", "SELECT o.dn AS driver_number, " + _rounded("rain_risk=\"RainRisk\"", "track_temp=\"TrackTemp\"", "humidity=\"Humidity\"", "wind_speed=\"WindSpeed\"") + " FROM ord o LEFT JOIN wx USING (year, round_number)"))
def j4(spark, sf):
    side = small_side(fr.weather_summary(st.weather(spark, sf)))
    out = st.session_results(spark, sf).join(side, SESSION_KEYS, "left")
    return cells(out, {"driver_number": "DriverNumber", "rain_risk": "RainRisk", "track_temp": "TrackTemp", "humidity": "Humidity", "wind_speed": "WindSpeed"})


def _team_frame(spark, sf):
    out = fr.join_drivers(fr.prepare_results(st.session_results(spark, sf)), st.driver_info(spark, sf))
    return fr.normalise_teams(out, st.RENAMES)


@query("j5_team_form", with_parts("team_hist", f"SELECT f.year, f.round_number, f.dn AS driver_number, f.team, {_rounded('team_ewm=team_ewm', 'team_roll=team_roll')} FROM frame f LEFT JOIN team_hist USING (team, year, round_number)"))
def j5(spark, sf):
    df = _team_frame(spark, sf)
    teams = small_side(fr.team_history(fr.team_race_mean(df)).drop("TeamAvgPosition"))
    out = df.join(teams, ["TeamName", "year", "round_number"], "left")
    return cells(out, {"year": "year", "round_number": "round_number", "driver_number": "DriverNumber", "team": "TeamName", "team_ewm": "TeamFinish_ewm", "team_roll": "TeamFinish_roll3_inseason"})


# ---- aggregates -------------------------------------------------------------


@query("a1_lap_spread", with_parts("lap", f"SELECT l_orderkey AS driver_number, {_rounded('lap_std=lapstd')} FROM lap"))
def a1(spark, sf):
    return cells(fr.lap_spread(st.laps(spark, sf), st.LAP_KEYS), {"driver_number": "DriverNumber", "lap_std": "LapTime_std"})


@query("a2_lap_summary", with_parts("lap", f"SELECT l_orderkey AS driver_number, {_rounded('lap_mean=lapmean', 'lap_std=lapstd')}, pits AS pit_count FROM lap"))
def a2(spark, sf):
    return cells(fr.lap_summary(st.laps(spark, sf), st.LAP_KEYS), {"driver_number": "DriverNumber", "lap_mean": "LapTime_mean", "lap_std": "LapTime_std", "pit_count": "PitCount"})


@query("a3_weather_summary", with_parts("wx", "SELECT year, round_number, " + _rounded(*[f"{a}=\"{b}\"" for a, b in (("rain_risk", "RainRisk"), ("track_temp", "TrackTemp"), ("humidity", "Humidity"), ("pressure", "Pressure"), ("air_temp", "AirTemp"), ("wind_speed", "WindSpeed"))]) + " FROM wx"))
def a3(spark, sf):
    out = fr.weather_summary(st.weather(spark, sf))
    return cells(out, {"year": "year", "round_number": "round_number", "rain_risk": "RainRisk", "track_temp": "TrackTemp", "humidity": "Humidity", "pressure": "Pressure", "air_temp": "AirTemp", "wind_speed": "WindSpeed"})


@query("a3b_rain_by_round", with_parts("wx", 'SELECT round_number, round("RainRisk", 6) AS rain_risk FROM wx WHERE year = 2001'))
def a3b(spark, sf):
    return cells(fr.rain_by_round(st.weather(spark, sf), st.TEST_YEAR), {"round_number": "round_number", "rain_risk": "RainRisk"})


@query("a4_team_race_mean", with_parts("team_race", f"SELECT team, year, round_number, {_rounded('team_mean=tpos')} FROM team_race"))
def a4(spark, sf):
    return cells(fr.team_race_mean(_team_frame(spark, sf)), {"team": "TeamName", "year": "year", "round_number": "round_number", "team_mean": "TeamAvgPosition"})


# ---- windows ----------------------------------------------------------------

_ORDER = ["year", "round_number", "DriverNumber"]


def _starts(spark, sf):
    return fr.join_drivers(fr.prepare_results(st.session_results(spark, sf)), st.driver_info(spark, sf))


@query("w1_lag_cross_season", with_parts("lagged", "SELECT dn AS driver_number, lag1 FROM lagged"))
def w1(spark, sf):
    out = add_history(_starts(spark, sf), "DriverId", _ORDER, lags={"lag1": TARGET}, key_source=st.driver_keys(spark, sf))
    return cells(out, {"driver_number": "DriverNumber", "lag1": "lag1"})


@query("w2_lag_lap_spread", with_parts("lagged", f"SELECT dn AS driver_number, {_rounded('lap_std_lag1=lapstd1')} FROM lagged"))
def w2(spark, sf):
    df = _starts(spark, sf).join(fr.lap_spread(st.laps(spark, sf), st.LAP_KEYS), st.LAP_KEYS, "left")
    out = add_history(df, "DriverId", _ORDER, lags={"lap_std_lag1": "LapTime_std"}, key_source=st.driver_keys(spark, sf))
    return cells(out, {"driver_number": "DriverNumber", "lap_std_lag1": "lap_std_lag1"})


@query("w3_season_rolling_mean", with_parts("lagged", f"SELECT dn AS driver_number, {_rounded('roll3=roll')} FROM lagged"))
def w3(spark, sf):
    out = add_history(_starts(spark, sf), "DriverId", _ORDER, rolls={"roll3": (TARGET, 3)}, key_source=st.driver_keys(spark, sf))
    return cells(out, {"driver_number": "DriverNumber", "roll3": "roll3"})


@query("w4_ewm", with_parts("lagged", f"SELECT dn AS driver_number, {_rounded('ewm5=ewm')} FROM lagged"))
def w4(spark, sf):
    out = add_history(_starts(spark, sf), "DriverId", _ORDER, ewms={"ewm5": (TARGET, 5)}, key_source=st.driver_keys(spark, sf))
    return cells(out, {"driver_number": "DriverNumber", "ewm5": "ewm5"})


@query(
    "w4b_ewm_split_entities",
    with_parts("lagged", f"SELECT dn AS driver_number, lag1, {_rounded('roll3=roll', 'ewm5=ewm')} FROM lagged"),
)
def w4b(spark, sf):
    """The hot-entity route for every driver with more than 12 starts."""
    out = add_history(
        _starts(spark, sf),
        "DriverId",
        _ORDER,
        lags={"lag1": TARGET},
        rolls={"roll3": (TARGET, 3)},
        ewms={"ewm5": (TARGET, 5)},
        key_source=st.driver_keys(spark, sf),
        hot_rows=12,
    )
    return cells(out, {"driver_number": "DriverNumber", "lag1": "lag1", "roll3": "roll3", "ewm5": "ewm5"})


@query("w3b_rolling_in_blocks", with_parts("lagged", f"SELECT dn AS driver_number, lag1, {_rounded('roll3=roll')} FROM lagged"))
def w3b(spark, sf):
    """Histories of more than five starts, cut into blocks of five."""
    out = add_history(_starts(spark, sf), "DriverId", _ORDER, lags={"lag1": TARGET}, rolls={"roll3": (TARGET, 3)}, key_source=st.driver_keys(spark, sf), hot_rows=5)
    return cells(out, {"driver_number": "DriverNumber", "lag1": "lag1", "roll3": "roll3"})


@query("w5_team_ewm", with_parts("team_hist", f"SELECT team, year, round_number, {_rounded('team_ewm=team_ewm')} FROM team_hist"))
def w5(spark, sf):
    out = add_history(fr.team_race_mean(_team_frame(spark, sf)), "TeamName", ["year", "round_number"], ewms={"team_ewm": ("TeamAvgPosition", 5)}, hot_rows=None)
    return cells(out, {"team": "TeamName", "year": "year", "round_number": "round_number", "team_ewm": "team_ewm"})


@query("w6_team_season_rolling", with_parts("team_hist", f"SELECT team, year, round_number, {_rounded('team_roll=team_roll')} FROM team_hist"))
def w6(spark, sf):
    out = add_history(fr.team_race_mean(_team_frame(spark, sf)), "TeamName", ["year", "round_number"], rolls={"team_roll": ("TeamAvgPosition", 3)}, hot_rows=None)
    return cells(out, {"team": "TeamName", "year": "year", "round_number": "round_number", "team_roll": "team_roll"})


@query("w7_prior_count", with_parts("ord", "SELECT dn AS driver_number, row_number() OVER (PARTITION BY did ORDER BY year, round_number, dn) - 1 AS prior_races FROM ord"))
def w7(spark, sf):
    out = prior_races(_starts(spark, sf))
    return cells(out, {"driver_number": "DriverNumber", "prior_races": "prior_races"})


@query("w8_rank_in_race", with_parts("ord", "SELECT year, round_number, dn AS driver_number, row_number() OVER (PARTITION BY year, round_number ORDER BY price, dn) AS predicted_rank FROM ord"))
def w8(spark, sf):
    """Rank of the scored rows of every race; a race may be of any size."""
    df = st.session_results(spark, sf).select("year", "round_number", "DriverNumber", F.col("Time").alias("score"))
    out = global_rank(df, ["score", "DriverNumber"], ["year", "round_number"], "predicted_rank")
    return cells(out, {"year": "year", "round_number": "round_number", "driver_number": "DriverNumber", "predicted_rank": "predicted_rank"})


@query(
    "w9_season_boundary",
    with_parts(
        "lagged",
        """SELECT count(*) AS rows_checked, CAST(sum(CASE WHEN n = 1 AND roll IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS driver_leaks,
       CAST(sum(CASE WHEN round_number = 1 AND team_roll IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS team_leaks
FROM (SELECT *, row_number() OVER (PARTITION BY did, year ORDER BY rn) AS n FROM lagged)""",
    ),
)
def w9(spark, sf):
    df = st.race_table(spark, sf)
    season = add_history(df.withColumn("entry", F.concat_ws("|", "DriverId", "year")), "entry", _ORDER, prior="in_season")
    driver = F.count_if((F.col("in_season") == 0) & F.col("DriverFinish_roll3_inseason").isNotNull())
    team = F.count_if((F.col("round_number") == 1) & F.col("TeamFinish_roll3_inseason").isNotNull())
    return tidy(season.agg(F.count("*").alias("rows_checked"), driver.alias("driver_leaks"), team.alias("team_leaks")))


@query(
    "w10_average_rank",
    """SELECT price_k, n, rank FROM (
  SELECT CAST(ceil(o_totalprice / 1000e0) AS BIGINT) AS price_k, count(*) AS n,
         sum(count(*)) OVER (ORDER BY CAST(ceil(o_totalprice / 1000e0) AS BIGINT)) - count(*) + (count(*) + 1) / 2e0 AS rank
  FROM orders GROUP BY 1)""",
)
def w10(spark, sf):
    counts = (
        st._read(spark, sf, "orders")
        .groupBy(F.ceil(F.col("o_totalprice") / F.lit(1000.0)).cast("long").alias("price_k"))
        .agg(F.count("*").alias("n"))
        .withColumn("all", F.lit(0))
    )
    return cells(average_ranks(counts, ["all"], "price_k"), {"price_k": "price_k", "n": "n", "rank": "rank"})


# ---- composed features ------------------------------------------------------

FRAME_COLS = {**KEYS, "team": "TeamName", "circuit": CIRCUIT, "grid": "GridPosition", "race_position": TARGET, "lap_std": "LapTime_std"}


@query("fe10_race_frame", with_parts("frame", f"SELECT {SQL_KEYS}, raw_team AS team, circuit, grid, pos AS race_position, {_rounded('lap_std=lapstd')} FROM frame"))
def fe10(spark, sf):
    t = st.tables(spark, sf)
    return cells(fr.race_frame(*t.values(), lap_keys=st.LAP_KEYS), FRAME_COLS)


@query(
    "fe10b_audit_frame",
    with_parts(
        "frame wx",
        f"SELECT {SQL_KEYS}, {_rounded('lap_mean=lapmean', 'lap_std=lapstd')}, coalesce(pits, NULL) AS pit_count, "
        + _rounded('rain_risk="RainRisk"', 'air_temp="AirTemp"')
        + " FROM frame LEFT JOIN wx USING (year, round_number)",
    ),
)
def fe10b(spark, sf):
    t = st.tables(spark, sf)
    out = fr.race_frame(*t.values(), weather=st.weather(spark, sf), lap_keys=st.LAP_KEYS)
    return cells(out, {**KEYS, "lap_mean": "LapTime_mean", "lap_std": "LapTime_std", "pit_count": "PitCount", "rain_risk": "RainRisk", "air_temp": "AirTemp"})


LAG_COLS = {
    **KEYS,
    "lag1": "DriverFinish_lag1",
    "ewm": "DriverFinish_ewm",
    "roll": "DriverFinish_roll3_inseason",
    "lap_std_lag1": "LapStd_lag1",
    "team_ewm": "TeamFinish_ewm",
    "team_roll": "TeamFinish_roll3_inseason",
}
LAG_SQL = f"SELECT {SQL_KEYS}, lag1, {_rounded('ewm=ewm', 'roll=roll', 'lap_std_lag1=lapstd1', 'team_ewm=team_ewm', 'team_roll=team_roll')} FROM lagged"


@query("fe11_lag_features", with_parts("lagged", LAG_SQL))
def fe11(spark, sf):
    return cells(st.lagged(spark, sf), LAG_COLS)


@query(
    "fe11b_lag_features_span10_window7",
    with_parts("lagged", LAG_SQL)
    .replace("pow(1.5e0, rn)", f"pow({(1 / (1 - 2 / 11))!r}e0, rn)")
    .replace("BETWEEN 3 PRECEDING", "BETWEEN 7 PRECEDING"),
)
def fe11b(spark, sf):
    """Another point of the tuning grid: span 10, window 7."""
    return cells(st.lagged(spark, sf, ewm_span=10, roll_window=7), LAG_COLS)


@query(
    "fe12_label_encode",
    with_parts(
        "codes",
        """SELECT f.dn AS driver_number, t.code AS team_code, c.code AS circuit_code
FROM frame f LEFT JOIN team_codes t ON f.team = t.cls LEFT JOIN circuit_codes c ON f.circuit = c.cls""",
    ),
)
def fe12(spark, sf):
    df = st.race_table(spark, sf)
    out = prep.encode(df, prep.fit_encoders(df))
    return cells(out, {"driver_number": "DriverNumber", "team_code": "TeamName", "circuit_code": CIRCUIT})


@query(
    "fe13_label_transform",
    with_parts(
        "codes",
        """SELECT f.dn AS driver_number, t.code AS team_code, c.code AS circuit_code
FROM frame f JOIN team_codes t ON f.team = t.cls JOIN circuit_codes c ON f.circuit = c.cls WHERE f.year = 2001""",
    ),
)
def fe13(spark, sf):
    """Codes fitted on all seasons, applied strictly to the held-out one."""
    df = st.race_table(spark, sf)
    out = prep.encode(df.where(F.col("year") == st.TEST_YEAR), prep.fit_encoders(df), strict=True)
    return cells(out, {"driver_number": "DriverNumber", "team_code": "TeamName", "circuit_code": CIRCUIT})


@query("fe14_inverse_label", with_parts("frame", "SELECT dn AS driver_number, circuit, team FROM frame WHERE pos IS NOT NULL"))
def fe14(spark, sf):
    df, fitted = st.matrix(spark, sf)
    out = prep.decode(prep.decode(df, fitted.encoders, CIRCUIT, "circuit"), fitted.encoders, "TeamName", "team")
    return cells(out, {"driver_number": "DriverNumber", "circuit": "circuit", "team": "team"})


_FILLED = ", ".join(f"round({c}, 6) + 0e0 AS {c}" for c in NUMERIC.values())


@query("fe15_median_impute", with_parts("filled", f"SELECT dn AS driver_number, {_FILLED} FROM filled"))
def fe15(spark, sf):
    placed = prep.drop_unplaced(st.race_table(spark, sf))
    medians = prep.fit_medians(placed, NUMERIC_SCALE_FEATURES)
    out = prep.impute(placed, {c: (m, None, None) for c, m in medians.items()})
    return cells(out, {"driver_number": "DriverNumber", **{short: c for c, short in NUMERIC.items()}})


_SCALED = ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled), 6) + 0e0 AS {c}" for c in NUMERIC.values()
)


@query("fe16_standardise", with_parts("filled", f"SELECT dn AS driver_number, {_SCALED} FROM filled"))
def fe16(spark, sf):
    placed = prep.drop_unplaced(st.race_table(spark, sf))
    numeric = prep.fit_numeric(placed)
    out = prep.scale(prep.impute(placed, numeric), numeric)
    return cells(out, {"driver_number": "DriverNumber", **{short: c for c, short in NUMERIC.items()}})


@query("fe17_inverse_scale", with_parts("filled", "SELECT dn AS driver_number, raw_round AS round_raw, round(grid, 6) AS grid, round(ewm, 6) AS ewm FROM filled"))
def fe17(spark, sf):
    df, fitted = st.matrix(spark, sf)
    out = prep.raw_round(df, fitted.numeric, "back").drop("round_raw")
    out = prep.unscale(out, fitted.numeric, ["GridPosition", "DriverFinish_ewm"], "_raw")
    return cells(out, {"driver_number": "DriverNumber", "round_raw": "back", "grid": "GridPosition_raw", "ewm": "DriverFinish_ewm_raw"})


_MATRIX_SQL = f"""SELECT f.year, f.raw_round AS round_raw, f.dn AS driver_number, f.did AS driver_id, t.code AS team_code,
  c.code AS circuit_code, {_SCALED.replace('round((', 'round((f.')}, f.pos AS race_position
FROM filled f LEFT JOIN team_codes t ON f.team = t.cls LEFT JOIN circuit_codes c ON f.circuit = c.cls"""


def _matrix_cols():
    return {
        "year": "year",
        "round_raw": "round_raw",
        "driver_number": "DriverNumber",
        "driver_id": "DriverId",
        "team_code": "TeamName",
        "circuit_code": CIRCUIT,
        **{short: c for c, short in NUMERIC.items()},
        "race_position": TARGET,
    }


@query("fe18_training_matrix", with_parts("filled codes", _MATRIX_SQL))
def fe18(spark, sf):
    df, _ = build_features(st.tables(spark, sf), test_year=st.TEST_YEAR, **st.LAG_OPTIONS)
    return cells(df, _matrix_cols())


@query(
    "fe18b_train_scope_parameters",
    with_parts("placed", """SELECT "column", round(median(value), 6) AS median FROM (""" + melted("(SELECT * FROM placed WHERE year <> 2001)") + """) GROUP BY 1"""),
)
def fe18b(spark, sf):
    """Medians fitted without the held-out season."""
    df = prep.drop_unplaced(st.race_table(spark, sf)).where(F.col("year") != st.TEST_YEAR)
    return cells(exact_quantiles(df, NUMERIC_SCALE_FEATURES, {"median": 0.5}), {"column": "column", "median": "median"})


@query(
    "fe19_inference_matrix",
    with_parts("filled codes", "", "").rstrip()
    + ", "
    + masked_lagged(2001, 5)
    + f""", params AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in NUMERIC.values())} FROM filled),
tgt AS (SELECT * FROM m_lagged WHERE year = 2001 AND round_number = 5)
SELECT g.dn AS driver_number, g.did AS driver_id, t.code AS team_code, c.code AS circuit_code,
  {', '.join(f'round((coalesce(CAST(g.{c} AS DOUBLE), m.{c}) - p.{c}_m) / p.{c}_s, 6) + 0e0 AS {c}' for c in NUMERIC.values())}
FROM tgt g CROSS JOIN med m CROSS JOIN params p LEFT JOIN team_codes t ON g.team = t.cls LEFT JOIN circuit_codes c ON g.circuit = c.cls""",
)
def fe19(spark, sf):
    """Features of one race; drivers that start twice in it see nothing of it."""
    _, fitted = st.matrix(spark, sf)
    tables = st.tables(spark, sf)
    out = build_inference_features(tables, st.TEST_YEAR, 5, fitted, strict=False, **st.LAG_OPTIONS)
    cols = _matrix_cols()
    return cells(out, {k: c for k, c in cols.items() if k not in ("year", "round_raw", "race_position")})


@query(
    "fe20_season_split",
    with_parts("ord", "SELECT CASE WHEN year = 2001 THEN 'test' ELSE 'train' END AS part, year, count(*) AS n FROM ord WHERE pos IS NOT NULL GROUP BY 1, 2"),
)
def fe20(spark, sf):
    df, _ = st.matrix(spark, sf)
    train, test = split_by_season(df, st.TEST_YEAR)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return tidy(both.groupBy("part", "year").agg(F.count("*").alias("n")))


@query("fe21_leak_guard", with_parts("ord", "SELECT year, round_number AS round_raw, count(*) AS n FROM ord WHERE pos IS NOT NULL AND NOT (year = 2000 AND round_number >= 6) GROUP BY 1, 2"))
def fe21(spark, sf):
    df, _ = st.matrix(spark, sf)
    return tidy(drop_from_race(df, 2000, 6).groupBy("year", "round_raw").agg(F.count("*").alias("n")))


# ---- joins of the later steps -----------------------------------------------


@query(
    "j6_driver_names",
    with_parts("ord team", "SELECT dn AS driver_number, pos AS prediction, c_name AS full_name, raw_team AS team_raw FROM ord JOIN team ON o_custkey = c_custkey WHERE pos IS NOT NULL"),
)
def j6(spark, sf):
    df, _ = st.matrix(spark, sf)
    names = st.driver_info(spark, sf).select("DriverId", "FullName", F.col("TeamName").alias("TeamName_raw")).distinct()
    out = df.select("DriverNumber", "DriverId", TARGET).join(small_side(names), "DriverId", "left")
    return cells(out, {"driver_number": "DriverNumber", "prediction": TARGET, "full_name": "FullName", "team_raw": "TeamName_raw"})


@query("j7_actual_results", with_parts("ord", "SELECT dn AS driver_number, grid AS predicted, pos AS actual FROM ord"))
def j7(spark, sf):
    results = st.session_results(spark, sf)
    predicted = results.select("DriverNumber", F.col("GridPosition").alias("predicted"))
    actual = results.select("DriverNumber", F.col("Position").alias("actual"))
    return cells(predicted.join(actual, "DriverNumber", "left"), {"driver_number": "DriverNumber", "predicted": "predicted", "actual": "actual"})


@query("j8_rain_risk", with_parts("ord wx", 'SELECT dn AS driver_number, round("RainRisk", 6) AS rain_risk FROM (SELECT * FROM ord WHERE year = 2001) o LEFT JOIN (SELECT round_number, "RainRisk" FROM wx WHERE year = 2001) w USING (round_number)'))
def j8(spark, sf):
    season = st.session_results(spark, sf).where(F.col("year") == st.TEST_YEAR)
    rain = small_side(fr.rain_by_round(st.weather(spark, sf), st.TEST_YEAR))
    return cells(season.join(rain, "round_number", "left"), {"driver_number": "DriverNumber", "rain_risk": "RainRisk"})


@query(
    "j9_prior_races_lookup",
    with_parts("ord", "SELECT o.dn AS driver_number, p.prior_races FROM ord o LEFT JOIN (SELECT dn, row_number() OVER (PARTITION BY did ORDER BY year, round_number, dn) - 1 AS prior_races FROM ord WHERE pos IS NOT NULL) p ON o.dn = p.dn WHERE o.year = 2001"),
)
def j9(spark, sf):
    starts = _starts(spark, sf)
    prior = prior_races(prep.drop_unplaced(starts))
    keys = ["DriverId", "year", "round_number", "DriverNumber"]
    out = starts.where(F.col("year") == st.TEST_YEAR).select(*keys).join(prior.select(*keys, "prior_races"), keys, "left")
    return cells(out, {"driver_number": "DriverNumber", "prior_races": "prior_races"})


@query("j11_semi_join", "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def j11(spark, sf):
    return st._read(spark, sf, "orders").join(st._read(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left_semi").select("o_orderkey")


@query(
    "j12_unseen_classes",
    with_parts("team", "SELECT DISTINCT 'TeamName' AS \"column\", raw_team AS class FROM team JOIN orders ON o_custkey = c_custkey WHERE raw_team NOT IN (SELECT team FROM team)"),
)
def j12(spark, sf):
    """Raw team names that the encoder, fitted after renaming, has never seen."""
    drivers = st.driver_info(spark, sf)
    fitted = prep.fit_encoders(fr.normalise_teams(drivers, st.RENAMES), ["TeamName"])
    return prep.unseen_classes(drivers, fitted, ["TeamName"])


@query(
    "p12_value_map",
    with_parts("team", "SELECT c_custkey AS driver_id, raw_team, team FROM team"),
)
def p12(spark, sf):
    c, n = st._read(spark, sf, "customer"), st._read(spark, sf, "nation")
    joined = c.join(n, c.c_nationkey == n.n_nationkey)
    return joined.select(F.col("c_custkey").alias("driver_id"), F.col("n_name").alias("raw_team"), mapped(F.col("n_name"), st.RENAMES).alias("team"))


@query("p17_mask_target", with_parts("ord", "SELECT dn AS driver_number, CASE WHEN NOT (year = 2001 AND round_number = 5) THEN pos END AS race_position FROM ord"))
def p17(spark, sf):
    hit = (F.col("year") == 2001) & (F.col("round_number") == 5)
    out = st.session_results(spark, sf).withColumn("Position", F.when(~hit, F.col("Position")))
    return cells(out, {"driver_number": "DriverNumber", "race_position": "Position"})
