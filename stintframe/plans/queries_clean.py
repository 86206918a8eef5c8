"""Scans, sinks, cleaning, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import membership_flag, position_tier, threshold_flag
from ..operators import audit, cleaning, prep
from ..operators.frame import join_drivers, prepare_results
from ..operators.prep import Preprocessors
from ..schemas import ALL_TABLES, CIRCUIT, CORE_TABLES, FINAL_FEATURES, ID_COLUMNS, LEAKAGE_REGISTRY, TARGET
from ..session import scratch_path
from ..sources import sinks, tables
from . import standin as st
from .catalog import cells, query, tidy
from .features import run_modules
from .ingest import run_ingestion
from .oracle import with_parts

# ---- scans and sinks --------------------------------------------------------


def _scan(spark, sf, table, **options):
    schema = st.landed_schema(st.landed_table(spark, sf, table))
    return tables.read_table(spark, st.landed_root(spark, sf, [table]), table, schema=schema, **options)


@query("s1_partitioned_scan", with_parts("ord", "SELECT year, round_number, count(*) AS n, count(pos) AS placed FROM ord GROUP BY 1, 2"))
def s1(spark, sf):
    df = _scan(spark, sf, "session_results")
    return tidy(df.groupBy("year", "round_number").agg(F.count("*").alias("n"), F.count("Position").alias("placed")))


@query("s2_year_filter", with_parts("ord", "SELECT year, dn AS driver_number, pos AS position FROM ord WHERE year IN (1996, 2000)"))
def s2(spark, sf):
    df = _scan(spark, sf, "session_results", years=[1996, 2000])
    return cells(df, {"year": "year", "driver_number": "DriverNumber", "position": "Position"})


@query("s3_session_filter", with_parts("wx", "SELECT CAST(year AS BIGINT) AS year, CAST(round_number AS BIGINT) AS round_number, count(*) AS n FROM wx0 WHERE session_type = 'R' GROUP BY 1, 2"))
def s3(spark, sf):
    return tidy(_scan(spark, sf, "weather", session="R").groupBy("year", "round_number").agg(F.count("*").alias("n")))


def _landed_races(spark, sf, wanted=CORE_TABLES, **options):
    root = st.landed_root(spark, sf, wanted)
    return tables.load_sources(spark, root, tables=wanted, schemas=st.landed_schemas(spark, sf), **options)


def _manifest(spark, sf, wanted):
    return tables.partition_manifest(spark, st.landed_root(spark, sf, wanted), wanted)


# Partitions of each landed table.
_HELD = f"""held AS (
  SELECT DISTINCT year, round_number, unnest(['session_info', 'session_results']) AS t FROM ord
  UNION SELECT year, round_number, 'driver_info' FROM ord JOIN team ON c_custkey = o_custkey
  UNION SELECT year, round_number, 'laps' FROM ord JOIN lineitem ON l_orderkey = dn WHERE round_number <= {st.LAP_ROUNDS}
  UNION SELECT year, round_number, 'weather' FROM wx0 WHERE session_type = 'R'),
complete AS (SELECT year, round_number FROM held WHERE t <> 'weather' GROUP BY 1, 2 HAVING count(*) = 4)"""


def _held_sql(body: str) -> str:
    return with_parts("ord team wx", body, extra=_HELD)


@query("s4_complete_partitions", _held_sql("SELECT dn AS driver_number, pos AS position FROM ord JOIN complete USING (year, round_number)"))
def s4(spark, sf):
    """Results of the partitions that have all four core tables."""
    df = _landed_races(spark, sf)["session_results"]
    return cells(df, {"driver_number": "DriverNumber", "position": "Position"})


@query(
    "s4b_incomplete_partitions",
    _held_sql(
        f"""SELECT year, round_number AS round, array_to_string(list_filter({ALL_TABLES!r}, lambda x: NOT list_contains(h, x)), ',') AS missing
FROM (SELECT year, round_number, list(t) AS h FROM held GROUP BY 1, 2) WHERE len(h) < 5"""
    ),
)
def s4b(spark, sf):
    """Partitions that lack one of the five tables, from the manifests."""
    df = tables.missing_in(_manifest(spark, sf, ALL_TABLES), ALL_TABLES)
    return tidy(df.select("year", "round", F.array_join("missing", ",").alias("missing")))


@query(
    "s5_empty_input",
    _held_sql(
        """SELECT y AS year, count(o.dn) AS n, CASE WHEN count(c.year) = 0 THEN 'no complete race-session partitions' ELSE 'ok' END AS status
FROM (SELECT unnest([1990, 1996, 2001, 2030]) AS y) LEFT JOIN complete c ON c.year = y LEFT JOIN ord o ON o.year = c.year AND o.round_number = c.round_number
GROUP BY y"""
    ),
)
def s5(spark, sf):
    """Rows of single seasons; a season without partitions is an error."""
    out = []
    for year in (1990, 1996, 2001, 2030):
        try:
            n, status = _landed_races(spark, sf, years=[year])["session_results"].count(), "ok"
        except FileNotFoundError as e:
            n, status = 0, str(e).split(" under ")[0]
        out.append((year, n, status))
    return spark.createDataFrame(out, "year long, n long, status string")


@query(
    "s6_audit_scan",
    with_parts(
        "ord team wx",
        f"""SELECT 'session_info' AS "table", (SELECT count(DISTINCT year * 100 + round_number) FROM ord) AS n
UNION ALL SELECT 'driver_info', (SELECT count(*) FROM ord JOIN team ON c_custkey = o_custkey)
UNION ALL SELECT 'session_results', (SELECT count(*) FROM ord)
UNION ALL SELECT 'laps', (SELECT count(*) FROM ord JOIN lineitem ON l_orderkey = dn WHERE round_number <= {st.LAP_ROUNDS})
UNION ALL SELECT 'weather', (SELECT count(*) FROM wx0 WHERE session_type = 'R')""",
    ),
)
def s6(spark, sf):
    """Rows of all five tables, complete or not."""
    found = _landed_races(spark, sf, ALL_TABLES, complete=False)
    counts = [df.agg(F.lit(t).alias("table"), F.count("*").alias("n")) for t, df in found.items()]
    return reduce(DataFrame.unionByName, counts)


@query(
    "s7_skipped_sessions",
    with_parts(
        "ord wx",
        """SELECT g.year, g.round_number, g.session_type FROM (
  SELECT * FROM (SELECT DISTINCT year, round_number FROM ord)
  CROSS JOIN (SELECT unnest(['FP1', 'FP2', 'FP3', 'Q', 'SQ', 'S', 'R']) AS session_type)) g
WHERE NOT EXISTS (SELECT 1 FROM wx0 w WHERE w.year = g.year AND w.round_number = g.round_number AND w.session_type = g.session_type)""",
    ),
)
def s7(spark, sf):
    """Scheduled sessions without any landed weather reading."""
    schedule = st.session_results(spark, sf).select("year", "round_number")
    return tidy(tables.skipped_sessions(schedule, st.weather(spark, sf, session=None)))


@query(
    "s8_load_mode",
    with_parts(
        "ord team",
        f"""SELECT 'session_info' AS "table", (SELECT count(DISTINCT year * 100 + round_number) FROM ord) AS n
UNION ALL SELECT 'driver_info', (SELECT count(*) FROM ord JOIN team ON c_custkey = o_custkey)
UNION ALL SELECT 'session_results', (SELECT count(*) FROM orders)
UNION ALL SELECT 'laps', (SELECT count(*) FROM ord JOIN lineitem ON l_orderkey = dn WHERE round_number <= {st.LAP_ROUNDS})
UNION ALL SELECT 'weather', (SELECT count(*) FROM events)""",
    ),
)
def s8(spark, sf):
    """Rows of every table that a load mode asks for."""
    counts = [_scan(spark, sf, t, session=None).agg(F.lit(t).alias("table"), F.count("*").alias("n")) for t in tables.tables_for_mode("viz")]
    return reduce(DataFrame.unionByName, counts)


@query(
    "s9_hive_sink",
    with_parts("ord", "SELECT year, CAST(round_number AS BIGINT) AS round, 'R' AS session, round_number, 'R' AS session_type, dn AS driver_number, pos AS position FROM ord"),
)
def s9(spark, sf):
    """Write once more over the first write: partitions are replaced, not added."""
    root = scratch_path(spark, "sink")
    df = st.session_results(spark, sf)
    sinks.write_table(df, root, "session_results")
    sinks.write_table(df.where(F.col("year") == 2001), root, "session_results")
    out = tables.read_table(spark, root, "session_results", schema=st.landed_schemas(spark, sf)["session_results"])
    return cells(out, {"year": "year", "round": "round", "session": "session", "round_number": "round_number", "session_type": "session_type", "driver_number": "DriverNumber", "position": "Position"})


@query("s10_feature_sink", with_parts("lagged", "SELECT dn AS driver_number, pos AS race_position, round(ewm, 6) AS ewm FROM lagged"))
def s10(spark, sf):
    table = st.whole_race_table(spark, sf)
    path = sinks.write_seasons(table, scratch_path(spark, "features"))
    return cells(sinks.read_seasons(spark, path, table.schema), {"driver_number": "DriverNumber", "race_position": TARGET, "ewm": "DriverFinish_ewm"})


@query(
    "s11_preprocessor_store",
    with_parts("codes", """SELECT 'TeamName' AS "column", cls AS class, code FROM team_codes UNION ALL SELECT 'Meeting.Circuit.ShortName', cls, code FROM circuit_codes"""),
)
def s11(spark, sf):
    _, fitted = st.matrix(spark, sf)
    path = scratch_path(spark, "params")
    fitted.write(path)
    return tidy(Preprocessors.read(spark, path).encoders)


@query("s12_parquet_source", "SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem")
def s12(spark, sf):
    return tidy(sinks.read_parquet(spark, f"{sf}/lineitem.parquet").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys")))


_REPORT = "SELECT CAST(year AS VARCHAR) AS model, round(avg(abs(grid - pos)), 6) AS mae FROM ord WHERE grid IS NOT NULL AND pos IS NOT NULL GROUP BY 1"


def _report(spark, sf):
    r = st.session_results(spark, sf)
    return tidy(r.groupBy(F.col("year").cast("string").alias("model")).agg(F.avg(F.abs(F.col("GridPosition") - F.col("Position"))).alias("mae")))


@query("s13_csv_report", with_parts("ord", _REPORT))
def s13(spark, sf):
    path = sinks.write_csv(_report(spark, sf), scratch_path(spark, "report"))
    return sinks.read_csv(spark, path, "model string, mae double")


@query("s14_json_report", with_parts("ord", _REPORT))
def s14(spark, sf):
    path = sinks.write_json(_report(spark, sf), scratch_path(spark, "best"))
    return sinks.read_json(spark, path, "model string, mae double")


@query("s16_latest_complete_round", _held_sql("SELECT max(year) AS year, max_by(round_number, year * 100 + round_number) AS round FROM complete"))
def s16(spark, sf):
    return tidy(tables.latest_complete(_manifest(spark, sf, CORE_TABLES), CORE_TABLES))


@query(
    "s17_ingestion_status",
    """SELECT 'laps' AS "table", (SELECT count(*) FROM lineitem) AS rows, 0 AS rejected_sessions, 'ok' AS status
UNION ALL SELECT 'weather', NULL, NULL, 'error'""",
)
def s17(spark, sf):
    """One good and one missing table: the second fails, the first is written."""
    landing = scratch_path(spark, "landing")
    sinks.write_parquet(_raw_laps(spark, sf), f"{landing}/laps")
    status = run_ingestion(spark, landing, scratch_path(spark, "clean"), active=["laps", "weather"])
    return tidy(status.drop("error"))


@query(
    "s18_module_switch",
    """SELECT 'data' AS module, (SELECT count(*) FROM lineitem) AS clean_laps, 'ok' AS outcome
UNION ALL SELECT 'fe', NULL, 'FileNotFoundError' UNION ALL SELECT 'all', (SELECT count(*) FROM lineitem), 'FileNotFoundError'
UNION ALL SELECT 'none', NULL, 'ValueError'""",
)
def s18(spark, sf):
    """What each module runs when only laps were landed: features need every core table."""
    landing = scratch_path(spark, "landing")
    sinks.write_parquet(_raw_laps(spark, sf), f"{landing}/laps")
    out = []
    for module in ("data", "fe", "all", "none"):
        root, outcome = scratch_path(spark, "modules"), "ok"
        try:
            run_modules(spark, landing, root, module=module)
        except (FileNotFoundError, ValueError) as e:
            outcome = type(e).__name__
        held = tables.partition_manifest(spark, root, ["laps"], session=None).agg(F.sum("n")).scalar()
        out.append(spark.range(1).select(F.lit(module).alias("module"), held.alias("clean_laps"), F.lit(outcome).alias("outcome")))
    return reduce(DataFrame.unionByName, out)


# ---- cleaning ---------------------------------------------------------------


def _raw_laps(spark, sf):
    """Order lines in the raw shape of laps: numbers as text, durations in ns."""
    li = st._read(spark, sf, "lineitem")
    ns = F.rint(F.col("l_extendedprice") * F.lit(1e7)).cast("long")
    return li.select(
        F.col("l_linenumber").cast("string").alias("DriverNumber"),
        F.col("l_orderkey").alias("__order"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".0")).alias("LapNumber"),
        F.when(F.col("l_returnflag") == "R", "x").otherwise(F.col("l_linenumber").cast("string")).alias("Stint"),
        ns.alias("LapTime"),
        F.when(F.col("l_returnflag") != "A", ns).alias("PitInTime"),
        F.col("l_extendedprice").alias("SpeedST"),
        F.col("l_returnflag").alias("Compound"),
        F.col("l_quantity").alias("TyreLife"),
        F.when(F.col("l_linestatus") == "O", "true").otherwise("false").alias("FreshTyre"),
        F.col("l_linestatus").alias("TrackStatus"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("LapStartDate"),
        F.col("l_quantity").cast("string").alias("Position"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("round_number"),
        F.lit("R").alias("session_type"),
    )


def _clean_laps(spark, sf):
    return cleaning.registry.get("laps").clean(_raw_laps(spark, sf))


@query(
    "p1_json_flatten",
    """SELECT event_id, event_type AS meeting_name, CAST(user_id AS VARCHAR) AS country, CASE WHEN event_type <> 'view' THEN 'Circuit' || CAST(user_id % 10 AS VARCHAR) END AS circuit,
  'Race' AS type FROM events""",
)
def p1(spark, sf):
    e = st._read(spark, sf, "events")
    circuit = F.when(F.col("event_type") != "view", F.concat(F.lit("Circuit"), (F.col("user_id") % 10).cast("string")))
    meeting = F.struct(
        F.col("event_type").alias("Name"),
        F.struct(F.col("user_id").cast("string").alias("Name")).alias("Country"),
        F.struct(circuit.alias("ShortName")).alias("Circuit"),
    )
    raw = e.select("event_id", F.to_json(F.struct(meeting.alias("Meeting"), F.lit("Race").alias("Type"))).alias("session_info"))
    out = cleaning.flatten(raw, "session_info")
    return cells(out, {"event_id": "event_id", "meeting_name": "Meeting.Name", "country": "Meeting.Country.Name", "circuit": CIRCUIT, "type": "Type"})


@query(
    "p2_explode_records",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS driver_id, o_orderpriority AS team FROM orders
UNION ALL SELECT o_orderkey, CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders""",
)
def p2(spark, sf):
    o = st._read(spark, sf, "orders")
    records = F.array(
        F.struct(F.col("o_custkey").cast("string").alias("DriverId"), F.col("o_orderpriority").alias("TeamName")),
        F.struct(F.col("o_orderkey").cast("string").alias("DriverId"), F.col("o_orderstatus").alias("TeamName")),
    )
    out = cleaning.explode_records(o.select("o_orderkey", F.to_json(records).alias("drivers")), "drivers")
    return cells(out, {"o_orderkey": "o_orderkey", "driver_id": "DriverId", "team": "TeamName"})


@query(
    "p3_tolerant_projection",
    "SELECT CAST(l_linenumber AS BIGINT) AS driver_number, l_returnflag AS compound, CAST(NULL AS DOUBLE) AS sector1, CAST(NULL AS DOUBLE) AS speed_fl, CAST(NULL AS VARCHAR) AS team FROM lineitem",
)
def p3(spark, sf):
    """Optional columns that the raw table lacks come out as typed nulls."""
    return cells(_clean_laps(spark, sf), {"driver_number": "DriverNumber", "compound": "Compound", "sector1": "Sector1Time", "speed_fl": "SpeedFL", "team": "Team"})


@query(
    "p4_coercing_cast",
    """SELECT CAST(l_linenumber AS BIGINT) AS driver_number, CAST(l_quantity AS BIGINT) AS lap_number,
  CASE WHEN l_returnflag <> 'R' THEN CAST(l_linenumber AS BIGINT) END AS stint, l_quantity AS position FROM lineitem""",
)
def p4(spark, sf):
    return cells(_clean_laps(spark, sf), {"driver_number": "DriverNumber", "lap_number": "LapNumber", "stint": "Stint", "position": "Position"})


@query(
    "p4b_unfit_sessions",
    "SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS round_number FROM orders WHERE o_totalprice > 499000",
)
def p4b(spark, sf):
    """Sessions with a car number that does not fit the narrow integer."""
    o = st._read(spark, sf, "orders")
    raw = o.select(
        F.when(F.col("o_totalprice") > 499000, F.lit("300")).otherwise("44.0").alias("DriverNumber"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("round_number"),
        F.lit("R").alias("session_type"),
    )
    return tidy(cleaning.unfit_sessions(raw, "driver_info").drop("session_type"))


@query(
    "p5_duration_seconds",
    "SELECT l_orderkey AS order_key, round(l_extendedprice / 100e0, 6) AS lap_time, CASE WHEN l_returnflag <> 'A' THEN round(l_extendedprice / 100e0, 6) END AS pit_in FROM lineitem",
)
def p5(spark, sf):
    raw = _raw_laps(spark, sf)
    from ..functions.casts import clean_value

    out = raw.select(F.col("__order").alias("order_key"), clean_value(raw, "LapTime", "seconds").alias("lap_time"), clean_value(raw, "PitInTime", "seconds").alias("pit_in"))
    return tidy(out)


@query("p6_timestamp_parse", "SELECT l_returnflag AS compound, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS started, count(*) AS n FROM lineitem GROUP BY 1, 2")
def p6(spark, sf):
    df = _clean_laps(spark, sf).withColumn("started", F.date_format("LapStartDate", "yyyy-MM-dd HH:mm:ss"))
    return df.groupBy(F.col("Compound").alias("compound"), "started").agg(F.count("*").alias("n"))


@query(
    "p7_string_cast",
    with_parts("ord", "SELECT dn AS driver_number, CASE WHEN status = 'P' AND prio = 5 THEN 'R' ELSE CAST(CAST(ceil(price / 25000e0) AS BIGINT) AS VARCHAR) END AS classified FROM ord"),
)
def p7(spark, sf):
    from ..functions.casts import clean_value

    raw = st.session_results(spark, sf)
    return raw.select(F.col("DriverNumber").alias("driver_number"), clean_value(raw, "ClassifiedPosition", "text").alias("classified"))


@query("p8_boolean_cast", "SELECT l_linestatus AS track_status, l_linestatus = 'O' AS fresh_tyre, count(*) AS n FROM lineitem GROUP BY 1, 2")
def p8(spark, sf):
    df = _clean_laps(spark, sf)
    return df.groupBy(F.col("TrackStatus").alias("track_status"), F.col("FreshTyre").alias("fresh_tyre")).agg(F.count("*").alias("n"))


@query(
    "p9_partition_keys",
    "SELECT CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS round_number, 'R' AS session_type, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def p9(spark, sf):
    return tidy(_clean_laps(spark, sf).groupBy("year", "round_number", "session_type").agg(F.count("*").alias("n")))


@query("p10_rename_results", with_parts("ord", "SELECT dn AS driver_number, pos AS race_position, round(price / 100e0, 6) AS race_time FROM ord"))
def p10(spark, sf):
    return cells(prepare_results(st.session_results(spark, sf)), {"driver_number": "DriverNumber", "race_position": TARGET, "race_time": "RaceTime"})


@query("p11_drop_ambiguous", with_parts("ord team", "SELECT dn AS driver_number, raw_team AS team, c_name AS full_name FROM ord JOIN team ON o_custkey = c_custkey"))
def p11(spark, sf):
    """Team and name of the results give way to those of the driver table."""
    results = st.session_results(spark, sf).withColumns({"TeamName": F.lit("?"), "FullName": F.lit("?")})
    out = join_drivers(prepare_results(results), st.driver_info(spark, sf))
    return cells(out, {"driver_number": "DriverNumber", "team": "TeamName", "full_name": "FullName"})


@query("p13_ordered_projection", with_parts("lagged", "SELECT year, round_number, did AS driver_id, dn AS driver_number, grid, pos AS race_position FROM lagged"))
def p13(spark, sf):
    from ..plans.features import _project

    wide = st.race_table(spark, sf).withColumnRenamed("DriverFinish_lag1", "unused")
    out = _project(wide, [*ID_COLUMNS, *FINAL_FEATURES, TARGET])
    return cells(out, {"year": "year", "round_number": "round_number", "driver_id": "DriverId", "driver_number": "DriverNumber", "grid": "GridPosition", "race_position": TARGET})


@query("p14_drop_unplaced", with_parts("ord", "SELECT count(pos) AS kept, count(*) - count(pos) AS dropped FROM ord"))
def p14(spark, sf):
    df = st.session_results(spark, sf)
    kept = prep.drop_unplaced(df, "Position").agg(F.count("*").alias("kept"))
    return tidy(kept.withColumn("dropped", df.agg(F.count("*")).scalar() - F.col("kept")))


@query("p15_year_predicates", with_parts("ord", "SELECT year, count(*) AS n, year = 2001 AS is_test, year <= 1998 AS is_past FROM ord WHERE year <> 1995 GROUP BY year"))
def p15(spark, sf):
    y = F.col("year")
    df = st.session_results(spark, sf).where(y != 1995).groupBy("year").agg(F.count("*").alias("n"))
    return tidy(df.withColumns({"is_test": y == 2001, "is_past": y <= 1998}))


@query("p16_year_list", with_parts("ord", "SELECT year, count(*) AS n FROM ord WHERE year IN (1995, 1997, 1998, 1999) GROUP BY year"))
def p16(spark, sf):
    years = tables.parse_years(["1997-1999", "1995", "1998"])
    df = _scan(spark, sf, "session_results", years=years)
    return tidy(df.groupBy("year").agg(F.count("*").alias("n")))


@query("p18_complete_rows", with_parts("lagged", "SELECT dn AS driver_number, grid, lag1, round(lapstd1, 6) AS lap_std FROM lagged WHERE grid IS NOT NULL AND lag1 IS NOT NULL AND lapstd1 IS NOT NULL"))
def p18(spark, sf):
    out = st.race_table(spark, sf).dropna(subset=["GridPosition", "DriverFinish_lag1", "LapStd_lag1"])
    return cells(out, {"driver_number": "DriverNumber", "grid": "GridPosition", "lag1": "DriverFinish_lag1", "lap_std": "LapStd_lag1"})


_STREET = ", ".join(f"'{s}'" for s in st.STREET)


@query("p19_membership_flag", with_parts("frame", f"SELECT circuit, CASE WHEN circuit IN ({_STREET}) THEN 'Street' ELSE 'Permanent' END AS circuit_type, count(*) AS n FROM frame GROUP BY 1, 2"))
def p19(spark, sf):
    df = st.race_table(spark, sf)
    flag = membership_flag(F.col(f"`{CIRCUIT}`"), st.STREET, "Street", "Permanent")
    return df.groupBy(F.col(f"`{CIRCUIT}`").alias("circuit"), flag.alias("circuit_type")).agg(F.count("*").alias("n"))


@query(
    "p20_threshold_flags",
    with_parts("ord wx", """SELECT year, round_number, CASE WHEN "RainRisk" > 0e0 THEN 'Rain' ELSE 'Dry' END AS rain_gt_0, CASE WHEN "RainRisk" > 0.2e0 THEN 'Rain' ELSE 'Dry' END AS rain_gt_02
FROM (SELECT DISTINCT year, round_number FROM ord) LEFT JOIN wx USING (year, round_number)"""),
)
def p20(spark, sf):
    from ..operators.frame import weather_summary

    s = st.session_info(spark, sf).join(weather_summary(st.weather(spark, sf)), ["year", "round_number", "session_type"], "left")
    risk = F.col("RainRisk")
    return tidy(s.select("year", "round_number", threshold_flag(risk, 0.0).alias("rain_gt_0"), threshold_flag(risk, 0.2).alias("rain_gt_02")))


@query(
    "p20b_experience_flag",
    with_parts("ord", "SELECT DISTINCT did AS driver_id FROM (SELECT did, year, row_number() OVER (PARTITION BY did ORDER BY year, round_number, dn) - 1 AS prior FROM ord) WHERE year = 2001 AND prior < 10"),
)
def p20b(spark, sf):
    from ..functions.scalars import experience_flag
    from ..operators.segments import flagged_entities, prior_races

    starts = join_drivers(prepare_results(st.session_results(spark, sf)), st.driver_info(spark, sf))
    df = prior_races(starts).where(F.col("year") == 2001)
    out = flagged_entities(df.withColumn("experience", experience_flag(F.col("prior_races"), 10)), "experience", "Rookie")
    return out.withColumnRenamed("DriverId", "driver_id")


@query(
    "p21_position_tier",
    with_parts("ord", """SELECT CASE WHEN pos <= 3 THEN 'Podium (1-3)' WHEN pos <= 10 THEN 'Points (4-10)' WHEN pos <= 15 THEN 'Midfield (11-15)' ELSE 'Back (16-20)' END AS tier, count(*) AS n FROM ord GROUP BY 1"""),
)
def p21(spark, sf):
    return st.session_results(spark, sf).groupBy(position_tier(F.col("Position")).alias("tier")).agg(F.count("*").alias("n"))


@query(
    "p22_numeric_columns",
    with_parts("ord", """SELECT 'DriverNumber' AS "column", count(*) AS n FROM ord UNION ALL SELECT 'GridPosition', count(grid) FROM ord UNION ALL SELECT 'Position', count(pos) FROM ord
UNION ALL SELECT 'Time', count(*) FROM ord UNION ALL SELECT 'Points', count(*) FROM ord"""),
)
def p22(spark, sf):
    df = st.session_results(spark, sf)
    wanted = audit.numeric_columns(df)
    row = df.agg(*[F.count(c).alias(c) for c in wanted])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in wanted])
    return row.select(F.explode(pairs).alias("v")).select("v.*")


@query(
    "p23_null_validation",
    with_parts(
        "lagged",
        """SELECT "column", nulls, CASE WHEN nulls = 0 THEN 'OK' ELSE 'WARNING: ' || CAST(nulls AS VARCHAR) || ' nulls' END AS status FROM (
  SELECT 'round_number' AS "column", count(*) - count(round_number) AS nulls FROM lagged UNION ALL
  SELECT 'GridPosition', count(*) - count(grid) FROM lagged UNION ALL
  SELECT 'LapStd_lag1', count(*) - count(lapstd1) FROM lagged)""",
    ),
)
def p23(spark, sf):
    return tidy(prep.null_report(st.race_table(spark, sf), ["round_number", "GridPosition", "LapStd_lag1"]))


_REGISTRY_SQL = ", ".join(f"('{c}', '{d}')" for c, _, _, d in LEAKAGE_REGISTRY)


@query(
    "p23b_leakage_registry",
    f"""SELECT c AS "column", d AS disposition, n FROM (VALUES {_REGISTRY_SQL}) v(c, d) CROSS JOIN (SELECT count(*) AS n FROM orders)
WHERE c IN ('GridPosition', 'RacePosition', 'RaceTime', 'ClassifiedPosition', 'Status', 'Points', 'LapTime_std', 'TeamName', 'round_number',
  'Meeting.Circuit.ShortName', 'DriverFinish_lag1', 'DriverFinish_ewm', 'DriverFinish_roll3_inseason', 'TeamFinish_ewm', 'TeamFinish_roll3_inseason', 'LapStd_lag1')""",
)
def p23b(spark, sf):
    """Disposition of each column of the race table; the model columns pass the check."""
    audit.check_registry(FINAL_FEATURES)
    df = st.whole_race_table(spark, sf)
    known = [(c, d) for c, _, _, d in LEAKAGE_REGISTRY if c in df.columns]
    out = spark.createDataFrame(known, "`column` string, disposition string")
    return out.withColumn("n", df.agg(F.count("*")).scalar())


@query("p24_table_registry", "SELECT CAST(year(l_shipdate) AS BIGINT) AS year, count(*) AS n, round(avg(l_extendedprice / 100e0), 4) AS lap_time FROM lineitem GROUP BY 1")
def p24(spark, sf):
    """A table type added by registering it."""
    own = cleaning.TableRegistry()
    own.register("laps", cleaning.TableSpec("laps", lambda d: d.drop("Compound")))
    out = own.get("laps").clean(_raw_laps(spark, sf)).groupBy("year")
    return tidy(out.agg(F.count("*").alias("n"), F.avg("LapTime").alias("lap_time")), 4)


# ---- sorts, limits, top-k ---------------------------------------------------


@query("o1_entity_order", with_parts("ord", "SELECT did AS driver_id, year, round_number, dn AS driver_number FROM ord"))
def o1(spark, sf):
    df = join_drivers(st.session_results(spark, sf), st.driver_info(spark, sf))
    return cells(df.orderBy("DriverId", "year", "round_number", "DriverNumber"), {"driver_id": "DriverId", "year": "year", "round_number": "round_number", "driver_number": "DriverNumber"})


@query("o2_report_sort", with_parts("wx", 'SELECT year, round_number, round("RainRisk", 6) AS rain_risk FROM wx'))
def o2(spark, sf):
    from ..operators.frame import weather_summary

    out = weather_summary(st.weather(spark, sf)).orderBy(F.desc("RainRisk"), "year", "round_number")
    return cells(out, {"year": "year", "round_number": "round_number", "rain_risk": "RainRisk"})


@query("o3_predicted_winner", with_parts("ord", "SELECT year, round_number, dn AS winner FROM (SELECT *, row_number() OVER (PARTITION BY year, round_number ORDER BY price, dn) AS r FROM ord) WHERE r = 1"))
def o3(spark, sf):
    """Best score of every race, combined on the map side."""
    df = st.session_results(spark, sf)
    return tidy(df.groupBy("year", "round_number").agg(F.min_by("DriverNumber", F.struct("Time", "DriverNumber")).alias("winner")))


@query("o4_top_features", with_parts("lagged", """SELECT feature, round(v, 6) AS mean_abs FROM (SELECT 'lag1' AS feature, avg(abs(lag1)) AS v FROM lagged UNION ALL SELECT 'ewm', avg(abs(ewm)) FROM lagged
UNION ALL SELECT 'lapstd', avg(abs(lapstd1)) FROM lagged UNION ALL SELECT 'grid', avg(abs(grid)) FROM lagged) ORDER BY v DESC LIMIT 3"""))
def o4(spark, sf):
    from ..operators.explain import mean_attribution

    names = {"lag1": "DriverFinish_lag1", "ewm": "DriverFinish_ewm", "lapstd": "LapStd_lag1", "grid": "GridPosition"}
    df = st.race_table(spark, sf).select(*[F.col(c).alias(n) for n, c in names.items()])
    return tidy(mean_attribution(df, list(names)).limit(3))


@query(
    "o5_best_worst_row",
    with_parts(
        "ord",
        """(SELECT 'best' AS kind, abs(grid - pos) AS abs_error, dn AS driver_number FROM ord WHERE grid IS NOT NULL AND pos IS NOT NULL ORDER BY 2, 3 LIMIT 1)
UNION ALL (SELECT 'worst', abs(grid - pos), dn FROM ord WHERE grid IS NOT NULL AND pos IS NOT NULL ORDER BY 2 DESC, 3 DESC LIMIT 1)""",
    ),
)
def o5(spark, sf):
    from ..operators.metrics import best_and_worst, with_errors

    df = with_errors(st.session_results(spark, sf).dropna(subset=["GridPosition", "Position"]), "Position", "GridPosition")
    return cells(best_and_worst(df, "abs_error", ["DriverNumber"]), {"kind": "kind", "abs_error": "abs_error", "driver_number": "DriverNumber"})


@query("o6_latest_round", with_parts("ord", "SELECT max(year) AS year, max_by(round_number, year * 100 + round_number) AS round_number FROM ord"))
def o6(spark, sf):
    out = st.session_results(spark, sf).agg(F.max(F.struct("year", "round_number")).alias("m"))
    return tidy(out.select("m.year", "m.round_number"))


@query(
    "o7_fixed_category_order",
    with_parts(
        "ord",
        """SELECT v.g AS "group", v.p AS position, n FROM (VALUES ('Podium (1-3)', 0), ('Points (4-10)', 1), ('Unclassified', 2), ('Back (16-20)', 3)) v(g, p)
LEFT JOIN (SELECT CASE WHEN pos <= 3 THEN 'Podium (1-3)' WHEN pos <= 10 THEN 'Points (4-10)' WHEN pos <= 15 THEN 'Midfield (11-15)' ELSE 'Back (16-20)' END AS tier, count(*) AS n FROM ord GROUP BY 1) t ON t.tier = v.g""",
    ),
)
def o7(spark, sf):
    """Absent labels give an empty row, labels not asked for are left out."""
    from ..operators.segments import in_fixed_order

    counts = st.session_results(spark, sf).groupBy(position_tier(F.col("Position")).alias("group")).agg(F.count("*").alias("n"))
    return tidy(in_fixed_order(counts, ["Podium (1-3)", "Points (4-10)", "Unclassified", "Back (16-20)"]))


@query("o8_head", with_parts("ord", "SELECT dn AS driver_number, year, round_number FROM ord ORDER BY dn LIMIT 20"))
def o8(spark, sf):
    out = st.session_results(spark, sf).orderBy("DriverNumber").limit(20)
    return cells(out, {"driver_number": "DriverNumber", "year": "year", "round_number": "round_number"})


# ---- set operations ---------------------------------------------------------


@query(
    "u1_union_tolerant",
    with_parts("ord", "SELECT dn AS driver_number, CASE WHEN year >= 1998 THEN grid END AS grid FROM ord"),
)
def u1(spark, sf):
    """Early seasons lack the grid column."""
    df = st.session_results(spark, sf)
    early = df.where("year < 1998").drop("GridPosition")
    return cells(df.where("year >= 1998").unionByName(early, allowMissingColumns=True), {"driver_number": "DriverNumber", "grid": "GridPosition"})


@query("u2_union_history", with_parts("ord", "SELECT year, count(*) AS n FROM ord WHERE pos IS NOT NULL GROUP BY 1"))
def u2(spark, sf):
    from .features import split_by_season

    train, test = split_by_season(st.matrix(spark, sf)[0], st.TEST_YEAR)
    return tidy(train.unionByName(test).groupBy("year").agg(F.count("*").alias("n")))


@query(
    "u3_union_labelled",
    with_parts("frame", "SELECT 'team' AS segment, team AS \"group\", count(*) AS n FROM frame GROUP BY 2 UNION ALL SELECT 'circuit', circuit, count(*) FROM frame GROUP BY 2"),
)
def u3(spark, sf):
    from ..operators.segments import union_labelled

    df = st.race_table(spark, sf)
    parts = {n: df.groupBy(F.col(f"`{c}`").alias("group")).agg(F.count("*").alias("n")) for n, c in (("team", "TeamName"), ("circuit", CIRCUIT))}
    return union_labelled(parts)


@query("u5_year_overlap", with_parts("ord", "SELECT DISTINCT year FROM ord WHERE year <= 1998 INTERSECT SELECT DISTINCT year FROM ord WHERE year >= 1997"))
def u5(spark, sf):
    df, _ = st.matrix(spark, sf)
    audit.assert_no_overlap(df.where("year != 2001"), df.where("year = 2001"))
    return tidy(df.where("year <= 1998").select("year").intersect(df.where("year >= 1997").select("year")))


@query(
    "u6_feature_difference",
    with_parts("filled", """SELECT "column", round(avg(value), 6) AS mean FROM (SELECT 'grid' AS "column", grid AS value FROM filled UNION ALL SELECT 'lag1', lag1 FROM filled) GROUP BY 1"""),
)
def u6(spark, sf):
    """Features minus categorical ones; two of them back on their own scale."""
    from ..operators.prep import unscale
    from ..schemas import CATEGORICAL_FEATURES

    df, fitted = st.matrix(spark, sf)
    numeric = [c for c in FINAL_FEATURES if c not in CATEGORICAL_FEATURES]
    row = unscale(df, fitted.numeric, numeric).agg(*[F.avg(c).alias(c) for c in numeric])
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(c).alias("mean")) for n, c in (("grid", "GridPosition"), ("lag1", "DriverFinish_lag1"))])
    return tidy(row.select(F.explode(pairs).alias("v")).select("v.*"))
