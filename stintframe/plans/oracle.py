"""SQL fragments for the independent check of the stand-in queries."""

from __future__ import annotations

import re

_RENAMED = " ".join(f"WHEN 'NATION_{i}' THEN 'NATION_{i - 20}'" for i in range(20, 25))

PARTS = {
    "ord": """ord AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS round_number,
         o_orderkey AS dn, CAST(o_custkey AS VARCHAR) AS did, o_custkey, o_orderstatus AS status,
         o_totalprice AS price, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio,
         CASE WHEN NOT (o_orderstatus = 'P' AND substr(o_orderpriority, 1, 1) = '5')
              THEN ceil(o_totalprice / 25000e0) END AS pos,
         CASE WHEN NOT (o_orderstatus = 'O' AND substr(o_orderpriority, 1, 1) = '4')
              THEN ceil(0.75e0 * o_totalprice / 25000e0 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) END AS grid
  FROM orders)""",
    "team": f"""team AS (
  SELECT c_custkey, c_name, n_name AS raw_team, CASE n_name {_RENAMED} ELSE n_name END AS team
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "lap": """lap AS (
  SELECT l_orderkey, avg(l_quantity + 60e0) AS lapmean, stddev_samp(l_quantity + 60e0) AS lapstd,
         count(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS pits
  FROM lineitem GROUP BY l_orderkey)""",
    "wx": """wx0 AS (
  SELECT 1995 + hour(ts) % 7 AS year, 1 + (day(ts) - 1) % 11 AS round_number,
         CASE WHEN event_type = 'signup' THEN 'FP1' ELSE 'R' END AS session_type,
         value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, event_type = 'error' AS rain
  FROM events),
wx AS (
  SELECT CAST(year AS BIGINT) AS year, CAST(round_number AS BIGINT) AS round_number,
         avg(CAST(rain AS DOUBLE)) AS "RainRisk", avg(value * 1.5e0) AS "TrackTemp", avg(k) AS "Humidity",
         avg(1000e0 + value / 10e0) AS "Pressure", avg(value) AS "AirTemp", avg(value / 7e0) AS "WindSpeed"
  FROM wx0 WHERE session_type = 'R' GROUP BY 1, 2)""",
    "frame": """frame AS (
  SELECT o.*, t.team, t.raw_team, t.c_name, n.n_name AS circuit, l.lapstd, l.lapmean, l.pits
  FROM ord o LEFT JOIN team t ON o.o_custkey = t.c_custkey
  LEFT JOIN lap l ON l.l_orderkey = o.dn
  LEFT JOIN nation n ON n.n_nationkey = (o.round_number * 7 + o.year) % 25)""",
    "team_race": """team_race AS (
  SELECT team, year, round_number, avg(pos) AS tpos FROM frame WHERE team IS NOT NULL GROUP BY 1, 2, 3)""",
    "team_hist": """team_pos AS (
  SELECT *, row_number() OVER (PARTITION BY team ORDER BY year, round_number) AS rn FROM team_race),
team_hist AS (
  SELECT *, sum(tpos * pow(1.5e0, rn)) OVER h / sum(CASE WHEN tpos IS NOT NULL THEN pow(1.5e0, rn) END) OVER h AS team_ewm,
         avg(tpos) OVER s AS team_roll
  FROM team_pos
  WINDOW h AS (PARTITION BY team ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         s AS (PARTITION BY team, year ORDER BY rn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))""",
    "lagged": """dpos AS (
  SELECT *, row_number() OVER (PARTITION BY did ORDER BY year, round_number, dn) AS rn FROM frame),
dhist AS (
  SELECT *, lag(pos) OVER e AS lag1, lag(lapstd) OVER e AS lapstd1,
         sum(pos * pow(1.5e0, rn)) OVER h / sum(CASE WHEN pos IS NOT NULL THEN pow(1.5e0, rn) END) OVER h AS ewm,
         avg(pos) OVER s AS roll
  FROM dpos
  WINDOW e AS (PARTITION BY did ORDER BY rn),
         h AS (PARTITION BY did ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         s AS (PARTITION BY did, year ORDER BY rn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
lagged AS (
  SELECT d.*, t.team_ewm, t.team_roll
  FROM dhist d LEFT JOIN team_hist t ON d.team = t.team AND d.year = t.year AND d.round_number = t.round_number)""",
    "codes": """team_codes AS (
  SELECT team AS cls, row_number() OVER (ORDER BY team) - 1 AS code FROM (SELECT DISTINCT team FROM frame)),
circuit_codes AS (
  SELECT circuit AS cls, row_number() OVER (ORDER BY circuit) - 1 AS code FROM (SELECT DISTINCT circuit FROM frame))""",
    "placed": """placed AS (SELECT * FROM lagged WHERE pos IS NOT NULL)""",
    "med": """med AS (
  SELECT median(grid) AS grid, median(CAST(round_number AS DOUBLE)) AS round_number, median(lag1) AS lag1,
         median(ewm) AS ewm, median(team_ewm) AS team_ewm, median(roll) AS roll, median(team_roll) AS team_roll,
         median(lapstd1) AS lapstd1 FROM placed)""",
    "filled": """filled AS (
  SELECT p.year, p.round_number AS raw_round, p.did, p.dn, p.team, p.circuit, p.pos,
         coalesce(p.grid, m.grid) AS grid, CAST(p.round_number AS DOUBLE) AS round_number,
         coalesce(p.lag1, m.lag1) AS lag1, coalesce(p.ewm, m.ewm) AS ewm, coalesce(p.team_ewm, m.team_ewm) AS team_ewm,
         coalesce(p.roll, m.roll) AS roll, coalesce(p.team_roll, m.team_roll) AS team_roll,
         coalesce(p.lapstd1, m.lapstd1) AS lapstd1
  FROM placed p, med m)""",
}

# fragment -> fragments it needs
NEEDS = {
    "ord": [],
    "team": [],
    "lap": [],
    "wx": [],
    "frame": ["ord", "team", "lap"],
    "team_race": ["frame"],
    "team_hist": ["team_race"],
    "lagged": ["frame", "team_hist"],
    "codes": ["frame"],
    "placed": ["lagged"],
    "med": ["placed"],
    "filled": ["placed", "med"],
}

NUMERIC = {
    "GridPosition": "grid",
    "round_number": "round_number",
    "DriverFinish_lag1": "lag1",
    "DriverFinish_ewm": "ewm",
    "TeamFinish_ewm": "team_ewm",
    "DriverFinish_roll3_inseason": "roll",
    "TeamFinish_roll3_inseason": "team_roll",
    "LapStd_lag1": "lapstd1",
}


def with_parts(parts: str, body: str, extra: str = "") -> str:
    """``body`` behind the named fragments and everything they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS[name]:
            add(need)
        if name not in order:
            order.append(name)

    for name in parts.split():
        add(name)
    ctes = [PARTS[n] for n in order] + ([extra] if extra else [])
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body

_MASKED = ["frame", "team_race", "team_pos", "team_hist", "dpos", "dhist", "lagged"]


def masked_lagged(year: int, round_number: int) -> str:
    """The lag fragments again, over a frame whose target race has no outcome."""
    text = ",\n".join(PARTS[n] for n in ("team_race", "team_hist", "lagged"))
    for name in _MASKED:
        text = re.sub(rf"\b{name}\b", f"m_{name}", text)
    return f"""m_frame AS (
  SELECT * REPLACE (CASE WHEN NOT (year = {year} AND round_number = {round_number}) THEN pos END AS pos) FROM frame),
{text}"""


def melted(source: str, columns: dict[str, str] = NUMERIC, keys: str = "") -> str:
    """Long form of several columns: (keys, column, value)."""
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{name}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source}"
        for name, c in columns.items()
    )


def spearman_sql(source: str, x: str, y: str, by: str = "") -> str:
    """Rank correlation with average ties, as a sub-select (by, rho, n)."""
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {lead}CASE WHEN min(x) = max(x) THEN 0e0 ELSE corr(rx, ry) END AS rho, count(*) AS n FROM (
  SELECT {lead}x, rank() OVER ({part} ORDER BY x) + (count(*) OVER (PARTITION BY {lead}x) - 1) / 2e0 AS rx,
         rank() OVER ({part} ORDER BY y) + (count(*) OVER (PARTITION BY {lead}y) - 1) / 2e0 AS ry
  FROM (SELECT {lead}CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source}
        WHERE {x} IS NOT NULL AND {y} IS NOT NULL)) {group}"""
