from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stintframe.session import local_session  # noqa: E402

POSITIONS = {"ham": [1.0, 2.0, 3.0], "ver": [4.0, 5.0, 6.0]}
NUMBERS = {"ham": 44, "ver": 1}
TEAMS = {"ham": "Mercedes", "ver": "Red Bull Racing"}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    # Small test tables would otherwise end up in a single range chunk.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session


def race_rows():
    return [
        (y, r, "R", d, NUMBERS[d], TEAMS[d], POSITIONS[d][r - 1], 2.0 + 0.1 * r, float(r), f"Circuit{r}")
        for d in POSITIONS
        for y in (2024, 2025)
        for r in (1, 2, 3)
    ]


@pytest.fixture()
def race(spark):
    """12 starts of two drivers over two seasons."""
    return spark.createDataFrame(
        race_rows(),
        "year int, round_number tinyint, session_type string, DriverId string, DriverNumber bigint, TeamName string,"
        " RacePosition double, LapTime_std double, GridPosition double, `Meeting.Circuit.ShortName` string",
    )


@pytest.fixture(scope="session")
def clean_root(spark, tmp_path_factory):
    """Partitioned dataset: 6 sessions, 12 drivers, 12 results, 24 laps."""
    from stintframe.schemas import table_schema
    from stintframe.sources.sinks import write_table

    keys = [(y, r, "R") for y in (2024, 2025) for r in (1, 2, 3)]
    root = str(tmp_path_factory.mktemp("clean"))

    def build(table, rows):
        schema = table_schema(table)
        full = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
        write_table(spark.createDataFrame(full, schema), root, table)

    def base(y, r, s):
        return {"year": y, "round_number": r, "session_type": s}

    build("session_info", [{**base(*k), "Meeting.Circuit.ShortName": f"Circuit{k[1]}"} for k in keys])
    build(
        "driver_info",
        [{**base(*k), "DriverNumber": NUMBERS[d], "DriverId": d, "TeamName": TEAMS[d]} for k in keys for d in NUMBERS],
    )
    build(
        "session_results",
        [
            {**base(*k), "DriverNumber": NUMBERS[d], "Position": POSITIONS[d][k[1] - 1], "GridPosition": k[1] + (d == "ver") * 1.0}
            for k in keys
            for d in NUMBERS
        ],
    )
    build(
        "laps",
        [
            {**base(*k), "DriverNumber": NUMBERS[d], "LapTime": t, "PitInTime": p}
            for k in keys
            for d in NUMBERS
            for t, p in ((90.0, None), (91.0, 100.0))
        ],
    )
    return root


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
