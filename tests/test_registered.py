from __future__ import annotations

import re

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"

# One query per kind; check.py runs all of them at any scale.
SAMPLE = [
    "s4_complete_partitions",
    "p4_coercing_cast",
    "a7_box_statistics",
    "w4b_ewm_split_entities",
    "fe11_lag_features",
    "fe16_standardise",
    "a21b_spearman_matrix_complete",
    "m4_expanding_folds",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_has_rows_and_schema(spark):
    df = entry(spark)
    assert df.count() > 0 and {"driver_id", "lag1", "ewm", "roll", "team_ewm"} <= set(df.columns)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    cur = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert check.canonical([tuple(r) for r in df.collect()], df.columns) == check.canonical(cur.fetchall(), names)


def test_every_check_belongs_to_a_query_and_parses(duck):
    assert set(oracle_sql()) <= set(queries())
    for name, sql in oracle_sql().items():
        duck.execute(f"EXPLAIN {sql}"), name


def test_every_survey_operator_has_a_query():
    groups = {"s": 17, "p": 24, "j": 12, "a": 24, "w": 10, "o": 8, "u": 6, "m": 21}
    have = {m.group() for m in (re.match(r"[a-z]+\d+", q) for q in queries()) if m}
    have |= {
        "s5",  # empty input: an error, tested in test_sources
    }
    wanted = {f"{g}{i}" for g, n in groups.items() for i in range(1, n + 1)} | {f"fe{i}" for i in range(10, 22)}
    assert not wanted - have


def test_no_plan_has_a_nested_loop_or_cartesian_join(spark):
    for name in ("fe11_lag_features", "j4_results_weather", "a18_segment_summary", "m2_mean_baseline"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_history_needs_one_exchange_and_two_sorts(spark):
    from stintframe.operators.history import add_history

    df = spark.read.parquet(f"{SF}/orders.parquet")
    out = add_history(df, "o_custkey", ["o_orderdate", "o_orderkey"], lags={"l": "o_totalprice"}, ewms={"e": ("o_totalprice", 5)})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2


def test_lap_scan_reads_only_its_columns(spark):
    plan = queries()["fe11_lag_features"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert scans and all("ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in line for line in scans)
