from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stintframe.operators import ordering
from stintframe.operators.frame import add_lag_features, season_leaks, team_history, team_race_mean
from stintframe.operators.history import add_history, hot_entities
from stintframe.operators.ordering import (
    average_ranks,
    exact_quantiles,
    global_rank,
    range_chunks,
    running_before,
    sorted_codes,
)
from stintframe.operators.segments import prior_races

SCHEMA = "entity string, season int, seq int, x double"


def expected(pdf, span=5, window=3):
    """The same features by pandas, as an independent check."""
    pdf = pdf.sort_values(["entity", "season", "seq"]).reset_index(drop=True)
    by = pdf.groupby("entity")["x"]
    pdf["lag"] = by.shift(1)
    pdf["ewm"] = by.transform(lambda v: v.shift(1).ewm(span=span, min_periods=1).mean())
    season = pdf.groupby(["entity", "season"])["x"]
    pdf["roll"] = season.transform(lambda v: v.shift(1).rolling(window, min_periods=1).mean())
    pdf["prior"] = pdf.groupby("entity").cumcount().astype(float)
    pdf.loc[pdf["entity"].isna(), "prior"] = np.nan
    return pdf


def computed(spark, pdf, span=5, window=3, **options):
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).to_numpy()], SCHEMA)
    out = add_history(df, "entity", ["season", "seq"], lags={"lag": "x"}, rolls={"roll": ("x", window)}, ewms={"ewm": ("x", span)}, prior="prior", **options)
    return out.toPandas().sort_values(["entity", "season", "seq"]).reset_index(drop=True)


def assert_same(spark, pdf, span=5, window=3, **options):
    want, got = expected(pdf, span, window), computed(spark, pdf, span, window, **options)
    for c in ("lag", "ewm", "roll", "prior"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-12, atol=1e-12, err_msg=c)


def history(n, entity="a", nulls=0.2, seed=0, season_rows=24):
    rng = np.random.default_rng(seed)
    x = rng.integers(1, 21, n).astype(float)
    x[rng.random(n) < nulls] = np.nan
    return pd.DataFrame({"entity": entity, "season": 2000 + np.arange(n) // season_rows, "seq": np.arange(n), "x": x})


@pytest.mark.parametrize("span", [1, 2, 3, 5, 8, 10, 50])
def test_matches_pandas_for_every_span(spark, span):
    pdf = pd.concat([history(300, "a", seed=1), history(40, "b", seed=2), history(1, "c", 0, seed=3)])
    assert_same(spark, pdf, span=span, window=span)


def test_long_history_with_a_long_null_gap(spark):
    pdf = history(3000, season_rows=100)
    pdf.loc[500:1900, "x"] = np.nan
    assert_same(spark, pdf)
    assert_same(spark, pdf, hot_rows=700)


@pytest.mark.parametrize("hot_rows", [5, 40, 1300])
def test_split_entities_give_the_same(spark, hot_rows):
    pdf = pd.concat([history(2600, "hot", seed=4), history(30, "cold", seed=5), history(1, "one", 0)])
    assert_same(spark, pdf, hot_rows=hot_rows)


def test_split_entity_with_an_all_null_start_and_gap(spark):
    pdf = history(4000, "hot", seed=6)
    pdf.loc[:100, "x"] = np.nan
    pdf.loc[900:3800, "x"] = np.nan
    assert_same(spark, pdf, span=3, hot_rows=10)


def test_rows_without_entity_get_nulls(spark):
    pdf = pd.concat([history(20, "a"), history(30, None)])
    got = computed(spark, pdf)
    missing = got[got["entity"].isna()]
    assert len(missing) == 30 and missing[["lag", "ewm", "roll", "prior"]].isna().all().all()
    assert_same(spark, pdf[pdf["entity"].notna()])


def test_hot_entities_ignores_nulls(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 9, "entity string")
    assert [r.entity for r in hot_entities(df, "entity", 3).collect()] == ["a"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(1, 20)), min_size=1, max_size=60),
    hot_rows=st.sampled_from([2, 7, 10**6]),
)
def test_any_history_matches_pandas(spark, values, hot_rows):
    pdf = pd.DataFrame({"entity": "a", "season": [2000 + i // 7 for i in range(len(values))], "seq": range(len(values)), "x": [np.nan if v is None else float(v) for v in values]})
    assert_same(spark, pdf, hot_rows=hot_rows)


def test_race_lag_values(spark, race):
    out = {(r.DriverId, r.year, r.round_number): r for r in add_lag_features(race).collect()}
    ham = [out[("ham", y, r)] for y in (2024, 2025) for r in (1, 2, 3)]
    assert [r.DriverFinish_lag1 for r in ham] == [None, 1.0, 2.0, 3.0, 1.0, 2.0]
    assert [r.DriverFinish_roll3_inseason for r in ham] == [None, 1.0, 1.5, None, 1.0, 1.5]
    assert [None if r.DriverFinish_ewm is None else round(r.DriverFinish_ewm, 6) for r in ham][:4] == [None, 1.0, 1.6, 2.263158]
    assert ham[0].LapStd_lag1 is None and ham[1].LapStd_lag1 == pytest.approx(2.1)
    assert ham[0].TeamFinish_ewm is None and ham[3].TeamFinish_ewm is not None
    assert ham[0].TeamFinish_roll3_inseason is None and ham[3].TeamFinish_roll3_inseason is None


def test_duplicate_first_round_fails_the_boundary_check(spark, race):
    twice = race.unionByName(race.where("DriverId = 'ham' and round_number = 1 and year = 2024").selectExpr("* except (DriverNumber)", "45L as DriverNumber"))
    with pytest.raises(Exception, match="season boundary leak"):
        add_lag_features(twice).collect()
    assert season_leaks(add_lag_features(twice, check_boundary=False)).count() == 1


def test_team_mate_does_not_leak(spark, race):
    one_team = race.replace({"Red Bull Racing": "Mercedes"}, subset=["TeamName"])
    out = {(r.year, r.round_number): r.TeamFinish_ewm for r in team_history(team_race_mean(one_team)).collect()}
    assert out[(2024, 1)] is None and out[(2024, 2)] == 2.5 and out[(2024, 3)] == pytest.approx((3.5 + 2.5 * 2 / 3) / (1 + 2 / 3))


def test_missed_round_keeps_its_frame_in_rows(spark, race):
    out = add_lag_features(race.where("not (DriverId = 'ham' and year = 2024 and round_number = 2)"))
    row = out.where("DriverId = 'ham' and year = 2024 and round_number = 3").first()
    assert row.DriverFinish_lag1 == 1.0 and row.DriverFinish_roll3_inseason == 1.0


def test_prior_races(spark, race):
    out = prior_races(race)
    assert [r[2] for r in rows(out.where("DriverId = 'ver'"), "year", "round_number", "prior_races")] == list(range(6))


# ---- ordering ---------------------------------------------------------------


def test_chunks_are_ordered_ranges(spark):
    out = range_chunks(spark.range(1000).selectExpr("pmod(hash(id), 500) as v"), ["v"])
    bounds = rows(out.groupBy("__chunk").agg(F.min("v").alias("lo"), F.max("v").alias("hi")), "__chunk", "lo", "hi")
    assert len(bounds) > 1 and all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))


def test_running_sums_over_chunks(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "id", "id % 7 as w")
    got = running_before(df, ["g"], ["id"], "w").toPandas().sort_values(["g", "id"])
    want = got.groupby("g")["w"].cumsum() - got["w"]
    assert (got["before"].to_numpy() == want.to_numpy()).all()
    assert (got["total"].to_numpy() == got.groupby("g")["w"].transform("sum").to_numpy()).all()


def test_quantiles_match_pandas_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 2000), "a": np.where(rng.random(2000) < 0.4, 7.0, rng.normal(size=2000)), "b": rng.integers(0, 9, 2000).astype(float)})
    pdf.loc[rng.random(2000) < 0.1, "b"] = np.nan
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).to_numpy()], "g int, a double, b double")
    out = exact_quantiles(df, ["a", "b"], {"q1": 0.25, "median": 0.5, "p99": 0.99}, ["g"])
    for r in out.collect():
        v = pdf[pdf["g"] == r.g][r["column"]]
        assert [r.q1, r.median, r.p99] == pytest.approx([v.quantile(0.25), v.median(), v.quantile(0.99)])
        assert r.n == v.notna().sum()


def skewed(seed, n=4000):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random(n) < 0.35, 7.0, rng.normal(size=n) * 50)
    b = np.where(rng.random(n) < 0.1, np.nan, rng.exponential(size=n))
    return pd.DataFrame({"g": rng.integers(0, 2, n), "a": a, "b": b, "none": np.nan})


def frame_of(spark, pdf):
    values = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).to_numpy()]
    return spark.createDataFrame(values, "g int, a double, b double, none double").repartition(5)


PROBS = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "highest": 1.0}


@pytest.mark.parametrize("group", [(), ("g",)])
def test_coarse_sketch_still_gives_exact_quantiles(spark, monkeypatch, group):
    monkeypatch.setattr(ordering, "SKETCH", 100)
    pdf = skewed(11)
    got = exact_quantiles(frame_of(spark, pdf), ["a", "b", "none"], PROBS, list(group)).collect()
    assert len(got) == (4 if group else 2)  # a column without values has no row
    for r in got:
        v = pdf[pdf["g"] == r.g][r["column"]] if group else pdf[r["column"]]
        assert r.n == v.notna().sum()
        assert [r[p] for p in PROBS] == pytest.approx([v.quantile(q) for q in PROBS.values()], rel=1e-12)


def test_only_values_near_a_quantile_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SKETCH", 100)
    counts = ordering.bracketed_counts(frame_of(spark, skewed(12)), ["b"], [0.5]).collect()
    singles = [r for r in counts if not r.run]
    assert len([r for r in counts if r.run]) == 2 and 0 < len(singles) < 400
    assert all(r.least == r.most == r["at"] for r in singles)
    assert sum(r.n for r in counts) == skewed(12)["b"].notna().sum()


def test_quantile_outside_its_bracket_is_found_among_all_values(spark, monkeypatch):
    right = ordering.quantile_brackets

    def wrong(df, columns, probs, group=()):
        return right(df, columns, [0.9 for _ in probs], group)

    monkeypatch.setattr(ordering, "quantile_brackets", wrong)
    pdf = skewed(13)
    for r in exact_quantiles(frame_of(spark, pdf), ["a", "b"], {"median": 0.5}).collect():
        assert r.median == pytest.approx(pdf[r["column"]].median(), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=12), p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_any_short_list_has_its_exact_quantile(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert exact_quantiles(df, ["v"], {"q": p}).first().q == pytest.approx(np.quantile(values, p))


def test_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert exact_quantiles(df, ["v"], {"m": 0.5}).count() == 0
    assert exact_quantiles(df, ["v"], {"m": 0.5}, ["g"]).count() == 0


def test_ranks_and_codes(spark):
    counts = spark.createDataFrame([(0, 1.0, 2), (0, 3.0, 1), (0, 2.0, 3)], "g int, v double, n long")
    assert rows(average_ranks(counts, ["g"], "v"), "v", "rank", "centred") == [(1.0, 1.5, -2.0), (2.0, 4.0, 0.5), (3.0, 6.0, 2.5)]
    df = spark.createDataFrame([("b",), ("A",), ("b",), ("a",), ("10",), ("9",)], "c string")
    assert [r["class"] for r in sorted(sorted_codes(df, ["c"]).collect(), key=lambda r: r["code"])] == sorted(["b", "A", "a", "10", "9"])
    ranked = global_rank(spark.range(50).selectExpr("-id as v"), ["v"])
    assert rows(ranked, "rank", "v") == [(i + 1, i - 49) for i in range(50)]
