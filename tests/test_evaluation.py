from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stintframe.functions import scalars
from stintframe.operators import audit, explain, metrics, models, search
from stintframe.operators.segments import flagged_entities, in_fixed_order, segment_summary, union_labelled

RNG = np.random.default_rng(11)


def frame(spark, pdf):
    return spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).to_numpy()], ", ".join(f"{c} {'string' if pdf[c].dtype == object else 'double'}" for c in pdf))


def pandas_spearman(x, y):
    return x.rank().corr(y.rank())


def f1_by_hand(actual, pred):
    guess = np.clip(np.round(pred), 1, 20).astype(int)
    truth = np.asarray(actual).astype(int)
    scores = []
    for c in set(truth) | set(guess):
        tp = ((truth == c) & (guess == c)).sum()
        scores.append(2 * tp / ((truth == c).sum() + (guess == c).sum()))
    return float(np.mean(scores))


@pytest.fixture(scope="module")
def scored(spark):
    pdf = pd.DataFrame({"g": np.where(np.arange(400) % 3 == 0, "a", "b"), "actual": RNG.integers(1, 21, 400).astype(float)})
    pdf["pred"] = np.round(pdf["actual"] * 0.5 + RNG.normal(5, 3, 400), 1)
    return pdf, frame(spark, pdf)


def test_metric_bundle_against_pandas(scored):
    pdf, df = scored
    got = {r.g: r for r in metrics.score(df, "actual", "pred", ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g].MAE == pytest.approx((part.pred - part.actual).abs().mean())
        assert got[g].Spearman_rho == pytest.approx(pandas_spearman(part.pred, part.actual))
        assert got[g].Macro_F1 == pytest.approx(f1_by_hand(part.actual, part.pred))


def test_spearman_constant_and_ties(spark):
    df = spark.createDataFrame([(1.0, 3.0, 1.0), (1.0, 1.0, 2.0), (1.0, 2.0, 2.0)], "k double, x double, y double")
    assert metrics.spearman(df, "k", "y").first()["Spearman_rho"] == 0.0
    assert metrics.spearman(df, "k", "y", safe=False).first()["Spearman_rho"] is None
    assert metrics.spearman(df, "x", "y").first()["Spearman_rho"] == pytest.approx(pandas_spearman(pd.Series([3.0, 1, 2]), pd.Series([1.0, 2, 2])))


def test_spearman_with_a_hot_value(spark):
    x = np.where(RNG.random(3000) < 0.5, 0.0, RNG.normal(size=3000))
    y = np.round(x + RNG.normal(size=3000), 2)
    df = frame(spark, pd.DataFrame({"x": x, "y": y}))
    assert metrics.spearman(df, "x", "y").first()["Spearman_rho"] == pytest.approx(pandas_spearman(pd.Series(x), pd.Series(y)))


def test_macro_f1_counts_classes_only_predicted(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 7.0), (2.0, 2.5), (2.0, 25.0)], "a double, p double")
    # classes 1, 2, 7, 20; 2.5 rounds to 2, 25 clips to 20
    assert metrics.macro_f1(df, "a", "p").first()[0] == pytest.approx((2 / 3 + 2 / 3 + 0 + 0) / 4)


@pytest.mark.parametrize("value,cls", [(2.5, 2), (3.5, 4), (0.2, 1), (-4.0, 1), (20.5, 20), (99.0, 20)])
def test_position_class(spark, value, cls):
    assert spark.range(1).select(scalars.position_class(F.lit(value))).first()[0] == cls


def test_tiers_flags_and_maps(spark):
    df = spark.createDataFrame([(3.0, 0.0), (10.0, 0.05), (15.0, 0.06), (16.0, None), (None, None)], "p double, rain double")
    got = [tuple(r) for r in df.select(scalars.position_tier(F.col("p")), scalars.threshold_flag(F.col("rain"), 0.05)).collect()]
    assert got == [("Podium (1-3)", "Dry"), ("Points (4-10)", "Dry"), ("Midfield (11-15)", "Rain"), ("Back (16-20)", "Dry"), ("Back (16-20)", "Dry")]
    prior = spark.createDataFrame([(21,), (22,), (None,)], "n int")
    assert [r[0] for r in prior.select(scalars.experience_flag(F.col("n"))).collect()] == ["Rookie", "Veteran", "Veteran"]


def test_p_values():
    # two-sided t test; values of the published t tables
    assert scalars.correlation_p_value(0.632, 10) == pytest.approx(0.05, abs=2e-4)
    assert scalars.correlation_p_value(0.765, 10) == pytest.approx(0.01, abs=2e-4)
    t, n = 1.9623, 1002
    assert scalars.correlation_p_value(t / math.sqrt(t * t + n - 2), n) == pytest.approx(0.05, abs=1e-4)
    assert scalars.correlation_p_value(0.0, 50) == pytest.approx(1.0)
    assert scalars.correlation_p_value(None, 50) is None and scalars.correlation_p_value(1.0, 50) == 0.0


def test_segments_in_one_pass(spark, scored):
    pdf, df = scored
    df = metrics.with_errors(df)
    out = segment_summary(df, {"g": "g", "tier": scalars.position_tier(F.col("actual"))})
    got = {(r.segment, r.group): r for r in out.collect()}
    part = pdf[pdf.g == "a"]
    assert got[("g", "a")].n == len(part)
    assert got[("g", "a")].MAE == pytest.approx(round((part.pred - part.actual).abs().mean(), 3), abs=1e-9)
    assert sum(r.n for (s, _), r in got.items() if s == "tier") == 400
    ordered = in_fixed_order(out.where("segment = 'tier'"), ["Back (16-20)", "Nobody", "Podium (1-3)"])
    assert [(r.group, r.n is None) for r in ordered.collect()] == [("Back (16-20)", False), ("Nobody", True), ("Podium (1-3)", False)]
    both = union_labelled({"x": df.select("g"), "y": df.select("pred")})
    assert both.count() == 800 and set(both.columns) == {"g", "pred", "segment"}


def test_flagged_entities(spark):
    df = spark.createDataFrame([("b", "Rookie"), ("a", "Rookie"), ("b", "Rookie"), ("c", "Veteran")], "DriverId string, e string")
    assert [r[0] for r in flagged_entities(df, "e", "Rookie").collect()] == ["a", "b"]


def test_baselines_and_comparison(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "y double")
    test = spark.createDataFrame([(5.0, 4.0)], "y double, GridPosition double")
    assert metrics.mean_baseline(train, test, "y").first()["prediction"] == 2.0
    assert metrics.grid_baseline(test).first()["prediction"] == 4.0
    table = spark.createDataFrame([("cv", 3.0, 0.5, 0.1), ("test", 2.5, 0.75, 0.2)], "dataset string, MAE double, Spearman_rho double, Macro_F1 double")
    assert tuple(metrics.metric_deltas(table, "cv", "test").first()) == pytest.approx((-0.5, 0.25, 0.1))
    best = metrics.best_and_worst(spark.createDataFrame([(1, 0.5), (2, 0.1), (3, 0.9)], "id int, e double"), "e", ["id"])
    assert rows(best, "kind", "id") == [("best", 2), ("worst", 3)]


# ---- audit ------------------------------------------------------------------


@pytest.fixture(scope="module")
def wide(spark):
    n = 500
    a = RNG.normal(size=n)
    pdf = pd.DataFrame({"a": a, "b": a + RNG.normal(scale=0.2, size=n), "c": RNG.normal(size=n), "y": np.round(a * 2 + RNG.normal(size=n))})
    pdf.loc[RNG.random(n) < 0.2, "c"] = np.nan
    return pdf, frame(spark, pdf)


def test_spearman_matrix_is_pairwise_complete(wide):
    pdf, df = wide
    got = {(r.c1, r.c2): r for r in audit.spearman_pairs(df, ["a", "b", "c"]).collect()}
    for (i, j), r in got.items():
        part = pdf[[i, j]].dropna()
        assert r.n == len(part) and r.rho == pytest.approx(pandas_spearman(part[i], part[j]))
    high = audit.high_correlations(audit.spearman_pairs(df, ["a", "b", "c"]))
    assert rows(high, "c1", "c2") == [("a", "b")]


def test_spearman_matrix_of_complete_columns(wide):
    pdf, df = wide
    got = {(r.c1, r.c2): r for r in audit.spearman_pairs(df.withColumn("k", F.lit(1)), ["a", "b", "y", "k"]).collect()}
    assert len(got) == 6
    for (i, j), r in got.items():
        if j == "k":
            assert r.rho is None
        else:
            assert r.n == 500 and r.rho == pytest.approx(pandas_spearman(pdf[i], pdf[j]))


def test_target_correlations(spark, wide):
    pdf, df = wide
    few = df.withColumn("few", F.when(F.monotonically_increasing_id() < 5, F.col("a")))
    out = {r.feature: r for r in audit.target_correlations(few, ["a", "c", "few"], "y").collect()}
    assert out["a"].marker == "***" and out["a"].p_value < 1e-6 and out["a"].n == 500
    assert out["few"].p_value is None and out["few"].marker == "(n too small)" and out["few"].n < 30
    part = pdf[["c", "y"]].dropna()
    assert out["c"].spearman_rho == pytest.approx(pandas_spearman(part.c, part.y))
    assert "few" not in {r.feature for r in audit.target_correlations(few, ["a", "few"], "y", keep_small=False).collect()}


def test_vif_equals_the_regression_form(wide):
    pdf, df = wide
    part = pdf[["a", "b", "c"]].dropna()
    got = {r.feature: r.VIF for r in audit.inflation_factors(df, ["a", "b", "c"]).collect()}
    for c in part:
        others = np.column_stack([np.ones(len(part)), part.drop(columns=c)])
        fit = others @ np.linalg.lstsq(others, part[c], rcond=None)[0]
        r2 = 1 - ((part[c] - fit) ** 2).sum() / ((part[c] - part[c].mean()) ** 2).sum()
        assert got[c] == pytest.approx(1 / (1 - r2))


def test_feature_selection_needs_both_signals(spark):
    importance = spark.createDataFrame([("weak_high", 0.1), ("weak_low", 0.1), ("weak_none", 0.1), ("strong_high", 2.0)], "feature string, importance double")
    vif = spark.createDataFrame([("weak_high", 9.0), ("weak_low", 2.0), ("strong_high", 9.0)], "feature string, VIF double")
    assert rows(audit.select_features(importance, vif).where("drop"), "feature") == [("weak_high",)]


def test_null_audit_box_and_histogram(spark, wide):
    pdf, df = wide
    got = {r["column"]: r for r in audit.null_audit(df).collect()}
    assert got["c"].null_pct == round(pdf.c.isna().mean() * 100, 1) and got["c"].n_unique == pdf.c.nunique() and got["a"].dtype == "double"
    box = audit.box_statistics(df.withColumn("g", F.lit("all")), "y", "g").first()
    q1, q3 = pdf.y.quantile(0.25), pdf.y.quantile(0.75)
    inside = pdf.y[(pdf.y >= q1 - 1.5 * (q3 - q1)) & (pdf.y <= q3 + 1.5 * (q3 - q1))]
    assert (box.q1, box.q3, box.whisker_low, box.whisker_high, box.outliers) == (q1, q3, inside.min(), inside.max(), 500 - len(inside))
    hist = audit.histograms(df, ["a", "c"]).toPandas()
    want, _ = np.histogram(pdf.a, bins=30)
    mine = hist[hist["column"] == "a"].set_index("bin")["n"].reindex(range(30), fill_value=0)
    assert mine.tolist() == want.tolist() and hist[hist["column"] == "c"]["n"].sum() == pdf.c.notna().sum()


def test_registry_and_overlap_checks(spark):
    audit.check_registry(["GridPosition", "LapStd_lag1"])
    with pytest.raises(ValueError, match="Points"):
        audit.check_registry(["GridPosition", "Points"])
    with pytest.raises(ValueError, match="unclassified"):
        audit.check_registry(["Nonsense"])
    a, b = spark.createDataFrame([(1,), (2,)], "year int"), spark.createDataFrame([(2,)], "year int")
    with pytest.raises(ValueError, match="2"):
        audit.assert_no_overlap(a, b)
    audit.assert_no_overlap(a.where("year = 1"), b)
    assert audit.numeric_columns(spark.sql("select 1 as year, 2 as a, 'x' as b, 3.0D as c")) == ["a", "c"]


# ---- models -----------------------------------------------------------------


@pytest.fixture(scope="module")
def season_rows(spark):
    n = 400
    pdf = pd.DataFrame({"year": 2020.0 + np.arange(n) // 100, "id": np.arange(n) * 1.0, "x1": RNG.normal(size=n), "x2": RNG.normal(size=n), "x3": RNG.integers(0, 4, n) * 1.0})
    pdf["y"] = np.clip(10 + 3 * pdf.x1 + (pdf.x3 > 1) * 4 + RNG.normal(scale=0.5, size=n), 1, 20)
    df = frame(spark, pdf).withColumn("year", F.col("year").cast("int"))
    return models.model_input(df, ["x1", "x2", "x3"]).cache()


def test_folds_expand(season_rows):
    got = rows(models.expanding_folds(season_rows), "fold", "train_years", "val_year", "n_train", "n_val")
    assert got == [(1, "2020", 2021, 100, 100), (2, "2020-2021", 2022, 200, 100), (3, "2020-2022", 2023, 300, 100)]


def test_cross_validation_beats_the_mean(season_rows):
    cv = models.cross_validate(season_rows, lambda: models.random_forest(trees=10, max_depth=5, label="y"), label="y")
    got = cv.collect()
    assert [r.fold for r in got] == [1, 2, 3] and [r.train_years for r in got][-1] == "2020-2022"
    assert all(r.MAE < 2.0 and r.Spearman_rho > 0.7 for r in got)
    summary = {r.stat: r for r in metrics.fold_summary(cv).collect()}
    assert summary["mean"].MAE == pytest.approx(np.mean([r.MAE for r in got])) and summary["std"].MAE == pytest.approx(np.std([r.MAE for r in got], ddof=1))


def test_folds_open_the_files_of_their_seasons(season_rows):
    held = models.fold_store(season_rows, "y")
    assert held.columns == ["year", "y", "features"] and held.count() == season_rows.count()
    for fold, files in ((held.where("year < 2022"), 2), (held.where("year = 2023"), 1)):
        scan = fold._jdf.queryExecution().executedPlan()
        assert "PartitionFilters: [isnotnull(year" in scan.toString()
        fold.count()
        assert len({r.f for r in fold.selectExpr("input_file_name() as f").distinct().collect()}) == files


def test_fit_score_overfit_and_importance(spark, season_rows):
    make = lambda: models.boosted_trees({"max_depth": 3, "learning_rate": 0.3}, label="y", max_iter=8)
    train, test = season_rows.where("year < 2023"), season_rows.where("year = 2023")
    table = models.fit_and_score(train, test, make, "b", label="y")
    assert rows(table, "dataset") == [("test",), ("train",)]
    cv = models.cross_validate(train, make, label="y")
    assert rows(models.overfit_table(table, cv), "dataset") == [("cv_mean",), ("test",), ("train",)]
    importance = models.feature_importance(make().fit(train), ["x1", "x2", "x3"], spark).collect()
    assert importance[0].feature == "x1" and sum(r.importance for r in importance) == pytest.approx(1)


def test_model_store(spark, season_rows, tmp_path):
    path = str(tmp_path / "model")
    make = lambda: models.boosted_trees({"max_depth": 2}, label="y", max_iter=2).fit(season_rows)
    first = models.load_or_fit(spark, path, make)
    again = models.load_or_fit(spark, path, lambda: pytest.fail("must not fit again"))
    assert rows(first.transform(season_rows), "id", "prediction") == rows(again.transform(season_rows), "id", "prediction")


def test_random_search_logs_what_it_fits(season_rows, monkeypatch):
    space = models.SEARCH_SPACE | {"n_estimators": ("int", 1, 2), "max_depth": ("int", 2, 3)}
    fitted, plain = [], models.boosted_trees
    monkeypatch.setattr(models, "boosted_trees", lambda p, **k: fitted.append(p) or plain(p, **k))
    a = models.random_search(season_rows, trials=6, seed=3, label="y", space=space, warmup=1, startup=2, parallel=2)
    got = a.orderBy("number").collect()
    assert [r.params.asDict() for r in got] == [models.sample_params(random.Random(f"3:{t}"), space) for t in range(6)]
    assert {tuple(sorted(p.items())) for p in fitted} == {tuple(sorted(r.params.asDict().items())) for r in got}
    assert plain(got[0].params.asDict(), label="y").getMaxIter() == got[0].params.n_estimators
    done = [r for r in got if r.state == "COMPLETE"]
    assert {r.state for r in got} <= {"COMPLETE", "PRUNED"} and all(r.folds == 3 for r in done)
    best = search.best_trial(a).first()
    assert best.cv_mae == min(r.value for r in done)
    for name, (_, low, high) in space.items():
        assert all(low <= r.params[name] <= high for r in got)


@pytest.mark.parametrize("name", ["m13", "m15"])
def test_study_queries_run_the_whole_study(spark, season_rows, monkeypatch, name):
    """50 trials over the published ranges; only the fits are left out here."""
    from stintframe.plans import queries_eval

    asked = {}

    def study(spark, folder, propose, evaluate, folds, trials, params, **options):
        asked.update(folds=folds, trials=trials, proposals=[propose(t) for t in range(trials)], **options)
        steps = spark.createDataFrame([(0, 0, 1, 2.0, 2.0, None, None, asked["proposals"][0])], search.steps_schema(params))
        return search.trial_table(steps, spark.createDataFrame([(0, 0, "COMPLETE", None)], search.FINISHED))

    monkeypatch.setattr(models, "run_study", study)
    monkeypatch.setattr(queries_eval, "_split", lambda *_: (season_rows, None))
    monkeypatch.setattr(queries_eval.st, "_once", lambda spark, sf, name, make: make())
    assert getattr(queries_eval, name)(spark, "none").count() == 1
    assert (asked["folds"], asked["trials"], asked["startup"], asked["warmup"]) == (3, 50, 5, 2)
    assert asked["proposals"] == [models.sample_params(random.Random(f"42:{t}")) for t in range(50)]


def brute_shapley(x, trees):
    """Shapley values by the definition, from the conditional tree expectation."""

    def value(known):
        total = 0.0
        for leaves in trees:
            for _, leaf, path in leaves:
                w = 1.0
                for f, low, high, share in path:
                    w *= float(low < x[f] <= high) if f in known else share
                total += w * leaf
        return total

    k = len(x)
    out = []
    for i in range(k):
        others = [j for j in range(k) if j != i]
        phi = 0.0
        for size in range(k):
            for s in itertools.combinations(others, size):
                phi += math.factorial(size) * math.factorial(k - size - 1) / math.factorial(k) * (value({*s, i}) - value(set(s)))
        out.append(phi)
    return out


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_attribution(spark, season_rows, kind):
    estimator = models.boosted_trees({"max_depth": 3, "learning_rate": 0.3}, label="y", max_iter=4) if kind == "boosted" else models.random_forest(trees=4, max_depth=4, label="y")
    model = estimator.fit(season_rows)
    features = ["x1", "x2", "x3"]
    parts = explain.attribute(season_rows, model, features, ["id"])
    pdf = parts.toPandas().set_index("id").sort_index()
    predicted = model.transform(season_rows).select("id", "prediction").toPandas().set_index("id").sort_index()["prediction"]
    np.testing.assert_allclose(pdf.sum(axis=1), predicted, rtol=1e-9)
    trees = explain.tree_leaves(model)
    inputs = season_rows.select("id", *features).toPandas().set_index("id").sort_index()
    for i in (0, 57, 333):
        np.testing.assert_allclose(pdf.loc[i, features].astype(float), brute_shapley(inputs.loc[i].tolist(), trees), rtol=1e-9, atol=1e-12)
    top = explain.mean_attribution(parts, features).first()
    assert top.feature == "x1"
    steps = explain.decision_paths(parts, features, ["id"]).where("id = 57").toPandas().sort_values("step")
    assert steps["running"].iloc[-1] == pytest.approx(predicted.loc[57]) and steps["part"].abs().is_monotonic_increasing


def test_attribution_refuses_clashing_keys(season_rows):
    model = models.boosted_trees({"max_depth": 2}, label="y", max_iter=1).fit(season_rows)
    with pytest.raises(ValueError, match="x1"):
        explain.attribute(season_rows, model, ["x1", "x2", "x3"], ["x1"])


def test_inflation_factors_of_degenerate_columns(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=60), rng.normal(size=60)
    frame = pd.DataFrame({"a": a, "b": b, "d": 2 * a, "one": 1.0})
    df = spark.createDataFrame(frame)
    got = {r.feature: r.VIF for r in audit.inflation_factors(df, ["a", "b", "d", "one"]).collect()}
    alone = {r.feature: r.VIF for r in audit.inflation_factors(df, ["a", "b"]).collect()}
    assert got["a"] == got["d"] == float("inf") and got["one"] is None
    assert got["b"] == pytest.approx(alone["b"]) and alone["b"] < 2
    empty = df.selectExpr("a", "b", "cast(null as double) as none")
    assert {r.VIF for r in audit.inflation_factors(empty, ["a", "b", "none"]).collect()} == {None}


def test_importance_share_of_a_zero_total(spark):
    df = spark.createDataFrame([("x", 0.0), ("y", 0.0)], "feature string, importance double")
    assert [r.importance_share for r in audit.importance_share(df).collect()] == [0.0, 0.0]


def test_rank_matrix_shuffles_alike_for_any_number_of_columns(wide):
    _, df = wide
    wider = df.select("*", *[(F.col("a") * k + F.col("b")).alias(f"d{k}") for k in range(4)])
    counts = {
        audit.spearman_pairs(part, part.columns)._jdf.queryExecution().executedPlan().toString().count("Exchange")
        for part in (df.select("a", "b"), df, wider)
    }
    assert len(counts) == 1


def test_selection_keeps_features_of_either_table(spark):
    importance = spark.createDataFrame([("a", 9.0), ("b", 1.0)], "feature string, importance double")
    vif = spark.createDataFrame([("b", 20.0), ("c", 30.0)], "feature string, VIF double")
    got = {r.feature: (r.VIF, r.drop) for r in audit.select_features(importance, vif).collect()}
    assert got == {"a": (None, False), "b": (20.0, True), "c": (30.0, False)}
