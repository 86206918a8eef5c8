"""Study log, pruning, resumption; histogram trees against brute force."""

from __future__ import annotations

import random
import statistics

import pytest

from stintframe.operators import search, trees
from stintframe.session import scratch_path
from stintframe.sources import sinks

PARAMS = "struct<a:int,b:double>"
FOLDS = 4


def error_of(trial: int, step: int) -> float:
    return random.Random(f"{trial}/{step}").uniform(0, 1) + (trial % 3) * 0.2


def propose(trial: int) -> dict:
    return {"a": trial, "b": trial / 4}


def study_by_force(trials: int, wave: int, startup: int, warmup: int) -> dict[int, tuple[int, str]]:
    """(folds, state) of every trial, one after another."""
    out, complete = {}, {}
    for t in range(trials):
        peers = [v for n, v in complete.items() if n < t // wave * wave]
        means, state = [], "COMPLETE"
        for step in range(1, FOLDS + 1):
            errors = [round(error_of(t, k), 9) for k in range(1, step + 1)]
            means.append(round(sum(errors) / step, 9))
            if len(peers) >= startup and step >= warmup and min(means) > statistics.median(v[step - 1] for v in peers):
                state = "PRUNED"
                break
        out[t] = (len(means), state)
        if state == "COMPLETE":
            complete[t] = means
    return out


class Killed(Exception):
    pass


def run(spark, path, trials=14, wave=1, startup=3, warmup=2, stop_at=None, seen=None):
    calls = []

    def evaluate(proposals, step):
        calls.append(step)
        if len(calls) == stop_at:
            raise Killed
        if seen is not None:
            seen.extend((t, step) for t in proposals)
        return {t: error_of(t, step) for t in proposals}

    return search.run_study(
        spark, path, propose, evaluate, FOLDS, trials, PARAMS, wave=wave, startup=startup, warmup=warmup
    )


def facts(table):
    return {r.number: (r.folds, r.state) for r in table.collect()}


@pytest.mark.parametrize("wave", [1, 4])
def test_study_equals_the_rule_played_by_hand(spark, wave):
    got = run(spark, scratch_path(spark, "study"), wave=wave)
    want = study_by_force(14, wave, 3, 2)
    assert facts(got) == want and {s for _, s in want.values()} == {"COMPLETE", "PRUNED"}


def test_killed_study_goes_on_and_ends_the_same(spark):
    path, seen = scratch_path(spark, "study"), []
    for stop in (9, 7):
        with pytest.raises(Killed):
            run(spark, path, stop_at=stop, seen=seen)
    got = run(spark, path, seen=seen)
    whole = run(spark, scratch_path(spark, "study"))
    keep = ["number", "value", "folds", "state"]
    assert sorted(map(tuple, got.select(keep).collect())) == sorted(map(tuple, whole.select(keep).collect()))
    assert len(seen) == len(set(seen))  # no fold was scored twice
    again = []
    run(spark, path, seen=again)
    assert again == []


def test_longer_study_keeps_its_first_trials(spark):
    path = scratch_path(spark, "study")
    short, long = facts(run(spark, path, trials=6)), facts(run(spark, path, trials=12))
    assert {t: long[t] for t in short} == short and len(long) == 12


def test_report_has_times_and_a_column_for_each_parameter(spark):
    table = run(spark, scratch_path(spark, "study"), trials=3)
    report = search.trial_report(table)
    assert report.columns == ["number", "value", "datetime_start", "datetime_complete", "duration", "params_a", "params_b", "state"]
    row = report.first()
    assert row.datetime_complete >= row.datetime_start and row.duration >= 0
    back = spark.read.option("header", True).csv(sinks.write_csv(report, scratch_path(spark, "trials")))
    assert back.columns == report.columns and back.count() == 3


def test_decisions_without_complete_trials_prune_nothing(spark):
    steps = spark.createDataFrame([(0, 0, 2, 1.0, 1.0, None, None, None)], search.steps_schema(PARAMS))
    (row,) = search.pruning_decisions(steps, spark.createDataFrame([], search.FINISHED), startup=0).collect()
    assert row.median is None and not row.pruned


# ---- trees --------------------------------------------------------------------


def table(n: int, seed: int):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a, b = rng.choice([None, *range(12)]), rng.uniform(-3, 3)
        rows.append((k, a, b, 5.0, (2.0 if (a or 0) > 6 else -1.0) + (b > 1) * 1.5 + rng.gauss(0, 0.1)))
    return rows


SCHEMA = "id int, a int, b double, one double, y double"


def bin_by_force(value, low, high, bins):
    if value is None:
        return -1
    return 0 if low == high else max(0, min(int((value - low) * bins // (high - low)), bins - 1))


def grow_by_force(rows, gaps, depth, leaves, least, alpha, lam, bins):
    """Nested split dict over binned rows: best split of every node, by levels."""

    def shrunk(s):
        return (abs(s) - alpha) * (1 if s > 0 else -1) if abs(s) > alpha else 0.0

    def score(part):
        return shrunk(sum(part)) ** 2 / (len(part) + lam)

    nodes, tree, values, count = {0: list(range(len(rows)))}, {}, {}, 1
    for _ in range(depth):
        found = []
        for node, members in nodes.items():
            best = None
            for f in range(len(rows[0])):
                for cut in range(-1, bins):
                    left = [gaps[i] for i in members if rows[i][f] <= cut]
                    right = [gaps[i] for i in members if rows[i][f] > cut]
                    if len(left) < least or len(right) < least or not any(rows[i][f] == cut for i in members):
                        continue
                    gain = round(score(left) + score(right) - score(left + right), trees.GAIN_DIGITS)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, cut, shrunk(sum(left)) / (len(left) + lam), shrunk(sum(right)) / (len(right) + lam))
            if best:
                found.append((-best[0], node, best))
        found = sorted(found)[: leaves - count]
        count += len(found)
        following = {}
        for _, node, (_, f, cut, lv, rv) in found:
            tree[node] = (f, cut)
            values[2 * node + 1], values[2 * node + 2] = lv, rv
            following[2 * node + 1] = [i for i in nodes[node] if rows[i][f] <= cut]
            following[2 * node + 2] = [i for i in nodes[node] if rows[i][f] > cut]
        nodes = following
    return tree, values


def value_by_force(row, tree, values):
    node = 0
    while node in tree:
        f, cut = tree[node]
        node = 2 * node + 1 + (row[f] > cut)
    return values.get(node, 0.0)


@pytest.mark.parametrize("depth, leaves, alpha, lam", [(1, 31, 0.0, 0.0), (3, 31, 0.5, 1.0), (3, 5, 0.0, 2.0)])
def test_boosted_trees_equal_brute_force(spark, depth, leaves, alpha, lam):
    data = table(260, 7)
    p = trees.TreeParams(rounds=3, max_depth=depth, num_leaves=leaves, learning_rate=0.4, min_child=8, reg_alpha=alpha, reg_lambda=lam, bins=9)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    model = trees.fit(df, ["a", "b", "one"], "y", p)
    ranges = [(0, 11), (min(r[2] for r in data), max(r[2] for r in data)), (5.0, 5.0)]
    binned = [[bin_by_force(r[k + 1], *ranges[k], 9) for k in range(3)] for r in data]
    base = sum(r[4] for r in data) / len(data)
    guess = [base] * len(data)
    for t in model.trees:
        tree, values = grow_by_force(binned, [r[4] - g for r, g in zip(data, guess)], depth, leaves, 8, alpha, lam, 9)
        assert {n: (t.feature[n], t.upto[n]) for n in t.feature} == tree
        guess = [g + 0.4 * value_by_force(b, tree, values) for g, b in zip(guess, binned)]
    got = {r.id: r.prediction for r in model.transform(df).collect()}
    assert all(abs(got[k] - g) < 1e-9 for k, g in enumerate(guess))
    gains = dict(model.importance())
    assert gains["one"] == 0.0 and gains["a"] > gains["b"] > 0


def test_sampling_is_seeded_and_learns(spark):
    df = spark.createDataFrame(table(600, 1), SCHEMA)
    p = trees.TreeParams(rounds=12, max_depth=2, learning_rate=0.5, min_child=5, subsample=0.7, colsample=0.6, bins=16)
    a, b = (trees.fit(df, ["a", "b", "one"], "y", p) for _ in range(2))
    assert [t.feature for t in a.trees] == [t.feature for t in b.trees]
    rows = a.transform(df).selectExpr("avg(abs(prediction - y)) AS e", "avg(abs(y)) AS s").first()
    assert rows.e < 0.35 * rows.s


def test_clean_ends(spark):
    df = spark.createDataFrame(table(40, 3), SCHEMA)
    same = df.withColumn("y", df.one)
    model = trees.fit(same, ["a", "one"], "y", trees.TreeParams(rounds=2))
    assert {r.prediction for r in model.transform(df).collect()} == {5.0}
    none = trees.fit(df.where("id < 0"), ["a"], "y", trees.TreeParams(rounds=1))
    assert none.transform(df).count() == 40
