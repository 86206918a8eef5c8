"""Search, pruning and histogram trees as queries that SQL can state in full."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, search, trees
from ..operators.prep import unscale
from ..schemas import TARGET
from ..session import scratch_path
from ..sources import sinks
from . import standin as st
from .catalog import cells, query, tidy
from .oracle import with_parts
from .queries_eval import sweep_sql

# ---- a study of rules: prediction = share * form + (1 - share) * grid + shift ---
# Nothing is fitted, so every fold error of every trial is one aggregate.

TRIALS, WAVE, STARTUP, WARMUP = 16, 4, 4, 2
RULE = "struct<share:double,shift:double>"


def rule_of(trial: int) -> dict:
    return {"share": (trial * 5 % 16) / 15.0, "shift": (trial * 3 % 4) - 1.5}


def _rule_errors(spark, sf) -> list[dict[int, float]]:
    """Mean absolute error of each rule, per season after the first: one row a season."""
    df = st.race_table(spark, sf).where(F.col("year") != st.TEST_YEAR)
    df = df.withColumns({"form": F.round("DriverFinish_ewm", 6), "grid": F.col("GridPosition"), "y": F.col(TARGET)})
    df = df.where("form is not null and grid is not null and y is not null")

    def error(trial: int):
        p = rule_of(trial)
        guess = p["share"] * F.col("form") + (1 - p["share"]) * F.col("grid") + p["shift"]
        return F.round(F.avg(F.abs(F.col("y") - guess)), 6).alias(f"e{trial}")

    rows = df.groupBy("year").agg(*[error(t) for t in range(TRIALS)]).orderBy("year").collect()
    return [{t: r[f"e{t}"] for t in range(TRIALS)} for r in rows[1:]]


class _Interrupted(Exception):
    pass


def _study(spark, sf) -> str:
    """Folder of a study that was stopped in its third wave and then resumed."""

    def make() -> str:
        errors, path, calls = _rule_errors(spark, sf), scratch_path(spark, "study"), []

        def evaluate(proposals, step):
            calls.append(step)
            if len(calls) == 2 * len(errors) + 2:
                raise _Interrupted
            return {t: errors[step - 1][t] for t in proposals}

        options = dict(wave=WAVE, startup=STARTUP, warmup=WARMUP)
        for _ in range(2):
            try:
                search.run_study(spark, path, rule_of, evaluate, len(errors), TRIALS, RULE, **options)
            except _Interrupted:
                continue
        return path

    return st._once(spark, sf, "study", make)


_SHARE, _SHIFT = "((t * 5 % 16) / 15e0)", "((t * 3 % 4) - 1.5e0)"
_STUDY = f"""scored AS (
  SELECT year, pos, round(ewm, 6) AS form, grid FROM lagged
  WHERE pos IS NOT NULL AND ewm IS NOT NULL AND grid IS NOT NULL AND year <> {st.TEST_YEAR}),
fold AS (
  SELECT t, year, round(avg(abs(pos - ({_SHARE} * form + (1 - {_SHARE}) * grid + {_SHIFT}))), 6) AS err
  FROM scored, (SELECT unnest(range({TRIALS})) AS t) GROUP BY ALL),
step AS (SELECT t, row_number() OVER (PARTITION BY t ORDER BY year) - 1 AS k, err FROM fold),
means AS (SELECT t, k, round(avg(err) OVER (PARTITION BY t ORDER BY k), 9) AS value FROM step WHERE k >= 1),
curve AS (SELECT t, t // {WAVE} AS wave, list(value ORDER BY k) AS v FROM means GROUP BY t),
study AS (
  SELECT 0 AS wave, []::DOUBLE[][] AS done
  UNION ALL
  SELECT s.wave + 1, list_concat(any_value(s.done), coalesce(list(c.v ORDER BY c.t) FILTER (WHERE len(list_filter(range(1, len(c.v) + 1),
    lambda k: len(s.done) >= {STARTUP} AND k >= {WARMUP} AND list_min(c.v[1:k]) > list_median(list_transform(s.done, lambda x: x[k])))) = 0), []))
  FROM study s JOIN curve c ON c.wave = s.wave GROUP BY s.wave),
decided AS (
  SELECT t, wave, k, v[k] AS value, list_min(v[1:k]) AS best, list_median(list_transform(done, lambda x: x[k])) AS median, len(done) AS n_complete
  FROM (SELECT c.t, c.wave, c.v, s.done, unnest(range(1, len(c.v) + 1)) AS k FROM curve c JOIN study s ON s.wave = c.wave)),
flagged AS (SELECT *, coalesce(n_complete >= {STARTUP} AND k >= {WARMUP} AND best > median, false) AS pruned FROM decided),
logged AS (
  SELECT * FROM flagged f WHERE NOT EXISTS (SELECT 1 FROM flagged g WHERE g.t = f.t AND g.k < f.k AND g.pruned)),
ended AS (
  SELECT t AS number, arg_max(value, k) AS value, count(*) AS folds, CASE WHEN bool_or(pruned) THEN 'PRUNED' ELSE 'COMPLETE' END AS state,
         {_SHARE} AS share, {_SHIFT} AS shift
  FROM logged GROUP BY t)"""


def _study_sql(body: str) -> str:
    return with_parts("lagged", body, extra=_STUDY).replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "m14_median_pruning",
    _study_sql("SELECT t AS trial, wave, k AS step, round(value, 6) AS value, round(best, 6) AS best, round(median, 6) AS median, n_complete, pruned FROM logged"),
)
def m14(spark, sf):
    """The decision of every (trial, step) of a study, from its log."""
    steps, finished = search.read_study(spark, _study(spark, sf), RULE)
    return tidy(search.pruning_decisions(steps, finished, STARTUP, WARMUP))


@query(
    "m13b_resumed_search",
    _study_sql("SELECT number, round(value, 6) AS value, folds, round(share, 6) AS share, round(shift, 6) AS shift, state FROM ended"),
)
def m13b(spark, sf):
    """Trial table of an interrupted and resumed study."""
    table = search.trial_table(*search.read_study(spark, _study(spark, sf), RULE))
    return tidy(table.select("number", "value", "folds", "params.share", "params.shift", "state"))


@query(
    "m15b_best_rule",
    _study_sql("SELECT round(value, 6) AS cv_mae, round(share, 6) AS share, round(shift, 6) AS shift FROM ended WHERE state = 'COMPLETE' ORDER BY value, number LIMIT 1"),
)
def m15b(spark, sf):
    """Best trial, written as JSON and read back."""
    table = search.trial_table(*search.read_study(spark, _study(spark, sf), RULE))
    path = sinks.write_json(search.best_trial(table), scratch_path(spark, "best"))
    return tidy(sinks.read_json(spark, path, f"cv_mae double, params {RULE}").select("cv_mae", "params.*"))


# ---- histogram trees ------------------------------------------------------------

FEATURES = {"GridPosition": "grid", "DriverFinish_lag1": "lag1", "DriverFinish_ewm": "ewm", "DriverFinish_roll3_inseason": "roll"}
TREE = trees.TreeParams(rounds=1, max_depth=1, learning_rate=1.0, min_child=5, bins=16)
BOOSTED = trees.TreeParams(rounds=3, max_depth=1, learning_rate=0.5, min_child=5, reg_alpha=2.0, reg_lambda=1.0, bins=16)


def _raw_rows(spark, sf):
    """Imputed features on their own scale, rounded, with the target."""
    matrix, fitted = st.matrix(spark, sf)
    raw = unscale(matrix, fitted.numeric, list(FEATURES))
    return raw.select("year", "DriverNumber", TARGET, *[F.round(c, 6).alias(c) for c in FEATURES])


def _tree_model(spark, sf, params):
    def make():
        return trees.fit(_raw_rows(spark, sf).where(F.col("year") != st.TEST_YEAR), list(FEATURES), TARGET, params)

    return st._once(spark, sf, f"trees-{params}", make)


def _bin_sql(i: int, bins: int) -> str:
    return f"CASE WHEN hi{i} = lo{i} THEN 0 ELSE greatest(0, least(floor((f{i} - lo{i}) * {float(bins)!r} / (hi{i} - lo{i})), {bins - 1})) END AS b{i}"


def _trees_sql(p: trees.TreeParams, body: str) -> str:
    """Rounds of one-split trees, unrolled."""
    n, train = len(FEATURES), f"year <> {st.TEST_YEAR}"
    shrunk = lambda s: f"(sign({s}) * greatest(abs({s}) - {p.reg_alpha!r}, 0e0))"
    score = lambda s, c: f"(pow({shrunk(s)}, 2) / ({c} + {p.reg_lambda!r}))"
    value = lambda s, c: f"({shrunk(s)} / ({c} + {p.reg_lambda!r}))"
    ctes = [
        "tr AS (SELECT year, dn, pos AS y, " + ", ".join(f"round({c}, 6) AS f{i}" for i, c in enumerate(FEATURES.values())) + " FROM filled)",
        "ed AS (SELECT avg(y) AS base, " + ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(n)) + f" FROM tr WHERE {train})",
        "r0 AS (SELECT year, dn, y, base AS fit, " + ", ".join(_bin_sql(i, p.bins) for i in range(n)) + " FROM tr, ed)",
    ]
    bins = ", ".join(f"b{i}" for i in range(n))
    for k in range(p.rounds):
        melted = " UNION ALL ".join(f"SELECT {i} AS f, b{i} AS b, y - fit AS g FROM r{k} WHERE {train}" for i in range(n))
        ctes += [
            f"h{k} AS (SELECT f, b, count(*) AS n, sum(g) AS s FROM ({melted}) GROUP BY f, b)",
            f"""p{k} AS (SELECT f, b, sum(n) OVER u AS nl, sum(s) OVER u AS sl, sum(n) OVER w AS nt, sum(s) OVER w AS st FROM h{k}
  WINDOW u AS (PARTITION BY f ORDER BY b), w AS (PARTITION BY f))""",
            f"""c{k} AS (SELECT f, b, round({score("sl", "nl")} + {score("(st - sl)", "(nt - nl)")} - {score("st", "nt")}, {trees.GAIN_DIGITS}) AS gain,
  {value("sl", "nl")} AS lv, {value("(st - sl)", "(nt - nl)")} AS rv FROM p{k} WHERE nl >= {p.min_child} AND nt - nl >= {p.min_child})""",
            f"s{k} AS (SELECT * FROM c{k} WHERE gain > 0 ORDER BY gain DESC, f, b LIMIT 1)",
            f"""r{k + 1} AS (SELECT year, dn, y, fit + {p.learning_rate!r} * CASE WHEN CASE s.f {" ".join(f"WHEN {i} THEN b{i}" for i in range(n))} END <= s.b THEN lv ELSE rv END AS fit, {bins}
  FROM r{k}, s{k} s)""",
        ]
    return with_parts("filled", body, extra=",\n".join(ctes))


def _predictions(spark, sf, params):
    test = _raw_rows(spark, sf).where(F.col("year") == st.TEST_YEAR)
    out = _tree_model(spark, sf, params).transform(test)
    return cells(out, {"driver_number": "DriverNumber", "prediction": "prediction"})


def _predicted_sql(p: trees.TreeParams) -> str:
    return _trees_sql(p, f"SELECT dn AS driver_number, round(fit, 6) + 0e0 AS prediction FROM r{p.rounds} WHERE year = {st.TEST_YEAR}")


@query("m5b_one_split_tree", _predicted_sql(TREE))
def m5b(spark, sf):
    """Test-season predictions of one tree with one split, the unit of a forest."""
    return _predictions(spark, sf, TREE)


@query("m6b_boosted_splits", _predicted_sql(BOOSTED))
def m6b(spark, sf):
    """Test-season predictions of boosted one-split trees with L1 and L2 penalties."""
    return _predictions(spark, sf, BOOSTED)


_GAINS = " UNION ALL ".join(f"SELECT f, gain FROM s{k}" for k in range(BOOSTED.rounds))


@query(
    "m9b_gain_importance",
    _trees_sql(
        BOOSTED,
        f"""SELECT n.feature, round(coalesce(g.gain, 0), 4) AS gain, round(coalesce(g.gain, 0) / sum(g.gain) OVER (), 6) AS share
FROM ({" UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature" for i, c in enumerate(FEATURES))}) n
LEFT JOIN (SELECT f, sum(gain) AS gain FROM ({_GAINS}) GROUP BY f) g USING (f)""",
    ),
)
def m9b(spark, sf):
    """Gain of each feature over the boosted splits, and its share."""
    gains = _tree_model(spark, sf, BOOSTED).importance()
    total = sum(g for _, g in gains) or 1.0
    rows = [(f, round(g, 4), round(g / total, 6)) for f, g in gains]
    return spark.createDataFrame(rows, "feature string, gain double, share double")


@query(
    "m5c_split_table",
    _trees_sql(
        TREE,
        """SELECT n.feature, count(*) AS n_splits, round(max(c.gain), 4) AS best_gain FROM c0 c
JOIN (""" + " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature" for i, c in enumerate(FEATURES)) + """) n USING (f) GROUP BY n.feature""",
    ),
)
def m5c(spark, sf):
    """Allowed splits of the root and the best gain, per feature."""
    train = _raw_rows(spark, sf).where(F.col("year") != st.TEST_YEAR)
    names = list(FEATURES)
    model = trees.BoostedTrees(names, trees.bin_ranges(train, names), 0.0, [], TREE)
    mean = _tree_model(spark, sf, TREE).base
    rows = model.binned(train).select(
        F.lit(0).alias("node"), (F.col(TARGET) - F.lit(mean)).alias("y"), *[f"b{i}" for i in range(len(names))]
    )
    found = trees.split_candidates(trees.histograms(rows, range(len(names)), "y"), TREE.min_child)
    label = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("feature") + 1)
    out = found.groupBy(label.alias("feature")).agg(F.count("*").alias("n_splits"), F.max("gain").alias("best_gain"))
    return tidy(out, 4)


_NAMED = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature" for i, c in enumerate(FEATURES))
_VIF_OF = {c: f"round({s}, 6)" for c, s in FEATURES.items() if c != "DriverFinish_lag1"} | {"LapStd_lag1": "round(lapstd1, 6)"}


@query(
    "j10b_gain_and_vif",
    _trees_sql(
        BOOSTED,
        f"""SELECT coalesce(i.feature, v.feature) AS feature, round(i.share, 6) AS importance_share, round(1 / v.rest, 6) AS vif
FROM (SELECT n.feature, coalesce(g.gain, 0) / sum(g.gain) OVER () AS share FROM ({_NAMED}) n
      LEFT JOIN (SELECT f, sum(gain) AS gain FROM ({_GAINS}) GROUP BY f) g USING (f)) i
FULL JOIN vif v ON v.feature = i.feature""",
    )
    .replace("WITH ", "WITH RECURSIVE ", 1)
    .replace("tr AS (", sweep_sql(_VIF_OF) + ",\ntr AS (", 1),
)
def j10b(spark, sf):
    """Gain share next to collinearity, outer-joined: either side may lack a feature."""
    matrix, fitted = st.matrix(spark, sf)
    names = list(_VIF_OF)
    raw = unscale(matrix, fitted.numeric, names).select(*[F.round(c, 6).alias(c) for c in names])
    gains = _tree_model(spark, sf, BOOSTED).importance()
    importance = spark.createDataFrame(gains, "feature string, importance double")
    out = audit.select_features(importance, audit.inflation_factors(raw, names))
    return tidy(out.select("feature", "importance_share", F.col("VIF").alias("vif")))
