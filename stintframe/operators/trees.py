"""Regression trees grown from histograms: exact splits on binned features, boosted with penalties.

The table is binned once and stored narrow (row number, target, one small integer
per feature). A level of a tree is one pass: counts, sums and square sums per
(node, feature, bin), combined on the map side, so at most nodes x features x bins
rows reach the shuffle whatever the size of the table. Prefix sums over the bins
give the gain of every split, and a window picks the best split of each node.

Leaf count, L1 and L2 penalties, smallest leaf, row and feature sampling are those
of the histogram-based boosting that the published study tunes. A tree grows by
levels; within the last level the best splits come first until the leaves are
used up. Nulls have a bin below all others. Ties go to the earlier feature, then
to the lower bin.

A fitted model is a few small lists (splits and leaf values), as is usual for a
model; no rows pass through the driver.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import quoted
from ..session import stored

BINS = 255
#: Gains are compared after rounding, so that the order of a sum decides nothing.
GAIN_DIGITS = 6
#: Trees between two writes of the running prediction.
KEEP_EVERY = 10


@dataclass(frozen=True)
class TreeParams:
    """Settings of a boosted model; one round with a step of 1 and no penalty is a plain tree."""

    rounds: int = 100
    max_depth: int = 3
    num_leaves: int = 31
    learning_rate: float = 0.1
    min_child: int = 20
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    bins: int = BINS
    seed: int = 42


@dataclass
class Tree:
    """Splits by node (children of i are 2i + 1 and 2i + 2) and values of the leaves."""

    feature: dict[int, int] = field(default_factory=dict)
    upto: dict[int, int] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)


def bin_ranges(df: DataFrame, features: Sequence[str]) -> list[tuple[float, float]]:
    """Least and greatest value of each feature, one aggregate row."""
    value = lambda c: F.col(quoted(c)).cast("double")
    row = df.agg(*[f(value(c)) for c in features for f in (F.min, F.max)]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(features))]


def bin_of(value: Column, low: float | None, high: float | None, bins: int) -> Column:
    """Equal-width bin from 0; values beyond the range are in the outer bins, nulls in -1."""
    if low is None or low == high:
        return F.when(value.isNull(), -1).otherwise(0)
    place = F.floor((value - F.lit(low)) * F.lit(float(bins)) / F.lit(high - low))
    return F.when(value.isNull(), -1).otherwise(F.greatest(F.lit(0), F.least(place, F.lit(bins - 1)))).cast("int")


def histograms(rows: DataFrame, features: Sequence[int], target: str) -> DataFrame:
    """(node, feature, bin, n, s, q): count, sum and square sum of the target."""
    cells = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"b{i}").alias("bin")) for i in features])
    return (
        rows.select("node", F.col(target).alias("y"), F.explode(cells).alias("c"))
        .groupBy("node", "c.feature", "c.bin")
        .agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    )


def _shrunk(total: Column, alpha: float) -> Column:
    return F.signum(total) * F.greatest(F.abs(total) - alpha, F.lit(0.0))


def split_candidates(hist: DataFrame, min_child: int = 1, alpha: float = 0.0, lam: float = 0.0) -> DataFrame:
    """Every allowed split (node, feature, bin) with its gain, leaf values and the square error of both sides."""
    part = Window.partitionBy("node", "feature")
    upto = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = hist
    for c in ("n", "s", "q"):
        out = out.withColumns({f"{c}l": F.sum(c).over(upto), f"{c}t": F.sum(c).over(part)})
    out = out.withColumns({f"{c}r": F.col(f"{c}t") - F.col(f"{c}l") for c in ("n", "s", "q")})
    score = lambda k: F.pow(_shrunk(F.col(f"s{k}"), alpha), 2) / (F.col(f"n{k}") + lam)
    value = lambda k: _shrunk(F.col(f"s{k}"), alpha) / (F.col(f"n{k}") + lam)
    spread = lambda k: F.col(f"q{k}") - F.col(f"s{k}") * F.col(f"s{k}") / F.col(f"n{k}")
    return out.where((F.col("nl") >= min_child) & (F.col("nr") >= min_child) & (F.col("nr") > 0)).select(
        "node",
        "feature",
        "bin",
        F.round(score("l") + score("r") - score("t"), GAIN_DIGITS).alias("gain"),
        value("l").alias("left"),
        value("r").alias("right"),
        (spread("l") + spread("r")).alias("error"),
    )


def best_splits(candidates: DataFrame) -> DataFrame:
    """The best split of each node, if it gains anything."""
    order = Window.partitionBy("node").orderBy(F.desc("gain"), "feature", "bin")
    return candidates.where("gain > 0").withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")


def _child(tree: Tree) -> Column:
    """Node of a row one level below its node, or its node if that is a leaf."""
    out = F.col("node")
    for node, feature in tree.feature.items():
        goes_left = F.col(f"b{feature}") <= tree.upto[node]
        out = F.when(F.col("node") == node, F.when(goes_left, 2 * node + 1).otherwise(2 * node + 2)).otherwise(out)
    return out


def _leaf_value(tree: Tree, node: int = 0) -> Column:
    if node not in tree.feature:
        return F.lit(tree.value.get(node, 0.0))
    goes_left = F.col(f"b{tree.feature[node]}") <= tree.upto[node]
    return F.when(goes_left, _leaf_value(tree, 2 * node + 1)).otherwise(_leaf_value(tree, 2 * node + 2))


def grow(rows: DataFrame, features: Sequence[int], target: str, p: TreeParams) -> Tree:
    """One tree on the binned rows."""
    tree, leaves = Tree(), 1
    rows, level = rows.withColumn("node", F.lit(0)), {0}
    for _ in range(p.max_depth):
        hist = histograms(rows.where(F.col("node").isin(sorted(level))), features, target)
        found = best_splits(split_candidates(hist, p.min_child, p.reg_alpha, p.reg_lambda)).collect()  # one row a node
        found = sorted(found, key=lambda r: (-r["gain"], r["node"]))[: max(0, p.num_leaves - leaves)]
        step = Tree()
        for r in found:
            step.feature[r["node"]], step.upto[r["node"]] = r["feature"], r["bin"]
            tree.gain[r["node"]] = r["gain"]
            tree.value[2 * r["node"] + 1], tree.value[2 * r["node"] + 2] = r["left"], r["right"]
        tree.feature |= step.feature
        tree.upto |= step.upto
        leaves += len(found)
        level = {c for r in found for c in (2 * r["node"] + 1, 2 * r["node"] + 2)}
        if not level or leaves >= p.num_leaves:
            break
        rows = rows.withColumn("node", _child(step))
    return tree


@dataclass
class BoostedTrees:
    """A fitted model: the start value, the trees, and how features are binned."""

    features: list[str]
    ranges: list[tuple[float, float]]
    base: float
    trees: list[Tree]
    params: TreeParams

    def binned(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                f"b{i}": bin_of(F.col(quoted(c)).cast("double"), *self.ranges[i], self.params.bins)
                for i, c in enumerate(self.features)
            }
        )

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the prediction. The trees travel as one row; each is walked by an array fold."""
        spark = df.sparkSession
        nodes = 2 ** (self.params.max_depth + 1) - 1
        packed = [
            (
                [t.feature.get(i, -1) for i in range(nodes)],
                [t.upto.get(i, 0) for i in range(nodes)],
                [float(t.value.get(i, 0.0)) for i in range(nodes)],
            )
            for t in self.trees
        ]
        model = spark.createDataFrame(
            [(packed,)], "__trees array<struct<feature:array<int>,upto:array<int>,value:array<double>>>"
        )
        bins = F.array(*[F.col(f"b{i}") for i in range(len(self.features))])
        wide = self.binned(df).withColumn("__bins", bins).join(F.broadcast(model))  # one row

        def leaf(tree: Column) -> Column:
            def below(node: Column, _: Column) -> Column:
                feature = F.get(tree["feature"], node)
                right = (F.get(F.col("__bins"), feature) > F.get(tree["upto"], node)).cast("int")
                return F.when(feature < 0, node).otherwise(2 * node + 1 + right)

            levels = F.sequence(F.lit(1), F.lit(max(1, self.params.max_depth)))
            return F.aggregate(levels, F.lit(0), below, lambda node: F.get(tree["value"], node))

        rate = F.lit(float(self.params.learning_rate))
        total = F.aggregate("__trees", F.lit(float(self.base)), lambda s, t: s + rate * leaf(t))
        names = [F.col(quoted(c)) for c in df.columns]
        return wide.select(*names, total.alias(out))

    def importance(self) -> list[tuple[str, float]]:
        """Total gain per feature, in the order of the features."""
        gains = [0.0] * len(self.features)
        for t in self.trees:
            for node, feature in t.feature.items():
                gains[feature] += t.gain[node]
        return list(zip(self.features, gains))


def fit(df: DataFrame, features: Sequence[str], target: str, params: TreeParams | None = None) -> BoostedTrees:
    """Boosted trees of the target on the features; rows without a target are left out."""
    p = params or TreeParams()
    df = df.where(F.col(quoted(target)).isNotNull())
    model = BoostedTrees(list(features), bin_ranges(df, features), 0.0, [], p)
    y = F.col(quoted(target)).cast("double")
    narrow = model.binned(df.withColumn("__y", y)).select(
        F.monotonically_increasing_id().alias("__row"), "__y", *[f"b{i}" for i in range(len(features))]
    )
    rows = stored(narrow, "binned")
    model.base = rows.agg(F.avg("__y")).first()[0] or 0.0
    rows = rows.withColumn("__fit", F.lit(model.base))
    for k in range(p.rounds):
        rng = random.Random(f"{p.seed}:{k}")
        chosen = sorted(rng.sample(range(len(features)), max(1, round(p.colsample * len(features)))))
        data = rows.withColumn("__gap", F.col("__y") - F.col("__fit"))
        if p.subsample < 1.0:
            draw = F.pmod(F.xxhash64("__row", F.lit(p.seed), F.lit(k)), F.lit(1_000_000))
            data = data.where(draw < p.subsample * 1_000_000)
        tree = grow(data, chosen, "__gap", p)
        model.trees.append(tree)
        if not tree.feature:
            break
        rows = rows.withColumn("__fit", F.col("__fit") + p.learning_rate * _leaf_value(tree))
        if k % KEEP_EVERY == KEEP_EVERY - 1 and k + 1 < p.rounds:
            rows = stored(rows, "boosted")
    return model
