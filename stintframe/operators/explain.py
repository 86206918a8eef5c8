"""Per-row attribution of tree models, and the tables built on it.

For each leaf only the features on its path matter (at most the tree depth), so
the Shapley value of every feature is summed over the subsets of that path, with
the training share of each branch as the expectation for an unknown feature. The
trees are part of the model and travel with the task; rows stay partitioned as
they are and are handled in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import quoted
from .models import plain_name

BASE = "base_value"


def tree_leaves(model) -> list[list[tuple[float, float, list[tuple[int, float, float, float]]]]]:
    """Leaves of each tree as (probability, scaled value, path conditions).

    A condition is (feature, lower bound, upper bound, branch share) and stands
    for all splits on that feature along the path.
    """
    trees = model.trees
    if hasattr(model, "treeWeights"):
        weights = list(model.treeWeights)
    else:
        weights = [1.0] * len(trees)
    if type(model).__name__.startswith("RandomForest"):
        weights = [w / len(trees) for w in weights]

    def walk(node, value_weight, path, prob, out):
        if node.numDescendants() == 0:
            out.append((prob, node.prediction() * value_weight, [(f, *c) for f, c in path.items()]))
            return
        split = node.split()
        feature, threshold = split.featureIndex(), split.threshold()
        left, right = node.leftChild(), node.rightChild()
        count = node.impurityStats().count()
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, bounds in ((left, (low, min(high, threshold))), (right, (max(low, threshold), high))):
            part = child.impurityStats().count() / count
            walk(child, value_weight, {**path, feature: (*bounds, share * part)}, prob * part, out)

    result = []
    for tree, weight in zip(trees, weights):
        leaves: list = []
        walk(tree._java_obj.rootNode() if hasattr(tree, "_java_obj") else tree.rootNode(), weight, {}, 1.0, leaves)
        result.append(leaves)
    return result


def expected_value(trees) -> float:
    return float(sum(prob * value for leaves in trees for prob, value, _ in leaves))


def shapley_values(x: np.ndarray, trees) -> np.ndarray:
    """Shapley value of each feature for each row of ``x``."""
    out = np.zeros_like(x)
    for leaves in trees:
        for _, value, path in leaves:
            d = len(path)
            if d == 0:
                continue
            follows = [((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, low, high, _ in path]
            shares = [c[3] for c in path]
            for i, (feature, *_rest) in enumerate(path):
                others = [j for j in range(d) if j != i]
                total = np.zeros(len(x))
                for size in range(d):
                    weight = factorial(size) * factorial(d - size - 1) / factorial(d)
                    for known in combinations(others, size):
                        term = np.full(len(x), weight)
                        for j in others:
                            term *= follows[j] if j in known else shares[j]
                        total += term
                out[:, feature] += total * (follows[i] - shares[i]) * value
    return out


def attribute(df: DataFrame, model, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Keys, prediction parts and base value: base + sum of parts = prediction.

    Suited to shallow trees; the work per leaf grows with 2^depth.
    """
    trees = tree_leaves(model)
    base = expected_value(trees)
    names = [plain_name(f) for f in features]
    rows = df.select(
        *[F.col(quoted(k)) for k in keys],
        *[F.col(quoted(f)).cast("double").alias(f"__x{i}") for i, f in enumerate(features)],
    )
    schema = T.StructType(
        [rows.schema[k] for k in keys]
        + [T.StructField(n, T.DoubleType()) for n in names]
        + [T.StructField(BASE, T.DoubleType())]
    )
    inputs = [f"__x{i}" for i in range(len(features))]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            parts = shapley_values(pdf[inputs].to_numpy(dtype=float), trees)
            done = pdf[list(keys)].copy()
            for i, n in enumerate(names):
                done[n] = parts[:, i]
            done[BASE] = base
            yield done

    # Key names must not collide with the attribution columns.
    clash = set(keys) & set(names)
    if clash:
        raise ValueError(f"rename key columns {sorted(clash)} before attribution")
    return rows.mapInPandas(batches, schema)


def mean_attribution(parts: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    names = [plain_name(f) for f in features]
    sums = parts.agg(*[F.avg(F.abs(n)).alias(n) for n in names])
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("mean_abs")) for n in names])
    return sums.select(F.explode(cells).alias("v")).select("v.*").orderBy(F.desc("mean_abs"), "feature")


def decision_paths(parts: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Contributions of each row in order of size, with the running prediction."""
    names = [plain_name(f) for f in features]
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("part")) for n in names])
    long = parts.select(*keys, BASE, F.explode(cells).alias("v")).select(*keys, BASE, "v.*")
    by_row = Window.partitionBy(*keys).orderBy(F.abs("part"), "feature")
    upto = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return long.withColumns(
        {"step": F.row_number().over(by_row), "running": F.col(BASE) + F.sum("part").over(upto)}
    )
