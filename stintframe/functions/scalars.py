"""Scalar expressions of the evaluation and segmentation steps."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: labels and thresholds of the published reports ---------
TIER_ORDER = ["Podium (1-3)", "Points (4-10)", "Midfield (11-15)", "Back (16-20)"]
TIER_LIMITS = [3, 10, 15]
ROOKIE_RACES = 22
RAIN_THRESHOLDS = [0.0, 0.05]
# ---------------------------------------------------------------------------


def position_class(prediction: Column, low: int = 1, high: int = 20) -> Column:
    """Nearest position, half to even, clipped to the grid."""
    return F.least(F.greatest(F.rint(prediction), F.lit(float(low))), F.lit(float(high))).cast("int")


def position_tier(position: Column) -> Column:
    """Finishing tier; a null position falls into the last tier."""
    out = F.when(position <= TIER_LIMITS[0], TIER_ORDER[0])
    for limit, label in zip(TIER_LIMITS[1:], TIER_ORDER[1:]):
        out = out.when(position <= limit, label)
    return out.otherwise(TIER_ORDER[-1])


def membership_flag(col: Column, members: Iterable[str], inside: str, outside: str) -> Column:
    return F.when(col.isin(list(members)), inside).otherwise(outside)


def threshold_flag(col: Column, threshold: float, above: str = "Rain", below: str = "Dry") -> Column:
    """``above`` strictly over the threshold; null counts as ``below``."""
    return F.when(col > threshold, above).otherwise(below)


def experience_flag(prior: Column, limit: int = ROOKIE_RACES) -> Column:
    """Rookie below ``limit`` prior races; unknown history is a veteran."""
    return F.when(prior < limit, "Rookie").otherwise("Veteran")


def mapped(col: Column, renames: Mapping[str, str]) -> Column:
    """Value map that leaves unknown values as they are."""
    if not renames:
        return col
    old, new = F.lit(list(renames)), F.lit(list(renames.values()))
    return F.coalesce(F.try_element_at(F.map_from_arrays(old, new), col), col)


def significance_marker(p_value: Column) -> Column:
    return (
        F.when(p_value.isNull(), "(n too small)")
        .when(p_value < 0.001, "***")
        .when(p_value < 0.01, "**")
        .when(p_value < 0.05, "*")
        .otherwise("(ns)")
    )


def year_label(first: Column, last: Column) -> Column:
    """``a-b``, or just ``a`` for a single year."""
    return F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first, last))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def correlation_p_value(rho: float | None, n: int) -> float | None:
    """Two-sided p-value of a rank correlation by the t distribution, n-2 df."""
    if rho is None or math.isnan(rho) or n < 3:
        return None
    if abs(rho) >= 1.0 or rho == 0.0:
        return 1.0 if rho == 0.0 else 0.0
    df = n - 2
    if df > 1_000_000:  # the t distribution is normal to six digits
        return math.erfc(abs(rho) * math.sqrt(df / (1.0 - rho * rho)) / math.sqrt(2.0))
    x = 1.0 - rho * rho  # = df / (df + t^2)
    a, b = df / 2.0, 0.5
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log1p(-rho * rho) + b * math.log(rho * rho)
    )
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, rho * rho) / b
