"""Lagged history features per entity: lag, season rolling mean, EWM, prior count.

Every value of a row looks only at earlier rows of its entity. The common case
is one window per entity. Two cases would overload one task and are split:

* rows without an entity get null features and are spread by a hash;
* an entity with more than ``hot_rows`` rows is cut into blocks of consecutive
  rows. Each block also receives the rows just before it (as many as the
  longest look-back needs), so all blocks run in parallel with equal results.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import quoted
from ..session import durable, stored
from .ordering import running_before

HOT_ROWS = 4_000_000

_POS, _SPREAD, _BLOCK, _OWN = "__pos", "__spread", "__block", "__own"
_SEG, _WEIGHT, _TERM = "__seg", "__weight", "__term"


def entity_rows(df: DataFrame, entity: str) -> DataFrame:
    """(entity, n): rows per entity, a map-side combined aggregate over one column."""
    key = F.col(quoted(entity))
    return df.where(key.isNotNull()).groupBy(key.alias("entity")).agg(F.count("*").alias("n"))


def hot_entities(df: DataFrame, entity: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(entity): those with more than ``hot_rows`` rows, all of them.

    The list has at most one entry per ``hot_rows`` rows and stays a table.
    """
    return entity_rows(df, entity).where(F.col("n") > hot_rows).select("entity")


def ewm_segment(span: float) -> int:
    """Rows after which the weights are rebased, so that no power overflows."""
    decay = 1.0 - 2.0 / (span + 1.0)
    return max(1, int(250 / -math.log(decay))) if decay > 0 else 1


def add_history(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    *,
    lags: Mapping[str, str] | None = None,
    rolls: Mapping[str, tuple[str, int]] | None = None,
    ewms: Mapping[str, tuple[str, float]] | None = None,
    prior: str | None = None,
    key_source: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add lagged history columns.

    ``order[0]`` is the season at which rolling means restart; the whole of
    ``order`` must be unique per entity. ``key_source`` is a cheaper table with
    the same entity column for the hot-entity check; ``hot_rows=None`` skips the
    check where the rows per entity are bounded by the calendar.
    """
    spec = (dict(lags or {}), dict(rolls or {}), dict(ewms or {}), prior)
    key = F.col(quoted(entity))
    columns = [*df.columns, *_outputs(spec)]
    counted = key_source if key_source is not None else df
    longest = None if hot_rows is None else entity_rows(counted, entity).agg(F.max("n")).first()[0] or 0
    if longest is None or longest <= hot_rows:
        known = longest if key_source is None else None  # another table may hold fewer rows
        return _plain(df, entity, order, spec, known).select(*_quoted(columns))
    hot = stored(hot_entities(counted, entity, hot_rows), "hot")
    df = durable(df)
    listed = hot.withColumnRenamed("entity", "__hot")
    is_hot = key == F.col("__hot")
    cold = _plain(df.join(listed, is_hot, "left_anti"), entity, order, spec)
    split = _blocked(df.join(listed, is_hot, "left_semi"), entity, order, spec, hot_rows)
    return cold.select(*_quoted(columns)).unionByName(split.select(*_quoted(columns)))


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def _outputs(spec) -> list[str]:
    lags, rolls, ewms, prior = spec
    return [*lags, *rolls, *ewms, *([prior] if prior else [])]


def _plain(df: DataFrame, entity: str, order: Sequence[str], spec, longest: int | None = None) -> DataFrame:
    key = F.col(quoted(entity))
    spread = F.when(key.isNull(), F.pmod(F.xxhash64(*_quoted(order)), F.lit(100_003)))
    df = df.withColumn(_SPREAD, spread)
    by_entity = Window.partitionBy(key, _SPREAD).orderBy(*_quoted(order))
    df = df.withColumn(_POS, F.row_number().over(by_entity).cast("long") - 1)
    df = _windowed(df, [entity, _SPREAD], order, spec, longest)
    return df.withColumns(
        {c: F.when(key.isNotNull(), F.col(quoted(c))) for c in _outputs(spec)}
    )


def _windowed(df: DataFrame, parts: Sequence[str], order: Sequence[str], spec, longest: int | None = None) -> DataFrame:
    lags, rolls, ewms, prior = spec
    keys, ordering = _quoted(parts), _quoted(order)
    by_entity = Window.partitionBy(*keys).orderBy(*ordering)
    in_season = Window.partitionBy(*keys, ordering[0]).orderBy(*ordering[1:])
    added = {out: F.lag(quoted(col)).over(by_entity) for out, col in lags.items()}
    for out, (col, width) in rolls.items():
        added[out] = F.avg(quoted(col)).over(in_season.rowsBetween(-width, -1))
    if prior:
        added[prior] = F.col(_POS)
    if added:
        df = df.withColumns(added)
    for out, (col, span) in ewms.items():
        short = longest is not None and 0 < longest <= ewm_segment(span) and span > 1
        df = (_short_ewm if short else _ewm)(df, keys, ordering, out, col, span)
    return df


def _short_ewm(df: DataFrame, keys, ordering, out: str, col: str, span: float) -> DataFrame:
    """``_ewm`` where every history fits one segment: plain running sums in the order of the other windows."""
    value = F.col(quoted(col)).cast("double")
    weight = F.when(value.isNotNull(), F.pow(F.lit(1.0 / (1.0 - 2.0 / (span + 1.0))), F.col(_POS)))
    before = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({_WEIGHT: weight, _TERM: weight * value})
    return df.withColumn(out, F.sum(_TERM).over(before) / F.sum(_WEIGHT).over(before)).drop(_WEIGHT, _TERM)


def _ewm(df: DataFrame, keys, ordering, out: str, col: str, span: float) -> DataFrame:
    """Adjusted exponentially weighted mean of the earlier values.

    Weights are powers relative to the start of a segment; a value older than
    the segment before weighs less than e^-250 of the newest one, far below the
    resolution of a double. Null values keep their place but carry no weight.
    """
    decay = 1.0 - 2.0 / (span + 1.0)
    value = F.col(quoted(col)).cast("double")
    before = Window.partitionBy(*keys).orderBy(_SEG, *ordering).rowsBetween(Window.unboundedPreceding, -1)
    segment = ewm_segment(span)
    df = df.withColumn(_SEG, F.floor(F.col(_POS) / segment))
    latest = f"__e_{out}"
    if decay <= 0:
        df = df.withColumn(latest, value)
    else:
        place = F.col(_POS) - F.col(_SEG) * segment
        weight = F.when(value.isNotNull(), F.pow(F.lit(1.0 / decay), place))
        df = df.withColumns({_WEIGHT: weight, _TERM: weight * value})
        within = (
            Window.partitionBy(*keys, _SEG)
            .orderBy(*ordering)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        previous = Window.partitionBy(*keys).orderBy(_SEG).rangeBetween(-1, -1)
        df = df.withColumns({c + "_in": F.sum(c).over(within) for c in (_WEIGHT, _TERM)})
        # The total of the segment before is its last running sum; built on the
        # first window, this one reuses its sort.
        df = df.withColumns({c + "_back": F.max_by(c + "_in", _POS).over(previous) for c in (_WEIGHT, _TERM)})

        def total(c: str) -> Column:
            older = F.coalesce(F.col(c + "_back"), F.lit(0.0)) * F.lit(decay**segment)
            return F.col(c + "_in") + older

        df = df.withColumn(latest, F.when(value.isNotNull(), total(_TERM) / total(_WEIGHT)))
    return df.withColumn(out, F.last(latest, ignorenulls=True).over(before))


def _blocked(df: DataFrame, entity: str, order: Sequence[str], spec, block_rows: int) -> DataFrame:
    """History of hot entities in blocks of consecutive rows with a look-back."""
    lags, rolls, ewms, prior = spec
    reach = max(
        [1 if lags else 0]
        + [width for _, width in rolls.values()]
        + [2 * ewm_segment(span) for _, span in ewms.values()]
    )
    block = max(block_rows, reach, 1)
    placed = running_before(df, [entity], list(order)).withColumnRenamed("before", _POS).drop("total")
    home = F.floor(F.col(_POS) / block)
    tail = F.col(_POS) - home * block >= block - reach
    copies = (
        placed.withColumn(_BLOCK, F.explode(F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))))
        .withColumn(_OWN, F.col(_BLOCK) == home)
    )
    done = _windowed(copies, [entity, _BLOCK], order, spec)
    out = done.where(_OWN)
    if not ewms:
        return out
    # A block whose look-back holds only nulls takes the last mean of an earlier block.
    ends = out.groupBy(F.col(quoted(entity)), F.col(_BLOCK)).agg(
        *[F.max_by(f"__e_{o}", F.when(F.col(f"__e_{o}").isNotNull(), F.col(_POS))).alias(f"__end_{o}") for o in ewms]
    )
    earlier = (
        Window.partitionBy(F.col(quoted(entity))).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        F.col(quoted(entity)),
        F.col(_BLOCK),
        *[F.last(f"__end_{o}", ignorenulls=True).over(earlier).alias(f"__carry_{o}") for o in ewms],
    )
    out = out.join(carried, [entity, _BLOCK], "left")
    return out.withColumns({o: F.coalesce(F.col(o), F.col(f"__carry_{o}")) for o in ewms})
