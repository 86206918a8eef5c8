"""Feature matrix for training, and for one race to be predicted."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.frame import HISTORY_COLUMNS, add_lag_features, normalise_teams, race_frame
from ..operators.history import HOT_ROWS
from ..operators.prep import (
    Preprocessors,
    drop_unplaced,
    encode,
    fit_encoders,
    fit_numeric,
    impute,
    null_report,
    rows_with_nulls,
    scale,
)
from ..schemas import (
    DRIVER_KEYS,
    FEATURE_COLUMNS,
    FINAL_FEATURES,
    ID_COLUMNS,
    NUMERIC_SCALE_FEATURES,
    TEAM_RENAMES,
    quoted,
)
from ..session import durable, small_side
from ..sources.sinks import read_seasons, write_seasons
from ..sources.tables import load_sources
from .ingest import run_ingestion

RAW_ROUND = "round_raw"


def _project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    wanted = list(dict.fromkeys(columns))
    return df.select(*[F.col(quoted(c)) for c in wanted if c in df.columns])


def lagged_frame(
    tables: Mapping[str, DataFrame],
    *,
    ewm_span: float = 5,
    roll_window: int = 3,
    renames: Mapping[str, str] = TEAM_RENAMES,
    lap_keys: Iterable[str] = DRIVER_KEYS,
    hot_rows: int | None = HOT_ROWS,
    check_boundary: bool = True,
    starters: DataFrame | None = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Race frame with normalised teams and all lag features.

    ``columns`` limits the result to those listed; others are not even joined or
    shuffled. With ``starters`` only the drivers listed there keep their history, and only
    their laps are aggregated; team form still comes from everybody.
    """
    laps = tables["laps"]
    if starters is not None:
        starters = small_side(starters.select("DriverId"))
        same = F.col("DriverId").eqNullSafe(F.col("__starter"))
        listed = starters.withColumnRenamed("DriverId", "__starter")
        entries = tables["driver_info"].join(listed, same, "left_semi").select(*lap_keys).distinct()
        laps = laps.join(small_side(entries), list(lap_keys), "left_semi")
    frame = race_frame(
        tables["session_info"],
        tables["driver_info"],
        tables["session_results"],
        laps,
        lap_keys=list(lap_keys),
    )
    frame = normalise_teams(frame, renames)
    if columns is not None:
        columns = list(columns)
        frame = _project(frame, [*columns, *HISTORY_COLUMNS])
    lagged = add_lag_features(
        frame,
        ewm_span=ewm_span,
        roll_window=roll_window,
        hot_rows=hot_rows,
        check_boundary=check_boundary,
        starters=starters,
    )
    return lagged if columns is None else _project(lagged, columns)


def build_features(
    tables: Mapping[str, DataFrame],
    *,
    fit_scope: str = "all",
    test_year: int = 2025,
    **lag_options,
) -> tuple[DataFrame, Preprocessors]:
    """Training matrix and the fitted preprocessors.

    Order matters: teams are normalised before any team window; lags and the
    encoders see every row; rows without a target are dropped before medians and
    scales are fitted. ``fit_scope="train"`` fits medians and scales without the
    test season. The standardised ``round_number`` is kept as in the published
    matrix, with the calendar round next to it as ``round_raw``.
    """
    frame = lagged_frame(tables, columns=FEATURE_COLUMNS, **lag_options)
    frame = durable(frame.withColumn(RAW_ROUND, F.col("round_number").cast("int")))
    seen = frame if fit_scope == "all" else frame.where(F.col("year") != test_year)
    encoders = fit_encoders(frame)
    placed = drop_unplaced(frame)
    numeric = fit_numeric(drop_unplaced(seen))
    matrix = scale(impute(encode(placed, encoders), numeric), numeric)
    return matrix, Preprocessors(encoders, numeric)


def build_inference_features(
    tables: Mapping[str, DataFrame],
    target_year: int,
    target_round: int,
    preprocessors: Preprocessors,
    *,
    strict: bool = True,
    fill: bool = True,
    **lag_options,
) -> DataFrame:
    """Features of one race from its past only, with fitted parameters.

    The race's own outcome is masked before any lag is computed. Classes not
    seen in fitting always raise. Null features raise if ``strict``; otherwise
    they are filled with the persisted medians, or left null if not ``fill``.
    """
    past = {
        t: df.where(F.col("year") <= target_year) if "year" in df.columns else df
        for t, df in tables.items()
    }
    is_target = (F.col("year") == target_year) & (F.col("round_number") == target_round)
    results = past["session_results"]
    if results.where(is_target).isEmpty():
        raise ValueError(f"no race data for year={target_year}, round_number={target_round}")
    past["session_results"] = results.withColumn("Position", F.when(~is_target, F.col("Position")))
    starters = past["driver_info"].where(is_target).select("DriverId").distinct()
    wanted = [*ID_COLUMNS, *FINAL_FEATURES]
    rows = durable(lagged_frame(past, starters=starters, columns=wanted, **lag_options).where(is_target))
    coded = encode(rows, preprocessors.encoders, strict=True)
    missing = null_report(coded, NUMERIC_SCALE_FEATURES).where("nulls > 0").collect()
    if missing and strict:
        who = [r["DriverId"] for r in rows_with_nulls(coded, NUMERIC_SCALE_FEATURES, ["DriverId"]).limit(50).collect()]
        counts = {r["column"]: r["nulls"] for r in missing}
        raise ValueError(f"null features {counts} for drivers {who}")
    filled = impute(coded, preprocessors.numeric) if fill else coded
    return scale(filled.withColumn(RAW_ROUND, F.lit(target_round)), preprocessors.numeric)


def split_by_season(df: DataFrame, test_year: int = 2025) -> tuple[DataFrame, DataFrame]:
    """Train is every other season, later ones included; test is the held-out one."""
    return df.where(F.col("year") != test_year), df.where(F.col("year") == test_year)


def drop_from_race(train: DataFrame, year: int, round_number: int) -> DataFrame:
    """Training rows without the target race and the rest of its season."""
    return train.where(~((F.col("year") == year) & (F.col(RAW_ROUND) >= round_number)))


def run_feature_engineering(
    spark: SparkSession,
    data_root: str,
    output_path: str,
    *,
    years: Iterable[int] | None = None,
    preprocessors_path: str | None = None,
    layout: str = "table",
    **options,
) -> str:
    """Read, build, write the matrix by season and, if asked, the parameters."""
    tables = load_sources(spark, data_root, years, layout=layout)
    matrix, fitted = build_features(tables, **options)
    write_seasons(matrix, output_path)
    if preprocessors_path is not None:
        fitted.write(preprocessors_path)
    return output_path


def split_train_test(spark: SparkSession, features_path: str, out_dir: str, *, test_year: int = 2025) -> tuple[DataFrame, DataFrame]:
    """Write ``train`` and ``test`` as season stores; from a season store each season is read once."""
    matrix = spark.read.parquet(features_path)
    parts = zip(("train", "test"), split_by_season(matrix, test_year))
    train, test = (read_seasons(spark, write_seasons(df, f"{out_dir}/{name}"), matrix.schema) for name, df in parts)
    return train, test


def run_modules(
    spark: SparkSession,
    landing_root: str,
    output_root: str,
    *,
    years: Iterable[int] | None = None,
    module: str = "all",
    test_year: int = 2025,
    **options,
) -> None:
    """Ingestion (``data``), features and split (``fe``), or both (``all``)."""
    if module not in ("data", "fe", "all"):
        raise ValueError(f"invalid module {module!r}; choose from: all, data, fe")
    if module in ("data", "all"):
        run_ingestion(spark, landing_root, output_root, years)
    if module in ("fe", "all"):
        path = run_feature_engineering(
            spark,
            output_root,
            f"{output_root}/features",
            years=years,
            preprocessors_path=f"{output_root}/features_preprocessors",
            **options,
        )
        split_train_test(spark, path, output_root, test_year=test_year)
