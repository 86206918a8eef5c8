"""Ingestion: one Spark job per table over all landed sessions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import TableRegistry
from ..operators.cleaning import registry as default_registry
from ..sources.sinks import write_table
from ..sources.tables import read_landing, tables_for_mode

STATUS_SCHEMA = "`table` string, rows long, rejected_sessions long, status string, error string"


def run_ingestion(
    spark: SparkSession,
    landing_root: str,
    output_root: str,
    years: Iterable[int] | None = None,
    *,
    mode: str = "ml",
    active: Sequence[str] | None = None,
    registry: TableRegistry = default_registry,
) -> DataFrame:
    """Clean and write every active table; return one status row per table.

    Unknown table names fail before anything is read. After that a failing
    table does not stop the others, and a session with values that do not fit
    is left out of that table only.
    """
    names = list(active) if active is not None else tables_for_mode(mode)
    specs = {name: registry.get(name) for name in names}
    years = None if years is None else sorted(set(years))
    status = []
    for name, spec in specs.items():
        try:
            landing = read_landing(spark, landing_root, name, years)
            good, bad = spec.clean_valid(landing)
            seen = Observation(f"rows_{name}")
            write_table(good.observe(seen, F.count(F.lit(1)).alias("rows")), output_root, name)
            rejected = bad.count()
            outcome = "ok" if rejected == 0 else "partial"
            status.append((name, seen.get["rows"], rejected, outcome, None))
        except Exception as e:  # one table must not stop the others
            status.append((name, None, None, "error", f"{type(e).__name__}: {str(e)[:300]}"))
    return spark.createDataFrame(status, STATUS_SCHEMA)
