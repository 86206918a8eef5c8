"""Session helpers: local session, shared scratch space, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side at or below this many rows may be broadcast; above it the join shuffles.
BROADCAST_ROWS = 500_000
# And so many bytes of compressed files.
BROADCAST_BYTES = 64 << 20


def local_session(cpus: int | str = 8, name: str = "stintframe") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Call-site capture for every column expression slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Local sessions without that setting get a temporary folder; a cluster
    without it is an error, because executors could not reach a local path.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured is None and current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="stintframe-")
    if current is None:
        sc.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared folder."""
    return f"{scratch_root(spark)}/stintframe-{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage.

    Used where later steps must all see one and the same computation, such as
    range chunk numbers, or where a small derived table feeds several joins. As
    Parquet it is computed once, and later steps read only their columns.
    """
    return stored(df, "durable")


def file_bytes(df: DataFrame) -> int:
    """Size of the files under a scan, as the optimizer knows it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Materialise a derived join side and mark it for broadcast if it is small.

    The size is measured, not assumed: bytes by the files written, rows by their
    footers. Beyond either bound the table is returned without a hint and the join
    shuffles (with AQE skew handling).
    """
    held = durable(df)
    if file_bytes(held) <= max_bytes and held.count() <= max_rows:
        return F.broadcast(held)
    return held
