"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables.

    A cluster names it in `spark.checkpoint.dir`; only a local session without that
    setting (tests on one machine) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="zonetally-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder nobody else writes to."""
    return f"{scratch_root(spark)}/zonetally/{name}-{uuid.uuid4().hex}"


def store(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the scratch folder: computed once, safe from lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a dimension up to which it is broadcast. They are counted first; larger ones are joined by shuffle.
MOST_BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """The table, marked for broadcast if it really has few rows."""
    return F.broadcast(df) if df.limit(MOST_BROADCAST_ROWS + 1).count() <= MOST_BROADCAST_ROWS else df


def build_session(app: str = "zonetally", master: str | None = None, partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Session as the operators expect it: UTC, AQE with skew handling."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """What the operators need from a session that somebody else built.

    Times are read in UTC. The package is shipped to the executors, since a few
    operators run its Python code in tasks. Batches for that code have fewer rows
    than by default, since rows can hold long texts; another setting is left as it is.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")
    _ship_package(spark)
    return spark


_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
