"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # without it every column expression records its call site, several calls to the JVM each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Largest row count that is sent to every executor. Only narrow rows are broadcast this way
# (ids, hashes, lengths: under 150 bytes each), so it stays below about 75 MB.
BROADCAST_ROWS = 500_000

_test_folders: dict[str, str] = {}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _test_folders:
        _test_folders[app] = tempfile.mkdtemp(prefix="flightloom-")
    return _test_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later plans start from files: nothing is recomputed when an executor is lost, and the
    optimizer knows the real size.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(settled: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a settled DataFrame is small enough for a broadcast (footer count only)."""
    return settled.count() <= max_rows
