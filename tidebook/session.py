"""Session factory with the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "tidebook", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A session in UTC, with AQE and strict JSON settings; keyword arguments add Spark settings.

    Underscores in keyword names stand for dots (``spark_sql_shuffle_partitions="8"``).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if "SPARK_MASTER" not in os.environ:
        builder = builder.master(f"local[{cpus}]")
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


_own: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share, below ``spark.checkpoint.dir``. Only in local mode may
    the setting be absent: a temporary folder takes its place."""
    app, found = spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="tidebook-")
        found = _own[app]
    return f"{found.rstrip('/')}/tidebook/{app}"
