"""Spark session and shared-folder helpers.

On a cluster the session is created by the platform; ``get_session`` only
fills in settings that are still unset, so a cluster's own values win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings this library relies on. They are defaults, not overrides.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no per-Column call-site capture on the driver (it costs several JVM
    # round trips per expression built from Python)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallyho") -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TALLYHO_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one. Only on a local
    master (tests) may it be unset: then a folder under the system temp dir is
    created once per application and registered as the checkpoint dir (the
    setting itself cannot be changed at runtime). On a cluster an unset folder
    is an error, since executors could not see each other's files.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - not readable on some builds
            d = None
    if not d:
        master = spark.sparkContext.master or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        app = spark.sparkContext.applicationId
        d = _LOCAL_DIRS.get(app)
        if d is None:
            d = _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tallyho-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
