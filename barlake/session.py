"""Spark session and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    # Call-site capture for error messages costs several JVM round trips per
    # Column function call while a plan is built; plans here are built from
    # hundreds of expressions, so it is off. (A static setting: it applies to
    # sessions built here, not to a session handed in.)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "barlake", **conf) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster pass no master; the submitter decides. Size
    ``spark.sql.shuffle.partitions`` to a few times the total core count
    (e.g. 3 x 8000 on 1000 eight-core executors) and let AQE coalesce toward
    the 256 MB advisory size and split skewed partitions; scans split
    files at 256 MB. Locally the partition count should follow the core
    count, not Spark's 200.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators rely on to a session."""
    # Writers pass overwrite mode and codec per write; only settings the
    # operators' semantics and plans rely on are applied to a given session.
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled",
    ):
        spark.conf.set(key, _DEFAULT_CONF[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset and the master is local (one
    machine, as in tests) is a private folder created, registered, and removed
    when the process ends; elsewhere executors would each write to a folder
    of their own, so an unset setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jdir.get() if jdir.isDefined() else None
    if not path:
        path = _private_dir(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def _private_dir(master: str) -> str:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"Set spark.checkpoint.dir to a folder that all executors of {master} share")
    path = tempfile.mkdtemp(prefix="barlake-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` adds a fresh component."""
    tail = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return os.path.join(shared_dir(spark), "barlake", *tail)
