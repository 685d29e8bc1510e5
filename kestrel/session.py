"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "kestrel", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller owns the session."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session (driver and executors in one process, as in tests) may name none; it
    gets a private folder. On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def sized_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session of its own on the same context, with the caller's settings, that reads at most ``split_bytes`` of a file a task.

    For eager jobs only: its DataFrames cannot be joined to those of the caller's session. The caller's
    settings stay as they are, and a smaller ``spark.sql.files.maxPartitionBytes`` of the caller holds.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value and (spark.conf.isModifiable(key) or not key.startswith("spark.")):
            own.conf.set(key, value)
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(own.conf.get("spark.sql.files.maxPartitionBytes")) > split_bytes:
        own.conf.set("spark.sql.files.maxPartitionBytes", f"{split_bytes}b")
    return own


def sized_read(spark: SparkSession, split_bytes: int, read: Callable[[SparkSession], DataFrame]) -> DataFrame:
    """``read(session)`` as a DataFrame of ``spark`` whose files are read in splits of at most ``split_bytes``.

    A file scan is split as the session says that opened the files, so a sized session opens them and
    hands its plan over by a global temporary view, which is gone on return. A format may have larger
    units that are read whole (row groups, files in gzip).
    """
    own = sized_session(spark, split_bytes)
    name = f"sized_{uuid.uuid4().hex}"
    read(own).createGlobalTempView(name)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)
