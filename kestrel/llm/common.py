"""Small helpers shared by the corpus operators: tables, shared-folder checkpoints, column names."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session (driver and executors in one process) may leave it unset; it then
    gets a private folder, as in the tests. On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kestrel-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder (lineage cut)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables of one job in a folder of the shared file system, each removed as soon as it is of no more use.

    ``cut`` writes a table (Parquet, so that a lost executor only reads it again) and ``drop`` removes it; ``release``
    also lets Spark remove the shuffle files of what has run, which it does when nothing refers to them any more.
    ``close`` removes the folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n, self.places = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}", 0, {}

    def cut(self, df: DataFrame) -> DataFrame:
        path, self.n = f"{self.folder}/{self.n}", self.n + 1
        df.write.parquet(path)
        out = self.spark.read.parquet(path)
        self.places[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            if t is not None:
                drop_folder(self.spark, self.places.pop(id(t))[1])

    def release(self) -> None:
        release(self.spark)

    def close(self) -> None:
        self.places.clear()
        drop_folder(self.spark, self.folder)
        self.release()


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


BATCH_ROWS = 2_000


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches cut to at most ``BATCH_ROWS`` rows.

    Whole texts and pages are large rows: a smaller batch bounds what the JVM and a Python
    worker hold at a time. A session that asks for less keeps its own number.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


BROADCAST_ROWS = 500_000


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is.

    For narrow tables of ids that are cheap to count (written before, with ``cut``). Beyond the
    bound the join is a plain one, which shuffles both sides.
    """
    return F.broadcast(df) if df.count() <= rows else df
