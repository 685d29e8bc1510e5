"""Byte ranges of files as a data source: ``spark.read.format("byte_range")``.

The session's Hadoop file systems list the files and resolve them (a mount of a view file system becomes
the store behind it), so a path means what it means to every other reader of the session. Each piece
of a file's range is an input partition: its task opens the file, seeks, and reads that piece alone.
Files of stores that only the JVM can open are read with Spark's binary reader, whole, and cut.

Columns: ``path string, offset bigint, content binary``; the pieces of a file, put together by offset,
are its bytes ``[offset, offset + length)`` as far as it goes. A file that ends before has no row.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, offset bigint, content binary"
PIECE = 1 << 20             # bytes of one row
ROWS_PER_PARTITION = 64     # pieces read by one task, one after the other
#: Stores that Arrow opens without the JVM; hdfs needs the cluster's native library.
OPENED_BY_ARROW = ("file", "s3", "s3a", "gs", "abfs", "abfss", "hdfs")


@dataclass
class Pieces(InputPartition):
    """Pieces of one file that one task reads: its name, where it is, and from where to where."""

    path: str
    uri: str
    start: int
    end: int


def open_store(uri: str):
    """(file system, path in it) of a URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class ByteRangeReader(DataSourceReader):
    def __init__(self, files, offset: int, length: int, piece: int):
        self.files, self.offset, self.length, self.piece = files, offset, length, piece

    def partitions(self):
        step = self.piece * ROWS_PER_PARTITION
        out = []
        for path, uri, size in self.files:
            end = min(size, self.offset + self.length)
            out += [Pieces(path, uri, at, min(at + step, end)) for at in range(self.offset, end, step)]
        return out or [Pieces("", "", 0, 0)]

    def read(self, part):
        if part.end <= part.start:
            return
        store, inner = open_store(part.uri)
        with store.open_input_file(inner) as f:
            for at in range(part.start, part.end, self.piece):
                f.seek(at)
                yield part.path, at, f.read(min(self.piece, part.end - at))


class ByteRangeSource(DataSource):
    """Options: ``files`` (JSON of [path, uri, size]), ``offset``, ``length``, ``piece``."""

    @classmethod
    def name(cls):
        return "byte_range"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        o = self.options
        return ByteRangeReader(json.loads(o["files"]), int(o["offset"]), int(o["length"]), int(o.get("piece", PIECE)))


def list_files(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(path, URI of the store behind it, size) of the files that ``path`` (a file, folder or pattern) names.

    As with Spark's readers, folders are read to any depth and names with a leading ``_`` or ``.`` are skipped.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    start = jvm.org.apache.hadoop.fs.Path(path)
    store = start.getFileSystem(conf)
    found, todo = [], list(store.globStatus(start) or [])
    if not todo:
        raise FileNotFoundError(path)
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [s for s in store.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
        else:
            found.append((status.getPath().toString(), store.resolvePath(status.getPath()).toString(), status.getLen()))
    return sorted(found)


def read_byte_range(spark: SparkSession, path: str, offset: int, length: int, piece: int = PIECE,
                    opened_by_arrow=OPENED_BY_ARROW) -> DataFrame:
    """The bytes ``[offset, offset + length)`` of every file -> path, offset, content binary.

    Neither a file's size nor the range's is bounded by a row: a row holds at most ``piece`` bytes, and only
    the range is read. Files of stores that only the JVM opens (``opened_by_arrow`` does not name their
    scheme) go through Spark's binary reader, which reads them whole and takes files up to 2 GB.
    """
    if offset < 0 or length < 0 or piece < 1:
        raise ValueError("offset and length must not be negative, piece must be positive")
    files = list_files(spark, path)
    direct = [f for f in files if f[1].split(":", 1)[0] in opened_by_arrow]
    whole = [f[0] for f in files if f[1].split(":", 1)[0] not in opened_by_arrow and f[2] > offset]
    spark.dataSource.register(ByteRangeSource)
    out = (spark.read.format(ByteRangeSource.name()).option("files", json.dumps(direct)).option("offset", offset)
           .option("length", length).option("piece", piece).load())
    if whole:
        cut = (spark.read.format("binaryFile").load(whole)
               .select("path", F.expr(f"substring(content, {offset + 1}, {length})").alias("_c")).where("length(_c) > 0"))
        at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.length("_c").cast("bigint") - 1, F.lit(piece).cast("bigint")))
        out = out.unionByName(cut.select("path", "_c", at.alias("_at")).select(
            "path", (F.col("_at") + offset).alias("offset"), F.expr(f"substring(_c, cast(_at as int) + 1, {piece})").alias("content")))
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no install
