"""Sinks: record formats, ordered file counts, parquet round trip; bucket routing."""

import glob
import os

from pyspark.sql import functions as F

from kestrel import sinks
from kestrel.operators import rangesort


def _parts(path):
    out = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(f) as fh:
            out.append(fh.read().splitlines())
    return out


def test_tab_and_tuple_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    sinks.write_pairs(df, str(tmp_path / "tab"), "k", "n", style="tab", num_files=1)
    sinks.write_pairs(df, str(tmp_path / "tup"), "n", "k", style="tuple", num_files=1)
    assert sorted(x for p in _parts(str(tmp_path / "tab")) for x in p) == ["a\t1", "b\t2"]
    assert sorted(x for p in _parts(str(tmp_path / "tup")) for x in p) == ["(1,a)", "(2,b)"]


def test_ordered_file_count(spark, tmp_path):
    df = spark.range(0, 500).select(F.format_string("%04d", (F.col("id") * 37) % 500).alias("k"),
                                    F.col("id").alias("v"))
    sinks.write_pairs(df, str(tmp_path / "o"), "k", "v", num_files=4, order_by=["k"])
    parts = [p for p in _parts(str(tmp_path / "o")) if p]
    keys = [line.split("\t")[0] for p in parts for line in p]
    assert keys == sorted(keys) and len(keys) == 500 and len(parts) == 4


def test_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    sinks.write_pairs(df, str(tmp_path / "pq"), style="parquet")
    back = spark.read.parquet(str(tmp_path / "pq"))
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1), ("b", 2)]


def test_space_joined(spark):
    df = spark.createDataFrame([("t", 1, "s", "d", "Blocked")], "tm string, id long, s string, d string, a string")
    assert sinks.space_joined(df, "tm", "id", "s", "d", "a").collect()[0].value == "t 1 s d Blocked"
