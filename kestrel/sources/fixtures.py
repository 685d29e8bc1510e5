"""Inputs of the operators, derived from the driver's tables (see FIXTURES.md §2).

The reference reads raw text files; here the same record shapes are built from the
parquet tables so that every query grows with the data. Each derivation is linear in its
input (no all-pairs step) and is mirrored by the SQL in ``kestrel.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.text import explode_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines``: one row per line of every document -> doc_id, line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return explode_lines(docs, "text", keep=["doc_id"])


def kv_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kv``: k = md5 of the order key as text, v = the order key as text."""
    key = F.col("o_orderkey").cast("string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.select(F.md5(key).alias("k"), key.alias("v"))


def kv_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kv_skewed``: k = every line of each document, v = ``<doc_id>:<line number>``.

    Many first characters, very uneven and often non-ASCII, and repeated lines: the hard case
    for a first-char range partition.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = explode_lines(docs, "text", keep=["doc_id"], line_col="k", number_col="_n")
    return lines.select("k", F.concat_ws(":", F.col("doc_id").cast("string"), F.col("_n").cast("string")).alias("v"))


def kv_lines(spark: SparkSession, sf_dir: str, sep: str = "\t") -> DataFrame:
    """``kv`` as text lines ``k<sep>v`` (``value string``)."""
    kv = kv_pairs(spark, sf_dir)
    return kv.select(F.concat_ws(sep, "k", "v").alias("value"))


def ip_trace_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ip_trace``: ``time conn_id src > dst`` lines from events."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    tm = F.regexp_replace(F.col("ts").cast("string"), " ", "T")
    src = F.concat_ws(".", F.lit("10.0"), F.expr("user_id div 50").cast("string"),
                      (F.col("user_id") % 50).cast("string"),
                      (F.lit(1024) + F.col("event_id") % 1000).cast("string"))
    dst = F.concat_ws(".", F.lit("192.168"), (F.col("event_id") % 7).cast("string"),
                      (F.col("event_id") % 50).cast("string"), F.lit("80"))
    return e.select(F.concat_ws(" ", tm, F.col("event_id").cast("string"), src, F.lit(">"), dst)
                    .alias("value"))


def raw_block_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_block``: ``conn_id action`` lines; action is Blocked for error events."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    action = F.when(F.col("event_type") == "error", F.lit("Blocked")).otherwise(F.lit("Allowed"))
    return e.select(F.concat_ws(" ", F.col("event_id").cast("string"), action).alias("value"))


def repo_csv_lines(spark: SparkSession, sf_dir: str, malformed: bool = False) -> DataFrame:
    """``repo``: 13-column comma lines from part; 0 = repo, 1 = language, 12 = stars.

    ``malformed``: the stars of small parts are text, those of large parts are blank.
    """
    p = table(spark, sf_dir, "part")
    stars = F.col("p_retailprice").cast("string")
    if malformed:
        stars = F.when(F.col("p_size") <= 5, F.lit("N/A")).when(F.col("p_size") > 45, F.lit("")).otherwise(stars)
    fields = [F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_name"),
              F.col("p_type"), F.col("p_size").cast("string")]
    fields += [F.lit("")] * 7
    fields.append(stars)
    return p.select(F.concat_ws(",", *fields).alias("value"))


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``edges``: one ``part customer`` line per line item, in one shared id space.

    Each line item links its part with the customer of its order: an n:1 join on the
    order key, so the graph is linear in the data (duplicates and self-loops are left in
    for the edge-list parser to canonicalise).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(F.concat_ws(" ", F.col("l_partkey").cast("string"),
                                F.col("o_custkey").cast("string")).alias("value"))


def document_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bytes``: doc_id and the UTF-8 bytes of the text (``content binary``)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.encode("text", "UTF-8").alias("content"))
