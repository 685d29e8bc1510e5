"""Relational operators: firewall log join, per-source counts, group count + arg-max.

Joins are plain equi-joins: Catalyst picks broadcast-hash only when the statistics (or
AQE's runtime sizes) put a side under the broadcast threshold, otherwise sort-merge, and
AQE's skew-join rule splits a hot key's partition. Aggregates are partial + final, so a
hot group never reaches the shuffle as more than one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.text import strip_last_component


def lines_containing(lines: DataFrame, marker: str, value_col: str = "value") -> DataFrame:
    """Raw lines that contain ``marker`` anywhere (case-sensitive)."""
    return lines.where(F.col(value_col).contains(marker))


def strip_endpoints(trace: DataFrame, cols=("src", "dst")) -> DataFrame:
    """Drop the last dot component (the port) of the address columns."""
    out = trace
    for c in cols:
        out = out.withColumn(c, strip_last_component(c))
    return out


def firewall_log(trace: DataFrame, blocks: DataFrame, key: str = "conn_id") -> DataFrame:
    """Connections joined with their firewall action -> tm, conn_id, src, dst, action.

    Inner join: a connection id repeated on both sides multiplies, as a join does.
    """
    t = strip_endpoints(trace.select("tm", key, "src", "dst"))
    return t.join(blocks.select(key, "action"), on=key, how="inner").select(
        "tm", key, "src", "dst", "action")


def count_by(df: DataFrame, key: str, out_col: str = "n") -> DataFrame:
    """Rows per key (partial + final aggregate)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out_col))


def group_total_join_back(df: DataFrame, group_col: str, out_col: str = "n") -> DataFrame:
    """Every row with the size of its group.

    The group sizes are an aggregate (one row per group) joined back on the group key.
    A windowed ``count() over (partition by g)`` would put a hot group in one task; the
    join lets AQE broadcast the aggregate when it is small at run time, or split a hot
    key's partition with its skew-join rule when it is not. The null group is a group.
    """
    totals = count_by(df, group_col, out_col).withColumnRenamed(group_col, "_group")
    joined = df.join(totals, F.col(group_col).eqNullSafe(F.col("_group")), how="inner")
    return joined.select(*df.columns, out_col)


def group_count_argmax(df: DataFrame, group_col: str, id_col: str, score_col: str) -> DataFrame:
    """grp, n, best_id, best_score: rows per group and the row with the largest score.

    Two hash aggregates: count and largest score per group, then the smallest id among the
    rows that have that score (joined back; the null group is a group). Rows with a null
    score are counted but cannot win; NaN is larger than any number, as in SQL.
    """
    rows = df.select(F.col(group_col).alias("grp"), F.col(id_col).alias("_id"), F.col(score_col).alias("_score"))
    totals = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("_score").alias("best_score"))
    tops = totals.select(F.col("grp").alias("_g"), F.col("best_score").alias("_top"))
    winners = (rows.join(tops, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("_score") == F.col("_top")), "inner")
               .groupBy(F.col("grp").alias("_wg")).agg(F.min("_id").alias("best_id")))
    return (totals.join(winners, F.col("grp").eqNullSafe(F.col("_wg")), "left")
            .select("grp", "n", "best_id", "best_score"))
