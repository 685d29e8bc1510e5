"""Ranking: top-k by distinct count with ties, and global orders with a tie-break.

``top_k_distinct`` never moves the counted rows to one task. It reduces the counts to
their distinct values (a partial aggregate, tiny for count-like columns), keeps the k
largest with a TakeOrdered of k rows, and broadcasts those k values - a side whose size is
bounded by the parameter k - into a hash join with the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k_distinct(counts: DataFrame, value_col: str = "n", k: int = 10) -> DataFrame:
    """Rows whose ``value_col`` is among the k largest distinct values (all ties kept)."""
    if k <= 0:
        raise ValueError("k must be positive")
    cut = counts.select(value_col).distinct().orderBy(F.desc(value_col)).limit(k)
    return counts.join(F.broadcast(cut), on=value_col, how="inner")


def order_by_count(df: DataFrame, count_col: str = "n", *tie_break: str) -> DataFrame:
    """Global order: count descending, then the tie-break columns ascending.

    A range-partitioned sort (sampled bounds), so the order scales with the data.
    """
    return df.orderBy(F.desc(count_col), *[F.asc(c) for c in tie_break])
