"""Sinks: text pairs (``k<TAB>v`` or ``(k,v)``), space-joined records, parquet.

Writers keep the partitioning they are given: a range-partitioned, sorted DataFrame
(``total_order_sort``, ``orderBy``) is written one range per file in order. A file
count is forced only when asked for, and then by range when an order is given so the
files stay globally ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tab_pairs(df: DataFrame, key, value) -> DataFrame:
    """``key<TAB>value`` lines (a text output format's record)."""
    return df.select(F.concat_ws("\t", _c(key).cast("string"), _c(value).cast("string")).alias("value"))


def tuple_pairs(df: DataFrame, key, value) -> DataFrame:
    """``(key,value)`` lines (how a pair prints when saved as text)."""
    return df.select(F.format_string("(%s,%s)", _c(key).cast("string"), _c(value).cast("string"))
                     .alias("value"))


def space_joined(df: DataFrame, *cols) -> DataFrame:
    """Fields joined by single spaces (the reference's hand-built records)."""
    return df.select(F.concat_ws(" ", *[_c(c).cast("string") for c in cols]).alias("value"))


def _shape(df: DataFrame, num_files: int | None, order_by) -> DataFrame:
    if not num_files:
        return df
    if order_by:
        return df.repartitionByRange(num_files, *order_by).sortWithinPartitions(*order_by)
    return df.repartition(num_files)


def write_lines(lines: DataFrame, path: str, num_files: int | None = None, order_by=(),
                mode: str = "overwrite", partition_by=()) -> None:
    """Write a one-string-column DataFrame as text files."""
    out = _shape(lines, num_files, list(order_by))
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)


def write_pairs(df: DataFrame, path: str, key=None, value=None, style: str = "tab",
                num_files: int | None = None, order_by=(), mode: str = "overwrite") -> None:
    """Write pairs as ``tab`` text, ``tuple`` text or ``parquet`` (all columns kept).

    With ``order_by`` and ``num_files`` the rows are range-partitioned into that many
    sorted files; without, the DataFrame's own partitioning (and order) is written.
    """
    if style == "parquet":
        _shape(df, num_files, list(order_by)).write.mode(mode).parquet(path)
        return
    if key is None or value is None:
        key, value = df.columns[0], df.columns[1]
    shaped = _shape(df, num_files, list(order_by))
    lines = tab_pairs(shaped, key, value) if style == "tab" else tuple_pairs(shaped, key, value)
    lines.write.mode(mode).text(path)
