"""Text operators: line counts, sentence-aware bigram counts, whitespace word counts.

All tokenising is done with regex and array expressions inside the scan stage (no shuffle, no
UDF); the only exchange is the count's, which Spark plans as a partial (map-side)
aggregate followed by a final one, so a hot word or bigram collapses to one row per task
before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.text import java_ws_words, line_bigrams, split_lines


def line_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Number of lines per text value -> id, n_lines."""
    return docs.select(F.col(id_col), F.size(split_lines(text_col)).cast("bigint").alias("n_lines"))


def bigrams(lines: DataFrame, line_col: str = "line", out_col: str = "bigram") -> DataFrame:
    """One row per bigram occurrence.

    Per line: lower-case, cut into sentences after tokens ending in ``. ! ?``, clean each
    token to ``[a-z0-9]`` and drop empty ones, then pair consecutive words. Bigrams never
    cross a line or a sentence end; a pure-punctuation token neither emits nor breaks.
    A value holding several lines (a whole document) gives the bigrams of its lines.
    """
    return lines.select(F.explode(line_bigrams(line_col)).alias(out_col))


def bigram_count(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """bigram, n: occurrences of each bigram over all lines."""
    return bigrams(lines, line_col).groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


def words(lines: DataFrame, line_col: str = "line", out_col: str = "word") -> DataFrame:
    """One row per word as a ``\\s+`` split gives it (no lower-casing, no stripping)."""
    return lines.select(F.explode(java_ws_words(line_col)).alias(out_col))


def word_count(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """word, n: occurrences per word, unsorted (sort with ``ranking.order_by_count``)."""
    return words(lines, line_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
