"""Line-oriented sources and parsers: text lines, key/value, logs, naive CSV, edge lists.

Each parser takes a DataFrame with one line per row (column ``value`` by default, as
``spark.read.text`` gives) and returns typed columns. Parsing is pure column
expressions, so Catalyst prunes and pipelines it into the scan stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.text import JAVA_WS, split_lines


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines of one or many text files or directories (``value string``)."""
    if isinstance(paths, str):
        paths = [paths]
    return spark.read.text(list(paths))


def explode_lines(df: DataFrame, text_col: str, keep=(), line_col: str = "line",
                  number_col: str | None = None) -> DataFrame:
    """One row per line of a text column; a final line break opens no extra line."""
    keep = list(keep)
    if number_col:
        exploded = F.posexplode(split_lines(text_col)).alias(number_col, line_col)
        return df.select(*keep, exploded)
    return df.select(*keep, F.explode(split_lines(text_col)).alias(line_col))


def parse_kv_tab(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``key<TAB>value``: key before the first TAB, value the rest; no TAB -> value ''."""
    v = F.col(value_col)
    tab = F.instr(v, "\t")
    return lines.select(
        F.substring_index(v, "\t", 1).alias("k"),
        F.when(tab > 0, F.expr(f"substring(`{value_col}`, instr(`{value_col}`, '\\t') + 1)"))
        .otherwise(F.lit("")).alias("v"),
    )


def parse_kv_ws(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """First two whitespace-separated tokens; extra tokens dropped, a missing value is null."""
    parts = F.split(F.col(value_col), JAVA_WS)
    return lines.select(
        F.get(parts, 0).alias("k"),
        F.get(parts, 1).alias("v"),
    )


def split_once(lines: DataFrame, pieces, name: str = "_f") -> DataFrame:
    """``lines`` with one array column ``name`` computed once per row, inside a generator.

    Filters on fields taken from the array (including the not-null filters Spark infers
    from a join key) cannot be pushed below a generator, so they are not rewritten into
    repeated evaluations of the split over the raw line.
    """
    return lines.select(F.explode(F.array(pieces)).alias(name))


def parse_space_fields(lines: DataFrame, fields: dict, value_col: str = "value") -> DataFrame:
    """Split on single spaces and keep ``{name: (index, type)}`` fields (ANSI casts)."""
    parts = split_once(lines, F.split(F.col(value_col), " "))
    cols = []
    for name, (index, dtype) in fields.items():
        item = F.get(F.col("_f"), index)
        cols.append((item.cast(dtype) if dtype != "string" else item).alias(name))
    return parts.select(*cols)


def parse_ip_trace(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``time conn_id src <unused> dst ...`` -> tm, conn_id, src, dst."""
    return parse_space_fields(lines, {
        "tm": (0, "string"),
        "conn_id": (1, "bigint"),
        "src": (2, "string"),
        "dst": (4, "string"),
    }, value_col)


def parse_block(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``conn_id action`` -> conn_id bigint, action string."""
    return parse_space_fields(lines, {"conn_id": (0, "bigint"), "action": (1, "string")}, value_col)


def parse_csv_positional(lines: DataFrame, columns: dict, value_col: str = "value",
                         header: str | None = None) -> DataFrame:
    """Naive CSV: split on every comma (no quoting) and keep ``{name: (index, type)}``.

    Numeric fields use ``try_cast``: a blank or malformed number becomes null and its row
    stays. Only lines equal to ``header`` (the text of the header line, which every split of
    a dataset may repeat) are left out.
    """
    if header is not None:
        lines = lines.where(~F.col(value_col).eqNullSafe(F.lit(header)))
    parts = split_once(lines, F.split(F.col(value_col), ","))
    cols = []
    for name, (index, dtype) in columns.items():
        item = F.get(F.col("_f"), index)
        cols.append((item.try_cast(dtype) if dtype != "string" else item).alias(name))
    return parts.select(*cols)


def parse_edges(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Whitespace-separated vertex pair per line; blank lines skipped -> src, dst bigint.

    The tokens are extracted once (``split_once``): the blank-line test here and the
    self-loop filter later do not re-run the regex over the raw line.
    """
    tokens = F.regexp_extract_all(F.col(value_col), F.lit(r"[^ \t\n\x0B\f\r]+"), 0)
    parsed = split_once(lines, tokens, "_t")
    return (parsed.where(F.size("_t") > 0)
            .select(F.col("_t")[0].cast("bigint").alias("src"), F.col("_t")[1].cast("bigint").alias("dst")))
