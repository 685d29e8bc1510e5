"""Named end-to-end queries over the driver's tables: ``(spark, sf_dir) -> DataFrame``.

Each query wires sources -> operators with its parameters; the matching DuckDB SQL is in
``kestrel.plans.oracle``. Every computed column is aliased and cast to the same type on
both sides (counts and positions are bigint).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import sinks
from kestrel.operators import checksum, graph, rangesort, ranking, relational, text
from kestrel.plans.job_queries import JOB_QUERIES
from kestrel.plans.jobs import COUNT_SPLIT
from kestrel.session import checkpoint_dir, sized_read
from kestrel.sources import fixtures as fx
from kestrel.sources import text as src

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters (the reference's own settings where it has one).
TOP_K = 10
SORT_RANGES = None        # ranges of the total orders: the session's shuffle partitions
SAMPLE_FRACTION = 0.02    # share of keys in the first-char histogram
N_BUCKETS = 10            # equi-depth ranges
PREFIX_LEN = 1            # key characters that decide the range
ADJ_CHUNK = 64            # neighbours per adjacency row
XOR_OFFSET, XOR_LENGTH = 10, 100
SKEWED_SAMPLE_FRACTION = 0.25  # first lines of documents: fewer keys, so a larger sample


def q_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.line_counts(docs, "doc_id", "text")


def _counted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' lines in splits that bound the distinct bigrams a task holds (text is two or more times its parquet)."""
    return sized_read(spark, COUNT_SPLIT // 4, lambda own: fx.doc_lines(own, sf_dir))


def q_bigram_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.bigram_count(_counted_lines(spark, sf_dir))


def q_bigram_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = text.bigram_count(_counted_lines(spark, sf_dir))
    top = ranking.top_k_distinct(counts, "n", TOP_K)
    return ranking.order_by_count(top.select("n", "bigram"), "n", "bigram")


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = text.word_count(fx.doc_lines(spark, sf_dir))
    return ranking.order_by_count(counts, "n", "word")


def _trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_ip_trace(fx.ip_trace_lines(spark, sf_dir))


def _blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_block(relational.lines_containing(fx.raw_block_lines(spark, sf_dir), "Blocked"))


def _firewall_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.firewall_log(_trace(spark, sf_dir), _blocked(spark, sf_dir))


def q_firewall_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trace(spark, sf_dir)


def q_strip_last_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.strip_endpoints(_trace(spark, sf_dir).select("conn_id", "src", "dst"))


def q_blocked_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocked(spark, sf_dir)


def q_firewall_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firewall_log(spark, sf_dir).orderBy("conn_id")


def q_blocked_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = relational.count_by(_firewall_log(spark, sf_dir), "src")
    return ranking.order_by_count(counts, "n", "src")


REPO_COLUMNS = {"name": (0, "string"), "grp": (1, "string"), "score": (12, "double")}


def _repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_csv_positional(fx.repo_csv_lines(spark, sf_dir), REPO_COLUMNS)


def q_csv_positional_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repos(spark, sf_dir)


def q_group_total_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return relational.group_total_join_back(part, "p_brand").select("p_partkey", "p_brand", "n")


def q_group_count_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = relational.group_count_argmax(_repos(spark, sf_dir), "grp", "name", "score")
    return ranking.order_by_count(best, "n", "grp")


def q_group_count_argmax_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    best = relational.group_count_argmax(docs, "lang", "doc_id", "n_chars")
    return ranking.order_by_count(best, "n", "grp")


def _kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_kv_tab(fx.kv_lines(spark, sf_dir, "\t"))


def _boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = rangesort.first_char_histogram(_kv(spark, sf_dir), "k", SAMPLE_FRACTION, PREFIX_LEN)
    return rangesort.equi_depth_boundaries(hist, N_BUCKETS)


def q_kv_tab_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kv(spark, sf_dir)


def q_kv_ws_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.parse_kv_ws(fx.kv_lines(spark, sf_dir, " "))


def q_total_order_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangesort.total_order_sort(_kv(spark, sf_dir), ["k", "v"], SORT_RANGES, repeated_rows=False)


def q_first_char_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangesort.first_char_histogram(_kv(spark, sf_dir), "k", SAMPLE_FRACTION, PREFIX_LEN)


def q_equi_depth_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boundaries(spark, sf_dir)


def q_range_bucket_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = rangesort.range_bucket_assign(_kv(spark, sf_dir), "k", _boundaries(spark, sf_dir),
                                           N_BUCKETS, PREFIX_LEN)
    return rangesort.bucket_stats(tagged, "k")


def q_custom_range_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rangesort.custom_range_sort(_kv(spark, sf_dir), "k", _boundaries(spark, sf_dir),
                                      N_BUCKETS, PREFIX_LEN, SORT_RANGES, repeated_rows=False)
    return out.select("k", "v", "bucket", "pos_in_bucket")


def q_skewed_range_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    kv = fx.kv_skewed(spark, sf_dir)
    hist = rangesort.first_char_histogram(kv, "k", SKEWED_SAMPLE_FRACTION, PREFIX_LEN)
    bounds = rangesort.equi_depth_boundaries(hist, N_BUCKETS)
    out = rangesort.custom_range_sort(kv, "k", bounds, N_BUCKETS, PREFIX_LEN, SORT_RANGES)
    return out.select("k", "v", "bucket", "pos_in_bucket")


LONG_PREFIX = 4


def q_long_prefix_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equi-depth ranges over the four-character prefixes of every line of the documents."""
    hist = rangesort.first_char_histogram(fx.kv_skewed(spark, sf_dir), "k", 1.0, LONG_PREFIX)
    return rangesort.equi_depth_boundaries(hist, N_BUCKETS, prefix_len=LONG_PREFIX)


def q_long_prefix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kv = fx.kv_skewed(spark, sf_dir)
    bounds = rangesort.equi_depth_boundaries(rangesort.first_char_histogram(kv, "k", 1.0, LONG_PREFIX), N_BUCKETS, prefix_len=LONG_PREFIX)
    return rangesort.bucket_stats(rangesort.range_bucket_assign(kv, "k", bounds, N_BUCKETS, LONG_PREFIX), "k")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.canonical_edges(src.parse_edges(fx.edge_lines(spark, sf_dir)))


def q_edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


def q_edge_symmetrize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.symmetrize(_edges(spark, sf_dir))


def q_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    adj = graph.adjacency(_edges(spark, sf_dir), ADJ_CHUNK)
    return adj.select("v", "degree", "chunk",
                      F.array_join(F.col("neighbours").cast("array<string>"), " ").alias("neighbours"))


def q_wedge_closure_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.wedge_closure_histogram(_edges(spark, sf_dir))


def q_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.triangles(_edges(spark, sf_dir))


def q_triangle_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.triangle_count(graph.triangles(_edges(spark, sf_dir)))


def q_range_xor_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checksum.range_xor_checksum(fx.document_bytes(spark, sf_dir), "content",
                                       XOR_OFFSET, XOR_LENGTH, keep=["doc_id"])


def q_write_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts written as ``word<TAB>n`` text under the shared checkpoint folder, read back."""
    counts = text.word_count(fx.doc_lines(spark, sf_dir))
    path = f"{checkpoint_dir(spark).rstrip('/')}/write_pairs-{uuid.uuid4().hex}"
    sinks.write_pairs(counts, path, "word", "n", style="tab")
    back = src.parse_kv_tab(src.read_lines(spark, path))
    return back.select(F.col("k").alias("word"), F.col("v").cast("bigint").alias("n"))


QUERIES: dict[str, Query] = {
    **JOB_QUERIES,
    "text_lines": q_text_lines,
    "bigram_count": q_bigram_count,
    "bigram_top_k": q_bigram_top_k,
    "word_count": q_word_count,
    "firewall_parse": q_firewall_parse,
    "strip_last_component": q_strip_last_component,
    "blocked_filter": q_blocked_filter,
    "firewall_log": q_firewall_log,
    "blocked_sources": q_blocked_sources,
    "csv_positional_project": q_csv_positional_project,
    "group_total_join_back": q_group_total_join_back,
    "group_count_argmax": q_group_count_argmax,
    "group_count_argmax_docs": q_group_count_argmax_docs,
    "kv_tab_parse": q_kv_tab_parse,
    "kv_ws_parse": q_kv_ws_parse,
    "total_order_sort": q_total_order_sort,
    "first_char_histogram": q_first_char_histogram,
    "equi_depth_boundaries": q_equi_depth_boundaries,
    "range_bucket_assign": q_range_bucket_assign,
    "custom_range_sort": q_custom_range_sort,
    "skewed_range_sort": q_skewed_range_sort,
    "long_prefix_boundaries": q_long_prefix_boundaries,
    "long_prefix_buckets": q_long_prefix_buckets,
    "edge_list": q_edge_list,
    "edge_symmetrize": q_edge_symmetrize,
    "adjacency": q_adjacency,
    "wedge_closure_histogram": q_wedge_closure_histogram,
    "triangles": q_triangles,
    "triangle_count": q_triangle_count,
    "range_xor_checksum": q_range_xor_checksum,
    "write_pairs": q_write_pairs,
}
