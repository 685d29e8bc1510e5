"""The reference's eight batch programs as file-to-file Spark jobs.

Each job reads the same text inputs the reference reads, runs the operators and writes
the same record format, so a user of the reference can switch job by job. Parameters
default to the reference's settings (10 bigram counts, 10 sort ranges, a 2 % key sample,
1,000 bytes at offset 10^9). The caller owns the session.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kestrel import sinks
from kestrel.operators import checksum, graph, rangesort, ranking, relational, text
from kestrel.session import sized_session
from kestrel.sources import text as src
from kestrel.sources.byterange import read_byte_range

# Bytes of text whose distinct bigrams one task holds, before the shuffle and after it.
COUNT_SPLIT = 64 << 20


def _counting_lines(spark: SparkSession, inputs) -> DataFrame:
    """The lines of a count whose keys are nearly as many as its rows, in a session of its own.

    A count holds every distinct key of a task in memory, so tasks get ``COUNT_SPLIT`` bytes of
    text at most, and the shuffle has a partition for each such split (never fewer than the caller's).
    """
    own = sized_session(spark, COUNT_SPLIT)
    lines = src.read_lines(own, inputs).withColumnRenamed("value", "line")
    partitions = max(int(own.conf.get("spark.sql.shuffle.partitions")), lines.rdd.getNumPartitions())
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return lines


def xor_checksum_job(spark: SparkSession, path: str, offset: int = 10**9, length: int = 1000) -> DataFrame:
    """XOR of ``length`` bytes at ``offset`` of each file -> path, checksum.

    Only the range is read; a file that ends at or before ``offset`` gives no row.
    """
    pieces = read_byte_range(spark, path, offset, length)
    folded = checksum.range_xor_checksum(pieces, "content", 0, length, keep=["path"])
    return folded.groupBy("path").agg(F.bit_xor("checksum").alias("checksum"))


def bigram_job(spark: SparkSession, inputs, output: str, k: int = 10) -> None:
    """Most frequent bigrams: ``count<TAB>bigram`` for the k largest counts, ties kept."""
    lines = _counting_lines(spark, inputs)
    top = ranking.top_k_distinct(text.bigram_count(lines), "n", k)
    ordered = ranking.order_by_count(top, "n", "bigram")
    sinks.write_lines(sinks.tab_pairs(ordered, "n", "bigram"), output)


def sampled_sort_job(spark: SparkSession, inputs, output: str, n_ranges: int | None = None) -> int:
    """Total-order sort of ``key<ws>value`` lines into ordered files -> number of malformed lines.

    ``n_ranges`` files (default: the session's shuffle partitions). A line without a value
    is malformed: it is counted and left out of the output.
    """
    bad = F.col("v").isNull()
    # Malformed lines go through the sort, to be counted by the task that writes; each split's go to a
    # place of their own, so that many equal ones do not meet.
    place = F.when(bad, F.hex(F.xxhash64(F.input_file_name(), F.input_file_block_start()))).otherwise(F.col("k"))
    kv = src.parse_kv_ws(src.read_lines(spark, inputs)).withColumn("_place", place)
    seen = Observation()
    ordered = rangesort.range_sort(kv, ["_place", "v"], n_ranges).observe(seen, F.count(F.when(bad, F.lit(1))).alias("malformed"))
    sinks.write_lines(sinks.tab_pairs(ordered.where(~bad), "k", "v"), output)
    return seen.get["malformed"]


def histogram_sort_job(spark: SparkSession, inputs, output: str, sample_fraction: float = 0.02,
                       n_buckets: int = 10, prefix_len: int = 1, n_ranges: int | None = None) -> None:
    """Total-order sort of ``key<TAB>value`` lines by equi-depth first-char ranges.

    Output: one directory per bucket (``bucket=i``); every file is sorted, and files are
    ordered by bucket and then by part number, so a hot bucket spans several files.
    """
    kv = src.parse_kv_tab(src.read_lines(spark, inputs))
    hist = rangesort.first_char_histogram(kv, "k", sample_fraction, prefix_len)
    bounds = rangesort.equi_depth_boundaries(hist, n_buckets, prefix_len=prefix_len)
    # No position is wanted, so one plain range sort does. A partitioned write keeps this
    # order because it begins with the partition column.
    ordered = rangesort.range_sort(rangesort.range_bucket_assign(kv, "k", bounds, n_buckets, prefix_len),
                                   ["bucket", "k", "v"], n_ranges)
    lines = ordered.select("bucket", F.concat_ws("\t", "k", "v").alias("value"))
    sinks.write_lines(lines, output, partition_by=["bucket"])


def word_count_job(spark: SparkSession, inputs, output: str) -> None:
    """Words split on whitespace, counted, most frequent first: ``(count,word)``."""
    lines = src.read_lines(spark, inputs).withColumnRenamed("value", "line")
    counts = ranking.order_by_count(text.word_count(lines), "n", "word")
    sinks.write_lines(sinks.tuple_pairs(counts, "n", "word"), output)


def firewall_job(spark: SparkSession, trace_path: str, block_path: str, log_output: str,
                 sources_output: str) -> None:
    """Blocked connections: the joined log by connection id, then counts per source.

    The log feeds both outputs, so it is persisted (memory and disk; a lost block is
    recomputed from its lineage) and released after the second write.
    """
    trace = src.parse_ip_trace(src.read_lines(spark, trace_path))
    blocked = src.parse_block(relational.lines_containing(src.read_lines(spark, block_path), "Blocked"))
    log = relational.firewall_log(trace, blocked).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sinks.write_lines(sinks.space_joined(log.orderBy("conn_id"), "tm", "conn_id", "src", "dst", "action"),
                          log_output)
        counts = ranking.order_by_count(relational.count_by(log, "src"), "n", "src")
        sinks.write_lines(sinks.tuple_pairs(counts, "n", "src"), sources_output)
    finally:
        log.unpersist()


def top_repo_job(spark: SparkSession, inputs, output: str, header: str | None = None) -> None:
    """Repos per language and the most-starred one: ``language count repo stars``.

    Every row counts; rows whose stars are no number cannot be the most-starred one. ``header``
    is the text of the header line, if the files have one. Whole numbers are written as such.
    """
    repos = src.parse_csv_positional(src.read_lines(spark, inputs),
                                     {"repo": (0, "string"), "language": (1, "string"), "stars": (12, "double")},
                                     header=header)
    best = ranking.order_by_count(relational.group_count_argmax(repos, "language", "repo", "stars"), "n", "grp")
    stars = F.col("best_score")
    whole = (stars == F.floor(stars)) & (F.abs(stars) < 1e15)
    best = best.withColumn("best_score", F.when(whole, stars.cast("bigint").cast("string")).otherwise(stars.cast("string")))
    sinks.write_lines(sinks.space_joined(best, "grp", "n", "best_id", "best_score"), output)


def triangle_job(spark: SparkSession, inputs, output: str, orient_by: str = "degree") -> None:
    """``Total Triangles: N`` for the undirected graph in the edge-list lines."""
    edges = graph.canonical_edges(src.parse_edges(src.read_lines(spark, inputs)))
    label = graph.triangle_count(graph.triangles(edges, orient_by)).select("label")
    sinks.write_lines(label.withColumnRenamed("label", "value"), output)
