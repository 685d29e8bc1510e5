"""The file-to-file jobs as queries: inputs written as text to the shared folder, the job run on
them, and its output files read back. Each call writes and reads files, so it is eager; the
result is written to the checkpoint folder and the files are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import sinks
from kestrel.operators import rangesort, relational, text
from kestrel.plans import jobs
from kestrel.session import checkpoint_dir
from kestrel.sources import fixtures as fx
from kestrel.sources import text as src
from kestrel.sources.byterange import read_byte_range


def _in_folder(spark: SparkSession, body: Callable[[str], DataFrame]) -> DataFrame:
    """``body(folder)`` computed to the checkpoint folder; ``folder`` is removed afterwards."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"
    try:
        return body(folder).checkpoint(eager=True)
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _fields(lines: DataFrame, pattern: str, **cols: str) -> DataFrame:
    """Columns ``name=type`` from the groups of ``pattern`` in each line."""
    value = F.col("value")
    return lines.select(*[F.regexp_extract(value, pattern, i).cast(t).alias(c) for i, (c, t) in enumerate(cols.items(), 1)])


def _write_doc_lines(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """The documents' lines as two inputs (odd and even ids, null ids with the even), for jobs that take many paths."""
    lines = fx.doc_lines(spark, sf_dir)
    paths = []
    for i in (0, 1):
        paths.append(f"{folder}/in{i}")
        sinks.write_lines(lines.where(F.coalesce(F.pmod("doc_id", F.lit(2)), F.lit(0)) == i).select(F.col("line").alias("value")), paths[-1])
    return paths


def job_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        jobs.word_count_job(spark, _write_doc_lines(spark, sf_dir, folder), f"{folder}/out")
        return _fields(src.read_lines(spark, f"{folder}/out"), r"^\((\d+),(.*)\)$", n="bigint", word="string")
    return _in_folder(spark, body)


def job_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        jobs.bigram_job(spark, _write_doc_lines(spark, sf_dir, folder), f"{folder}/out")
        return _fields(src.read_lines(spark, f"{folder}/out"), r"^(\d+)\t(.*)$", n="bigint", bigram="string")
    return _in_folder(spark, body)


def _firewall(spark: SparkSession, sf_dir: str, folder: str) -> None:
    sinks.write_lines(fx.ip_trace_lines(spark, sf_dir), f"{folder}/trace")
    sinks.write_lines(fx.raw_block_lines(spark, sf_dir), f"{folder}/block")
    jobs.firewall_job(spark, f"{folder}/trace", f"{folder}/block", f"{folder}/log", f"{folder}/sources")


def job_firewall_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        _firewall(spark, sf_dir, folder)
        return _fields(src.read_lines(spark, f"{folder}/log"), r"^(\S+) (\S+) (\S+) (\S+) (\S+)$",
                       tm="string", conn_id="bigint", src="string", dst="string", action="string")
    return _in_folder(spark, body)


def job_firewall_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        _firewall(spark, sf_dir, folder)
        return _fields(src.read_lines(spark, f"{folder}/sources"), r"^\((\d+),(.*)\)$", n="bigint", src="string")
    return _in_folder(spark, body)


def job_top_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        sinks.write_lines(fx.repo_csv_lines(spark, sf_dir, malformed=True), f"{folder}/in")
        jobs.top_repo_job(spark, f"{folder}/in", f"{folder}/out")
        return _fields(src.read_lines(spark, f"{folder}/out"), r"^(\S+) (\d+) (\S+) (\S+)$",
                       grp="string", n="bigint", best_id="string", best_score="double")
    return _in_folder(spark, body)


def job_sampled_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted pairs, and one row (null key) with the number of malformed lines."""
    def body(folder):
        kv = fx.kv_lines(spark, sf_dir, " ")
        cut_off = F.when(F.col("value").endswith("3"), F.substring_index("value", " ", 1)).otherwise(F.col("value"))
        sinks.write_lines(kv.select(cut_off.alias("value")), f"{folder}/in")
        bad = jobs.sampled_sort_job(spark, f"{folder}/in", f"{folder}/out")
        back = _fields(src.read_lines(spark, f"{folder}/out"), r"^(.*)\t(.*)$", k="string", v="string")
        return back.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("k"), F.lit(str(bad)).alias("v")))
    return _in_folder(spark, body)


def job_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        sinks.write_lines(fx.kv_lines(spark, sf_dir, "\t"), f"{folder}/in")
        jobs.histogram_sort_job(spark, f"{folder}/in", f"{folder}/out")
        lines = spark.read.text(f"{folder}/out")
        kv = src.parse_kv_tab(lines.select("value", "bucket"))
        return kv
    return _in_folder(spark, body)


def stage_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts as a sorted Parquet stage in at most four files, read back with the file count."""
    def body(folder):
        counts = text.word_count(fx.doc_lines(spark, sf_dir))
        sinks.write_pairs(counts, f"{folder}/stage", style="parquet", num_files=4, order_by=["word"])
        back = spark.read.parquet(f"{folder}/stage")
        files = back.select(F.input_file_name().alias("f")).distinct().count()
        return back.select("word", "n", F.lit(files <= 4).alias("few_files"))
    return _in_folder(spark, body)


# Range of the byte-range queries: it begins inside the longer files, ends beyond the shorter ones, and is several pieces.
RANGE_OFFSET, RANGE_LENGTH, RANGE_PIECE = 1000, 3500, 1024


def _write_shards(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The documents' ids and sizes as text files, one for every 300 ids, ordered by id."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars").where("doc_id is not null")
    lines = docs.select(F.expr("doc_id div 300").alias("shard"), "doc_id",
                        F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("doc_id", "source", "lang", "n_chars")]).alias("value"))
    ordered = lines.repartition("shard").sortWithinPartitions("shard", "doc_id")
    ordered.select("shard", "value").write.partitionBy("shard").text(f"{folder}/in")
    return f"{folder}/in"


def _shard():
    return F.regexp_extract("path", "shard=([0-9]+)/", 1).cast("bigint").alias("shard")


def byte_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of a byte range of many files: where each begins, its size and its MD5."""
    def body(folder):
        pieces = read_byte_range(spark, _write_shards(spark, sf_dir, folder), RANGE_OFFSET, RANGE_LENGTH, RANGE_PIECE)
        return pieces.select(_shard(), "offset", F.octet_length("content").cast("bigint").alias("n_bytes"), F.md5("content").alias("md5"))
    return _in_folder(spark, body)


def job_xor_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        sums = jobs.xor_checksum_job(spark, _write_shards(spark, sf_dir, folder), RANGE_OFFSET, RANGE_LENGTH)
        return sums.select(_shard(), "checksum")
    return _in_folder(spark, body)


def job_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    def body(folder):
        sinks.write_lines(fx.edge_lines(spark, sf_dir), f"{folder}/in")
        jobs.triangle_job(spark, f"{folder}/in", f"{folder}/out")
        return src.read_lines(spark, f"{folder}/out").select(F.col("value").alias("label"))
    return _in_folder(spark, body)


def bounded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row sample of a tenth of the pairs, but at most 10,000 of them."""
    return rangesort.bounded_sample(src.parse_kv_tab(fx.kv_lines(spark, sf_dir, "\t")), 0.1, 10_000)


def csv_malformed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.parse_csv_positional(fx.repo_csv_lines(spark, sf_dir, malformed=True),
                                    {"name": (0, "string"), "grp": (1, "string"), "score": (12, "double")})
    return relational.group_count_argmax(rows, "grp", "name", "score")


def group_total_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_brand")).alias("grp"))
    return relational.group_total_join_back(part, "grp")


JOB_QUERIES = {f.__name__: f for f in (job_word_count, job_bigrams, job_firewall_log, job_firewall_sources, job_top_repo,
                                      job_sampled_sort, job_histogram_sort, stage_parquet, csv_malformed_scores,
                                      group_total_null_group, byte_ranges, job_xor_checksum, job_triangles, bounded_sample)}
