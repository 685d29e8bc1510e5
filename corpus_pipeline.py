"""The corpus pipeline over ``documents``: quality, near-duplicates, decontamination, PII, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``.

Defined cases, for all stages: null, empty and wordless texts stay until the mix, which takes no word of them; texts
of any length are read whole; null ids stay (they are in no near-duplicate group); of rows that agree on id and text
one stays after the second stage; null languages, sources and lengths are values of their own; other columns
of ``documents`` are ignored, whatever their names; an empty table runs through and gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm import decontam, mixing, ngram_join, pii, quality
from kestrel.llm.common import cut, drop_folder, if_small, shared_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.score_quality(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where("keep").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id (any one
    of equal rows). An id with several texts goes if one of them does; null ids stay."""
    classes = ngram_join.similarity_classes(docs)
    gone = cut(classes.where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct())
    keyed = docs.select(*COLUMNS, F.xxhash64("text").alias("_k"))
    kept = keyed.join(if_small(gone), F.col("doc_id") == F.col("_id"), "left_anti")
    twice = cut(keyed.where("doc_id is not null").groupBy("doc_id", "_k").count().where("count > 1")
                .select(F.col("doc_id").alias("_d"), F.col("_k").alias("_t")))
    if not twice.isEmpty():     # equal rows: one of each stays
        once = Window.partitionBy("doc_id", "_k").orderBy("lang", "source", "n_chars")
        same = (F.col("doc_id") == F.col("_d")) & (F.col("_k") == F.col("_t"))
        again = kept.join(if_small(twice), same, "left_semi").withColumn("_r", F.row_number().over(once)).where("_r = 1").drop("_r")
        kept = kept.join(if_small(twice), same, "left_anti").unionByName(again)
    return kept.select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("text_key").distinct()
    return docs.withColumn("text_key", F.xxhash64("text")).join(if_small(cut(found)), "text_key", "left_anti").select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; ``n_chars`` follows the new text."""
    found = (pii.find_spans(docs).where(F.size("spans") > 0).select(F.col("text_key").alias("_k"), "spans")
             .dropDuplicates(["_k"]))    # spans depend on the text alone
    d = docs.select(*COLUMNS, F.xxhash64("text").alias("_t")).join(if_small(cut(found), 100_000), F.col("_t") == F.col("_k"), "left")
    text = F.when(F.col("spans").isNotNull(), pii.mask(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    masked = d.select("doc_id", text.alias("text"), "lang", "source", "n_chars", F.col("spans").isNotNull().alias("_new"))
    return masked.select("doc_id", "text", "lang", "source",
                         F.when(F.col("_new"), F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per drawn piece with its shard, its place there and its text.

    The plan is made on narrow rows; the texts, one of each id and text, are joined to the pieces once.
    """
    d = docs.select(*COLUMNS, F.xxhash64("text").alias("text_key"))
    plan = mixing.mix_plan(d, keep=["text_key", "lang"])
    pieces = mixing.pieces(plan).select("doc_id", "text_key", "lang", "source", "shard", "place", "epoch", "first_word", "words", "size", "target")
    texts = d.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_k"), "text")
    twice = cut(texts.groupBy("_id", "_k").count().where("count > 1").select(F.col("_id").alias("_d"), F.col("_k").alias("_t")))
    if not twice.isEmpty():     # every row has its own pieces: one text serves them all
        same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_t"))
        again = texts.join(if_small(twice), same, "left_semi").dropDuplicates(["_id", "_k"])
        texts = texts.join(if_small(twice), same, "left_anti").unionByName(again)
    rows = texts.join(pieces, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_k")))
    words = F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))
    part = F.array_join(F.slice(words, (F.col("first_word") + 1).cast("int"), F.col("words").cast("int")), " ")
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(part)
    return rows.select("shard", "place", "doc_id", "epoch", "first_word", F.col("words").alias("n_words"), text.alias("text"), "lang", "source",
                       F.col("target").alias("source_target"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
]

ORACLE_SQL = None  # the classifiers are not SQL; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``. Intermediate tables live in the shared folder until the result is
    written there itself, so the call is eager."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    try:
        for i, (_, stage) in enumerate(STAGES[:-1]):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
        return cut(STAGES[-1][1](spark, docs, sf_dir))
    finally:
        drop_folder(spark, folder)
