"""Line streams and running word / bigram counts with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.operators import text


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files under ``path`` as a stream of lines (column ``line``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).withColumnRenamed("value", "line")


def running_counts(lines: DataFrame, kind: str, sink: str, checkpoint: str, name: str = "counts",
                   output_mode: str = "update"):
    """Start a streaming query of running word or bigram counts.

    ``update`` mode emits only the counts that changed in each micro-batch. The state
    store and offsets go to ``checkpoint``, a shared folder: a query restarted on it resumes
    where it stopped. The caller names the sink (``memory`` holds all counts on the driver and
    is for tests).
    """
    counts = text.word_count(lines) if kind == "words" else text.bigram_count(lines)
    return (counts.writeStream.outputMode(output_mode).format(sink).queryName(name)
            .option("checkpointLocation", checkpoint).start())
