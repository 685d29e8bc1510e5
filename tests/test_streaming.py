"""The batch text operators run unchanged on a file stream."""

import uuid

from kestrel.streaming import running_counts, stream_lines


def test_running_word_counts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("x y x\n")
    name = "wc_" + uuid.uuid4().hex[:8]
    q = running_counts(stream_lines(spark, str(src)), "words", "memory", name=name, output_mode="complete",
                       checkpoint=str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
        (src / "b.txt").write_text("y z\n")
        q.processAllAvailable()
        got = {r.word: r.n for r in spark.sql(f"select * from {name}").collect()}
    finally:
        q.stop()
    assert got == {"x": 2, "y": 2, "z": 1}


def test_restart_resumes_from_checkpoint(spark, tmp_path):
    """Stopping and restarting on the same checkpoint keeps the aggregation state."""
    src = tmp_path / "in"
    src.mkdir()
    ckpt = str(tmp_path / "ckpt")
    (src / "a.txt").write_text("The end. The end\n")
    name1 = "bg_" + uuid.uuid4().hex[:8]
    q = running_counts(stream_lines(spark, str(src)), "bigrams", "memory", name=name1, output_mode="complete",
                       checkpoint=ckpt)
    q.processAllAvailable()
    q.stop()
    (src / "b.txt").write_text("the end of it\n")
    name2 = "bg_" + uuid.uuid4().hex[:8]
    q = running_counts(stream_lines(spark, str(src)), "bigrams", "memory", name=name2, output_mode="complete",
                       checkpoint=ckpt)
    try:
        q.processAllAvailable()
        got = {r.bigram: r.n for r in spark.sql(f"select * from {name2}").collect()}
    finally:
        q.stop()
    assert got == {"the end": 3, "end of": 1, "of it": 1}
