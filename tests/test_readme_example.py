"""The README's usage example, run on tiny files."""

from kestrel.operators import graph, rangesort, ranking, text
from kestrel.plans import jobs
from kestrel.sources import text as src


def test_readme_usage(spark, tmp_path):
    (tmp_path / "corpus").mkdir()
    (tmp_path / "corpus" / "a.txt").write_text("The end. New start\nx - y z\n")
    (tmp_path / "kv.txt").write_text("b\t2\na\t1\n")
    (tmp_path / "g.txt").write_text("1 2\n2 3\n3 1\n")
    (tmp_path / "trace.txt").write_text("t1 1 10.0.0.1.5 > 9.9.9.9.80\n")
    (tmp_path / "block.txt").write_text("1 Blocked\n")

    lines = src.read_lines(spark, [str(tmp_path / "corpus")]).withColumnRenamed("value", "line")
    top = ranking.top_k_distinct(text.bigram_count(lines), "n", k=10)
    assert sorted(r.bigram for r in top.collect()) == ["new start", "the end", "x y", "y z"]
    kv = src.parse_kv_tab(src.read_lines(spark, str(tmp_path / "kv.txt")))
    assert [(r.k, r.pos) for r in rangesort.total_order_sort(kv, ["k"]).collect()] == [("a", 1), ("b", 2)]
    edges = graph.canonical_edges(src.parse_edges(src.read_lines(spark, str(tmp_path / "g.txt"))))
    assert graph.triangle_count(graph.triangles(edges)).collect()[0].n == 1
    jobs.firewall_job(spark, str(tmp_path / "trace.txt"), str(tmp_path / "block.txt"),
                      str(tmp_path / "log"), str(tmp_path / "sources"))
    assert spark.read.text(str(tmp_path / "log")).collect()[0].value == "t1 1 10.0.0.1 9.9.9.9 Blocked"
