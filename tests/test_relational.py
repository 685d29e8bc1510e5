"""Firewall join, blocked sources, group count + arg-max (FIXTURES.md §3.5-3.6)."""

from kestrel.operators import ranking, relational
from kestrel.sources import text as src


def test_firewall_micro(spark):
    trace = spark.createDataFrame([("t1 1 10.0.0.1.55 > 9.9.9.9.80",), ("t2 2 10.0.0.2.56 > 9.9.9.9.80",),
                                   ("t3 3 10.0.0.1.57 > 9.9.9.8.80",)], "value string")
    blocks = spark.createDataFrame([("1 Blocked",), ("2 Allowed",), ("3 Blocked",), ("4 Blocked",)], "value string")
    blocked = src.parse_block(relational.lines_containing(blocks, "Blocked"))
    log = relational.firewall_log(src.parse_ip_trace(trace), blocked).orderBy("conn_id").collect()
    assert [tuple(r) for r in log] == [("t1", 1, "10.0.0.1", "9.9.9.9", "Blocked"),
                                      ("t3", 3, "10.0.0.1", "9.9.9.8", "Blocked")]
    counts = relational.count_by(relational.firewall_log(src.parse_ip_trace(trace), blocked), "src")
    assert [tuple(r) for r in counts.collect()] == [("10.0.0.1", 2)]


def test_strip_without_dot(spark):
    df = spark.createDataFrame([(1, "nodot", "a.b")], "conn_id long, src string, dst string")
    r = relational.strip_endpoints(df).collect()[0]
    assert (r.src, r.dst) == ("nodot", "a")


def test_group_count_argmax_micro(spark):
    df = spark.createDataFrame([("r1", "Java", 5.0), ("r2", "Java", 9.0), ("r3", "Go", 2.0), ("r4", "Java", 9.0),
                                ("r5", "Go", None)], "repo string, lang string, stars double")
    out = ranking.order_by_count(relational.group_count_argmax(df, "lang", "repo", "stars"), "n", "grp")
    assert [tuple(r) for r in out.collect()] == [("Java", 3, "r2", 9.0), ("Go", 2, "r3", 2.0)]


def test_group_total_join_back(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, g string")
    out = {r.id: r.n for r in relational.group_total_join_back(df, "g").collect()}
    assert out == {1: 2, 2: 2, 3: 1}


def test_top_k_distinct_micro(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 4), ("d", 3)], "w string, n long")
    out = ranking.order_by_count(ranking.top_k_distinct(df, "n", 2), "n", "w")
    assert [(r.n, r.w) for r in out.collect()] == [(5, "a"), (5, "b"), (4, "c")]
