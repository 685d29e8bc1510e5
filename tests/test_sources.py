"""Parsers and the byte-range checksum (FIXTURES.md §1, §3.8)."""

from kestrel.operators.checksum import range_xor_checksum
from kestrel.sources import text as src


def test_kv_tab_and_ws(spark):
    lines = spark.createDataFrame([("k1\tv1",), ("k2\tv\t2",), ("nokey",), ("\tv",)], "value string")
    assert [tuple(r) for r in src.parse_kv_tab(lines).collect()] == [
        ("k1", "v1"), ("k2", "v\t2"), ("nokey", ""), ("", "v")]
    ws = spark.createDataFrame([("a  b c",), ("only",)], "value string")
    assert [tuple(r) for r in src.parse_kv_ws(ws).collect()] == [("a", "b"), ("only", None)]


def test_csv_positional_header(spark):
    lines = spark.createDataFrame([("repo,lang," + ",".join(["x"] * 10) + ",stars",),
                                   ("r1,Go," + ",".join([""] * 10) + ",12",)], "value string")
    cols = {"name": (0, "string"), "grp": (1, "string"), "score": (12, "double")}
    assert [tuple(r) for r in src.parse_csv_positional(lines, cols, header=lines.first().value).collect()] == [("r1", "Go", 12.0)]
    assert len(src.parse_csv_positional(lines, cols).collect()) == 2


def test_edges_skip_blank(spark):
    lines = spark.createDataFrame([("1 2",), ("",), ("   ",), (" 3\t4 ",)], "value string")
    assert [tuple(r) for r in src.parse_edges(lines).collect()] == [(1, 2), (3, 4)]


def test_ip_trace_fields(spark):
    lines = spark.createDataFrame([("t 7 1.2.3.4.5 > 6.7.8.9.10 extra",)], "value string")
    assert tuple(src.parse_ip_trace(lines).collect()[0]) == ("t", 7, "1.2.3.4.5", "6.7.8.9.10")


def test_xor_micro(spark):
    df = spark.createDataFrame([(1, bytearray([1, 2, 4, 8]))], "id int, content binary")
    assert [r.checksum for r in range_xor_checksum(df, "content", 1, 2, keep=["id"]).collect()] == [6]
    assert [r.checksum for r in range_xor_checksum(df, "content", 3, 5, keep=["id"]).collect()] == [8]
    assert range_xor_checksum(df, "content", 9, 5, keep=["id"]).collect() == []


def test_read_lines_many_paths_and_directories(spark, tmp_path):
    d = tmp_path / "dir"
    d.mkdir()
    (d / "a.txt").write_text("a1\na2\n")          # final newline: no extra empty line
    (d / "b.txt").write_text("b1\n\nb3")          # empty middle line kept, no final newline
    single = tmp_path / "c.txt"
    single.write_text("c1\r\nc2\r\n")
    lines = sorted(r.value for r in src.read_lines(spark, [str(d), str(single)]).collect())
    assert lines == ["", "a1", "a2", "b1", "b3", "c1", "c2"]
