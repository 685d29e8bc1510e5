import base64
import hashlib

import duckdb
import pytest

from kestrel.llm import warc
from kestrel.llm.common import Scratch

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def scratch(spark):
    got = Scratch(spark)
    yield got
    got.close()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "?", "?") for r in rows], "page_id long, url string, html string, digest string, refers_to string")


def test_segments_and_chunks_come_back(spark, tmp_path, scratch):
    long = "é€😀<p>\r\n" * 9000
    rows = [(1, "http://a/ü \n", long), (2, None, long), (3, "u", ""), (4, "u", None), (5, "v", "a\r\n\r\nWARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
            (None, "w", long), (None, "x", "only here")]
    got = {tuple(r) for r in warc.round_trip(pages(spark, rows + rows[:1]), str(tmp_path / "w"), scratch).collect()}
    want = set()
    for i, _, h in rows:
        b = (h or "").encode()
        last = max((x[0] for x in rows if (x[2] or "").encode() == b and x[0] is not None), default=None)
        first = last is None or i == last
        want.add((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", None if first else last))
    assert got == want


def test_small_segments_split_characters(spark, tmp_path, scratch):
    text = "😀é" * 3000
    warc.write_archives(pages(spark, [(1, "u", text)]), str(tmp_path / "w"), segment_bytes=777, records_per_file=3)
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part")]
    assert len(files) > 5
    back = warc.read_archives(spark, str(tmp_path / "w"), scratch).collect()
    assert [(r.page_id, r.type, bytes(r.payload).decode()) for r in back] == [(1, "response", text)]
    files[1].unlink()
    for f in (tmp_path / "w").glob(".*crc"):
        f.unlink()
    with pytest.raises(Exception, match="missing|don't add up"):
        warc.read_archives(spark, str(tmp_path / "w"), scratch).collect()


def test_query_matches_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    got = warc.op9_warc(spark, SMALL)
    want = duck.execute(warc.OP9_SQL)
    order = [got.columns.index(c[0]) for c in want.description]
    assert sorted((tuple(r[i] for i in order) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_empty_table(spark, tmp_path, scratch):
    assert warc.round_trip(pages(spark, []), str(tmp_path / "w"), scratch).collect() == []


def test_the_querys_archives_hold_continuations(spark, tmp_path):
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    warc.write_archives(table, str(tmp_path / "w"))
    records = [f for r in spark.read.format("binaryFile").load(str(tmp_path / "w")).collect() for f, _ in warc._records(warc.zlib.decompress(bytes(r.content), 31))]
    kinds = [f["WARC-Type"] for f in records]
    longer = table.selectExpr(f"sum(case when octet_length(html) > {warc.SEGMENT_BYTES} then 1 else 0 end)").first()[0]
    assert longer >= 2 and kinds.count("continuation") >= longer
    assert sum("WARC-Segment-Total-Length" in f for f in records) == sum(f.get("WARC-Segment-Number") == "1" for f in records)


def test_a_changed_payload_fails(spark, tmp_path, scratch):
    warc.write_archives(pages(spark, [(1, "u", "one text"), (2, "v", "two" * 9000)]), str(tmp_path / "w"))
    (changed := tmp_path / "x").mkdir()
    for i, f in enumerate(sorted((tmp_path / "w").glob("part*"))):
        (changed / f"{i}.warc").write_bytes(warc.zlib.decompress(f.read_bytes(), 31).replace(b"one text", b"one t3xt"))
    with pytest.raises(Exception, match="digest of a record differ"):
        warc.read_archives(spark, str(changed), scratch).collect()
