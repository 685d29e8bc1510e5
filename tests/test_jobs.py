"""File-to-file jobs on tiny text inputs: record formats and file ordering."""

import glob
import itertools
import os
import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import plan_string
from pyspark.sql import functions as F

from kestrel.operators import text
from kestrel.plans import jobs
from kestrel.session import sized_session


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("".join(line + "\n" for line in lines))
    return str(p)


def _read_parts(path):
    out = []
    for f in sorted(glob.glob(os.path.join(path, "**", "part-*"), recursive=True)):
        with open(f) as fh:
            out.append(fh.read().splitlines())
    return out


def test_job_queries_count_documents_with_a_null_id(spark, tmp_path):
    from kestrel.plans import job_queries

    rows = [(1, "a b\nb"), (2, "b c"), (None, "a a d")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.word: r.n for r in job_queries.job_word_count(spark, str(tmp_path)).collect()} == {"a": 3, "b": 3, "c": 1, "d": 1}
    assert {r.bigram: r.n for r in job_queries.job_bigrams(spark, str(tmp_path)).collect()} == {"a b": 1, "b c": 1, "a a": 1, "a d": 1}


def test_bigram_job(spark, tmp_path):
    inp = _write(tmp_path, "in.txt", ["a b. a b", "x - y a b", "Q"])
    out = str(tmp_path / "out")
    jobs.bigram_job(spark, [inp], out, k=2)
    lines = [x for part in _read_parts(out) for x in part]
    assert lines == ["3\ta b", "1\ty a", "1\tx y"] or lines == ["3\ta b", "1\tx y", "1\ty a"]


def test_bigram_job_counts_a_bounded_text_in_a_task(spark, tmp_path, monkeypatch):
    """Reading tasks and the partitions of the count follow the input, not the cores; the caller's settings stay."""
    split = 1 << 16
    monkeypatch.setattr(jobs, "COUNT_SPLIT", split, raising=False)
    seen, count = [], text.bigram_count
    monkeypatch.setattr(text, "bigram_count", lambda lines: seen.append(lines) or count(lines))
    rnd = random.Random(3)
    lines = [" ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 99)) for _ in range(12)) for _ in range(25_000)]
    settings = spark.conf.getAll
    jobs.bigram_job(spark, [_write(tmp_path, "in.txt", lines)], str(tmp_path / "out"), k=2)

    size = sum(len(x) + 1 for x in lines)
    most = seen[0].groupBy(F.spark_partition_id()).agg(F.sum(F.length("line") + 1).alias("n")).agg(F.max("n")).first()[0]
    assert most <= split + 100
    exchanges = [int(n) for n in re.findall(r"hashpartitioning\(bigram#\d+, (\d+)\)", plan_string(count(seen[0])))]
    assert exchanges and min(exchanges) >= size // split
    assert spark.conf.getAll == settings
    times = Counter(f"{a} {b}" for x in lines for a, b in itertools.pairwise(x.split()))
    largest = sorted(set(times.values()))[-2:]
    got = [x for part in _read_parts(str(tmp_path / "out")) for x in part]
    assert sorted(got) == sorted(f"{n}\t{b}" for b, n in times.items() if n in largest)


@pytest.mark.parametrize("name", ["bigram_count", "bigram_top_k"])
def test_bigram_queries_count_a_bounded_text_in_a_task(spark, tmp_path, monkeypatch, name):
    from kestrel.plans import queries

    split = 1 << 17
    monkeypatch.setattr(queries, "COUNT_SPLIT", split, raising=False)
    seen, count = [], text.bigram_count
    monkeypatch.setattr(text, "bigram_count", lambda lines: seen.append(lines) or count(lines))
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 99)) for _ in range(300))) for i in range(2000)]
    table = pa.Table.from_pylist([{"doc_id": i, "text": t} for i, t in docs])
    pq.write_table(table, tmp_path / "documents.parquet", row_group_size=50)
    got = {r.bigram: r.n for r in queries.QUERIES[name](spark, str(tmp_path)).collect()}

    assert seen[0].sparkSession is spark and spark.catalog.listTables("global_temp") == []
    most = seen[0].groupBy(F.spark_partition_id()).agg(F.sum(F.length("line")).alias("n")).agg(F.max("n")).first()[0]
    whole = sum(len(t) for _, t in docs)
    assert os.path.getsize(tmp_path / "documents.parquet") > 3 * split and most < whole / 6
    times = Counter(f"{a} {b}" for _, t in docs for a, b in itertools.pairwise(t.split()))
    least = 0 if name == "bigram_count" else sorted(set(times.values()))[-10:][0]
    assert got == {b: n for b, n in times.items() if n >= least}


def test_sized_session_takes_the_callers_settings(spark):
    caller = spark.newSession()
    caller.conf.set("spark.sql.shuffle.partitions", "7")
    caller.conf.set("fs.some.option", "x")
    caller.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    own = sized_session(caller, 1 << 16)
    assert [own.conf.get(k) for k in ("spark.sql.shuffle.partitions", "fs.some.option", "spark.sql.files.maxPartitionBytes")] == ["7", "x", "1k"]
    caller.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    assert sized_session(caller, 1 << 16).conf.get("spark.sql.files.maxPartitionBytes") == "65536b"
    assert caller.conf.get("spark.sql.files.maxPartitionBytes") == "1g"


def test_word_count_job(spark, tmp_path):
    inp = _write(tmp_path, "in.txt", ["b a b", "", "c"])
    out = str(tmp_path / "out")
    jobs.word_count_job(spark, [inp], out)
    lines = [x for part in _read_parts(out) for x in part]
    assert lines == ["(2,b)", "(1,)", "(1,a)", "(1,c)"]


def test_firewall_job(spark, tmp_path):
    trace = _write(tmp_path, "trace.txt", ["t1 1 10.0.0.1.55 > 9.9.9.9.80", "t2 2 10.0.0.2.56 > 9.9.9.9.80",
                                           "t3 3 10.0.0.1.57 > 9.9.9.8.80"])
    block = _write(tmp_path, "block.txt", ["1 Blocked", "2 Allowed", "3 Blocked", "4 Blocked"])
    log_out, src_out = str(tmp_path / "log"), str(tmp_path / "src")
    jobs.firewall_job(spark, trace, block, log_out, src_out)
    assert [x for p in _read_parts(log_out) for x in p] == ["t1 1 10.0.0.1 9.9.9.9 Blocked",
                                                         "t3 3 10.0.0.1 9.9.9.8 Blocked"]
    assert [x for p in _read_parts(src_out) for x in p] == ["(2,10.0.0.1)"]


def test_top_repo_job(spark, tmp_path):
    pad = "," * 10
    inp = _write(tmp_path, "repos.csv", ["repo,language" + pad + ",stars", "r1,Java" + pad + ",5", "r2,Java" + pad + ",9",
                                         "r3,Go" + pad + ",2", "r4,Java" + pad + ",9"])
    out = str(tmp_path / "out")
    jobs.top_repo_job(spark, [inp], out, header="repo,language" + pad + ",stars")
    assert [x for p in _read_parts(out) for x in p] == ["Java 3 r2 9", "Go 1 r3 2"]


def test_top_repo_job_counts_rows_without_a_number(spark, tmp_path):
    pad = "," * 10
    inp = _write(tmp_path, "repos.csv", [f"r{i},Java{pad},{s}" for i, s in enumerate(["5", "N/A", "", "9.5"])])
    jobs.top_repo_job(spark, [inp], str(tmp_path / "out"))
    assert [x for p in _read_parts(str(tmp_path / "out")) for x in p] == ["Java 4 r3 9.5"]


def test_sampled_sort_job_counts_malformed_lines(spark, tmp_path):
    inp = _write(tmp_path, "kv.txt", ["b 2", "lonely", "a 1"])
    assert jobs.sampled_sort_job(spark, [inp], str(tmp_path / "out"), n_ranges=2) == 1
    assert [x for p in _read_parts(str(tmp_path / "out")) for x in p] == ["a\t1", "b\t2"]


def test_triangle_job(spark, tmp_path):
    inp = _write(tmp_path, "g.txt", ["1 2", "", "2 3", "3 1", "3 4"])
    out = str(tmp_path / "out")
    jobs.triangle_job(spark, [inp], out)
    assert [x for p in _read_parts(out) for x in p] == ["Total Triangles: 1"]


@pytest.mark.parametrize("which", ["sampled", "histogram"])
def test_sort_jobs_globally_ordered(spark, tmp_path, which):
    import hashlib

    keys = [hashlib.md5(str(i).encode()).hexdigest() for i in range(400)]
    sep = " " if which == "sampled" else "\t"
    inp = _write(tmp_path, "kv.txt", [f"{k}{sep}{i}" for i, k in enumerate(keys)])
    out = str(tmp_path / "out")
    if which == "sampled":
        jobs.sampled_sort_job(spark, [inp], out, n_ranges=4)
        parts = _read_parts(out)
    else:
        jobs.histogram_sort_job(spark, [inp], out, sample_fraction=1.0, n_buckets=4, n_ranges=4)
        parts = []
        for d in sorted(glob.glob(os.path.join(out, "bucket=*")), key=lambda p: int(p.split("=")[-1])):
            parts.extend(_read_parts(d))
    flat = [x.split("\t")[0] for p in parts for x in p]
    assert flat == sorted(keys)
    assert sum(1 for p in parts if p) >= 2


def test_xor_checksum_of_a_file_over_two_gb(spark, tmp_path):
    """Only the range is read: the (sparse) file is larger than a row can be."""
    p = tmp_path / "big.bin"
    with open(p, "wb") as f:
        f.seek(3 * 10**9)
        f.write(bytes(range(200)) * 10)
    want = 0
    for b in (bytes(range(200)) * 10)[100:1100]:
        want ^= b
    rows = jobs.xor_checksum_job(spark, str(p), offset=3 * 10**9 + 100, length=1000).collect()
    assert [r.checksum for r in rows] == [want]
    assert jobs.xor_checksum_job(spark, str(p), offset=4 * 10**9).collect() == []


def test_xor_checksum_job(spark, tmp_path):
    p = tmp_path / "blob.bin"
    p.write_bytes(bytes([1, 2, 4, 8, 16]))
    row = jobs.xor_checksum_job(spark, str(p), offset=1, length=3).collect()[0]
    assert row.checksum == 2 ^ 4 ^ 8


def test_byte_ranges_across_pieces_and_past_the_end(spark, tmp_path):
    from kestrel.sources import byterange

    bodies = {"a": bytes(range(256)) * 20, "b": b"short", "sub/c": b"x" * 700, "_hidden": b"no" * 500, "empty": b""}
    for name, body in bodies.items():
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(body)
    for arrow in (byterange.OPENED_BY_ARROW, ()):          # through Arrow, and through the JVM's reader
        rows = byterange.read_byte_range(spark, str(tmp_path / "in"), 600, 1000, 64, arrow).collect()
        got = {}
        for r in sorted(rows, key=lambda r: r.offset):
            name = r.path.split("/in/")[1]
            assert len(r.content) <= 64 and r.offset == 600 + len(got.get(name, b""))
            got[name] = got.get(name, b"") + bytes(r.content)
        assert got == {"a": bodies["a"][600:1600], "sub/c": b"x" * 100}
    assert byterange.read_byte_range(spark, str(tmp_path / "in"), 10**10, 5).collect() == []
    assert byterange.read_byte_range(spark, str(tmp_path / "in" / "a"), 0, 0).collect() == []
    with pytest.raises(FileNotFoundError):
        byterange.read_byte_range(spark, str(tmp_path / "nothing"), 0, 5)


def test_a_piece_is_a_partition_and_only_the_range_is_read(spark, tmp_path):
    from kestrel.sources import byterange

    p = tmp_path / "sparse.bin"
    with open(p, "wb") as f:
        f.truncate(3 * 10**9)
    reader = byterange.ByteRangeReader([(str(p), f"file://{p}", 3 * 10**9)], 2 * 10**9, 10**9, 1 << 20)
    parts = reader.partitions()
    step = byterange.ROWS_PER_PARTITION << 20
    assert all(x.end - x.start <= step for x in parts) and sum(x.end - x.start for x in parts) == 10**9
    assert sum(len(c) for _, _, c in reader.read(parts[-1])) == parts[-1].end - parts[-1].start


def test_byte_range_of_a_mounted_view(spark, tmp_path):
    """A view file system's mount resolves to the store behind it."""
    from kestrel.sources import byterange

    (tmp_path / "f.bin").write_bytes(b"0123456789")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.kestreltest.link./in", f"file://{tmp_path}")
    rows = byterange.read_byte_range(spark, "viewfs://kestreltest/in/f.bin", 3, 4).collect()
    assert [(r.path, r.offset, bytes(r.content)) for r in rows] == [("viewfs://kestreltest/in/f.bin", 3, b"3456")]


def test_bounded_sample(spark):
    from kestrel.operators import rangesort

    df = spark.range(2000).selectExpr("cast(id as string) as k", "id % 7 as v").repartition(7)
    few, more = rangesort.bounded_sample(df, 0.5, 100), rangesort.bounded_sample(df.repartition(3), 0.5, 5000)
    assert few.count() == 100 and 900 < more.count() < 1100
    assert {r.k for r in few.collect()} <= {r.k for r in more.collect()}
