import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from kestrel.llm import merkle
from tests.llm import odd


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """The whole result from the definition, rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        changed = (*r[:4], lower(r[4])) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), leaf_of(changed), r[0]))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def steps(levels, i):
        for level in levels[:-1]:
            at = i // 16 * 16
            yield level[at:i], level[i + 1:at + 16]
            i //= 16

    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])]) for s in names}
    crown = tree([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for i, x in enumerate(sorted(groups[s])):
            path = [*steps(trees[s], i), *steps(crown, g)]
            now = x[3]
            for left, right in path:
                now = H(*left, now, *right)
            out.append((x[4], x[2], trees[s][-1][0], crown[-1][0], H(*[d for lr in path for side in lr for d in side]), now, now == crown[-1][0]))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def run(spark, tmp_path, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string").repartition(parts)
    frame = frame.withColumns({c: F.col("leaf") for c in ("grp", "id", "alt", "idx", "rank", "c", "path", "subroot", "_pos")})
    frame.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in merkle.op12_merkle(spark, str(tmp_path)).collect()]


@pytest.mark.parametrize("few", [1 << 16, 1])
def test_against_brute_force(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(merkle, "FEW_GROUPS", few)
    rows = [(i * 7 - 900, f"s{i % 3}" if i % 11 else None, "en", i, f"Text {i} É") for i in range(700)]
    rows += [(1 << 40, "far", None, None, None), ((1 << 62) + 5, "far", "fr", 1, ""), (-(1 << 61), "far", "fr", 1, "A"), (3, "alone", "en", 2, "B")]
    rows += [(8, "s1", "en", 1, f"Same id {i % 4}") for i in range(40)] + [(None, "s1", "en", 1, f"No id {i % 3}") for i in range(20)]
    rows += [(None, "only null", None, None, "x"), (63, "s2", "de", 5, "b" * 5000), (64, "s2", "de", 5, "Z")]
    assert sorted(run(spark, tmp_path, rows), key=key) == sorted(brute(rows), key=key)


def test_odd_rows_agree_with_brute_force_and_sql(spark, tmp_path):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in odd.document_rows()]
    got = sorted(run(spark, tmp_path, rows), key=key)
    assert got == sorted(brute(rows), key=key)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT doc_id, source, lang, n_chars, text FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(merkle.OP12_SQL).fetchall(), key=key) == got


@pytest.mark.parametrize("n", [1, 17, 257])
def test_one_group_is_its_own_root(spark, tmp_path, n):
    rows = [(i, "a", "en", i, "lower case") for i in range(n)]
    got = run(spark, tmp_path, rows)
    assert sorted(got) == sorted(brute(rows)) and all(r[2] == r[3] and r[6] for r in got)


def test_tampering_shows(spark, tmp_path):
    rows = [(i, "a", "en", i, "Upper") for i in range(100)]
    got = {r[0]: r[6] for r in run(spark, tmp_path, rows)}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 != 0 for i in range(100)}


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_ranks_need_no_wide_window(spark):
    """A group whose ids span the whole range is ranked through several levels of the tree."""
    ids = sorted({(i * 0x9E3779B97F4A7C15 + 12345) % (1 << 64) - (1 << 63) for i in range(3000)})
    leaves = spark.createDataFrame([("g", i, str(i), None) for i in ids], "grp string, id long, leaf string, alt string")
    got = sorted((r["id"], r["rank"], r["n"]) for r in merkle.ranked(merkle.cut(leaves)).collect())
    assert got == [(i, k, len(ids)) for k, i in enumerate(ids)]
