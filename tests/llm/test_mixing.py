import duckdb
import odd
import pytest
from pyspark.sql import functions as F

from kestrel.llm import mixing

SMALL = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(df.select("doc_id", "source", "size", "source_size", "target", "taken").collect(), key=str)


def test_query_matches_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(duck.execute(f"SELECT doc_id, size, source_size, round(target, 6), taken, source FROM ({mixing.OP1_SQL})").fetchall(), key=str)
    got = sorted([(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.source) for r in mixing.op1_mixing(spark, SMALL).collect()], key=str)
    assert got == want


def test_words_taken_reach_the_targets(spark):
    plan = mixing.mix_plan(odd.documents(spark), block_words=8, depth=3)
    got = rows_of(plan)
    assert got == rows_of(mixing.mix_plan(odd.documents(spark), block_words=8, depth=3))   # reruns agree
    assert len(got) == len(odd.document_rows())
    by = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        s = by.setdefault(r.source, [0, 0, r.target, r.source_size])
        s[0] += r.taken
        s[1] += r.size
    assert None in by
    for taken, size, target, source_size in by.values():
        assert size == source_size and abs(taken - target) <= 1 and target <= 2 * size + 1e-9
    total = sum(s[1] for s in by.values())
    assert abs(sum(s[2] for s in by.values()) - 1.5 * total) < 1e-6


def test_pieces_are_disjoint_and_quotas_exact(spark):
    plan = mixing.mix_plan(odd.documents(spark), block_words=8, depth=3, keep=["lang"])
    pieces = mixing.draw_mix(plan, n_partitions=4).collect()
    seen = set()
    for r in pieces:
        assert 0 <= r.shard < 8 and r.first_word >= 0 and r.first_word + r.words <= r.size
        if r.doc_id not in (5,):      # a repeated row: two documents with one id
            words = {(r.doc_id, r.epoch, w) for w in range(r.first_word, r.first_word + r.words)}
            assert not words & seen
            seen |= words
    assert sum(r.words for r in pieces) == plan.agg(F.sum("taken")).first()[0]
    sizes = [sum(r.words for r in pieces if r.shard == s) for s in range(8)]
    # a shard holds the same number of blocks; each source's last block may be short
    assert max(sizes) - min(sizes) <= 8 * 6


def test_draws_are_hypergeometric(spark):
    """Mean and spread of the left half over many seeds."""
    q = spark.range(3000).select(F.col("id"), F.lit(40).cast("long").alias("good"))
    x = q.select(mixing._hypergeometric(F.lit(100).cast("long"), F.col("good"), F.lit(50).cast("long"), mixing._uniform(1, F.col("id"))).alias("x"))
    mean, var, low, high = x.agg(F.avg("x"), F.var_pop("x"), F.min("x"), F.max("x")).first()
    assert abs(mean - 20) < 0.3 and abs(var - 50 * 0.4 * 0.6 * 50 / 99) < 0.6 and low >= 0 and high <= 40
    edge = spark.range(1).select(mixing._hypergeometric(F.lit(5).cast("long"), F.lit(5).cast("long"), F.lit(2).cast("long"), F.lit(0.3)),
                                 mixing._hypergeometric(F.lit(5).cast("long"), F.lit(0).cast("long"), F.lit(2).cast("long"), F.lit(0.3)),
                                 mixing._hypergeometric(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0.3))).first()
    assert tuple(edge) == (2, 0, 0)


@pytest.mark.parametrize("rows", [[], [(1, None, "en", None, None)]])
def test_nothing_to_draw(spark, rows):
    got = mixing.mix_plan(odd.documents(spark, rows), depth=2).collect()
    assert [(r.doc_id, r.taken) for r in got] == [(r[0], 0) for r in rows]
