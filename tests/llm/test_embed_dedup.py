import math

import numpy as np

from kestrel.llm import embed_dedup


def brute(rows, t=0.95):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            a /= np.abs(a).max()
            ok[i] = a / np.linalg.norm(a)
    ids = sorted(ok)
    near = {i: {j for j in ids if j != i and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= t} for i in ids}
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in near[i]:
                m = min(comp[i], comp[j])
                if comp[i] != m or comp[j] != m:
                    comp[i] = comp[j] = m
                    changed = True
    return {(i, len(near.get(i, ())), comp.get(i, i), i is not None and comp.get(i, i) == i) for i, _ in rows}


def test_against_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=16).tolist()) for i in range(120)]
    for i in range(60):     # near copies, some around the threshold, and a chain
        base = np.array(rows[i % 20][1])
        rows.append((200 + i, (base + r.normal(size=16) * r.choice([0.05, 0.2, 0.33])).tolist()))
    rows += [(300 + i, rows[7][1]) for i in range(30)]                    # equal vectors
    rows += [(400, (np.array(rows[3][1]) * 1e-200).tolist()), (401, [0.0] * 16), (402, None), (403, []), (404, [float("nan")] + [1.0] * 15),
             (405, [1.0, None] + [1.0] * 14), (406, [float("inf")] + [1.0] * 15), (None, rows[7][1]), (7, rows[7][1]), (407, [1.0, 2.0])]
    df = spark.createDataFrame([(*x, 0, "?") for x in rows], "vec_id long, embedding array<double>, label int, rep string").repartition(3)
    got = {tuple(x) for x in embed_dedup.near_duplicates(df).collect()}
    want = brute(rows)
    assert {x for x in got if x[0] is not None} == {x for x in want if x[0] is not None}
    assert (None, 0, None, False) in got


def test_hot_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "MEMBERS", 16)
    monkeypatch.setattr(embed_dedup, "VISITORS", 16)
    r = np.random.default_rng(3)
    base = r.normal(size=8)
    rows = [(i, (base + r.normal(size=8) * 0.01).tolist()) for i in range(150)] + [(1000 + i, r.normal(size=8).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(x) for x in embed_dedup.near_duplicates(df).collect()} == brute(rows)


def test_vectors_of_every_dimension_are_compared(spark):
    r = np.random.default_rng(4)
    rows = []
    for d, n in ((16, 60), (8, 30), (1, 3)):
        base = r.normal(size=(n, d))
        rows += [(1000 * d + i, x.tolist()) for i, x in enumerate(base)] + [(1000 * d + 500 + i, (x + r.normal(size=d) * 0.05).tolist()) for i, x in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {tuple(x) for x in embed_dedup.near_duplicates(df).collect()}
    assert got == brute(rows) and sum(x[1] > 0 for x in got if x[0] // 1000 == 8) == 60


def test_empty_table(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def shuffled_bytes(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_vectors_are_not_shuffled_once_per_visited_cell(spark):
    r = np.random.default_rng(5)
    n, d = 8000, 64
    x = r.normal(size=(n, d))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").coalesce(4)
    before = shuffled_bytes(spark)
    assert embed_dedup.near_duplicates(df).count() == n
    assert shuffled_bytes(spark) - before < 8 * n * 4 * d


def small_cells(monkeypatch, **other):
    for name, value in ({"CELL": 64, "CELLS": 8, "LARGE": 64, "PER_CELL": 2, "QUERIES": 50, "SCORES": 64, "ROUND_BYTES": 1, "ROUND": 0.5, "BITS": 2} | other).items():
        monkeypatch.setattr(embed_dedup, name, value)


def near_rows(r, n, d):
    base = r.normal(size=(n, d))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    step = r.normal(size=(n, d)) / np.sqrt(d)
    near = base + step * r.uniform(0.05, 0.4, size=(n, 1))       # cosines on both sides of the threshold
    hot = base[0] + r.normal(size=(n // 3, d)) * 0.06
    return [(i, v.tolist()) for i, v in enumerate(r.permutation(np.concatenate([base, near, hot])))]


def test_many_cells_in_rounds(spark, monkeypatch):
    small_cells(monkeypatch)
    rows = near_rows(np.random.default_rng(6), 300, 16)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert {tuple(x) for x in embed_dedup.near_duplicates(df).collect()} == brute(rows)


def test_many_cells_cut_into_blocks(spark, monkeypatch):
    small_cells(monkeypatch, MEMBERS=24, VISITORS=60, ROUND=4.0)
    rows = near_rows(np.random.default_rng(7), 200, 12)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert {tuple(x) for x in embed_dedup.near_duplicates(df).collect()} == brute(rows)


def test_nothing_of_a_run_stays_in_the_shared_folder(spark):
    import os

    from kestrel.llm.common import shared_dir

    there = lambda: {x for x in os.listdir(shared_dir(spark).removeprefix("file:")) if x.startswith("scratch-")}
    before = there()
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert {tuple(x) for x in embed_dedup.near_duplicates(df).collect()} == {(1, 1, 1, True), (2, 1, 1, False)}
    assert there() == before


def test_each_block_has_a_partition_of_its_own(spark):
    from pyspark.sql import functions as F

    for n in (1, 7, 25):
        keys = embed_dedup._keys_of(spark, n)
        df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(n, "k")
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() == n == len(set(keys))
