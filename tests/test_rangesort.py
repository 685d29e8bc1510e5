"""Range sorts: equi-depth boundaries (FIXTURES.md §3.4), the closed form against the
literal fold, and skew-safe global positions (order, no row lost or duplicated)."""

import random

from pyspark.sql import functions as F

from conftest import plan_string

from kestrel.operators import rangesort


def fold_buckets(hist, nb=10):
    """The definition on cumulative counts: range t (from 1) ends at the first char after the end
    of range t - 1 up to which at least t steps have been counted; chars after the last end are in
    the open last bucket."""
    step = sum(n for _, n in hist) // nb
    reached = [sum(n for _, n in hist[:i + 1]) for i in range(len(hist))]
    ends = []
    for t in range(1, nb + 1):
        after = ends[-1] + 1 if ends else 0
        end = next((i for i in range(after, len(hist)) if reached[i] >= t * step), None)
        if end is None:
            break
        ends.append(end)
    return {ch: next((t for t, e in enumerate(ends) if i <= e), nb - 1) for i, (ch, _) in enumerate(hist)}


def closed_form_buckets(hist, nb=10):
    total = sum(n for _, n in hist)
    step = total // nb
    cs, m, closed = 0, None, []
    for i, (_, n) in enumerate(hist, start=1):
        cs += n
        if step > 0:
            v = cs // step - i
            m = v if m is None else min(m, v)
        closed.append(min(nb, i + min(0, m if m is not None else 0)))
    last = closed[-1] if closed else 0
    prev = [0] + closed[:-1]
    return {ch: (p if p < last else nb - 1) for (ch, _), p in zip(hist, prev)}


def test_closed_form_equals_fold_python():
    rnd = random.Random(3)
    for _ in range(5000):
        k = rnd.randint(1, 30)
        chars = sorted(rnd.sample([chr(c) for c in range(33, 127)], k))
        hist = [(c, rnd.choice([0, 1, 1, 2, 5, 50, 500, rnd.randint(0, 100)])) for c in chars]
        nb = rnd.choice([1, 3, 10])
        assert closed_form_buckets(hist, nb) == fold_buckets(hist, nb)


def _spark_buckets(spark, hist, nb=10):
    h = spark.createDataFrame(hist, "ch string, n bigint")
    b = rangesort.equi_depth_boundaries(h, nb)
    keys = spark.createDataFrame([(c,) for c, _ in hist], "k string")
    tagged = rangesort.range_bucket_assign(keys, "k", b, nb)
    return {r.k: r.bucket for r in tagged.collect()}, b


def test_equi_depth_spark_equals_fold(spark):
    rnd = random.Random(9)
    for _ in range(8):
        chars = sorted(rnd.sample([chr(c) for c in range(48, 123)], rnd.randint(1, 25)))
        hist = [(c, rnd.choice([1, 2, 7, 40, 300])) for c in chars]
        got, _ = _spark_buckets(spark, hist)
        assert got == fold_buckets(hist), hist


def test_equi_depth_micro(spark):
    hist = [(chr(ord("a") + i), 10) for i in range(20)]
    got, b = _spark_buckets(spark, hist)
    ranges = sorted((r.bucket, r.lo, r.hi) for r in b.collect())
    assert ranges == [(i, chr(ord("a") + 2 * i), chr(ord("a") + 2 * i + 1)) for i in range(10)]
    keys = spark.createDataFrame([(k,) for k in ["a", "c", "t", "z", "0", ""]], "k string")
    tagged = {r.k: r.bucket for r in rangesort.range_bucket_assign(keys, "k", b).collect()}
    assert tagged == {"a": 0, "c": 1, "t": 9, "z": 9, "0": 0, "": 0}

    hist2 = [("a", 100), ("b", 5), ("c", 5)]
    _, b2 = _spark_buckets(spark, hist2)
    keys2 = spark.createDataFrame([(k,) for k in ["a", "b", "c", "d"]], "k string")
    tagged2 = {r.k: r.bucket for r in rangesort.range_bucket_assign(keys2, "k", b2).collect()}
    assert tagged2 == {"a": 0, "b": 1, "c": 2, "d": 9}


def _skewed_rows(seed=1, n=3000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rnd.random() < 0.35:
            rows.append(("hot", "same"))           # one value holds a third of the rows
        elif rnd.random() < 0.2:
            rows.append(("warm", str(rnd.randint(0, 3))))
        else:
            rows.append((rnd.choice("abcdefghij") + str(rnd.randint(0, 999)), str(i)))
    return rows


def test_total_order_positions_skewed(spark):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "k string, v string")
    out = rangesort.total_order_sort(df, ["k"], n_ranges=5, chunk_rows=50, sample_per_range=16)
    got = out.withColumn("p", F.spark_partition_id()).collect()
    assert sorted(r.pos for r in got) == list(range(1, len(rows) + 1))
    by_pos = [(r.k, r.v) for r in sorted(got, key=lambda r: r.pos)]
    assert by_pos == sorted(rows)
    # range layout: partition i holds keys <= those of partition i+1, and the hot value
    # (a third of all rows) is spread over several partitions
    parts = {}
    for r in got:
        parts.setdefault(r.p, []).append((r.k, r.v))
    ordered = [parts[p] for p in sorted(parts)]
    for a, b in zip(ordered, ordered[1:]):
        assert max(a) <= min(b)
    hot_parts = {r.p for r in got if r.k == "hot"}
    assert len(hot_parts) >= 2


def test_group_positions(spark):
    rows = _skewed_rows(seed=2, n=1500)
    df = spark.createDataFrame([(k[0], k, v) for k, v in rows], "g string, k string, v string")
    out = rangesort.ordered_positions(df, ["k", "v"], ["g"], n_ranges=4, chunk_rows=20).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.g, []).append(r)
    for g, rs in groups.items():
        assert sorted(r.pos for r in rs) == list(range(1, len(rs) + 1))
        assert [(r.k, r.v) for r in sorted(rs, key=lambda r: r.pos)] == sorted((r.k, r.v) for r in rs)


def test_custom_range_sort_keeps_every_row(spark):
    rows = [(k, str(i)) for i, k in enumerate(["", "0", "a1", "a2", "b", "c", "zz", "~x"] * 7)]
    df = spark.createDataFrame(rows, "k string, v string")
    hist = rangesort.first_char_histogram(df.where(F.col("k") > "a"), "k", 1.0)
    b = rangesort.equi_depth_boundaries(hist, 3)
    out = rangesort.custom_range_sort(df, "k", b, n_buckets=3, n_ranges=3).collect()
    assert len(out) == len(rows)
    by_bucket = {}
    for r in out:
        by_bucket.setdefault(r.bucket, []).append(r)
    assert {r.k for r in by_bucket[0]} >= {"", "0"}       # below the first sampled char -> 0
    for bk, rs in by_bucket.items():
        assert sorted(r.pos_in_bucket for r in rs) == list(range(1, len(rs) + 1))
    buckets = sorted(by_bucket)
    for a, c in zip(buckets, buckets[1:]):
        assert max(r.k for r in by_bucket[a]) <= min(r.k for r in by_bucket[c])


def test_hash_sample_is_deterministic(spark):
    df = spark.range(0, 20000).select(F.col("id").cast("string").alias("k"))
    a = df.where(rangesort.hash_sample(["k"], 0.02)).count()
    b = df.where(rangesort.hash_sample(["k"], 0.02)).count()
    assert a == b and 250 < a < 550


def test_sample_draws_rows_not_keys(spark):
    """A key with half of the rows has about half of the sample."""
    df = spark.range(0, 40000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                      F.col("id").cast("string").alias("v"))
    picked = df.where(rangesort.hash_sample(["k", "v"], 0.05))
    n, hot = picked.count(), picked.where("k = 'hot'").count()
    assert 1700 < n < 2300 and 0.45 < hot / n < 0.55


def test_more_ranges_than_a_linear_scan_would_like(spark):
    """Over 32 ranges and a wide payload that is not in the order: every row once, in order."""
    df = spark.range(0, 4000).select((F.col("id") * 7919 % 1000).alias("k"), F.repeat(F.lit("x"), 300).alias("wide"),
                                     F.col("id").cast("string").alias("v"))
    out = rangesort.total_order_sort(df, ["k"], n_ranges=40, repeated_rows=False, tie_cols=[])
    got = out.select("k", "v", "pos", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.pos for r in got) == list(range(1, 4001))
    keys = [r.k for r in sorted(got, key=lambda r: r.pos)]
    assert keys == sorted(keys) and len({r.v for r in got}) == 4000 and len({r.p for r in got}) > 32


def test_null_groups_keep_their_rows(spark):
    rows = [(None, "a"), (None, "b"), ("g", "c")]
    df = spark.createDataFrame(rows, "g string, k string")
    out = {(r.g, r.k): r.pos for r in rangesort.ordered_positions(df, ["k"], ["g"], n_ranges=2).collect()}
    assert out == {(None, "a"): 1, (None, "b"): 2, ("g", "c"): 1}


def test_count_below_bisection(spark):
    from kestrel.functions import search

    rnd = random.Random(4)
    bounds = sorted(rnd.sample(range(0, 5000), 100))
    keys = [rnd.randint(-10, 5010) for _ in range(500)] + bounds[:20]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    arr = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    out = df.select("k", search.count_below(arr, F.col("k"), 100).alias("bis"),
                    search.count_below(F.slice(arr, 1, 10), F.col("k"), 10).alias("lin"),
                    search.count_below(arr, F.col("k"), 100, inclusive=True).alias("inc")).collect()
    for r in out:
        assert r.bis == sum(1 for b in bounds if b < r.k)
        assert r.lin == sum(1 for b in bounds[:10] if b < r.k)
        assert r.inc == sum(1 for b in bounds if b <= r.k)


def test_positions_with_null_keys(spark):
    rows = [(None, "b"), ("a", None), ("a", "x"), (None, None), ("c", "y"), (None, "b"), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    out = rangesort.total_order_sort(df, ["k"], n_ranges=3).collect()
    got = [(r.k, r.v) for r in sorted(out, key=lambda r: r.pos)]

    def key(t):  # ascending, nulls first
        return tuple((x is not None, x or "") for x in t)

    assert sorted(r.pos for r in out) == list(range(1, len(rows) + 1))
    assert got == sorted(rows, key=key)


def test_empty_and_tiny_inputs(spark):
    empty = spark.createDataFrame([], "k string, v string")
    assert rangesort.total_order_sort(empty, ["k"], n_ranges=3).collect() == []
    hist = spark.createDataFrame([("a", 1), ("b", 2)], "ch string, n bigint")   # total < buckets: step 0
    got, _ = _spark_buckets(spark, [("a", 1), ("b", 2)])
    assert got == fold_buckets([("a", 1), ("b", 2)])
    b = rangesort.equi_depth_boundaries(hist.where("n > 5"), 10)          # empty histogram
    keys = spark.createDataFrame([("x",)], "k string")
    assert [r.bucket for r in rangesort.range_bucket_assign(keys, "k", b).collect()] == [9]


def test_group_positions_with_group_bound(spark):
    rows = _skewed_rows(seed=5, n=1200)
    df = spark.createDataFrame([(k[0], k, v) for k, v in rows], "g string, k string, v string")
    out = rangesort.ordered_positions(df, ["k", "v"], ["g"], n_ranges=4, chunk_rows=20).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.g, []).append(r)
    for g, rs in groups.items():
        assert [(r.k, r.v) for r in sorted(rs, key=lambda r: r.pos)] == sorted((r.k, r.v) for r in rs)
        assert sorted(r.pos for r in rs) == list(range(1, len(rs) + 1))


def _keyed(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string").repartition(3)
    return df.select("k", "v", F.struct("k", "v", F.xxhash64("k", "v").alias("_tie"), F.lit(0).cast("bigint").alias("_chunk")).alias("_key"),
                     F.lit(1).cast("bigint").alias("_w"))


def _two_level(spark, rows, r, per_range=4):
    keyed = _keyed(spark, rows)
    h = F.pmod(F.xxhash64("_key", F.lit(7)), F.lit(rangesort.HASH_SPACE))
    bounds = rangesort._sampled_bounds(keyed, r, per_range, h)
    return keyed, bounds


def test_two_level_bounds_cut_into_even_ranges(spark, monkeypatch):
    """Forced to two levels, with and without the join: same ids, monotone, and about even."""
    monkeypatch.setattr(rangesort, "SMALL_SAMPLE", 10)
    rnd = random.Random(11)
    rows = [(rnd.choice("abcdefgh") * rnd.randint(1, 3) + str(rnd.randint(0, 10**6)), str(i)) for i in range(6000)]
    keyed, bounds = _two_level(spark, rows, 40, 50)
    assert bounds.flat is None
    ids = {}
    for limit in (1 << 12, 1):
        monkeypatch.setattr(rangesort, "ONE_LEVEL", limit)
        got = rangesort.range_ids(keyed, bounds, 40).select("k", "v", "_range").collect()
        ids[limit] = {(r.k, r.v): r._range for r in got}
        assert len(got) == len(rows)
    assert ids[1 << 12] == ids[1]
    in_order = [ids[1][x] for x in sorted(ids[1])]
    assert in_order == sorted(in_order) and set(in_order) == set(range(40))
    sizes = [in_order.count(i) for i in range(40)]
    assert max(sizes) < 3 * 6000 / 40


def test_two_level_sort_is_a_total_order(spark, monkeypatch):
    monkeypatch.setattr(rangesort, "SMALL_SAMPLE", 10)
    monkeypatch.setattr(rangesort, "ONE_LEVEL", 1)
    rows = _skewed_rows(seed=12, n=1200)
    df = spark.createDataFrame(rows, "k string, v string")
    out = rangesort.total_order_sort(df, ["k"], n_ranges=9, chunk_rows=50, sample_per_range=8).collect()
    assert sorted(r.pos for r in out) == list(range(1, len(rows) + 1))
    assert [(r.k, r.v) for r in sorted(out, key=lambda r: r.pos)] == sorted(rows)


def test_what_every_task_holds_does_not_grow_with_the_ranges(spark):
    """10^5 ranges: the array sent to all tasks has about sqrt of them, as has each coarse range's list."""
    r = 100_000
    rows = [(f"{i * 7919 % 30011:05d}", str(i)) for i in range(30_000)]
    keyed, bounds = _two_level(spark, rows, r, 1)
    assert bounds.flat is None and bounds.n_coarse == 317
    assert bounds.coarse.select(F.size("_cuts")).first()[0] <= 316
    sizes = [x[0] for x in bounds.fine.select(F.size("_fine")).collect() if x[0]]
    assert max(sizes) <= 10 * 317
    plan = plan_string(rangesort.range_ids(keyed, bounds, r))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = [x[0] for x in rangesort.range_ids(keyed, bounds, r).orderBy("k", "v").select("_range").collect()]
    assert got == sorted(got) and len(set(got)) > 25_000


def test_no_task_sees_a_large_sample(spark):
    """At 400,000 ranges the sample's windows are partitioned by coarse range; those without partitions only read
    the coarse sample (633 / 400,000 of it) and sums of one row per coarse range."""
    keyed, bounds = _two_level(spark, [("a", "b")], 400_000, 64)
    assert bounds.n_coarse == 633 and f"* {633 / 400_000}" in plan_string(bounds.coarse)
    windows = [w for w in plan_string(bounds.fine).split("\n") if w.startswith("Arguments: [") and "windowspecdefinition(" in w]
    whole = [w for w in windows if "sum(_sw" in w and ("windowspecdefinition(_key" in w or "windowspecdefinition(specified" in w)]
    coarse = [w for w in plan_string(bounds.coarse).split("\n") if w.startswith("Arguments: [") and "sum(_sw" in w]
    assert any("sum(_sw" in w and "windowspecdefinition(_c" in w for w in windows) and len(whole) == len(coarse)


def test_trie_boundaries_equal_the_fold(spark):
    """Long prefixes, heavy ones, short keys, more ranges than prefixes: the literal fold on each."""
    rnd = random.Random(21)
    cases = [[("a", 100), ("b", 5), ("c", 5)], [("a", 1), ("b", 2)], [("", 50), ("a", 1), ("aa", 1), ("aaa", 1), ("ab", 50)],
             [("zz", 7)], [("z", 3), ("é", 10), ("éa", 30)]]
    for _ in range(4):
        keys = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(0, 3))) for _ in range(rnd.randint(2, 40))}, key=lambda k: k.encode())
        cases.append([(k, rnd.choice([1, 2, 30, 400])) for k in keys])
    for hist in cases:
        nb = rnd.choice([3, 10])
        b = rangesort.equi_depth_boundaries(spark.createDataFrame(hist, "ch string, n bigint"), nb, prefix_len=3)
        want, closed = fold_buckets(hist, nb), {}
        for ch, n in hist:
            lo, hi, total = closed.get(want[ch], (ch, ch, 0))
            closed[want[ch]] = (lo, ch, total + n)
        assert {r.bucket: (r.lo, r.hi, r.n) for r in b.collect()} == closed, hist
        keys = spark.createDataFrame([(c,) for c, _ in hist], "k string")
        assert {r.k: r.bucket for r in rangesort.range_bucket_assign(keys, "k", b, nb, 3).collect()} == want


def test_no_window_over_all_prefixes(spark):
    hist = spark.range(5).selectExpr("cast(id as string) as ch", "id as n")
    plan = plan_string(rangesort.equi_depth_boundaries(hist, 10, prefix_len=4))
    windows = [w for w in plan.split("\n") if "windowspecdefinition(" in w]
    assert windows and all("windowspecdefinition(_at" in w or "windowspecdefinition(_g" in w for w in windows)
    assert "WindowGroupLimit" in plan


def test_grouped_limit_where_it_can_cut(spark):
    """Spark leaves the limit out only where it knows of no more rows than that (as of the five of the test before)."""
    for n in (5, 11):
        hist = spark.range(n).selectExpr("cast(id as string) as ch", "id as n")
        assert ("WindowGroupLimit" in plan_string(rangesort.equi_depth_boundaries(hist, 10, prefix_len=4))) == (n > 10)
