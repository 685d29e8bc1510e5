"""Triangles and wedges (FIXTURES.md §3.7) plus invariance properties."""

import itertools
import random

import pytest

from kestrel.operators import graph


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def _tri(spark, pairs, by="degree"):
    return sorted(tuple(r) for r in graph.triangles(graph.canonical_edges(_edges(spark, pairs)), by).collect())


@pytest.mark.parametrize("pairs,expected", [
    ([(1, 2), (2, 3), (1, 3)], 1),
    ([(1, 2), (2, 1), (2, 3), (3, 2)], 0),
    ([(1, 2)] * 3, 0),
    ([(1, 2)] * 3 + [(2, 3)], 0),
    ([(1, 1), (1, 2), (2, 3), (1, 3)], 1),
    ([(1, 1), (1, 2)], 0),
])
def test_triangle_micro(spark, pairs, expected):
    for by in ("degree", "id"):
        assert len(_tri(spark, pairs, by)) == expected


def brute(pairs):
    adj = {}
    for a, b in pairs:
        if a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    tris = {tuple(sorted((a, b, c))) for a in adj for b, c in itertools.combinations(adj[a], 2) if c in adj[b]}
    wedges = {}
    for m, ns in adj.items():
        for p, q in itertools.combinations(sorted(ns), 2):
            t = tuple(sorted((p, m, q)))
            wedges[t] = wedges.get(t, 0) + 1
    hist = {}
    for c in wedges.values():
        hist[c] = hist.get(c, 0) + 1
    return sorted(tris), hist


def _random_graph(seed, n=60, m=400, hub=0):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
    pairs += [(hub, rnd.randrange(n)) for _ in range(m // 2)]   # one vertex with a large degree
    return pairs


def test_triangles_and_histogram_vs_brute(spark):
    pairs = _random_graph(1)
    tris, hist = brute(pairs)
    for by in ("degree", "id"):
        assert _tri(spark, pairs, by) == tris
    e = graph.canonical_edges(_edges(spark, pairs))
    got = {r.wedges: r.n_triples for r in graph.wedge_closure_histogram(e).collect()}
    assert got == hist
    label = graph.triangle_count(graph.triangles(e)).collect()[0]
    assert label.label == f"Total Triangles: {len(tris)}" and label.n == len(tris)


def test_triangle_invariances(spark):
    pairs = _random_graph(2, n=40, m=250)
    base = len(_tri(spark, pairs))
    reversed_pairs = [(b, a) for a, b in pairs]
    doubled = pairs + pairs[: len(pairs) // 2]
    relabel = {v: 1000 - 7 * v for v in range(40)}
    relabeled = [(relabel[a], relabel[b]) for a, b in pairs]
    assert len(_tri(spark, reversed_pairs)) == base
    assert len(_tri(spark, doubled)) == base
    assert len(_tri(spark, relabeled)) == base


@pytest.mark.parametrize("chunk", [4, 12])
def test_adjacency_chunks(spark, chunk):
    """Hub vertices (degree > chunk) are cut by rank, the others come whole as chunk 0."""
    pairs = _random_graph(3, n=30, m=200) + [(100 + i, i) for i in range(10)]   # some degree-1 vertices
    e = graph.canonical_edges(_edges(spark, pairs))
    adj = graph.adjacency(e, chunk_size=chunk, n_ranges=3).collect()
    assert {r.degree > chunk for r in adj} == {True, False}
    full = {}
    for r in adj:
        assert len(r.neighbours) <= chunk
        full.setdefault(r.v, {})[r.chunk] = list(r.neighbours)
    expected = {}
    for a, b in pairs:
        if a != b:
            expected.setdefault(a, set()).add(b)
            expected.setdefault(b, set()).add(a)
    for v, chunks in full.items():
        joined = [u for c in sorted(chunks) for u in chunks[c]]
        assert joined == sorted(expected[v])
    assert set(full) == set(expected)


def test_wedge_counts_are_whole_numbers(spark):
    df = spark.createDataFrame([(200_000_003,), (300_000_007,), (4_000_000_007,), (0,), (1,), (2,)], "degree long")
    for r in df.select("degree", graph.wedges_of("degree").alias("w")).collect():
        assert int(r.w) == r.degree * (r.degree - 1) // 2


def test_heavy_tails_meet_in_small_blocks(spark):
    import itertools
    import random

    rnd = random.Random(8)
    n, block = 60, 8
    pairs = [(0, i) for i in range(1, n)] + [tuple(sorted(rnd.sample(range(1, n), 2))) for _ in range(300)]
    edges = graph.canonical_edges(spark.createDataFrame(pairs, "src long, dst long"))
    have = {tuple(sorted(p)) for p in pairs}
    want = {t for t in itertools.combinations(range(n), 3) if {(t[0], t[1]), (t[0], t[2]), (t[1], t[2])} <= have}
    for by in ("id", "degree"):
        assert sorted(tuple(r) for r in graph.triangles(edges, by, block=block).collect()) == sorted(want)
        o = graph.orient(edges, by)
        blocks = graph._in_blocks(o, block).groupBy("x", "_b").count()
        assert blocks.agg({"count": "max"}).first()[0] <= 4 * block and blocks.where("_b > 0").count() > 0


def test_every_wedge_once_and_open_ones_filtered(spark):
    """Unfiltered: each pair of out-neighbours once, in order. Filtered: all closed ones, and few of the open ones."""
    pairs = _random_graph(7, n=300, m=3000)
    edges = graph.canonical_edges(_edges(spark, pairs)).cache()
    o = graph.orient(edges).cache()
    out, rank = {}, {}
    for r in o.collect():
        out.setdefault(r.x, set()).add(r.y)
        rank[r.y] = (r.dy, r.y)
    want = sorted((p, *sorted(c, key=rank.get)) for p, ns in out.items() for c in itertools.combinations(ns, 2))
    closed = {w for w in want if w[2] in out.get(w[1], ())}
    for block in (4096, 4):
        assert sorted(tuple(r) for r in graph.wedges(o, block, filtered=False).collect()) == want
        kept = [tuple(r) for r in graph.wedges(o, block).collect()]
        assert len(kept) == len(set(kept)) and closed <= set(kept) <= set(want)
        assert len(kept) - len(closed) < 0.3 * (len(want) - len(closed))


def test_adjacency_ranks_hubs_by_range(spark):
    pairs = [(0, i) for i in range(1, 200)] + [(1, i) for i in range(2, 20)]
    edges = graph.canonical_edges(spark.createDataFrame(pairs, "src long, dst long"))
    plain = sorted(tuple(r) for r in graph.adjacency(edges, 16).collect())
    hubs = sorted(tuple(r) for r in graph.adjacency(edges, 16, n_ranges=4, hub_degree=10).collect())
    assert plain == hubs and all(len(r[3]) <= 16 for r in plain)
