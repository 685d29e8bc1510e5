"""Graph operators over an undirected edge list: canonical edges, adjacency, triangles.

Triangles are found with the degree-ordered scheme (each edge is directed from the
endpoint of lower (degree, id) to the higher one): a vertex's out-degree is then at most
sqrt(2m), so the wedges enumerated at a vertex stay bounded even when one vertex touches
a third of all edges, and the total work is O(m^1.5) instead of sum(deg^2). Each wedge is
made once, from lists of bounded size; those that a Bloom filter of the edges (one per vertex, over its
out-neighbours) shows to be open go before the shuffle, the others are closed by an equi-join on the outer vertices.

The wedge histogram of the reference (how many of a triple's three wedges exist) follows
from two aggregates without enumerating any wedge: a simple graph has
sum(deg*(deg-1)/2) wedges, a triangle is a triple with 3 of them and every other triple
that has a wedge has exactly 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.rangesort import ordered_positions

# Fixed value: the label of the reference's triangle-count output record.
TRIANGLE_LABEL = "Total Triangles: "


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """src < dst, self-loops dropped, duplicates and reversed copies merged."""
    a, b = F.col(src), F.col(dst)
    return (edges.where(a != b)
            .select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"))
            .distinct())


def symmetrize(edges: DataFrame) -> DataFrame:
    """Both directions of every edge -> v, u."""
    both = F.explode(F.array(F.struct(F.col("src").alias("v"), F.col("dst").alias("u")),
                             F.struct(F.col("dst").alias("v"), F.col("src").alias("u"))))
    return edges.select(both.alias("_e")).select("_e.v", "_e.u")


def degrees(edges: DataFrame) -> DataFrame:
    """v, degree over canonical edges (partial + final aggregate)."""
    return symmetrize(edges).groupBy("v").agg(F.count(F.lit(1)).alias("degree"))


# A vertex up to this degree has its whole list gathered in one row before it is cut.
HUB_DEGREE = 1 << 20


def adjacency(edges: DataFrame, chunk_size: int = 1024, n_ranges: int | None = None,
              hub_degree: int = HUB_DEGREE) -> DataFrame:
    """v, degree, chunk, neighbours: sorted neighbour lists in pieces of <= chunk_size.

    One shuffle by vertex gathers, sorts and cuts the lists of at most ``hub_degree``
    neighbours (8 MB). Larger vertices - at most 2 m / hub_degree of them - are known from their degree
    counts; their neighbours are ranked by range instead, so no task holds a hub's list.
    ``edges`` must be canonical (``canonical_edges``): then every (v, u) is distinct.
    """
    c = int(chunk_size)
    sym = symmetrize(edges)
    hubs = degrees(edges).where(F.col("degree") > hub_degree)
    lists = (sym.join(hubs.select("v"), "v", "left_anti").groupBy("v").agg(F.sort_array(F.collect_list("u")).alias("_all"))
             .withColumn("degree", F.size("_all").cast("bigint")))
    cut = F.transform(F.sequence(F.lit(0), F.expr(f"cast((degree - 1) div {c} as int)")),
                      lambda i: F.struct(i.cast("bigint").alias("chunk"), F.slice("_all", i * c + 1, F.lit(c)).alias("neighbours")))
    small = lists.select("v", "degree", F.explode(cut).alias("_c")).select("v", "degree", "_c.*")
    ranked = ordered_positions(sym.join(hubs, "v"), ["u"], ["v", "degree"], n_ranges, pos_col="_rank",
                             repeated_rows=False)
    big = (ranked.withColumn("chunk", F.expr(f"(_rank - 1) div {c}")).groupBy("v", "degree", "chunk")
           .agg(F.sort_array(F.collect_list("u")).alias("neighbours")))
    return small.unionByName(big).select("v", "degree", "chunk", "neighbours")


def orient(edges: DataFrame, by: str = "degree") -> DataFrame:
    """Direct each canonical edge low -> high: by (degree, id) or by id alone.

    -> x, y, dy: tail, head and the head's rank degree (0 when orienting by id), so that
    heads compare as (dy, y) with plain column compares.
    """
    if by == "id":
        return edges.select(F.col("src").alias("x"), F.col("dst").alias("y"),
                            F.lit(0).cast("bigint").alias("dy"))
    if by != "degree":
        raise ValueError("orient by 'degree' or 'id'")
    deg = degrees(edges)
    ds = deg.select(F.col("v").alias("src"), F.col("degree").alias("_ds"))
    dd = deg.select(F.col("v").alias("dst"), F.col("degree").alias("_dd"))
    e = edges.join(ds, "src").join(dd, "dst")
    forward = _rank_less(F.col("_ds"), F.col("src"), F.col("_dd"), F.col("dst"))
    return e.select(F.when(forward, F.col("src")).otherwise(F.col("dst")).alias("x"),
                    F.when(forward, F.col("dst")).otherwise(F.col("src")).alias("y"),
                    F.when(forward, F.col("_dd")).otherwise(F.col("_ds")).alias("dy"))


def _rank_less(d1, id1, d2, id2):
    """(d1, id1) < (d2, id2), lexicographically."""
    return (d1 < d2) | ((d1 == d2) & (id1 < id2))


# Out-neighbours of one vertex that meet in one join key; larger tails are cut into blocks.
TAIL_BLOCK = 4096


def _in_blocks(oriented: DataFrame, block: int) -> DataFrame:
    """``oriented`` with ``_nb``, the blocks of its tail's out-neighbours (1 up to ``block`` of them), and ``_b``, its own."""
    heavy = (oriented.groupBy("x").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
             .select(F.col("x").alias("_x"), F.ceil(F.col("_n") / block).cast("int").alias("_nb")))
    o = oriented.join(heavy, F.col("x") == F.col("_x"), "left").withColumn("_nb", F.coalesce("_nb", F.lit(1))).drop("_x")
    return o.withColumn("_b", F.when(F.col("_nb") > 1, F.pmod(F.xxhash64("y"), F.col("_nb")).cast("int")).otherwise(F.lit(0)))


# Bits of a vertex's Bloom filter over its out-neighbours, in 64-bit words.
FILTER_WORDS = 4


def _bit(vertex: str):
    """Number of the filter's bit that stands for a vertex."""
    return F.pmod(F.xxhash64(F.lit(17), F.col(vertex)), F.lit(64 * FILTER_WORDS)).cast("int")


def with_filters(oriented: DataFrame) -> DataFrame:
    """``oriented`` with ``bit``, that of the head, and ``f0`` .. the Bloom filter of the head's out-neighbours.

    A wedge (q1, q2) can only be closed if q2's bit is set in q1's filter. One aggregate (a bitwise OR,
    combined before the shuffle) and one equi-join on the head; a head without out-neighbours has an empty filter.
    """
    o = oriented.withColumn("bit", _bit("y"))
    word = [F.bit_or(F.when(F.shiftright("bit", 6) == i, F.expr("shiftleft(1L, bit & 63)")).otherwise(F.lit(0).cast("bigint"))).alias(f"f{i}")
            for i in range(FILTER_WORDS)]
    filters = o.groupBy(F.col("x").alias("_v")).agg(*word)
    return o.join(filters, F.col("y") == F.col("_v"), "left").select(
        "x", "y", "dy", "bit", *[F.coalesce(f"f{i}", F.lit(0).cast("bigint")).alias(f"f{i}") for i in range(FILTER_WORDS)])


def _may_hold(filters, bit: str):
    """Whether the bit numbered ``bit`` is set in the filter whose words are the columns ``filters``."""
    word = " ".join(f"when {i} then {f}" for i, f in enumerate(filters))
    return F.expr(f"shiftrightunsigned(case {bit} >> 6 {word} end, {bit} & 63) & 1 = 1")


def wedges(oriented: DataFrame, block: int = TAIL_BLOCK, filtered: bool = True) -> DataFrame:
    """p, q1, q2: pairs of out-neighbours of p, q1 below q2, each once; ``filtered`` leaves out pairs that
    the Bloom filters show to have no edge.

    The out-neighbours of a tail come together as sorted lists of at most about ``block``, and each is paired
    with those after it. Blocks of one heavy tail (cut by hash) meet as rows, every two of them by an equi-join of their
    own, so no list and no join key grows with a tail.
    """
    fs = [f"f{i}" for i in range(FILTER_WORDS)]
    o = _in_blocks(with_filters(oriented) if filtered else oriented, block)
    if not filtered:
        o = o.select("*", F.lit(0).alias("bit"), *[F.lit(0).cast("bigint").alias(f) for f in fs])
    lists = (o.groupBy("x", "_b").agg(F.sort_array(F.collect_list(F.struct(F.col("dy").alias("d"), F.col("y").alias("q"), "bit", *fs))).alias("_l"))
             .where(F.size("_l") > 1).withColumn("_r", F.transform("_l", lambda e: F.struct(e["q"].alias("q"), e["bit"].alias("bit")))))
    each = lists.select("x", "_r", F.posexplode("_l").alias("_i", "_e"))
    pairs = each.select("x", "_e", F.explode(F.slice("_r", F.col("_i") + 2, F.lit(1 << 30))).alias("_o"))
    keep = _may_hold([f"_e.{f}" for f in fs], "_o.bit") if filtered else F.lit(True)
    inside = pairs.where(keep).select(F.col("x").alias("p"), F.col("_e.q").alias("q1"), F.col("_o.q").alias("q2"))

    big = o.where("_nb > 1")
    left = big.select(F.col("x").alias("p"), F.col("_b").alias("i"), F.explode(F.sequence(F.col("_b"), F.col("_nb"))).alias("j"),
                      *[F.col(c).alias(f"{c}1") for c in ("y", "dy", "bit", *fs)], "_nb").where("j > i and j < _nb")
    right = big.select(F.col("x").alias("p"), F.explode(F.sequence(F.lit(-1), F.col("_b") - 1)).alias("i"), F.col("_b").alias("j"),
                       *[F.col(c).alias(f"{c}2") for c in ("y", "dy", "bit", *fs)]).where("i >= 0")
    met = left.drop("_nb").join(right, ["p", "i", "j"])
    up = _rank_less(F.col("dy1"), F.col("y1"), F.col("dy2"), F.col("y2"))
    if filtered:
        met = met.where(F.when(up, _may_hold([f"{f}1" for f in fs], "bit2")).otherwise(_may_hold([f"{f}2" for f in fs], "bit1")))
    across = met.select("p", F.when(up, F.col("y1")).otherwise(F.col("y2")).alias("q1"), F.when(up, F.col("y2")).otherwise(F.col("y1")).alias("q2"))
    return inside.unionByName(across)


def triangles(edges: DataFrame, by: str = "degree", block: int = TAIL_BLOCK) -> DataFrame:
    """a, b, c (a < b < c by id): every triangle of the canonical edge list once."""
    o = orient(edges, by)
    close = o.select(F.col("x").alias("q1"), F.col("y").alias("q2"))
    tri = wedges(o, block).join(close, ["q1", "q2"], "left_semi")
    p, q1, q2 = F.col("p"), F.col("q1"), F.col("q2")
    middle = F.greatest(F.least(p, q1), F.least(F.greatest(p, q1), q2))
    return tri.select(F.least(p, q1, q2).alias("a"), middle.alias("b"), F.greatest(p, q1, q2).alias("c"))


def triangle_count(tris: DataFrame) -> DataFrame:
    """label, n: one row, ``Total Triangles: <n>``."""
    n = tris.agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.concat(F.lit(TRIANGLE_LABEL), F.col("n").cast("string")).alias("label"), "n")


def wedges_of(degree: str):
    """degree * (degree - 1) / 2 in whole numbers (one of the factors is even)."""
    d = F.col(degree).cast("bigint")
    even = d % 2 == 0
    half = F.when(even, F.expr(f"cast({degree} as bigint) div 2")).otherwise(F.expr(f"(cast({degree} as bigint) - 1) div 2"))
    other = F.when(even, d - 1).otherwise(d)
    return (half.cast("decimal(19,0)") * other.cast("decimal(19,0)")).cast("decimal(38,0)")


def wedge_closure_histogram(edges: DataFrame, by: str = "degree") -> DataFrame:
    """wedges, n_triples: triples having 1 wedge (open paths) and 3 wedges (triangles).

    Both numbers come from aggregates (no wedge list): all wedges = sum C(deg, 2), and the
    triangle count from ``triangles``. Empty classes are left out.
    """
    whole = "decimal(38,0)"
    w = degrees(edges).select(F.lit("w").alias("_k"), wedges_of("degree").alias("_x"))
    t = triangles(edges, by).select(F.lit("t").alias("_k"), F.lit(1).cast(whole).alias("_x"))
    zero = F.lit(0).cast(whole)
    totals = w.unionByName(t).agg(
        F.coalesce(F.sum(F.when(F.col("_k") == "w", F.col("_x"))), zero).cast(whole).alias("_w"),
        F.coalesce(F.sum(F.when(F.col("_k") == "t", F.col("_x"))), zero).cast(whole).alias("_t"))
    rows = totals.select(F.explode(F.array(
        F.struct(F.lit(1).cast("bigint").alias("wedges"), (F.col("_w") - 3 * F.col("_t")).cast("bigint").alias("n_triples")),
        F.struct(F.lit(3).cast("bigint").alias("wedges"), F.col("_t").cast("bigint").alias("n_triples")))).alias("_r"))
    return rows.select("_r.wedges", "_r.n_triples").where(F.col("n_triples") > 0)
