"""Range partitioning and total orders: global positions, equi-depth boundaries, bucket sorts.

``range_sort`` is a plain range-partitioned sort (no positions). ``ordered_positions`` adds a
global position per row without a window over the whole data:

1. range bounds are weighted quantiles of a size-proportional hash sample (about
   ``R * sample_per_range`` narrow rows: the order and tie-break columns, a 64-bit row hash and a
   chunk number - not the payload); a large sample is cut into about sqrt(R) coarse ranges first, which
   find their own bounds, so no task sees it whole;
2. each row finds its range by binary search over the bounds (a scalar subquery of at most ``ONE_LEVEL``
   such structs, or two levels of about sqrt(R)) - deterministic, so a lost task recomputes the same range id;
3. ``repartitionById(R)`` puts range r in partition r (the one shuffle of whole rows);
   per-range totals (R rows, broadcast) give each range's base offset and a ``row_number``
   in key order gives every row its position.

Inputs in which equal rows may be a large share are collapsed to (row, count) first and a
row repeated more than ``chunk_rows`` times is cut into chunks, so a hot value becomes many
small, orderable pieces and is spread over many ranges.

The result is range-partitioned (partition i holds only keys <= those of partition i+1)
and sorted within partitions, i.e. a total-order sort that can be written as is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.search import count_below
from kestrel.functions.text import key_prefix

DEFAULT_CHUNK_ROWS = 1 << 20
DEFAULT_SAMPLE_PER_RANGE = 64
HASH_SPACE = 1 << 30
SMALL_SAMPLE = 1 << 15      # expected sample rows whose bounds one task finds
ONE_LEVEL = 1 << 12         # ranges whose bounds every task holds; more are looked up in two levels


def _n_ranges(df: DataFrame, n_ranges: int | None) -> int:
    """Ranges to cut the order into; by default the session's shuffle partition count,
    which a cluster sizes to its data (each range is one task's share)."""
    if n_ranges:
        return int(n_ranges)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_sort(df: DataFrame, order_cols, n_ranges: int | None = None) -> DataFrame:
    """Rows in range partitions, sorted within each: a total order without positions."""
    return df.repartitionByRange(_n_ranges(df, n_ranges), *order_cols).sortWithinPartitions(*order_cols)


def _coarse_ranges(r: int) -> int:
    """Ranges of the first level: about the square root of ``r``."""
    return max(1, math.isqrt(r - 1) + 1)


def _cut_points(sample: DataFrame, pieces: int) -> DataFrame:
    """One row ``_cuts``: the last key of every piece but the last, for ``pieces`` of equal weight of a
    small weighted sample (``_key``, ``_sw``), as a sorted array."""
    cum = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy(F.lit(0))
    quant = sample.select("_key", F.floor((F.sum("_sw").over(cum) - F.col("_sw")) * pieces / F.sum("_sw").over(total)).alias("_q"))
    last = Window.orderBy("_key")
    ends = (quant.withColumn("_next", F.lead("_q").over(last))
            .where((F.col("_q") < pieces - 1) & ~F.col("_q").eqNullSafe(F.col("_next"))))
    return ends.agg(F.sort_array(F.collect_list("_key")).alias("_cuts"))


class Bounds:
    """Sort bounds: one sorted array (``flat``, one row ``_cuts``), or two levels: ``coarse`` (one row ``_cuts``) and
    ``fine`` (a row per coarse range with its bounds ``_fine`` and the number of those before, ``_from``)."""

    def __init__(self, flat: DataFrame | None = None, coarse: DataFrame | None = None, fine: DataFrame | None = None, n_coarse: int = 1):
        self.flat, self.coarse, self.fine, self.n_coarse = flat, coarse, fine, n_coarse


def _sampled_bounds(keyed: DataFrame, r: int, per_range: int, row_hash: Column) -> Bounds:
    """Bounds of ``r`` ranges of about equal weight of the rows (``_key``, ``_w``).

    A row of weight w is in the sample with probability p = min(1, r * per_range * w / W) (its hash decides; W is
    a scalar subquery, so this stays lazy) and counts w / p. The chunks of a hot value are all kept, so
    the bounds can cut it. Up to ``SMALL_SAMPLE`` expected rows the sample meets in one task. A larger one
    is first cut into about sqrt(r) coarse ranges by a sample of it of ``per_range`` rows for each of these, and every coarse
    range finds its own bounds: no task sees more than about sqrt(r) * per_range rows of the sample.
    """
    total_w = keyed.agg(F.sum("_w")).scalar()
    p_keep = F.least(F.lit(1.0), F.lit(float(r * per_range)) * F.col("_w") / total_w)
    drawn = keyed.select("_key", row_hash.alias("_h"), p_keep.alias("_p"), "_w").where(F.col("_h") < F.col("_p") * HASH_SPACE)
    sample = drawn.select("_key", "_h", (F.col("_w") / F.col("_p")).alias("_sw"), "_p")
    if r * per_range <= SMALL_SAMPLE:
        return Bounds(flat=_cut_points(sample, r))
    c = _coarse_ranges(r)
    # the same hash decides again, with a smaller share: a sample of the sample
    few = sample.withColumn("_share", F.lit(c / r))
    few = few.where(F.col("_h") < F.col("_p") * F.col("_share") * HASH_SPACE).select("_key", (F.col("_sw") / F.col("_share")).alias("_sw"))
    coarse = _cut_points(few, c)
    placed = sample.withColumn("_cuts", coarse.scalar()).select("_key", "_sw", _count_in("_cuts", c).alias("_c"))
    before = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_c").agg(F.sum("_sw").alias("_s"))           # one row per coarse range
    starts = sums.select("_c", F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_at"), F.sum("_s").over(Window.partitionBy(F.lit(0))).alias("_all"))
    inside = Window.partitionBy("_c").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.select("_c", "_key", F.coalesce(F.sum("_sw").over(inside), F.lit(0.0)).alias("_in"))
    quant = (ranked.join(F.broadcast(starts), "_c")
             .select("_c", "_key", F.floor((F.col("_at") + F.col("_in")) * r / F.col("_all")).alias("_q")).where(F.col("_q") < r - 1))
    # the last key of every quantile, which is the last coarse range's if several hold the quantile
    ends = quant.groupBy("_q").agg(F.max(F.struct("_key", "_c")).alias("_e")).select("_e._c", "_e._key")
    lists = ends.groupBy("_c").agg(F.sort_array(F.collect_list("_key")).alias("_fine"))
    every = keyed.sparkSession.range(c).select(F.col("id").cast("int").alias("_c"))
    filled = every.join(lists, "_c", "left").select("_c", "_fine", F.greatest(F.coalesce(F.size("_fine"), F.lit(0)), F.lit(0)).alias("_n"))
    return Bounds(coarse=coarse, n_coarse=c, fine=filled.select("_c", "_fine", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("int").alias("_from")))


def _count_in(cuts: str, most: int) -> Column:
    # coalesce makes the number non-nullable, so no inferred isnotnull filter re-runs the search
    return F.coalesce(count_below(F.col(cuts), F.col("_key"), most), F.lit(0))


def range_ids(keyed: DataFrame, bounds: Bounds, r: int) -> DataFrame:
    """``keyed`` (with ``_key``) with ``_range``: the number of bounds below the key.

    Up to ``ONE_LEVEL`` ranges all bounds are one array, a scalar in every task. Beyond, a task only holds the about
    sqrt(r) coarse bounds; rows meet their coarse range's bounds (about sqrt(r) as well) in an equi-join, spread over
    copies of these so that no coarse range is one task's. What is sent to all tasks grows with sqrt(r).
    """
    if bounds.flat is not None:
        cuts = bounds.flat
    elif r <= ONE_LEVEL:
        cuts = bounds.fine.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_c", "_fine"))),
                                                     lambda x: F.coalesce(x["_fine"], F.array()))).alias("_cuts"))
    else:
        spread = max(1, r // bounds.n_coarse)
        rows = keyed.withColumn("_cuts", bounds.coarse.scalar())
        rows = rows.withColumn("_c", _count_in("_cuts", bounds.n_coarse).cast("int")).drop("_cuts")
        rows = rows.withColumn("_s", F.pmod(F.xxhash64("_key"), F.lit(spread)).cast("int"))
        copies = bounds.fine.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        found = rows.join(copies, ["_c", "_s"], "left")
        inner = F.when(F.col("_fine").isNull(), F.lit(0)).otherwise(F.coalesce(count_below(F.col("_fine"), F.col("_key"), r), F.lit(0)))
        return found.select(*keyed.columns, (F.coalesce("_from", F.lit(0)) + inner).cast("int").alias("_range"))
    return keyed.withColumn("_cuts", cuts.scalar()).withColumn("_range", _count_in("_cuts", r)).drop("_cuts")


def ordered_positions(df: DataFrame, order_cols, group_cols=(), n_ranges: int | None = None,
                      pos_col: str = "pos", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                      sample_per_range: int = DEFAULT_SAMPLE_PER_RANGE,
                      repeated_rows: bool = True, tie_cols=None) -> DataFrame:
    """Every row of ``df`` with its 1-based position in the order ``group_cols + order_cols``.

    With ``group_cols`` the position restarts at 1 in each group (a null group is a group);
    the groups are few (buckets): one row per group meets in one task. Ties in the order
    are broken by ``tie_cols`` (default: the remaining columns, in order). The bounds hold these
    columns, so name short ones, or none, for wide rows: what is still tied goes by a hash of the
    row, and equal rows are interchangeable. ``repeated_rows=False`` skips the shuffle that collapses equal rows: right
    for rows with an id, and never wrong, but a hot row then stays in one range.
    """
    order_cols, group_cols = list(order_cols), list(group_cols)
    cols, named = df.columns, group_cols + order_cols
    named = named + [c for c in (cols if tie_cols is None else tie_cols) if c not in named]
    key_cols = named + [c for c in cols if c not in named]
    r = _n_ranges(df, n_ranges)

    if repeated_rows:
        collapsed = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_cnt"))
        chunks = collapsed.select(
            *key_cols, "_cnt",
            F.explode(F.sequence(F.lit(0).cast("bigint"),
                                F.expr(f"(_cnt - 1) div {int(chunk_rows)}"))).alias("_chunk"))
        chunks = chunks.select(
            *key_cols, "_chunk",
            F.least(F.lit(chunk_rows).cast("bigint"),
                    F.col("_cnt") - F.col("_chunk") * chunk_rows).alias("_w"))
    else:
        chunks = df.select(*key_cols, F.lit(0).cast("bigint").alias("_chunk"),
                           F.lit(1).cast("bigint").alias("_w"))
    tie = F.xxhash64(*key_cols)
    sort_key = F.struct(*[F.col(c) for c in named], tie.alias("_tie"), F.col("_chunk"))

    ranged = chunks.withColumn("_key", sort_key)
    bounds = _sampled_bounds(ranged, r, sample_per_range, F.pmod(F.xxhash64(tie, "_chunk"), F.lit(HASH_SPACE)))
    ranged = range_ids(ranged, bounds, r).drop("_key")

    # Base offset of each range: a prefix sum over at most R rows, broadcast by range id. The
    # guard (a fixed-width checksum of all columns) keeps column pruning from giving the
    # totals a narrower exchange, so they read the one that the rows read.
    ranges = ranged.select("_range", *key_cols, "_w").repartitionById(r, "_range")
    totals = ranges.groupBy("_range").agg(F.sum("_w").alias("_rw"),
                                          F.expr("bit_xor(xxhash64({}))".format(", ".join(f"`{c}`" for c in key_cols))).alias("_guard"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("_range").alias("_b_range"), "_guard",
                          F.coalesce(F.sum("_rw").over(before), F.lit(0)).alias("_base"))

    # The partitioned side's _range is kept: the window below must see the column the
    # exchange partitions by, or Spark re-shuffles.
    joined = ranges.join(F.broadcast(bases),
                         (F.col("_range") == F.col("_b_range")) & F.col("_guard").isNotNull(), how="left")
    if repeated_rows:
        # Chunks are expanded back into rows inside their range, then numbered in key order.
        joined = joined.select("_range", *key_cols, "_base",
                               F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_w") - 1)).alias("_i"))
    within_order = [*named, F.xxhash64(*key_cols), *[c for c in key_cols if c not in named]]
    within = Window.partitionBy("_range").orderBy(*within_order)
    out = joined.select("_range", *cols, (F.col("_base") + F.row_number().over(within)).alias(pos_col))
    if group_cols:
        # Start of a group = rows of the groups before it: one row per group.
        sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_size"))
        earlier = Window.orderBy(*group_cols).rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols],
                              F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
        cond = F.lit(True)
        for c in group_cols:
            cond = cond & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        out = out.join(starts, cond, how="left").select("_range", *cols, (F.col(pos_col) - F.col("_start")).alias(pos_col))
        return out.drop("_range")
    # The explicit sort keeps each range sorted even when a caller prunes the position (and
    # with it the window); otherwise the window's order satisfies it and Spark drops it.
    return out.sortWithinPartitions("_range", *within_order).drop("_range")


def total_order_sort(df: DataFrame, order_cols, n_ranges: int | None = None,
                     pos_col: str = "pos", **kw) -> DataFrame:
    """Rows in ``n_ranges`` range partitions, sorted within each, with a global position."""
    return ordered_positions(df, order_cols, (), n_ranges, pos_col, **kw)


def hash_sample(cols, fraction: float, resolution: int = 1_000_000) -> Column:
    """Deterministic row sample: the MD5 of the row's columns, TAB-joined (same rows in any engine).

    Rows are drawn, not keys: a key with half of all rows has about half of the sample.
    """
    row = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    bucket = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint") % resolution
    return bucket < F.lit(int(round(fraction * resolution)))


def bounded_sample(df: DataFrame, fraction: float, max_rows: int) -> DataFrame:
    """A hash sample of ``fraction`` of the rows, but at most ``max_rows``: those whose MD5 comes first.

    The same rows in any engine and partitioning; a task keeps at most ``max_rows`` rows. Rows
    that are equal in all columns have one MD5, so which of them stay makes no difference.
    """
    row = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    return df.where(hash_sample(df.columns, fraction)).orderBy(F.md5(row), *df.columns).limit(int(max_rows))


def first_char_histogram(df: DataFrame, key_col: str, sample_fraction: float = 0.02,
                         prefix_len: int = 1) -> DataFrame:
    """ch, n: key prefixes counted over a deterministic ``sample_fraction`` sample of the rows."""
    sampled = df.where(hash_sample(df.columns, sample_fraction)) if sample_fraction < 1 else df
    return sampled.groupBy(key_prefix(key_col, prefix_len).alias("ch")).agg(
        F.count(F.lit(1)).alias("n"))


def equi_depth_boundaries(hist: DataFrame, n_buckets: int = 10, ch_col: str = "ch",
                          n_col: str = "n", prefix_len: int = 1) -> DataFrame:
    """bucket, lo, hi, n, closed: equi-depth ranges over a histogram ordered by ``ch``.

    Running total with carry: with ``step = total div n_buckets``, a range closes at the
    char where the running count reaches ``step`` (at most one per char, at most
    ``n_buckets``), and ``step`` is subtracted so the remainder carries over. In closed
    form, with i the row number and cs the running sum,
    ``closed_i = least(n_buckets, i + least(0, min_{j<=i}(cs_j div step - j)))``;
    char i belongs to bucket ``closed_{i-1}`` unless no range closes after it, in which
    case it is in the open last bucket. With one character the histogram has a row per character
    of the alphabet, so the windows over it are small; longer prefixes go to ``trie_boundaries``.
    """
    if prefix_len > 1:
        return trie_boundaries(hist, n_buckets, prefix_len, ch_col, n_col)
    nb = int(n_buckets)
    w = Window.orderBy(ch_col)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    h = hist.select(ch_col, n_col,
                    F.row_number().over(w).cast("bigint").alias("_i"),
                    F.sum(n_col).over(run).alias("_cs"),
                    F.expr(f"sum({n_col}) over (partition by 0) div {nb}").alias("_step"))
    ratio = F.when(F.col("_step") > 0, F.expr("_cs div _step")).otherwise(F.lit(None))
    h = h.withColumn("_m", F.min(ratio - F.col("_i")).over(run))
    closed = F.least(F.lit(nb).cast("bigint"),
                     F.col("_i") + F.least(F.lit(0).cast("bigint"), F.coalesce(F.col("_m"), F.lit(0))))
    h = h.withColumn("_closed", closed)
    h = h.withColumn("_prev", F.coalesce(F.lag("_closed").over(w), F.lit(0).cast("bigint")))
    h = h.withColumn("_last", F.max("_closed").over(everything))
    h = h.withColumn("bucket", F.when(F.col("_prev") < F.col("_last"), F.col("_prev"))
                     .otherwise(F.lit(nb - 1)).cast("int"))
    return h.groupBy("bucket").agg(
        F.min(ch_col).alias("lo"), F.max(ch_col).alias("hi"), F.sum(n_col).alias("n"),
        F.max(F.col("_prev") < F.col("_last")).alias("closed"))


def _children(hist: DataFrame, frontier: DataFrame, depth: int) -> DataFrame:
    """_t, _node, _upto, _before: under each threshold's node, the child in which the running count reaches it.

    ``frontier`` has a row per threshold (_t, _need, _node, _before: the rows before the node). Only the children
    of these nodes are counted; a window holds the children of one node (characters of the alphabet)."""
    nodes = F.broadcast(frontier.select(F.col("_node").alias("_at")).distinct())     # one per threshold at most
    parent = F.substring("_p", 1, depth - 1)
    grown = (hist.join(nodes, parent == F.col("_at")).groupBy("_at", F.substring("_p", 1, depth).alias("_child"))
             .agg(F.sum("_n").alias("_n")))
    run = Window.partitionBy("_at").orderBy("_child").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = grown.select("_at", "_child", "_n", F.sum("_n").over(run).alias("_cum"))
    met = sums.join(F.broadcast(frontier), F.col("_at") == F.col("_node"))
    met = met.where((F.col("_before") + F.col("_cum") >= F.col("_need")) & (F.col("_before") + F.col("_cum") - F.col("_n") < F.col("_need")))
    return met.select("_t", "_need", F.col("_child").alias("_node"), (F.col("_before") + F.col("_cum") - F.col("_n")).alias("_before"))


def trie_boundaries(hist: DataFrame, n_buckets: int, prefix_len: int, ch_col: str = "ch", n_col: str = "n") -> DataFrame:
    """``equi_depth_boundaries`` for long prefixes, of which there may be very many.

    Range t closes at the first prefix after the end of range t - 1 up to which t steps are counted. The prefix
    at which t steps are reached is found in a trie that grows only under the at most ``n_buckets`` nodes that hold
    such a place, one level (and one aggregate over the histogram) for each character; where several ranges meet
    in one prefix, they close at the next ones, so the ``n_buckets`` prefixes from each place on are kept
    too (a grouped limit: a task sends at most that many of each group). No step orders all distinct prefixes.
    """
    nb = int(n_buckets)
    h = hist.select(F.col(ch_col).alias("_p"), F.col(n_col).cast("bigint").alias("_n"))
    step = h.agg(F.expr(f"sum(_n) div {nb}").alias("_step"))
    # the root is '', made from a column: a literal would be folded, and the joins on it would have no key
    root = F.substring(F.col("_t").cast("string"), 1, 0)
    frontier = (step.select(F.explode(F.sequence(F.lit(1), F.lit(nb))).alias("_t"), "_step")
                .select("_t", F.greatest(F.col("_t") * F.col("_step"), F.lit(1).cast("bigint")).alias("_need"), root.alias("_node"), F.lit(0).cast("bigint").alias("_before")))
    for depth in range(1, int(prefix_len) + 1):
        frontier = _children(h, frontier, depth)
    places = frontier.agg(F.sort_array(F.collect_list(F.struct("_t", "_node"))).alias("_l")).select(
        F.transform("_l", lambda x: x["_node"]).alias("_q"))                          # n_buckets prefixes, ascending
    near = h.withColumn("_q", places.scalar())
    near = near.select("_p", F.coalesce(count_below(F.col("_q"), F.col("_p"), nb, inclusive=True), F.lit(0)).alias("_g")).where("_g > 0").distinct()
    first = Window.partitionBy("_g").orderBy("_p")
    near = near.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= nb)
    row = near.agg(F.sort_array(F.collect_list("_p")).alias("_c")).withColumn("_q", places.scalar())
    # range t ends at the largest of: the place of t, and those of earlier ranges s moved on by t - s prefixes
    ends = F.expr(f"""array_distinct(filter(transform(sequence(1, {nb}), t -> get(_c, cast(array_max(transform(sequence(1, t),
        s -> array_position(_c, element_at(_q, s)) - 1 + (t - s))) as int))), x -> x is not null))""")
    his = row.where(F.size("_q") == nb).select(ends.alias("_his"))
    tagged = h.withColumn("_his", F.coalesce(his.scalar(), F.array().cast("array<string>")))
    tagged = tagged.select("_p", "_n", F.size("_his").alias("_k"), F.coalesce(count_below(F.col("_his"), F.col("_p"), nb), F.lit(0)).alias("_i"))
    in_range = F.col("_i") < F.col("_k")
    return tagged.select(F.when(in_range, F.col("_i")).otherwise(F.lit(nb - 1)).cast("int").alias("bucket"), "_p", "_n", in_range.alias("_in")).groupBy("bucket").agg(
        F.min("_p").alias("lo"), F.max("_p").alias("hi"), F.sum("_n").alias("n"), F.max("_in").alias("closed"))


def range_bucket_assign(df: DataFrame, key_col: str, boundaries: DataFrame, n_buckets: int = 10,
                        prefix_len: int = 1, bucket_col: str = "bucket") -> DataFrame:
    """Every row with the equi-depth bucket of its key prefix; no row is ever dropped.

    Bucket = number of closed ranges whose ``hi`` is below the prefix; past the last
    closed range a row is in the open last bucket. Keys below the first sampled char land
    in bucket 0 and an empty key has the empty prefix (bucket 0). The closed ``hi`` values
    (at most ``n_buckets``) reach the tasks as one scalar array.
    """
    his = (boundaries.where("closed").select(F.sort_array(F.collect_list("hi")).alias("_his")))
    his_col = F.col("_his")
    idx = count_below(his_col, key_prefix(key_col, prefix_len), n_buckets)
    bucket = F.when(idx < F.size(his_col), idx).otherwise(F.lit(n_buckets - 1)).cast("int")
    return (df.withColumn("_his", his.scalar()).withColumn(bucket_col, bucket).drop("_his"))


def bucket_stats(assigned: DataFrame, key_col: str, bucket_col: str = "bucket") -> DataFrame:
    """bucket, n, min_k, max_k per bucket (partial + final aggregate)."""
    return assigned.groupBy(bucket_col).agg(
        F.count(F.lit(1)).alias("n"), F.min(key_col).alias("min_k"), F.max(key_col).alias("max_k"))


def custom_range_sort(df: DataFrame, key_col: str, boundaries: DataFrame, n_buckets: int = 10,
                      prefix_len: int = 1, n_ranges: int | None = None,
                      pos_col: str = "pos_in_bucket", **kw) -> DataFrame:
    """Rows tagged with their equi-depth bucket and their 1-based position inside it.

    Positions come from ``ordered_positions`` grouped by bucket, so a bucket holding most
    of the rows is still spread over many tasks.
    """
    tagged = range_bucket_assign(df, key_col, boundaries, n_buckets, prefix_len)
    others = [c for c in df.columns if c != key_col]
    return ordered_positions(tagged, [key_col] + others, ["bucket"], n_ranges, pos_col, **kw)
