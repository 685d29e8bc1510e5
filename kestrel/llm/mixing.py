"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every source's documents are put in a pseudo-random order (MD5 of a seed and the id) and
   read as one long stream of words, cut into blocks of ``block_words`` words. A prefix of
   that stream is a random draw of the source's blocks without replacement; a source drawn
   more than once over starts its stream again (at most ``max_repeat`` times).
2. The targets are water-filled: each source gets its weight's share of the budget, targets
   stop at ``max_repeat`` times the source's size and the excess goes to the others by weight.
3. The exact block quotas are split over ``2 ** depth`` output shards by a binary tree: a node
   hands half of its blocks to its left child, drawn without replacement over the sources
   (one hypergeometric draw per source, conditional on those before it), and the rest to the
   right child. Quotas are conserved exactly at each node.
4. A leaf (shard) owns, per source, one run of the permuted blocks; runs are disjoint and cover
   the quota. Documents are cut at the run borders and each shard is ordered by a hash.

Everything is DataFrame functions. Stream offsets are two-level prefix sums: 4096 hash
buckets per source, then documents inside a bucket, so a source with a third of all rows is
spread over 4096 window groups. Only tables of one row per source (times buckets or shards)
meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A word is a run of anything but space and the ASCII controls TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in code point order, repeating.
WEIGHT_CYCLE = (3, 1, 2)
BUCKET_DIGITS = 3  # hex digits of the order hash that name a bucket


def n_words(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _order_key(doc_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def source_targets(totals: DataFrame, total_share: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """source, source_size, target from ``totals`` (source, source_size), one row per source.

    Water-filling in closed form: with the sources ordered by cap / weight, those before the
    first one whose cap exceeds its share of what is left are capped, the others share it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in WEIGHT_CYCLE]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHT_CYCLE))) + 1).cast("int"))
    t = totals.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(max_repeat))
    by_fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    t = (t.withColumn("_left", F.lit(float(total_share)) * F.sum("source_size").over(every)
                      - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
         .withColumn("_w_left", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
         .withColumn("_level", F.col("_left") / F.col("_w_left")))
    # The fill level is that of the first source that is not capped; all later ones share it.
    level = F.min(F.when(F.col("_cap") > F.col("_level") * F.col("_w"),
                         F.struct((F.col("_cap") / F.col("_w")).alias("r"), F.col("_level").alias("l")))).over(every)
    t = t.withColumn("_fill", level["l"])
    target = F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_fill") * F.col("_w"), F.col("_cap").cast("double")))
    return t.select("source", "source_size", target.alias("target"))


def _uniform(seed: int, *cols) -> Column:
    return (F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ratio(s: Column, x: Column) -> Column:
    """P(x) / P(x - 1)"""
    x = x.cast("double")
    return (s["g"] - x + 1) * (s["d"] - x + 1) / (x * (s["p"] - s["g"] - s["d"] + x))


def _weigh(s: Column, lower: bool) -> Column:
    """Walk from the mode (weight 1) to ``a`` (or ``b``): the last weight and the sum of those walked over."""
    if lower:
        steps = F.when(s["m"] > s["a"], F.sequence(s["m"], s["a"] + 1, F.lit(-1).cast("long")))
    else:
        steps = F.when(s["b"] > s["m"], F.sequence(s["m"] + 1, s["b"]))

    def go(acc, x):
        w = acc["w"] / _ratio(s, x) if lower else acc["w"] * _ratio(s, x)
        return F.struct(w.alias("w"), (acc["t"] + w).alias("t"))

    return F.aggregate(F.coalesce(steps, F.array().cast("array<bigint>")), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("t")), go)


def _hypergeometric(pop: Column, good: Column, draws: Column, u: Column) -> Column:
    """Draws of the ``good`` kind among ``draws`` from ``pop``, by inversion around the mode.

    The probabilities relative to the mode follow from their ratios; the window of ten
    standard deviations each side (clipped to the support) leaves out nothing a double holds.
    """
    def window(v):
        p, g, d = v["p"], v["g"], v["d"]
        lo = F.greatest(F.lit(0).cast("long"), (d - (p - g)).cast("long"))
        hi = F.least(d, g).cast("long")
        mode = F.least(hi, F.greatest(lo, F.floor((d + 1) * (g + 1) / (p + 2)).cast("long")))
        sd = F.sqrt(F.greatest(F.lit(0.0), d * g * (p - g) * (p - d)) / F.greatest(F.lit(1.0), p * p * F.greatest(p - 1, F.lit(1.0))))
        reach = (F.ceil(sd * 10) + 10).cast("long")
        return F.struct(v["p"], v["g"], v["d"], v["u"], mode.alias("m"), F.greatest(lo, mode - reach).alias("a"),
                        F.least(hi, mode + reach).alias("b"))

    def invert(s):
        # three folds with a running weight: both sums, then from ``a`` up to the drawn share of all
        def pick(t):
            goal = s["u"] * (t["lower"]["t"] + 1.0 + t["upper"]["t"])

            def go(acc, x):
                c = acc["c"] + acc["w"]
                return F.struct((acc["w"] * _ratio(s, x + 1)).alias("w"), c.alias("c"), (acc["k"] + F.when(c < goal, 1).otherwise(0)).cast("long").alias("k"))

            start = F.struct(t["lower"]["w"].alias("w"), F.lit(0.0).alias("c"), F.lit(0).cast("long").alias("k"))
            return F.least(s["b"], s["a"] + F.aggregate(F.sequence(s["a"], s["b"]), start, go, lambda acc: acc["k"]))

        return _let(F.struct(_weigh(s, True).alias("lower"), _weigh(s, False).alias("upper")), pick)

    args = F.struct(pop.cast("double").alias("p"), good.cast("double").alias("g"), draws.cast("double").alias("d"), u.alias("u"))
    return _let(_let(args, window), invert)


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """shard, q: the quota array of each of the ``2 ** depth`` leaves, from one row ``q``.

    ``q`` is array<bigint>, one entry per source in a fixed order. Each level is one narrow
    step over the nodes; sources are drawn one after the other inside the node's row.
    """
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), "q")
    def half(level):
        def draw(s, e):
            def put(x):
                return F.struct((s["pop"] - e["q"]).alias("pop"), (s["draws"] - x).alias("draws"),
                                F.array_append(s["out"], x).alias("out"))
            u = _uniform(seed, F.lit(level), F.col("shard"), e["i"])
            return _let(_hypergeometric(s["pop"], e["q"], s["draws"], u), put)
        return draw

    for level in range(depth):
        nodes = nodes.withColumn("_n", F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x))
        init = F.struct(F.col("_n").alias("pop"), F.expr("_n div 2").alias("draws"), F.array().cast("array<bigint>").alias("out"))
        left = F.aggregate(F.transform("q", lambda x, i: F.struct(x.alias("q"), i.alias("i"))), init, half(level), lambda s: s["out"])
        nodes = nodes.withColumn("_l", left)
        both = F.array(F.struct((F.col("shard") * 2).alias("shard"), F.col("_l").alias("q")),
                       F.struct((F.col("shard") * 2 + 1).alias("shard"), F.zip_with("q", "_l", lambda x, y: x - y).alias("q")))
        nodes = nodes.select(F.explode(both).alias("n")).select("n.*")
    return nodes


def mix_plan(docs: DataFrame, seed: int = 7, block_words: int = 256, depth: int = 5,
             total_share: float = 1.5, max_repeat: int = 2, keep=()) -> DataFrame:
    """One row per document with the words the mix takes from it and the shards they go to.

    -> doc_id, source, size, source_size, target, taken, pieces array<struct<shard, epoch,
    first_word, words>> (+ ``keep`` columns). ``first_word`` counts from 0 in the document.

    Defined cases: null or empty text has size 0 and takes nothing; a null source is a source of
    its own, last in order; repeated rows are separate documents of the same place in the
    order; an empty table gives no rows; other columns are ignored unless named in ``keep``.
    """
    keep = list(keep)
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), n_words("text").alias("size"),
                       *[F.col(c).alias(f"_keep_{c}") for c in keep])
    base = base.withColumn("_h", _order_key("doc_id", seed)).withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    buckets = base.groupBy("source", "_bucket").agg(F.sum("size").alias("_bw"))
    totals = buckets.groupBy("source").agg(F.sum("_bw").alias("source_size"))
    plan = (source_targets(totals, total_share, max_repeat)
            .withColumn("_take", F.least(F.round("target").cast("long"), F.col("source_size") * max_repeat))
            .withColumn("_q", F.ceil(F.col("_take") / F.lit(block_words)).cast("long")))

    # One row: quotas in source order; leaves: running block offsets of every source.
    quotas = plan.groupBy().agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("nul"), "source", F.col("_q").alias("q")))),
        lambda s: s["q"]).alias("q"))
    leaves = split_quotas(quotas, depth, seed)
    runs = leaves.select("shard", F.posexplode("q").alias("_s", "_n"))
    runs = runs.groupBy("_s").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "_n"))),
                                              lambda x: x["_n"]).alias("_ns"))
    ends = F.aggregate("_ns", F.array(F.lit(0).cast("long")), lambda s, x: F.array_append(s, F.element_at(s, -1) + x))
    runs = runs.select("_s", F.transform(ends, lambda x: x * block_words).alias("_ends"))
    number = Window.orderBy(F.col("source").asc_nulls_last())
    plan = (plan.withColumn("_s", F.row_number().over(number) - 1).join(runs, "_s", "left")
            .select(F.col("source").alias("_ps"), "source_size", "target", "_take", "_ends"))

    # Bucket starts: at most 4096 rows per source; then documents inside their bucket.
    up_to = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (buckets.withColumn("_b0", F.coalesce(F.sum("_bw").over(up_to), F.lit(0)))
              .join(plan, F.col("source").eqNullSafe(F.col("_ps")), "inner")
              .select(F.col("source").alias("_bs"), F.col("_bucket").alias("_bb"), "_b0", "source_size", "target", "_take", "_ends"))
    within = (Window.partitionBy("source", "_bucket").orderBy("_h", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (base.withColumn("_in", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(starts, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("_bucket") == F.col("_bb")), "inner")
            .withColumn("_from", F.col("_b0") + F.col("_in")))

    size, start, take, whole = F.col("size"), F.col("_from"), F.col("_take"), F.col("source_size")
    shards = F.sequence(F.lit(0), F.lit((1 << depth) - 1))

    def pieces(epoch):
        # the document's words [start, start + size) of this pass lie at these stream positions
        a = start + whole * epoch
        b = F.least(a + size, take)

        def piece(i):
            lo = F.greatest(a, F.get(F.col("_ends"), i))
            hi = F.least(b, F.get(F.col("_ends"), i + 1))
            return F.struct(i.alias("shard"), F.lit(epoch).alias("epoch"), (lo - a).cast("long").alias("first_word"),
                            (hi - lo).cast("long").alias("words"))

        return F.when((b > a) & (size > 0), F.filter(F.transform(shards, piece), lambda x: x["words"] > 0))

    none = F.array().cast("array<struct<shard:int,epoch:int,first_word:bigint,words:bigint>>")
    got = F.concat(*[F.coalesce(pieces(e), none) for e in range(max_repeat)])
    rows = rows.withColumn("pieces", got)
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       F.aggregate("pieces", F.lit(0).cast("long"), lambda s, x: s + x["words"]).alias("taken"),
                       "pieces", *[F.col(f"_keep_{c}").alias(c) for c in keep])


def pieces(plan: DataFrame, seed: int = 7) -> DataFrame:
    """One row per drawn piece: shard, epoch, first_word, words, place (its order inside the
    shard, pseudo-random) and the plan's columns."""
    rest = [c for c in plan.columns if c != "pieces"]
    rows = plan.select(*rest, F.explode("pieces").alias("_p")).select("_p.*", *rest)
    return rows.withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "epoch", "first_word"))


def draw_mix(plan: DataFrame, seed: int = 7, n_partitions: int | None = None) -> DataFrame:
    """The mix in order: ``pieces`` by shard and place. A shard may be larger than a task: it is
    dealt over ranges of places, each sorted by itself."""
    rows, key = pieces(plan, seed), ["shard", "place"]
    rows = rows.repartitionByRange(n_partitions, *key) if n_partitions else rows.repartitionByRange(*key)
    return rows.sortWithinPartitions(*key)


def op1_mixing(spark, sf_dir):
    from kestrel.llm.common import table

    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source")


# The prefix of the permuted stream, restated in plain SQL (the tree only decides the shards).
OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat('7:', COALESCE(doc_id::VARCHAR, ''))) AS h
  FROM documents),
s AS (SELECT source, SUM(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
      FROM s),
f AS (SELECT *, 2 * source_size AS cap,
             1.5 * SUM(source_size) OVER () - COALESCE(SUM(2 * source_size) OVER o, 0) AS rest,
             SUM(w) OVER () - COALESCE(SUM(w) OVER o, 0) AS w_rest
      FROM w WINDOW o AS (ORDER BY 2 * source_size / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rest::DOUBLE / w_rest, cap::DOUBLE / w) AS level FROM f WHERE cap > rest::DOUBLE / w_rest * w),
t AS (SELECT source, source_size, LEAST(cap::DOUBLE, COALESCE(level * w, cap::DOUBLE)) AS target FROM f CROSS JOIN l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, d.source, LEAST(round(t.target)::BIGINT, 2 * t.source_size) AS take,
             SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS a
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (LEAST(GREATEST(take - a, 0), size) + LEAST(GREATEST(take - source_size - a, 0), size))::BIGINT AS taken, source
FROM p
"""
