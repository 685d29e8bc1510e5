"""Merkle manifest of a table: a tree of digests per group, one root, and a proof per row.

A row's leaf is the SHA-256 of its fields, each written as ``-`` (null) or ``bytes:value``. Within a
group the leaves ascend by id and every 16 consecutive nodes become their parent until one, the
group's subroot, is left; the subroots, ordered by group, are reduced the same way to the root.

No row is sorted for its place. Places come from bitmaps of the ids:

1. Every 64 consecutive ids of a group are one word (a bitwise OR, combined before the shuffle), and
   the words that are not zero, at most 64, make a container with a popcount directory: the rows
   before each of its words. Sparse ids only store the words they have.
2. Containers get their first rank from a tree of counts with 4,096 children a node, so that no
   window holds more than that, however many ids a group has.
3. A row's rank is its container's first rank, the directory's entry of its word, and the set bits
   below its own. Ids that repeat add what the earlier ones repeat; rows of one id go by their leaf.
4. Ranks are coordinates: run ``rank div 16``, slot ``rank mod 16``. A run is one group of an
   aggregate over (group, run) that holds an array of at most 16 slots; each level has a sixteenth of the
   rows of the one below. Siblings go down the same tree once, by run, to all rows of it.

Defined cases: null ids come first in their group, a null group first of all; every row has a leaf of
its own, equal rows too (which of them gets which slot shows in nothing but their equal leaves); rows of
one id are ordered by leaf; the only row of a group is its subroot and its only group's root; an empty
table gives no rows; other columns are ignored. Negative ids are allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import cut, table
from kestrel.operators.rangesort import ordered_positions

RUN = 16                        # nodes of one parent
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NODE_BITS = 12                  # children of a node of the count tree: 2 ** 12
FEW_GROUPS = 1 << 16            # so many subroots are ordered by one task, more by a range-partitioned sort


def digest(*parts):
    """Lower-case hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value):
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = F.col(value).cast("string") if isinstance(value, str) else value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def lower_ascii(column):
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _null_safe(a: DataFrame, b: DataFrame, group: str, *keys: str, how: str = "inner") -> DataFrame:
    """``a`` joined to ``b`` on a nullable group and keys; ``b``'s copies of these columns go."""
    named = b.select(F.col(group).alias("_jg"), *[F.col(k).alias(f"_j{k}") for k in keys], *[c for c in b.columns if c not in (group, *keys)])
    on = F.col(group).eqNullSafe(F.col("_jg"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_j{k}"))
    return a.join(named, on, how).drop("_jg", *[f"_j{k}" for k in keys])


def _ties(rows: DataFrame) -> DataFrame:
    """grp, id, leaf, alt, tie: the rank of every row among the rows of its group and id, from 0."""
    placed = ordered_positions(rows.select("grp", "id", "leaf", "alt"), ["grp", "id", "leaf", "alt"], pos_col="_pos")
    first = placed.groupBy("grp", "id").agg(F.min("_pos").alias("_first"))
    both = placed.join(first.select(F.col("grp").alias("_jg"), F.col("id").alias("_ji"), "_first"),
                       F.col("grp").eqNullSafe(F.col("_jg")) & F.col("id").eqNullSafe(F.col("_ji")))
    return both.select("grp", "id", "leaf", "alt", (F.col("_pos") - F.col("_first")).alias("tie"))


def _first_ranks(sizes: DataFrame) -> DataFrame:
    """grp, c, first, n from grp, c, rows: the rows before each container and the rows of its group.

    A tree over the container numbers: a window covers the at most 4,096 children of one node."""
    span = sizes.agg(F.min("c").alias("lo"), F.max("c").alias("hi")).first()
    levels, node, lo, hi = [], sizes.select("grp", F.col("c").alias("node"), "rows"), span["lo"] or 0, span["hi"] or 0
    while hi - lo >= 1 << NODE_BITS:
        up = node.withColumn("parent", F.shiftright("node", NODE_BITS))
        w = Window.partitionBy("grp", "parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        levels.append(up.select("grp", "node", "parent", F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("first")))
        node = up.groupBy("grp", F.col("parent").alias("node")).agg(F.sum("rows").alias("rows"))
        lo, hi = lo >> NODE_BITS, hi >> NODE_BITS
    before = Window.partitionBy("grp").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    ranks = node.select("grp", "node", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"), F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    for level in reversed(levels):
        above = ranks.select("grp", F.col("node").alias("parent"), F.col("first").alias("_above"), "n")
        ranks = _null_safe(level, above, "grp", "parent").select("grp", "node", (F.col("first") + F.col("_above")).alias("first"), "n")
    return ranks.withColumnRenamed("node", "c")


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, id, leaf, alt; written before) with ``rank`` in the group and the group's rows ``n``."""
    known = leaves.where("id is not null")
    words = (known.groupBy("grp", F.shiftright("id", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(id & 63 as int)))").alias("bits"), F.count(F.lit(1)).alias("rows")))
    containers = cut(words.groupBy("grp", F.shiftright("w", 6).alias("c"))
                     .agg(F.sort_array(F.collect_list(F.struct(F.expr("w & 63").alias("i"), "bits", "rows"))).alias("ws"),
                          F.sum("rows").alias("rows"), F.sum(F.bit_count("bits")).alias("ids")))
    first = _first_ranks(containers.select("grp", "c", "rows"))
    # the directory: rows before each word of the container
    starts = F.expr("aggregate(ws, named_struct('at', 0L, 'all', cast(array() as array<bigint>)), "
                    "(a, x) -> named_struct('at', a.at + x.rows, 'all', array_append(a.all, a.at))).all")
    index = _null_safe(containers.select("grp", "c", "ws", starts.alias("starts")), first, "grp", "c")
    index = index.select("grp", "c", F.col("ws.i").alias("at"), F.col("ws.bits").alias("bits"), "starts", "first", "n")

    nulls = cut(leaves.where("id is null").groupBy("grp").agg(F.count(F.lit(1)).alias("nulls")))
    many = cut(containers.where("rows > ids").select("grp", "c"))
    rows = leaves.withColumn("c", F.shiftright("id", 12))
    extra = None
    if not many.isEmpty() or not nulls.isEmpty():
        found = _null_safe(rows.where("id is not null"), many, "grp", "c", how="left_semi") if not many.isEmpty() else rows.limit(0)
        twice = cut(found.groupBy("grp", "c", "id").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
        tied = _null_safe(known, twice.select("grp", "id"), "grp", "id", how="left_semi")
        ties = cut(_ties(tied.union(leaves.where("id is null"))))
        extra = twice.groupBy("grp", "c").agg(F.collect_list(F.struct("id", (F.col("k") - 1).alias("more"))).alias("extra"))
        single = _null_safe(known, twice.select("grp", "id"), "grp", "id", how="left_anti").withColumn("tie", F.lit(0).cast("bigint"))
        rows = single.unionByName(ties).withColumn("c", F.shiftright("id", 12))
        index = _null_safe(index, extra, "grp", "c", how="left")
    else:
        rows = rows.withColumn("tie", F.lit(0).cast("bigint"))
        index = index.withColumn("extra", F.lit(None).cast("array<struct<id:bigint,more:bigint>>"))

    placed = _null_safe(rows.where("id is not null"), index, "grp", "c")
    word = F.array_position("at", F.expr("shiftright(id, 6) & 63")).cast("int")
    below = F.element_at("bits", word).bitwiseAND(F.expr("~shiftleft(-1L, cast(id & 63 as int))"))
    more = F.when(F.col("extra").isNull(), F.lit(0)).otherwise(F.expr(
        "aggregate(filter(extra, x -> x.id < id and shiftright(x.id, 6) = shiftright(id, 6)), 0L, (a, x) -> a + x.more)"))
    rank = F.col("first") + F.element_at("starts", word) + F.bit_count(below) + more + F.col("tie")
    placed = placed.select("grp", "id", "leaf", "alt", rank.alias("rank"), "n")
    if nulls.isEmpty():
        return placed
    placed = _null_safe(placed, nulls, "grp", how="left").withColumn("nulls", F.coalesce("nulls", F.lit(0)))
    placed = placed.select("grp", "id", "leaf", "alt", (F.col("rank") + F.col("nulls")).alias("rank"), (F.col("n") + F.col("nulls")).alias("n"))
    all_ids = first.groupBy("grp").agg(F.max("n").alias("ids"))
    ahead = _null_safe(_null_safe(rows.where("id is null"), nulls, "grp"), all_ids, "grp", how="left")
    ahead = ahead.select("grp", "id", "leaf", "alt", F.col("tie").alias("rank"), (F.col("nulls") + F.coalesce("ids", F.lit(0))).alias("n"))
    return placed.unionByName(ahead)


def _runs(nodes: DataFrame) -> DataFrame:
    """Runs of 16 from nodes (grp, idx, dig, n): grp, idx, kids (digests by slot), dig, n of the level above."""
    grouped = nodes.groupBy("grp", F.expr(f"idx div {RUN}").alias("up")).agg(
        F.sort_array(F.collect_list(F.struct(F.expr(f"idx % {RUN}").alias("slot"), "dig"))).alias("s"), F.max("n").alias("n"))
    kids = F.col("s.dig")
    return grouped.select("grp", F.col("up").alias("idx"), kids.alias("kids"), F.sha2(F.array_join(kids, ""), 256).alias("dig"),
                          F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"))


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The levels above ``nodes`` (groups with one node left are done), each written to the shared folder."""
    out, now = [], nodes
    while most > 1:
        now = cut(_runs(now.where("n > 1").select("grp", "idx", "dig", "n")))
        out.append(now)
        most = -(-most // RUN)
    return out


def _step(kids, slot):
    """The siblings of a slot: what stands left and right of it in its run."""
    return F.struct(F.array_join(F.slice(kids, 1, slot), "").alias("l"),
                    F.array_join(F.slice(kids, slot + 2, RUN), "").alias("r"))


def _paths_down(runs: DataFrame) -> DataFrame:
    """grp, idx, path, subroot of the nodes below ``runs`` (which have a path and a subroot themselves)."""
    each = runs.select("grp", "idx", "kids", "path", "subroot", F.posexplode("kids").alias("slot", "_dig"))
    return each.select("grp", (F.col("idx") * RUN + F.col("slot")).alias("idx"),
                       F.concat(F.array(_step(F.col("kids"), F.col("slot"))), F.col("path")).alias("path"), "subroot")


NO_PATH = "array<struct<l:string,r:string>>"


def merkle_manifest(docs: DataFrame, group: str = "source", key: str = "doc_id", fields=FIELDS, tampered: dict | None = None):
    """(rows, root) of the manifest of ``docs``.

    ``rows`` has grp, id, leaf, alt, subroot and path, the siblings (left, right) of each level from the leaf up to
    the root. ``alt`` is the leaf with the columns that ``tampered`` replaces ({name: column}), or null. ``root`` is None
    for an empty table.
    """
    leaf = digest(*[field(f) for f in fields])
    alt = digest(*[field((tampered or {}).get(f, F.col(f))) for f in fields]) if tampered else F.lit(None).cast("string")
    if tampered and "when" in tampered:
        alt = F.when(tampered["when"], alt)
    leaves = cut(docs.select(F.col(group).cast("string").alias("grp"), F.col(key).cast("bigint").alias("id"), leaf.alias("leaf"), alt.alias("alt")))
    place = ranked(leaves)
    slots = place.groupBy("grp", F.expr(f"rank div {RUN}").alias("idx")).agg(
        F.sort_array(F.collect_list(F.struct(F.expr(f"rank % {RUN}").alias("slot"), "id", "leaf", "alt"))).alias("s"), F.max("n").alias("n"))
    kids = F.col("s.leaf")
    base = cut(slots.select("grp", "idx", "s", kids.alias("kids"),
                            F.when(F.col("n") == 1, kids[0]).otherwise(F.sha2(F.array_join(kids, ""), 256)).alias("dig"),
                            (F.col("n") == 1).alias("alone"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n")))
    most = base.agg(F.max("n")).first()[0]
    if most is None:
        return base.select("grp", F.lit(None).cast("bigint").alias("id"), "dig", F.col("dig").alias("leaf"), F.col("dig").alias("alt"),
                           F.col("dig").alias("subroot"), F.lit(None).cast(NO_PATH).alias("path")).drop("dig"), None
    levels = [base, *_levels(base, most)]
    tops = levels[0].where("n = 1").select("grp", "dig")
    for level in levels[1:]:
        tops = tops.union(level.where("n = 1").select("grp", "dig"))
    # the tree over the subroots: null first, then by UTF-8 bytes
    tops = cut(tops)
    count = tops.count()
    if count <= FEW_GROUPS:
        tops = tops.withColumn("pos", F.row_number().over(Window.orderBy("grp")).cast("bigint"))
    else:
        tops = cut(ordered_positions(tops, ["grp"], repeated_rows=False, pos_col="pos"))
    crown_nodes = tops.select(F.lit("").alias("grp"), (F.col("pos") - 1).alias("idx"), "dig", F.lit(count).cast("bigint").alias("n"))
    crown = _levels(crown_nodes, count)
    root = (crown[-1] if crown else crown_nodes).first()["dig"]
    if crown:
        paths = crown[-1].select("grp", "idx", "kids", F.array().cast(NO_PATH).alias("path"), F.lit("").alias("subroot"))
        for below in [*reversed(crown[:-1]), None]:
            down = _paths_down(paths)
            paths = _null_safe(below.select("grp", "idx", "kids"), down, "grp", "idx") if below is not None else down
        named = tops.select("grp", F.col("dig").alias("_sub"), (F.col("pos") - 1).alias("_at"))
        heads = cut(named.join(paths.select("idx", "path"), F.col("_at") == F.col("idx")).select("grp", F.lit(0).cast("bigint").alias("idx"), "path", F.col("_sub").alias("subroot")))
    else:
        heads = tops.select("grp", F.lit(0).cast("bigint").alias("idx"), F.array().cast(NO_PATH).alias("path"), F.col("dig").alias("subroot"))
    down = None
    for level in reversed(levels):
        cols = [c for c in level.columns if c not in ("dig", "n")]
        done = _null_safe(level.where("n = 1").select(*cols), heads, "grp", "idx")
        placed = done if down is None else done.unionByName(_null_safe(level.where("n > 1").select(*cols), down, "grp", "idx"))
        down = _paths_down(placed) if level is not base else placed
    each = down.select("grp", "kids", "alone", "path", "subroot", F.explode("s").alias("x"))
    path = F.when(F.col("alone"), F.col("path")).otherwise(F.concat(F.array(_step(F.col("kids"), F.col("x.slot").cast("int"))), F.col("path")))
    return each.select("grp", F.col("x.id").alias("id"), F.col("x.leaf").alias("leaf"), F.col("x.alt").alias("alt"), "subroot", path.alias("path")), root


def proof_digest(path):
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["l"], x["r"])), ""), 256)


def fold(start, path):
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda at, x: F.sha2(F.concat(x["l"], at, x["r"]), 256))


def op12_merkle(spark, sf_dir):
    """Manifest of ``documents`` with proofs; a fifth of the ids is checked with a tampered text."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows, root = merkle_manifest(docs, tampered={"text": lower_ascii(F.col("text")), "when": chosen})
    out = rows.withColumn("folded_root", fold(F.coalesce("alt", "leaf"), F.col("path")))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.lit(root).cast("string")).alias("verified"))


def _sql_leaf(text: str) -> str:
    def one(x):
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"
    return "sha256(" + " || ".join(one(x) for x in ["doc_id", "source", "lang", "n_chars", text]) + ")"


# Bytes one by one with the reflected polynomial; the unsigned CRC-32 of the decimal doc_id.
_SQL_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) for _ in range(8)]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

# Every row numbered, runs of 16 concatenated level by level; siblings are found by their numbers.
OP12_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_sql_leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_SQL_CRC} % 5 = 0 THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS alt
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n,
         dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS g
  FROM leaves
),
below(g, lvl, idx, dig) AS (
  SELECT g, 0, pos, leaf FROM placed
  UNION ALL
  SELECT g, lvl + 1, idx // 16, sha256(string_agg(dig, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM below) WHERE c > 1 GROUP BY g, lvl, idx // 16
),
tops AS (SELECT g, arg_max(dig, lvl) AS subroot, max(lvl) AS height FROM below GROUP BY g),
above(lvl, idx, dig) AS (
  SELECT 0, g, subroot FROM tops
  UNION ALL
  SELECT lvl + 1, idx // 16, sha256(string_agg(dig, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS c FROM above) WHERE c > 1 GROUP BY lvl, idx // 16
),
crown AS (SELECT max(lvl) AS height FROM above),
runs AS (
  SELECT g, lvl, idx // 16 AS run, list(dig ORDER BY idx) AS kids FROM below GROUP BY g, lvl, idx // 16
  UNION ALL
  SELECT -1, lvl, idx // 16, list(dig ORDER BY idx) FROM above GROUP BY lvl, idx // 16
),
steps AS (
  SELECT p.doc_id, p.g, p.pos, l.l AS step, CASE WHEN l.l < t.height THEN p.g ELSE -1 END AS tree,
         CASE WHEN l.l < t.height THEN l.l ELSE l.l - t.height END AS lvl,
         CASE WHEN l.l < t.height THEN p.pos // CAST(pow(16, l.l) AS BIGINT) ELSE p.g // CAST(pow(16, l.l - t.height) AS BIGINT) END AS idx
  FROM placed p JOIN tops t USING (g) CROSS JOIN crown c, LATERAL (SELECT unnest(range(t.height + c.height)) AS l) l
),
paths AS (
  SELECT s.g, s.pos, list(struct_pack(l := array_to_string(r.kids[1:idx % 16], ''), r := array_to_string(r.kids[idx % 16 + 2:], '')) ORDER BY step) AS path
  FROM steps s JOIN runs r ON r.g = s.tree AND r.lvl = s.lvl AND r.run = s.idx // 16 GROUP BY s.g, s.pos
),
fold(g, pos, k, dig, path) AS (
  SELECT p.g, p.pos, 0, coalesce(p.alt, p.leaf), coalesce(q.path, []) FROM placed p LEFT JOIN paths q ON q.g = p.g AND q.pos = p.pos
  UNION ALL
  SELECT g, pos, k + 1, sha256(path[k + 1].l || dig || path[k + 1].r), path FROM fold WHERE k < len(path)
),
done AS (SELECT * FROM fold WHERE k = len(path)),
root AS (SELECT arg_max(dig, lvl) AS root FROM above)
SELECT p.doc_id, p.leaf, t.subroot, r.root,
       sha256(array_to_string(list_transform(d.path, lambda x: x.l || x.r), '')) AS proof_sha256,
       d.dig AS folded_root, d.dig = r.root AS verified
FROM placed p JOIN tops t USING (g) JOIN done d ON d.g = p.g AND d.pos = p.pos CROSS JOIN root r"""
