"""Similarity join on word-shingle sets with signature trees.

Two documents link when ``100 * |A n B| >= 75 * |A u B|`` for their sets of 5-word shingles.

1. One pass over the texts gives per document the size of its set, an identity of the set (two
   64-bit sums), a token bitmap about two to four bits per shingle wide, and the ``SKETCH``
   smallest shingle hashes. Documents with the same set are one class; only its smallest id goes on.
2. Classes that share a sketch token meet in that token's group; tokens with the same classes are one group. For a pair at or above 0.75 the
   smallest hash of the union is shared with probability 0.75, the next one likewise, so a
   pair misses all groups with probability at most 0.25 ** SKETCH, below a collision of the
   64-bit hashes that name shingles; a set of at most ``4 * SKETCH`` shingles cannot miss (its
   prefix filter is that long). Groups beyond ``BLOCK`` members are cut into blocks that meet pairwise.
3. Inside a group a signature tree (members by size, nodes with OR-combined bitmaps and size
   ranges) is traversed against itself; a pair of nodes goes when its sizes or its largest
   possible overlap exclude 0.75, and so does every pair already in one component.
4. Surviving pairs are verified exactly on the full sets, in three rounds: first a spanning
   forest per group, then the four best partners outside one's component, last all that is left
   (from the second round on a pair counts only in the first group it shares).
   After each round, links are merged into components, so dense groups of near
   copies are never expanded into all pairs, and no link between different sets is lost.

Bitmaps only exclude pairs that cannot reach 0.75: bits of A outside B's bitmap are shingles
of A that B lacks. Python sees Arrow batches only; Spark does all grouping and joining.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import words as W
from kestrel.llm.common import Scratch, cut, if_small, in_batches
from kestrel.llm.components import components

SHINGLE = 5
SKETCH = 20
NUM, DEN = 75, 100
BLOCK = 2048
LEAF, FAN = 16, 8

PROFILE = "doc_id long, n_shingles long, s1 long, s2 long, sketch array<long>, bits binary"


def bitmap_width(n: np.ndarray) -> np.ndarray:
    """Bits of the bitmap of a set of ``n``: a power of two, 2 n to 4 n, at least 64."""
    return np.maximum(64, 2 ** np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))


def _bitmap(tokens: np.ndarray, width: int) -> bytes:
    bits = np.zeros(width, np.uint8)
    bits[(tokens >> np.uint64(20)) & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def shingle_sets(column, k: int = SHINGLE):
    """(first row, sets, begins) for each slice of a batch's texts: sorted distinct shingles."""
    data, offsets = W.utf8(column)
    for a, b in W.slices(offsets):
        off = offsets[a:b + 1] - offsets[a]
        part = data[offsets[a]:offsets[b]]
        starts, ends, first = W.word_spans(part, off)
        h, owner = W.shingle_hashes(W.word_hashes(part, starts, ends), first, k)
        sets, begins = W.distinct_sets(h, owner, b - a)
        yield a, b, sets, begins


def _profile(batches):
    for batch in batches:
        ids, text = batch.column("doc_id"), batch.column("text")
        n_all, s1, s2, sketch, bits = [], [], [], [], []
        for a, b, sets, begins in shingle_sets(text):
            n = np.diff(begins)
            i1, i2 = _identity(sets, begins)
            s1.append(i1)
            s2.append(i2)
            n_all.append(n)
            widths = bitmap_width(n)
            for i in range(b - a):
                t = sets[begins[i]:begins[i + 1]]
                sketch.append(t[:SKETCH].view(np.int64))
                bits.append(_bitmap(t, int(widths[i])) if len(t) else b"")
        n_all = np.concatenate(n_all) if n_all else np.zeros(0, np.int64)
        lens = np.array([len(x) for x in sketch], np.int64)
        flat = np.concatenate(sketch) if sketch else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(flat, pa.int64()))
        none = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), pa.array(n_all, pa.int64()), pa.array(np.concatenate(s1) if s1 else none, pa.int64()),
             pa.array(np.concatenate(s2) if s2 else none, pa.int64()), lists, pa.array(bits, pa.binary())],
            names=["doc_id", "n_shingles", "s1", "s2", "sketch", "bits"])


def _identity(sets, begins):
    """Two 64-bit sums that name each set."""
    with np.errstate(over="ignore"):
        c1 = np.concatenate([[np.uint64(0)], np.cumsum(sets, dtype=np.uint64)])
        c2 = np.concatenate([[np.uint64(0)], np.cumsum(W.mix64(sets + np.uint64(77)), dtype=np.uint64)])
        return (c1[begins[1:]] - c1[begins[:-1]]).view(np.int64), (c2[begins[1:]] - c2[begins[:-1]]).view(np.int64)


def _full_sets(batches):
    for batch in batches:
        for a, b, sets, begins in shingle_sets(batch.column("text")):
            s1, s2 = _identity(sets, begins)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(begins), pa.int64()), pa.array(s1), pa.array(s2),
                 pa.array([sets[begins[i]:begins[i + 1]].tobytes() for i in range(b - a)], pa.binary())],
                names=["n_shingles", "s1", "s2", "set"])


# ---- signature trees -------------------------------------------------------------------

class _Groups:
    """Members of consecutive groups as flat arrays; bitmaps are kept as Python bytes."""

    def __init__(self, k, side, rep, comp, n, t, bits, sketch):
        self.key, self.side, self.rep, self.comp, self.n, self.token, self.bits = k, side, rep, comp, n, t.view(np.uint64), bits
        self.sketch = sketch       # rows of the groups a member is in, padded with the largest number; None in the first round
        self.rows = {}

    def here(self, x, y):
        """Which pairs of members belong to this group: the first one they share."""
        ok = np.ones(len(x), bool)
        if self.sketch is not None:
            for at in range(0, len(x), 8192):
                a, b = self.sketch[x[at:at + 8192]], self.sketch[y[at:at + 8192]]
                shared = (a[:, :, None] == b[:, None, :]).any(2)
                ok[at:at + 8192] = a[np.arange(len(a)), shared.argmax(1)] == self.token[x[at:at + 8192]]
        return ok

    def bitmap(self, i: int, width: int) -> np.ndarray:
        """Member ``i``'s bitmap folded to ``width`` bits, as 64-bit words."""
        got = self.rows.get((i, width))
        if got is None:
            x = np.frombuffer(self.bits[i], np.uint64)
            got = x if len(x) * 64 == width else np.bitwise_or.reduce(x.reshape(-1, width // 64), axis=0)
            self.rows[(i, width)] = got
        return got


def _reach(na, nb):
    """Whether sizes alone allow 0.75: min >= 0.75 max."""
    return DEN * np.minimum(na, nb) >= NUM * np.maximum(na, nb)


def _possible(na, nb, only_a, only_b):
    """Whether the largest possible overlap reaches 0.75 (bits only in A are shingles B lacks)."""
    over = np.minimum(na - only_a, nb - only_b)
    return (NUM + DEN) * over >= NUM * (na + nb)


class _Tree:
    """Members of one group ordered by size; nodes are runs with an OR bitmap and a size range."""

    def __init__(self, g: _Groups, members: np.ndarray):
        self.g, self.m = g, members[np.argsort(g.n[members], kind="stable")]
        self.n = g.n[self.m]
        self.cache = {}

    def children(self, node):
        lo, hi = node
        size = max(LEAF, -(-(hi - lo) // FAN))
        return [(i, min(i + size, hi)) for i in range(lo, hi, size)]

    def sign(self, node, width):
        """(OR of the bitmaps, most bits any member loses to collisions) at ``width``."""
        got = self.cache.get((node, width))
        if got is None:
            rows = np.stack([self.g.bitmap(i, width) for i in self.m[node[0]:node[1]]])
            hidden = int((self.n[node[0]:node[1]] - np.bitwise_count(rows).sum(1)).max())
            got = (np.bitwise_or.reduce(rows, axis=0), hidden, rows)
            self.cache[(node, width)] = got
        return got

    def widest(self, node):
        return len(self.g.bits[self.m[node[0]]]) * 8    # the smallest member's width

    def pairs(self, visit):
        """Dual traversal: ``visit(rows_a, rows_b, score)`` gets the pairs that may reach 0.75."""
        todo = [((0, len(self.m)), (0, len(self.m)))]
        while todo:
            a, b = todo.pop()
            na, nb = (self.n[a[0]], self.n[a[1] - 1]), (self.n[b[0]], self.n[b[1] - 1])
            if DEN * na[1] < NUM * nb[0] or DEN * nb[1] < NUM * na[0]:
                continue
            if a != b:
                width = min(self.widest(a), self.widest(b))
                oa, ha, _ = self.sign(a, width)
                ob, hb, _ = self.sign(b, width)
                most = int(np.bitwise_count(oa & ob).sum()) + min(ha, hb)
                if (NUM + DEN) * most < NUM * int(na[0] + nb[0]):
                    continue
            if a[1] - a[0] <= LEAF and b[1] - b[0] <= LEAF:
                self.leaf(a, b, visit)
                continue
            ca, cb = self.children(a) if a[1] - a[0] > LEAF else [a], self.children(b) if b[1] - b[0] > LEAF else [b]
            if a == b:
                todo += [(ca[i], ca[j]) for i in range(len(ca)) for j in range(i, len(ca))][::-1]
            else:
                todo += [(x, y) for x in ca for y in cb][::-1]

    def leaf(self, a, b, visit):
        width = min(self.widest(a), self.widest(b))
        ra, rb = self.sign(a, width)[2], self.sign(b, width)[2]
        both = np.bitwise_count(ra[:, None, :] & rb[None, :, :]).sum(2, dtype=np.int64)
        ca, cb = np.bitwise_count(ra).sum(1, dtype=np.int64), np.bitwise_count(rb).sum(1, dtype=np.int64)
        na, nb = self.n[a[0]:a[1]], self.n[b[0]:b[1]]
        ok = _reach(na[:, None], nb[None, :]) & _possible(na[:, None], nb[None, :], ca[:, None] - both, cb[None, :] - both)
        if a == b:
            ok &= np.triu(np.ones_like(ok), 1)
        i, j = np.nonzero(ok)
        if len(i):
            visit(self.m[a[0] + i], self.m[b[0] + j], both[i, j] / np.maximum(ca[i] + cb[j] - both[i, j], 1))


class _Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _small_pairs(g: _Groups, starts, sizes):
    """All pairs inside many small groups (each a single leaf), vectorised over the groups."""
    left, right = [], []
    for size in np.unique(sizes):
        at = starts[sizes == size]
        i, j = np.triu_indices(size, 1)
        left.append((at[:, None] + i).ravel())
        right.append((at[:, None] + j).ravel())
    x, y = (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int),) * 2
    keep = (g.comp[x] != g.comp[y]) & _reach(g.n[x], g.n[y])
    x, y = x[keep], y[keep]
    keep = g.here(x, y)
    x, y = x[keep], y[keep]
    lens = np.array([len(b) for b in g.bits], np.int64)
    width = np.minimum(lens[x], lens[y])
    score = np.zeros(len(x))
    good = np.zeros(len(x), bool)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for part in np.array_split(at, max(1, len(at) * int(w) >> 24)):
            ra = np.stack([g.bitmap(i, int(w) * 8) for i in x[part]]) if len(part) else np.zeros((0, w // 8), np.uint64)
            rb = np.stack([g.bitmap(i, int(w) * 8) for i in y[part]]) if len(part) else ra
            both = np.bitwise_count(ra & rb).sum(1, dtype=np.int64)
            ca, cb = np.bitwise_count(ra).sum(1, dtype=np.int64), np.bitwise_count(rb).sum(1, dtype=np.int64)
            good[part] = _possible(g.n[x[part]], g.n[y[part]], ca - both, cb - both)
            score[part] = both / np.maximum(ca + cb - both, 1)
    return x[good], y[good], score[good]


def _emit(g: _Groups, x, y, score, best: int):
    """Pairs to verify out of one batch of groups: a spanning forest (best = 1), the ``best``
    highest scores per member and group, or all (best = 0)."""
    if not len(x):
        return x, y
    if best == 1:
        order = np.lexsort((g.rep[y] + g.rep[x], -score))
        union, kept = _Union(), []
        for i in order:
            if union.join(int(g.comp[x[i]]), int(g.comp[y[i]])):
                kept.append(i)
        kept = np.array(kept, int)
        return x[kept], y[kept]
    if best > 1:
        keep = np.zeros(len(x), bool)
        for end in (x, y):
            order = np.lexsort((-score, end))
            e = end[order]
            new = np.concatenate([[True], e[1:] != e[:-1]])
            rank = np.arange(len(e)) - np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
            keep[order[rank < best]] = True
        return x[keep], y[keep]
    return x, y


def _candidates(best: int):
    flat = ["k", "side", "rep", "comp", "n", "t"]

    def run(held):
        cols = {c: np.concatenate([h[c] for h in held]) for c in flat}
        g = _Groups(**cols, bits=[x for h in held for x in h["bits"]],
                    sketch=np.concatenate([h["sketch"] for h in held]) if best != 1 else None)
        bounds = np.flatnonzero(np.concatenate([[True], g.key[1:] != g.key[:-1], [True]]))
        starts, sizes = bounds[:-1], np.diff(bounds)
        small = (sizes >= 2) & (sizes <= LEAF)
        out = []
        x, y, score = _small_pairs(g, starts[small], sizes[small])
        out.append(_emit(g, x, y, score, best))
        for s, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF], strict=True):
            tree, found = _Tree(g, np.arange(s, s + size)), []
            met, union = best == 1, _Union()

            def visit(i, j, sc):
                cross = (g.comp[i] != g.comp[j]) & ((g.side[i] != g.side[j]) | (g.side[i] == 0))
                cross[cross] = g.here(i[cross], j[cross])
                for a, b, c in zip(i[cross], j[cross], sc[cross], strict=True):
                    if not met or union.join(int(g.comp[a]), int(g.comp[b])):
                        found.append((a, b, c))

            tree.pairs(visit)
            if found:
                f = np.array(found)
                out.append(_emit(g, f[:, 0].astype(int), f[:, 1].astype(int), f[:, 2], best))
        a = np.concatenate([g.rep[x] for x, _ in out])
        b = np.concatenate([g.rep[y] for _, y in out])
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        if len(lo):
            lo, hi = np.unique(np.stack([lo, hi]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["a", "b"])

    def task(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in flat}
            part["bits"] = batch.column("bits").to_pylist()
            if best != 1:
                lists = batch.column("sketch")
                size = np.diff(lists.offsets.to_numpy())
                rows_at = np.repeat(np.arange(len(size)), size)
                cols_at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                part["sketch"] = np.full((len(size), SKETCH), np.iinfo(np.uint64).max, np.uint64)
                part["sketch"][rows_at, cols_at] = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            key = part["k"]
            if rows + len(key) >= 1 << 15 and rows:
                # everything before this batch's last key is whole
                cut_at = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
                if cut_at:
                    held.append({c: v[:cut_at] for c, v in part.items()})
                    yield run(held)
                    held, rows = [{c: v[cut_at:] for c, v in part.items()}], len(key) - cut_at
                    continue
            held.append(part)
            rows += len(key)
        if held:
            yield run(held)

    return task


def _verify(batches):
    """Pairs with both sets -> those that link."""
    for batch in batches:
        sa, sb = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        ok = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(sa, sb, strict=True)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
            ok[i] = DEN * both >= NUM * (len(x) + len(y) - both)
        keep = pa.array(ok)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def similarity_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every document.

    Defined cases: null, empty or wordless text has an empty set and links with nothing;
    a text of fewer than five words has one shingle, the whole; equal sets always link;
    repeated rows (same id and text) give one row, rows of one id with different sets one row
    each; a null id keeps its row with its set size, links with nothing and has a null
    component; an empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    try:
        return _classes(in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), scratch)
    finally:
        scratch.close()


def _classes(base: DataFrame, scratch: Scratch) -> DataFrame:
    profile = scratch.cut(base.mapInArrow(_profile, PROFILE))
    same = ["n_shingles", "s1", "s2"]
    cid = F.xxhash64(*same).alias("cid")
    classes = scratch.cut(profile.where("n_shingles > 0 and doc_id is not null")
                          .groupBy(*same, "sketch", "bits").agg(F.min("doc_id").alias("rep"))
                          .select(cid, "rep", F.col("n_shingles").alias("n"), "sketch", "bits"))
    out = scratch.cut(profile.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, cid).alias("cid")).distinct())
    scratch.drop(profile)

    # Tokens whose classes are the same are one group, named by the smallest: near copies share most of their tokens.
    tokens = classes.select("cid", F.explode("sketch").alias("t"))
    shared = (tokens.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("_h1"), F.bit_xor(F.xxhash64("cid", F.lit(2))).alias("_h2"))
              .where("c > 1").groupBy("c", "_h1", "_h2").agg(F.min("t").alias("t")))
    shared = scratch.cut(shared.select("t", "c"))
    # written: a join with a plain exchange on both sides is one whose hot keys Spark can split
    grouped = scratch.cut(tokens.join(shared, "t").select("t", "cid", "c"))
    homes = grouped.groupBy("cid").agg(F.sort_array(F.collect_list("t")).alias("homes"))      # SKETCH groups at most
    marks = scratch.cut(classes.join(homes, "cid").select("cid", "n", "bits", "homes"))
    names = scratch.cut(classes.select("cid", "rep"))
    scratch.drop(classes, shared)
    scratch.release()

    labels, links, tested, sets = None, None, None, None
    for best in (1, 4, 0):
        if labels is None:
            rows = grouped.withColumn("comp", F.col("cid"))
        else:
            # only groups of several components go on, and only then do their members' bitmaps join
            rows = (grouped.join(labels, grouped["cid"] == labels["id"], "left")
                    .select("t", "cid", "c", F.coalesce("component", "cid").alias("comp")))
            open_ = rows.groupBy("t").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo < _hi").select("t")
            rows = scratch.cut(rows.join(open_, "t", "left_semi"))
            if rows.isEmpty():
                break
        meet = rows.join(marks, "cid")
        # groups beyond BLOCK members: blocks by hash, every pair of blocks (and each by itself)
        n_blocks = F.ceil(F.col("c") / F.lit(BLOCK)).cast("int")
        mine = F.pmod(F.xxhash64("cid"), n_blocks).cast("int")
        meet = meet.withColumn("_b", mine).withColumn("_o", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        meet = meet.select(F.xxhash64("t", F.least("_b", "_o"), F.greatest("_b", "_o")).alias("k"),
                           F.when(F.col("_b") == F.col("_o"), 0).when(F.col("_b") < F.col("_o"), 1).otherwise(2).alias("side"),
                           F.col("cid").alias("rep"), "comp", "n", "t", "bits", *([] if best == 1 else [F.col("homes").alias("sketch")]))
        pairs = meet.repartition("k").sortWithinPartitions("k").mapInArrow(_candidates(best), "a long, b long").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.cut(pairs)
        if labels is not None:
            scratch.drop(rows)
        if sets is None:
            # Whoever has a possible partner is in the first round's forests: only their sets are
            # needed, and only they can meet again.
            ends = scratch.cut(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
            wanted = scratch.cut(names.join(ends, "cid").select(F.col("rep").alias("_id")).distinct())
            texts = base.join(if_small(wanted), F.col("doc_id") == F.col("_id"), "inner").select("text")
            sets = scratch.cut(texts.mapInArrow(_full_sets, "n_shingles long, s1 long, s2 long, set binary").select(cid, "set"))
            all_groups, grouped = grouped, scratch.cut(grouped.join(ends, "cid").select("t", "cid", "c"))
            scratch.drop(all_groups, wanted, ends)
        scratch.release()
        if pairs.isEmpty():
            if best == 4:
                continue    # all the best are tested: what is left is listed in the last round
            break       # nothing untested is left across components
        both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("sa")), "a")
                .join(sets.select(F.col("cid").alias("b"), F.col("set").alias("sb")), "b"))
        found = scratch.cut(both.select("a", "b", "sa", "sb").mapInArrow(_verify, "a long, b long"))
        tested = pairs if tested is None else tested.union(pairs)
        if labels is None or not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = components(links, scratch=scratch)
        scratch.release()

    if labels is None:
        labels = names.select(F.col("cid").alias("id"), F.col("cid").alias("component")).limit(0)
    # the smallest document id of every component
    member = names.join(labels, names["cid"] == labels["id"], "left").select("cid", "rep", F.coalesce("component", "cid").alias("comp"))
    least = member.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = member.join(least, "comp").select(F.col("cid").alias("_c"), "component_id")
    out = out.join(named, F.col("cid") == F.col("_c"), "left")
    return cut(out.select("doc_id", "n_shingles",
                          F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def op7_ngram_join(spark, sf_dir):
    from kestrel.llm.common import table

    return similarity_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
