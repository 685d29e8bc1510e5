"""Removal of repeated passages by bucket-pointer refinement over sampled suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else. The
order of all suffixes is not needed for that, only their buckets of equal prefixes, and not of
all suffixes: in every window of ``length`` bytes the leftmost smallest ``GRAM``-gram (by
hash) marks a suffix. Equal windows mark the same place, so an equal window shares the bucket of its suffix.

1. Bucket identifiers are built by refinement: the bucket of 2 l bytes at p is made of the
   buckets of l bytes at p and at p + l, reusing each round's identifiers in the next; any
   longer string is named by the buckets at two or three of its offsets. Identifiers are 64-bit
   hashes of the contents, so they hold across tasks without a global sort.
2. Initial buckets: the marked suffixes by their ``GRAM``-gram. Buckets of one are done.
3. Refined buckets: inside a bucket by the identifier of all bytes of the windows that
   mark the suffix (its run). Suffixes that share it repeat each other over the whole run.
4. Only suffixes whose run is unlike all others in a bucket remain, with one witness of
   every refined bucket. Their bytes meet by bucket, and the last refinement, on the identifiers of
   each single window, decides. Buckets beyond ``HOT`` distinct runs are not gathered:
   their windows are counted as rows of their own, so none of them has to fit one task.

Counts are partial aggregates and joins are equi-joins that adaptive execution may split, so a
string with a third of all occurrences is spread. The texts are shuffled once, by document.

Passages counted in words take the same four steps in the same jobs, over words in place of bytes: their buckets
are odd, those of bytes even. A passage repeats there when another document has it, so a document gives
each of its runs once, and the last step finds the other places of a repeated window in the text itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import words as W
from kestrel.llm.common import cut, in_batches, release

LENGTH = 400
GRAM = 128           # a power of two below LENGTH
TOP = 256            # longest bucket kept: the largest power of two up to LENGTH
PASSAGE = 51         # words of a passage of over 50 words
WORD_GRAM = 8        # as GRAM and TOP, in words
WORD_TOP = 32
HOT = 64             # distinct runs of a bucket that may meet in one task
SEGMENT = 1 << 21    # bytes of one text that are looked at together
SLICE = 1 << 16      # bytes of short texts that are looked at together: their arrays stay in the cache

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _longer(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Buckets of twice the length, from those at an offset and of what follows."""
    with np.errstate(over="ignore"):
        out = left * _A
        out += right * _B
    out ^= out >> np.uint64(31)
    return out


def bucket_levels(codes: np.ndarray, top: int = TOP) -> dict[int, np.ndarray]:
    """Identifier of the 1, 2, 4 .. ``top`` symbols (bytes or words, by their codes) at every offset (as far as they fit)."""
    level, n = codes, 1
    out = {1: level}
    while n < top:
        level = _longer(level[:max(len(level) - n, 0)], level[n:])
        n *= 2
        out[n] = level
    return out


def string_ids(levels, start: np.ndarray, size: np.ndarray, top: int = TOP) -> np.ndarray:
    """Identifier of the ``size`` symbols (``top`` to 3 ``top``) at ``start``, from buckets of ``top`` at later offsets.
    Where few are asked for, ``levels`` may end at half of ``top``."""
    half = top // 2
    at = levels[top].__getitem__ if top in levels else lambda x: _longer(levels[half][x], levels[half][x + half])
    with np.errstate(over="ignore"):
        h = W.mix64(at(start) + size.astype(np.uint64) * _B)
        h = W.mix64(h * _A + at(start + np.minimum(top, size - top)))
        return W.mix64(h * _A + at(start + size - top))


def _windows(offsets: np.ndarray, length: int):
    """Starts of all windows that lie inside one text."""
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(count.sum())
    before = np.concatenate([[0], np.cumsum(count)])
    return np.repeat(offsets[:-1] - before[:-1], count) + np.arange(total), np.repeat(np.arange(len(count)), count)


def marked_runs(codes: np.ndarray, offsets: np.ndarray, length: int, gram: int, top: int = TOP):
    """Per run of windows that mark the same suffix: text, first and last window, suffix, bucket, run id."""
    p, text = _windows(offsets, length)
    none = np.zeros(0, np.int64)
    if not len(p):
        return none, none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    levels = bucket_levels(codes, max(top // 2, gram))
    grams = W.mix64(levels[gram])
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, n = length - gram + 1, 1
    while n * 2 <= width:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    if width > n:
        low = np.minimum(low[:n - width], low[width - n:])
    at = (low[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(p), bool)
    new[1:] = (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    start, end, suffix = p[first], p[last], at[first]
    return text[first], start, end, suffix, grams[suffix], string_ids(levels, start, end - start + length, top)


def _segments(data, offsets, length):
    """(row offset, bytes, offsets, shift) pieces of a batch: runs of rows, long texts in overlapping parts."""
    for a, b in W.slices(offsets, min(SLICE, SEGMENT)):
        size = int(offsets[b] - offsets[a])
        if b - a > 1 or size <= 2 * SEGMENT:
            yield a, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], 0
            continue
        for s in range(0, size - length + 1, SEGMENT):
            piece = data[offsets[a] + s:min(offsets[a] + s + SEGMENT + length - 1, offsets[b])]
            yield a, piece, np.array([0, len(piece)]), s


# pos, size: the bytes of the run's windows. span: (suffix - first window) << 10 | (suffix - last window)
RUNS = "k long, pos long, size int, span int, bucket long, run long"


def _run_batch(k, pos, size, span, bucket, run, words):
    bucket = (bucket & ~np.uint64(1)) | np.uint64(words)
    return pa.RecordBatch.from_arrays(
        [pa.array(k), pa.array(pos, pa.int64()), pa.array(size.astype(np.int32)), pa.array(span.astype(np.int32)),
         pa.array(bucket.view(np.int64)), pa.array(run.view(np.int64))], names=["k", "pos", "size", "span", "bucket", "run"])


def _run_rows(length, gram, words):
    def run(batches):
        for batch in batches:
            data, offsets = W.utf8(batch.column("text"))
            k = batch.column("k").to_numpy(zero_copy_only=False)
            for row, piece, off, shift in _segments(data, offsets, length):
                text, start, end, suffix, bucket, ident = marked_runs(W._BYTE_CODE[piece], off, length, gram)
                if len(text):
                    yield _run_batch(k[row + text], start - off[text] + shift, end - start + length, (suffix - start) << 10 | (suffix - end), bucket, ident, False)
            for a, b in W.slices(offsets, min(SLICE, SEGMENT)) if words else ():
                text, *found = _word_runs(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                if len(text):
                    yield _run_batch(k[a + text], *found, True)
    return run


def _words(data, offsets):
    """start, end, code of every word and the first word of each text."""
    starts, ends, first = W.word_spans(data, offsets)
    codes = np.zeros(len(starts), np.uint64)
    for a, b in W.slices(offsets, SLICE):
        at, i, j = offsets[a], first[a], first[b]
        codes[i:j] = W.word_hashes(data[at:offsets[b]], starts[i:j] - at, ends[i:j] - at)
    return starts, ends, codes, first


def _word_runs(data, offsets, length):
    """The distinct runs of words of each text: text, first byte, bytes, span, bucket, run id."""
    starts, ends, codes, first = _words(data, offsets)
    text, start, end, suffix, bucket, ident = marked_runs(codes, first, length, WORD_GRAM, WORD_TOP)
    span = (suffix - start) << 10 | (suffix - end)
    order = np.lexsort((start, ident, span, text))
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (span[order][1:] != span[order][:-1]) | (ident[order][1:] != ident[order][:-1])
    one = order[new]
    text, pos = text[one], starts[start[one]]
    return text, pos - offsets[text], ends[end[one] + length - 1] - pos, span[one], bucket[one], ident[one]


def _windows_of(ctx: list[bytes], length, words):
    """Every window of the contexts: context, number, identifier and its bytes (first, end) in the context."""
    data = np.frombuffer(b"".join(ctx), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(c) for c in ctx])])
    if words:
        starts, ends, codes, first = _words(data, off)
    else:
        codes, first = W._BYTE_CODE[data], off
    p, text = _windows(first, length)
    if not len(p):
        return text, p, np.zeros(0, np.uint64), p, p
    top = WORD_TOP if words else TOP
    ids = string_ids(bucket_levels(codes, top), p, np.full(len(p), length), top)
    a, b = (starts[p], ends[p + length - 1]) if words else (p, p + length)
    return text, p - first[text], ids, a - off[text], b - off[text]


SPANS = "k long, words boolean, a long, b long"


def _intervals(k, first, text, number, a, b, words):
    """Byte ranges covered by windows ``number`` of contexts ``text`` (both ascending)."""
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1] + 1)
    i = np.flatnonzero(new)
    j = np.append(i, len(text))[1:] - 1
    return pa.RecordBatch.from_arrays([pa.array(k[text[i]]), pa.array(np.full(len(i), words)), pa.array(first[text[i]] + a[i], pa.int64()),
                                       pa.array(first[text[j]] + b[j], pa.int64())], names=["k", "words", "a", "b"])


def _again(ids, c, k, words):
    """Whether each window occurs again: at another place or, for words, in another document."""
    if not len(ids):
        return np.zeros(0, bool)
    _, inverse = np.unique(ids, return_inverse=True)
    if not words:
        return np.bincount(inverse, weights=c)[inverse] >= 2
    order = np.argsort(inverse, kind="stable")
    at = np.flatnonzero(np.diff(inverse[order], prepend=-1))
    return ((np.maximum.reduceat(c[order], at) >= 2) | (np.minimum.reduceat(k[order], at) != np.maximum.reduceat(k[order], at)))[inverse]


def _of_kind(bucket, ctx, length, words):
    """(words?, window length, numbers of the contexts, these contexts) for bytes and for words."""
    for kind, n in ((False, length), (True, words)):
        at = np.flatnonzero((bucket & 1) == kind)
        if len(at):
            yield kind, n, at, [ctx[i] for i in at]


def _decide(length, words):
    """Contexts sorted by bucket -> byte ranges of the single ones whose windows occur again."""
    def some(rows):
        for kind, n, at, ctx in _of_kind(rows["bucket"], rows["ctx"], length, words):
            k, c = rows["k"][at], rows["c"][at]
            text, number, ids, a, b = _windows_of(ctx, n, kind)
            hit = _again(ids, c[text], k[text], kind) & (c[text] == 1)
            yield _intervals(k, rows["first"][at], text[hit], number[hit], a[hit], b[hit], kind)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = {c: part.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "k", "first", "c")}
                rows["ctx"] = part.column("ctx").to_pylist()
                key = rows["bucket"]
                if size > SEGMENT:
                    # the part's leading rows may belong to the last bucket held
                    m = int(np.argmax(key != held[-1]["bucket"][-1])) if (key != held[-1]["bucket"][-1]).any() else len(key)
                    held.append({c: v[:m] for c, v in rows.items()})
                    if m == len(key):
                        continue
                    yield from some(_joined(held))
                    held, size = [], 0
                    rows = {c: v[m:] for c, v in rows.items()}
                held.append(rows)
                size += sum(map(len, rows["ctx"]))
        if held:
            yield from some(_joined(held))
    return run


def _joined(parts):
    return {c: sum((p[c] for p in parts), []) if c == "ctx" else np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _window_rows(length, words):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                bucket, *rest = (part.column(x).to_numpy(zero_copy_only=False) for x in ("bucket", "k", "first", "c"))
                for kind, n, at, ctx in _of_kind(bucket, part.column("ctx").to_pylist(), length, words):
                    text, _, ids, a, b = _windows_of(ctx, n, kind)
                    k, first, c = (x[at][text] for x in rest)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids.view(np.int64)), pa.array(c, pa.int64()), pa.array(k), pa.array(np.full(len(k), kind)),
                         pa.array(first + a, pa.int64()), pa.array(first + b, pa.int64())], names=["w", "c", "k", "words", "a", "b"])
    return run


def _repeated_words(data, offsets, text, a, b, length):
    """Per text, how many words lie in its windows between bytes ``a`` and ``b`` of text ``text``, or in windows equal to these."""
    starts, ends, codes, first = _words(data, offsets)
    p, owner = _windows(first, length)
    with np.errstate(over="ignore"):
        ids = W.mix64(string_ids(bucket_levels(codes, WORD_TOP), p, np.full(len(p), length), WORD_TOP) + owner.astype(np.uint64) * _A)
    step = np.zeros(len(starts) + 1, np.int64)
    np.add.at(step, np.searchsorted(starts, offsets[text] + a), 1)
    np.add.at(step, np.searchsorted(ends, offsets[text] + b, side="right") - length + 1, -1)
    hit = p[np.isin(ids, ids[np.cumsum(step)[p] > 0])]
    step = np.zeros(len(starts) + 1, np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, hit + length, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    return np.diff(covered[first])


def _removed(words):
    def run(batches):
        for batch in batches:
            data, offsets = W.utf8(batch.column("text"))
            out, marks = [], []
            for i, spans in enumerate(batch.column("spans")):
                raw = data[offsets[i]:offsets[i + 1]]
                runs = removed = 0
                keep = raw
                if spans.is_valid and len(spans):
                    kind, a, b = (spans.values.field(x).to_numpy(zero_copy_only=False) for x in ("words", "a", "b"))
                    if kind.any():
                        marks.append((i, raw, a[kind], b[kind]))
                    if not kind.all():
                        step = np.zeros(len(raw) + 1, np.int64)
                        np.add.at(step, a[~kind], 1)
                        np.add.at(step, b[~kind], -1)
                        gone = np.cumsum(step[:-1]) > 0
                        removed = int(gone.sum())
                        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                        keep = raw[~gone]
                out.append((len(raw), removed, runs, keep.tobytes()))
            repeated = np.zeros(len(out), np.int64)
            if marks:
                at, raws, a, b = zip(*marks, strict=True)
                off = np.concatenate([[0], np.cumsum([len(x) for x in raws])])
                for i, j in W.slices(off, SEGMENT):
                    text = np.repeat(np.arange(j - i), [len(x) for x in a[i:j]])
                    repeated[list(at[i:j])] = _repeated_words(np.concatenate(raws[i:j]), off[i:j + 1] - off[i], text, np.concatenate(a[i:j]), np.concatenate(b[i:j]), words)
            cols = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in cols[3]], pa.string()), pa.array(cols[3], pa.binary()),
                 pa.array([x.decode("utf-8", "ignore") for x in cols[3]], pa.string()), pa.array(repeated)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text", "n_repeated_words"])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) and text (these decoded, without
    the parts of characters that a cut may leave) per document.

    With ``words`` (WORD_TOP to 51) also n_repeated_words: how many words of the document, all of its text, lie in a run of that
    many consecutive words that another document has too. Words are runs of anything but space and TAB..CR, A-Z count as a-z,
    white space between them may differ; such a passage may be shorter than ``length`` bytes, and it is not removed for that.

    ``length`` is 2 TOP at most and TOP at least. Defined cases: null or empty text has no bytes;
    shorter texts than ``length`` lose nothing; repeated rows are documents of their own, so each
    occurs in the other; a null id keeps its row; an empty table gives no rows; other columns
    are ignored.
    """
    if not TOP <= length <= 2 * TOP or gram >= length or gram not in (32, 64, 128, 256):
        raise ValueError("length must be 256 to 512 and gram a smaller power of two")
    if words is not None and not WORD_TOP <= words <= PASSAGE:
        raise ValueError("words must be 32 to 51")
    base = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    base = base.withColumn("k", F.xxhash64("doc_id", "text"))
    runs = base.select("k", "text").mapInArrow(_run_rows(length, gram, words), RUNS)

    # initial buckets
    # cut: a join with a plain exchange on both sides is one whose hot keys Spark can split
    shared = cut(runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"))
    runs = cut(runs.join(shared, "bucket"))
    del shared
    release(docs.sparkSession)
    # refined buckets: equal runs. min_by gives the position that belongs to the smallest k
    same = ["bucket", "span", "run"]
    refined = cut(runs.groupBy(*same).agg(F.count(F.lit(1)).alias("c"), F.min("k").alias("k"), F.min_by("pos", "k").alias("pos"), F.min_by("size", "k").alias("size")))
    release(docs.sparkSession)
    kind = (F.col("bucket").bitwiseAND(1) == 1).alias("words")
    whole = (runs.join(refined.where("c > 1").select(*same), same)
             .select("k", kind, F.col("pos").alias("a"), (F.col("pos") + F.col("size")).alias("b")))

    open_ = (refined.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"))
             .where("n > 1 and least = 1").select("bucket", (F.col("n") > HOT).alias("hot")))
    left = refined.join(open_, "bucket").select("bucket", "hot", "k", F.col("pos").alias("first"), "c", "size")
    # Both joins read one exchange of the texts, since both keep doc_id: without it the exchanges would differ. Equal
    # rows of a document have c > 1 here, so their several copies of a witness cannot change a decision.
    texts = base.select("k", "doc_id", "text")
    ctx = texts.join(left.hint("shuffle_hash"), "k").select(
        "bucket", "hot", "k", "doc_id", "first", "c", F.substring(F.col("text").cast("binary"), (F.col("first") + 1).cast("int"), F.col("size")).alias("ctx"))
    cold = (ctx.where("not hot").drop("hot").repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_decide(length, words), SPANS))
    rows = ctx.where("hot").drop("hot").mapInArrow(_window_rows(length, words), "w long, c long, k long, words boolean, a long, b long")
    again = (rows.groupBy("w", "words").agg(F.sum("c").alias("n"), F.max("c").alias("most"), F.min("k").alias("k0"), F.max("k").alias("k1"))
             .where("if(words, most > 1 or k0 <> k1, n > 1)").select("w", "words"))
    hot = rows.where("c = 1").join(again, ["w", "words"]).select("k", "words", "a", "b")

    spans = whole.unionByName(cold).unionByName(hot).groupBy("k").agg(F.collect_set(F.struct("words", "a", "b")).alias("spans"))
    out = texts.join(spans.hint("shuffle_hash"), "k", "left").select("doc_id", "text", "spans").mapInArrow(
        _removed(words), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, text string, n_repeated_words long")
    return out.drop("n_repeated_words") if words is None else out


def op6_suffix_dedup(spark, sf_dir):
    from kestrel.llm.common import table

    return remove_repeats(table(spark, sf_dir, "documents"), words=PASSAGE).drop("kept")
