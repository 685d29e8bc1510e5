"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, drawn from its code point. A trigram's vector is the
product of its letters' vectors, each rotated by its place (binding); a text's vector is the sum of the
vectors of its trigrams (bundling), and a language's prototype is the sum over its texts, each with the
same weight. A document gets the language whose prototype has the largest cosine with its vector.

Letters are lower-cased; all that is no letter separates words, and a run of it counts as one separator,
which has a vector of its own. A text has one trigram around each of its letters. Binding is linear in the
counts, so a task counts trigrams and multiplies the counts with the trigrams' vectors; prototypes are
integer sums over tasks, the same however the rows are dealt.

Defined cases: a null text and one without a letter are ``und`` with score 0, as is every text when nothing
can be learnt; null languages and null ids are not learnt from, a null id is not held out; ties go to the
language that sorts first; every row gets its own result, repeated or not; long texts are read whole, in
pieces that end between words; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import words as W
from kestrel.llm.common import cut, in_batches, table

DIM = 1024
SEED = 20240613
PIECE = 1 << 21          # bytes of text looked at together
UNIT = 1 << 24           # a text's weight in its language's prototype
DENSE = 1 << 22          # trigram codes up to which they are counted in a flat array
ROWS, COLUMNS = 256, 1 << 13    # of a block of counts (texts by trigrams)
LANGS = 256              # prototypes compared at a time


class Letters:
    """Letter numbers and sign vectors, found once per worker."""

    def __init__(self, dim: int = DIM):
        self.dim, self.vectors = dim, {}
        self.number = np.full(0x110000, -1, np.int32)    # of a code point: its lower case, or 0

    def lower(self, points: np.ndarray) -> np.ndarray:
        got = self.number[points]
        if (got < 0).any():
            for p in np.unique(points[got < 0]).tolist():
                c = chr(p)
                low = c.lower() if c.isalpha() else ""
                self.number[p] = ord(low[0]) if low else 0
            got = self.number[points]
        return got

    def matrix(self, numbers: np.ndarray) -> np.ndarray:
        for p in numbers.tolist():
            if p not in self.vectors:
                self.vectors[p] = (np.random.default_rng([SEED, p]).integers(0, 2, self.dim) * 2 - 1).astype(np.int8)
        return np.stack([self.vectors[p] for p in numbers.tolist()])

    def bound(self, alphabet: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Vectors of the trigrams ``codes`` (three places to the base of the alphabet's size)."""
        s, m = len(alphabet), self.matrix(alphabet)
        first, second = np.roll(m, 2, axis=1), np.roll(m, 1, axis=1)
        return first[codes // (s * s)] * second[codes // s % s] * m[codes % s]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE):
    """(start, end, row) of the texts' bytes; a longer text is cut at spaces, its pieces name the same row."""
    for row in range(len(offsets) - 1):
        start, stop = int(offsets[row]), int(offsets[row + 1])
        while stop - start > size:
            spaces = np.flatnonzero(data[start + 1:start + size] == 0x20)
            if not len(spaces):
                further = np.flatnonzero(data[start + size:stop] == 0x20)
                if not len(further):
                    break
                at = start + size + int(further[0])
            else:
                at = start + 1 + int(spaces[-1])
            yield start, at, row
            start = at
        yield start, stop, row


def slices(data: np.ndarray, offsets: np.ndarray, size: int = PIECE):
    """Pieces held together up to ``size`` bytes."""
    held, total = [], 0
    for p in pieces(data, offsets, size):
        if held and total + p[1] - p[0] > size:
            yield held
            held, total = [], 0
        held.append(p)
        total += p[1] - p[0]
    if held:
        yield held


def trigrams(data: np.ndarray, held, letters: Letters):
    """(alphabet, distinct codes, number in these of every trigram, its piece) of consecutive pieces."""
    begin = held[0][0]
    part = data[begin:held[-1][1]]
    ends = np.array([h[1] for h in held]) - begin
    try:
        points = np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])[ends]
    except UnicodeDecodeError:    # not UTF-8: what cannot be read is no letter
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b, _ in held]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        heads = np.cumsum([len(t) for t in texts])
    starts = np.concatenate([[0], heads])
    low = np.insert(letters.lower(points), starts, 0)
    piece = np.repeat(np.arange(len(held) + 1), np.diff(np.concatenate([starts, [len(points)]])) + 1)
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 0) | (low[:-1] != 0)
    low, piece = low[keep], piece[keep]
    alphabet, place = np.unique(low, return_inverse=True)
    s, place = len(alphabet), place.astype(np.int64)
    middle = np.flatnonzero(low[1:-1] != 0) + 1
    code = (place[middle - 1] * s + place[middle]) * s + place[middle + 1]
    if s ** 3 <= DENSE:
        there = np.bincount(code, minlength=s ** 3) > 0
        codes = np.flatnonzero(there)
        number = (np.cumsum(there) - 1)[code]
    else:
        codes, number = np.unique(code, return_inverse=True)
    return alphabet, codes, number, piece[middle]


def text_vectors(column, letters: Letters, size: int = PIECE):
    """(vectors, letters) of each text of an Arrow column: sums of its trigrams' vectors and their number."""
    data, offsets = W.utf8(column)
    out, count = np.zeros((len(offsets) - 1, letters.dim), np.float32), np.zeros(len(offsets) - 1, np.int64)
    for held in slices(data, offsets, size):
        alphabet, codes, number, piece = trigrams(data, held, letters)
        rows = np.array([h[2] for h in held])
        np.add.at(count, rows, np.bincount(piece, minlength=len(held))[:len(held)])
        for c in range(0, len(codes), COLUMNS):
            vectors = letters.bound(alphabet, codes[c:c + COLUMNS]).astype(np.float32)
            mine = (number >= c) & (number < c + COLUMNS) if len(codes) > COLUMNS else slice(None)
            n, p = number[mine] - c, piece[mine]     # ordered by piece
            for r in range(0, len(held), ROWS):
                a, b = np.searchsorted(p, [r, r + ROWS])
                if a == b:
                    continue
                height = min(ROWS, len(held) - r)
                counts = np.bincount((p[a:b] - r) * len(vectors) + n[a:b], minlength=height * len(vectors))
                np.add.at(out, rows[r:r + height], counts.reshape(height, -1).astype(np.float32) @ vectors)
    return out, count


def _profiles(dim: int):
    """Per task and language: the sum of its texts' vectors, each text with weight UNIT."""
    def run(batches):
        letters, sums = Letters(dim), {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            vectors, count = text_vectors(batch.column("text"), letters)
            share = np.rint(vectors.astype(np.float64) * (UNIT / np.maximum(count, 1))[:, None]).astype(np.int64)
            for lang in set(langs[count > 0].tolist()):
                got = share[(langs == lang) & (count > 0)].sum(0)
                sums[lang] = sums[lang] + got if lang in sums else got
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(v)], names=["lang", "d", "v"])
    return run


def _compare(model):
    """Adds the best language of a block of prototypes to what earlier blocks found."""
    def run(batches):
        names, prototypes = model.value
        letters = Letters(prototypes.shape[1])
        for batch in batches:
            vectors, count = text_vectors(batch.column("text"), letters)
            norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
            # rounded, so that the order of additions shows in no result
            close = np.round(vectors.astype(np.float64) @ prototypes.T / np.maximum(norm, 1e-300)[:, None], 9)
            best = close.argmax(1)
            score = np.clip(close[np.arange(len(best)), best], 0.0, 1.0)
            pred = np.array(names, object)[best]
            pred[count == 0], score[count == 0] = "und", 0.0
            if "lang_pred" in batch.schema.names:
                before = np.array(batch.column("score").to_pylist(), np.float64)
                older = (before >= score) | (count == 0)
                pred[older], score[older] = np.array(batch.column("lang_pred").to_pylist(), object)[older], before[older]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), batch.column("text"), pa.array(pred, pa.string()), pa.array(score)],
                                             names=["doc_id", "held_out", "text", "lang_pred", "score"])
    return run


def language_profiles(texts: DataFrame, dim: int = DIM) -> DataFrame:
    """lang, profile: the prototype of every non-null language of (lang, text), ``dim`` whole numbers."""
    sums = in_batches(texts).where("lang is not null and text is not null").select("lang", "text").mapInArrow(_profiles(dim), "lang string, d int, v long")
    merged = sums.groupBy("lang", "d").agg(F.sum("v").alias("v"))
    return merged.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("d", "v"))), lambda x: x["v"]).alias("profile"))


def identify(docs: DataFrame, profiles: DataFrame, block: int = LANGS) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with lang_pred and score; ``profiles`` are written before.

    Prototypes go to the tasks in blocks of at most ``block`` languages (8 KB each)."""
    names = sorted(r["lang"] for r in profiles.select("lang").toLocalIterator())
    spark, out = docs.sparkSession, docs.select("doc_id", "held_out", "text")
    if not names:
        return out.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    for at in range(0, len(names), block):
        some = names[at:at + block]
        rows = {r["lang"]: r["profile"] for r in profiles.where(F.col("lang").between(some[0], some[-1])).collect()}
        m = np.array([rows[x] for x in some], np.float64)
        m /= np.maximum(np.sqrt((m ** 2).sum(1)), 1e-300)[:, None]
        out = in_batches(out).mapInArrow(_compare(spark.sparkContext.broadcast((some, m))), "doc_id long, held_out boolean, text string, lang_pred string, score double")
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op13_language(spark, sf_dir):
    """The language of every document, learnt outside the fold crc32(doc_id) mod 3 = 1."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    learn = docs.where(fold != 1).select("lang", "text")
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "text")
    return identify(base, cut(language_profiles(learn)))
