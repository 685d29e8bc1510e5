"""Alignment of two tokenizers over a corpus.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces with byte fallback) the text,
to which it adds the space itself, so the tokens of both cover the same bytes. Offsets where a token of A
and one of B end cut them into groups; A and B tokens whose bytes overlap are linked; a link's count is how
many links of the corpus hold its pair of ids.

1. Texts are cut into segments before every space between two characters that are neither space nor control.
   Neither vocabulary has a token across such a place (checked when it is loaded; otherwise a text is one
   segment), so segments are encoded and aligned alone, and each worker keeps those it has seen.
2. ``identity`` maps an A id to the B id of the same bytes. A group of one token each whose ids are so mapped
   adds one to a vector as long as A's vocabulary; only links of other groups become pairs of ids, counted per
   task and then by Spark, which shuffles (pair, count) rows.
3. Links are resolved against counts in two steps: the vector of identity pairs and the ``TOP_PAIRS`` most
   frequent pairs go to the tasks (both sizes are fixed); all other pairs of a document meet their counts in a
   join, so a pair that a third of all documents hold never enters a shuffle by its key.

Encoded texts are written once, as pairs and counts, to the shared folder and read by the later steps.

Defined cases: null and empty texts have no tokens, nor have texts whose tokens of A or B do not join to
the space and the text (a literal U+2581, say); their numbers are 0 and the digest is ''. Special tokens' strings
are plain text. Every row has its own result and counts, repeated or not, whatever its id; texts of any length
are encoded whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import cut, drop_folder, in_batches, shared_dir, table

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
TOP_PAIRS = 1 << 17         # pairs whose counts are sent to every task (12 bytes each)
CACHE = 250_000             # segments a worker keeps
CHUNK = 1 << 20             # characters of a text cut into segments at a time
BATCH = 1 << 16             # pairs that a task holds before it counts them
SHIFT = 32                  # a pair is (A id << SHIFT) | B id
SAME = 1 << 62              # marks the link of an identity group

LONG = 1000                 # characters from which a segment goes to the tokenizer that takes long words well

# Fixed value: how byte-level vocabularies of this kind cut a text into words.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters next to a cut must not be spaces, separators, controls or formats.
EDGE = r"[^\s\x00-\x20\x7f-\xa0\xad ᠎ -‏ -  -⁯▁　﻿]"
CUT = re.compile(f"(?<={EDGE}) (?={EDGE})")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the other bytes for
    the characters from U+0100 on, in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, their token bytes, and the identity map."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        to_byte = byte_alphabet()
        spec = json.loads(a_json)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if token in special else bytes(to_byte[c] for c in token)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.fast = self._by_rank(spec)
        # cuts are safe if no token goes on after a space that follows another character
        splits = spec.get("pre_tokenizer") or {}
        a_safe = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not spec.get("normalizer")
        b_safe = not any(" " in t.lstrip(b" ").decode("utf-8", "replace") for t in self.b_bytes)
        self.cut = CUT if a_safe and b_safe else None
        by_bytes: dict[bytes, int] = {}
        for i, t in enumerate(self.b_bytes):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                by_bytes.setdefault(t, i)
        self.identity = np.array([by_bytes.get(t, -1) for t in self.a_bytes], np.int64)
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # a token's number and the sign after it: within its group, and at the group's end
        self.signed = [np.array([f"{i}," for i in range(len(t))] + [f"{i}{end}" for i in range(len(t))], object)
                       for t, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))]
        self.forget()

    def _by_rank(self, spec: dict):
        """An encoder of short segments by ranks, for a plain byte-level vocabulary whose merges are numbered in
        order: the same tokens (tests), several times faster. None for others."""
        model, splits = spec.get("model", {}), spec.get("pre_tokenizer") or {}
        joined = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        plain = (model.get("type", "BPE") == "BPE" and splits.get("type") == "ByteLevel" and splits.get("use_regex", True)
                 and not splits.get("add_prefix_space") and not spec.get("normalizer") and not model.get("dropout") and not model.get("ignore_merges")
                 and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(joined)) and len(model["vocab"]) == 256 + len(joined))
        if not plain:
            return None
        import tiktoken

        return tiktoken.Encoding("kestrel-a", pat_str=BYTE_LEVEL_WORDS, special_tokens={},
                                 mergeable_ranks={self.a_bytes[i]: i for i in model["vocab"].values()}).encode_ordinary

    def encode_a(self, segments: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.a.encode_batch([" " + s for s in segments], add_special_tokens=False)]
        return [self.fast(" " + s) if len(s) < LONG else self.a.encode(" " + s, add_special_tokens=False).ids for s in segments]

    def forget(self):
        """Segments seen so far: number by text (-1: its tokens do not join to it), and per number what align gives."""
        self.number: dict[str, int] = {}
        self.counts, self.shown = np.zeros((0, 4), np.int64), []
        self.links, self.links_at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def chunks(self, text: str):
        """The text in parts of about CHUNK characters that begin where a segment does."""
        at = 0
        while self.cut and len(text) - at > 2 * CHUNK:
            m = self.cut.search(text, at + CHUNK)
            if not m:
                break
            yield text[at:m.start()]
            at = m.end()
        yield text[at:] if at else text

    def segments(self, chunk: str) -> list[str]:
        return self.cut.split(chunk) if self.cut else [chunk]

    @staticmethod
    def _joins(ids, flat, tokens, size, raw) -> bool:
        """Whether the tokens of every segment join to it."""
        total = np.concatenate([[0], np.cumsum(size[flat])]) if flat else np.zeros(1, np.int64)
        stops = np.cumsum([len(x) for x in ids])
        return bool((total[stops] == np.cumsum([len(r) for r in raw])).all()) and b"".join([tokens[i] for i in flat]) == b"".join(raw)

    def learn(self, segments) -> None:
        """Encode and align segments not seen before, all at once."""
        number = self.number
        new = [s for s in set(segments) if s not in number]
        if not new:
            return
        a = self.encode_a(new)
        b = self.b.encode(new, num_threads=1)
        raw = [b" " + s.encode() for s in new]
        flat_a, flat_b = ([i for x in ids for i in x] for ids in (a, b))
        if not (self._joins(a, flat_a, self.a_bytes, self.a_size, raw) and self._joins(b, flat_b, self.b_bytes, self.b_size, raw)):
            good = [b"".join([self.a_bytes[i] for i in x]) == r and b"".join([self.b_bytes[i] for i in y]) == r for x, y, r in zip(a, b, raw, strict=True)]
            self.number.update((s, -1) for s, ok in zip(new, good, strict=True) if not ok)
            new, a, b, raw = ([x for x, ok in zip(xs, good, strict=True) if ok] for xs in (new, a, b, raw))
            if not new:
                return
            flat_a, flat_b = ([i for x in ids for i in x] for ids in (a, b))
        ends = np.cumsum([len(r) for r in raw])
        flat_a, flat_b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        a_end, b_end = np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b])
        # a link is a stretch between neighbouring ends of any token: one token of A and one of B cover it
        stretch = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        stretch = stretch[np.concatenate([stretch[1:] != stretch[:-1], [True]])]
        la, lb = np.searchsorted(a_end, stretch), np.searchsorted(b_end, stretch)
        closed = (a_end[la] == stretch) & (b_end[lb] == stretch)        # a group ends here
        alone = closed & np.concatenate([[True], closed[:-1]])          # and had one link: one token each
        same = alone & (self.identity[flat_a[la]] == flat_b[lb])
        owner = np.searchsorted(ends, stretch)
        n = len(new)
        first = len(self.shown)
        counts = np.stack([np.array([len(x) for x in a]), np.array([len(x) for x in b]), np.bincount(owner[closed], minlength=n), np.bincount(owner, minlength=n)], axis=1)
        pair = flat_a[la] << SHIFT | flat_b[lb]
        self.counts = np.concatenate([self.counts, counts])
        self.links = np.concatenate([self.links, pair | np.where(same, SAME, 0)])
        self.links_at = np.concatenate([self.links_at, self.links_at[-1] + np.cumsum(counts[:, 3])])
        # the groups' text: tokens ordered by group, A before B, each with the sign that follows it
        last_a, last_b = np.zeros(len(flat_a), bool), np.zeros(len(flat_b), bool)
        last_a[la[closed]] = last_b[lb[closed]] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        signed = np.concatenate([self.signed[0][flat_a + len(self.a_bytes) * last_a], self.signed[1][flat_b + len(self.b_bytes) * last_b]])
        signed = signed[np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")].tolist()
        at = np.concatenate([[0], np.cumsum(counts[:, 0] + counts[:, 1])]).tolist()
        self.shown += ["".join(signed[x:y])[:-1] for x, y in zip(at[:-1], at[1:], strict=True)]
        self.number.update(zip(new, range(first, first + n), strict=True))

    def texts(self, texts):
        """For each text (n_a, n_b, n_groups, n_links, sha256, A ids of identity groups, other pairs), the last
        two with how often each occurs, or None if it has no tokens."""
        for some in _together(texts):
            if len(self.number) > CACHE:
                self.forget()
            parts = [[self.segments(c) for c in self.chunks(t)] if t else None for t in some]
            self.learn(chain.from_iterable(c for p in parts if p for c in p))
            number, shown = self.number, self.shown
            for p in parts:
                if p is None:
                    yield None
                    continue
                sha, seen, ok = hashlib.sha256(), [], True
                for k, c in enumerate(p):
                    at = [*map(number.__getitem__, c)]
                    if min(at) < 0:
                        ok = False
                        break
                    sha.update(((";" if k else "") + ";".join(map(shown.__getitem__, at))).encode())
                    seen += at
                if not ok:
                    yield None
                    continue
                which = np.array(seen)
                total = self.counts[which].sum(0).tolist()
                v, n = _gather(self.links, self.links_at, which)
                same = v & SAME != 0
                yield *total, sha.hexdigest(), ((v[same] ^ SAME) >> SHIFT, n[same]), (v[~same], n[~same])


def _together(texts, size: int = 1 << 22):
    """Runs of texts of about ``size`` characters together."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t or "")
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _gather(values, at, which):
    """Distinct values of the lists ``which`` (cut out of ``values`` at ``at``) and how often each occurs."""
    size = at[which + 1] - at[which]
    got = np.sort(values[np.repeat(at[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())])
    first = np.flatnonzero(np.concatenate([[True], got[1:] != got[:-1]]))
    return got[first], np.diff(np.concatenate([first, [len(got)]]))


ENCODED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, ids binary, pairs binary"


def _packed(values, counts) -> bytes:
    """Distinct values and how often each occurs, as two arrays in one."""
    return values.tobytes() + counts.tobytes()


def _unpacked(raw: bytes):
    x = np.frombuffer(raw or b"", np.int64)
    return x[:len(x) // 2], x[len(x) // 2:]


def _encode(files):
    def run(batches):
        aligner = Aligner(*files.value)
        for batch in batches:
            rows = [(0, 0, 0, 0, "", b"", b"") if got is None else (*got[:5], _packed(*got[5]), _packed(*got[6]))
                    for got in aligner.texts(x.as_py() for x in batch.column("text"))]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                             names=[x.split()[0] for x in ENCODED.split(", ")])
    return run


def _count(identity):
    """Pairs and counts of a task: one vector for identity groups, sorted runs for the others."""
    def run(batches):
        same = np.zeros(len(identity.value), np.int64)
        held_pairs, held_counts, size = [], [], 0

        def flush():
            p, at = np.unique(np.concatenate(held_pairs), return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(p), pa.array(np.bincount(at, np.concatenate(held_counts)).astype(np.int64))], names=["pair", "n"])

        for batch in batches:
            for ids, pairs in zip(batch.column("ids").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                v, n = _unpacked(ids)
                same[v] += n        # distinct ids
                v, n = _unpacked(pairs)
                held_pairs.append(v)
                held_counts.append(n)
                size += len(v)
                if size >= BATCH:
                    yield flush()
                    held_pairs, held_counts, size = [], [], 0
        if size:
            yield flush()
        there = np.flatnonzero(same)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int64) << SHIFT | identity.value[there]), pa.array(same[there])], names=["pair", "n"])
    return run


RESOLVED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum decimal(38,0), groups_sha256 string, "
            "rest array<struct<pair:long,n:long>>")


def _resolve(known):
    """Sums over the links whose pair's count is known here; the others stay in ``rest``."""
    def run(batches):
        pairs, counts, best, identity = known.value
        for batch in batches:
            n_best, sums, rest_pairs, rest_n, ends = [], [], [], [], [0]
            for ids, other in zip(batch.column("ids").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                a, an = _unpacked(ids)
                p, n = _unpacked(other)
                p, n = np.concatenate([a << SHIFT | identity[a], p]), np.concatenate([an, n])
                at = np.minimum(np.searchsorted(pairs, p), max(len(pairs) - 1, 0))
                hit = pairs[at] == p if len(pairs) else np.zeros(len(p), bool)
                n_best.append(int(n[hit & best[at]].sum()) if len(pairs) else 0)
                # exact beyond 64 bits: high and low halves of the counts apart
                c, m = (counts[at[hit]], n[hit]) if len(pairs) else (np.zeros(0, np.int64),) * 2
                sums.append((int(((c >> 24) * m).sum()) << 24) + int(((c & 0xFFFFFF) * m).sum()))
                rest_pairs.append(p[~hit])
                rest_n.append(n[~hit])
                ends.append(ends[-1] + int((~hit).sum()))
            none = np.zeros(0, np.int64)
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(np.concatenate(rest_pairs or [none])), pa.array(np.concatenate(rest_n or [none]))], names=["pair", "n"]))
            import decimal

            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
                + [pa.array(n_best, pa.int64()), pa.array([decimal.Decimal(x) for x in sums], pa.decimal128(38, 0)), batch.column("groups_sha256"), rest],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rest"])
    return run


def read_files(spark: SparkSession, a_file: str = A_FILE, b_file: str = B_FILE):
    """The tokenizers' files (a few MB), read once on the driver and sent to every executor."""
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        return a.read(), b.read()


def align_corpus(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, top: int = TOP_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) for ``docs`` (doc_id, text).

    ``pairs`` has a_id, b_id, n (links of the corpus) and best (n is the highest of its B id)."""
    spark = docs.sparkSession
    files = read_files(spark, a_file, b_file)
    identity = Aligner(*files).identity
    sent = spark.sparkContext.broadcast(identity)
    folder = f"{shared_dir(spark)}/aligned-{uuid.uuid4().hex}"
    try:
        base = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
        encoded = base.mapInArrow(_encode(spark.sparkContext.broadcast(files)), ENCODED)
        encoded.select(F.monotonically_increasing_id().alias("row"), "*").write.option("compression", "zstd").parquet(folder)
        aligned = spark.read.parquet(folder)
        tasks = aligned.select("ids", "pairs").mapInArrow(_count(sent), "pair long, n long")
        counts = tasks.groupBy("pair").agg(F.sum("n").alias("n"))
        b_id = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
        counts = cut(counts.select("pair", b_id.alias("b"), "n"))
        highest = counts.groupBy("b").agg(F.max("n").alias("_most"))       # at most B's vocabulary
        pairs = cut(counts.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("_most")).alias("best")))
        same = spark.createDataFrame([(int(a) << SHIFT | int(b),) for a, b in enumerate(identity) if b >= 0], "_same long")     # at most A's vocabulary
        rows = [tuple(r) for r in pairs.join(F.broadcast(same), F.col("pair") == F.col("_same")).select("pair", "n", "best").toLocalIterator()]
        rows += [tuple(r) for r in pairs.orderBy(F.desc("n"), "pair").limit(top).toLocalIterator()]
        rows = sorted(set(rows))
        known = (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], bool), identity)
        resolved = cut(aligned.mapInArrow(_resolve(spark.sparkContext.broadcast(known)), RESOLVED))
    finally:
        drop_folder(spark, folder)
    rest = resolved.select("row", F.explode("rest").alias("x")).select("row", F.col("x.pair").alias("pair"), F.col("x.n").alias("m"))
    joined = rest.join(pairs, "pair")
    more = joined.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("_best"),
        F.sum(F.col("m").cast("decimal(38,0)") * F.col("n")).cast("decimal(38,0)").alias("_sum"))
    out = resolved.join(more, F.col("row") == F.col("_row"), "left")
    out = out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
                     (F.col("count_sum") + F.coalesce("_sum", F.lit(0).cast("decimal(38,0)"))).cast("long").alias("count_sum"), "groups_sha256")
    return out, pairs.select(F.shiftright("pair", SHIFT).alias("a_id"), b_id.alias("b_id"), "n", "best")


def op11_token_align(spark, sf_dir):
    return align_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))[0]
