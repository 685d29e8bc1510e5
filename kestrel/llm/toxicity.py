"""Toxicity scores from a small convolutional text classifier trained with numpy.

Words (runs of letters, digits and non-ASCII characters, A-Z lower-cased) are hashed into
``BUCKETS`` embeddings, each as the sum of those of the word and of its first bytes. Filters of widths 1, 2 and 3 run over the whole text, each filter keeps
its maximum over the text, and a logistic layer reads the maxima. The model is fitted on the driver on
a bounded sample of labelled rows (``MAX_TRAIN`` rows with the smallest hash of their id, sent
as word buckets, not as text, and kept in a temporary file of the driver, which holds one batch
of texts at a time); a model of fixed size is broadcast and every text is scored whole in
Arrow batches. The score sees the text only. A threshold per language is calibrated on rows the
fit has not seen and reported beside it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm import words as W
from kestrel.llm.common import cut, in_batches

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 12          # per width
MAX_TRAIN = 12_000    # labelled rows the fit may use
SENT_IN = 64          # parts the sample's word buckets reach the driver in
PREFIXES = (4, 6)     # bytes
PER_WORD = 1 + len(PREFIXES)
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.02, 1e-4
VALID = 0.2           # share of the sample kept for stopping and calibration

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[:128] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    SEPARATOR[_a:_b] = False


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def text_buckets(data, offsets):
    """Buckets of every word (whole, and its first 4 and 6 bytes) and the first word of each text."""
    starts, ends, first = W.word_spans(data, offsets, SEPARATOR)
    h = [W.word_hashes(data, starts, ends)]
    for n in PREFIXES:  # a prefix never shares a bucket with the same bytes as a word
        h.append(W.mix64(W.word_hashes(data, starts, np.minimum(ends, starts + n)) + np.uint64(n)))
    return np.stack([(x >> np.uint64(64 - BUCKET_BITS)).astype(np.int32) for x in h], axis=1), first


def _bucket_rows(batches):
    for batch in batches:
        out = []
        data, offsets = W.utf8(batch.column("text"))
        for a, b in W.slices(offsets):
            buckets, first = text_buckets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            out += [buckets[first[i]:first[i + 1]].tobytes() for i in range(b - a)]
        keys = [batch.column(c) for c in ("doc_id", "text_key", "label", "lang")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(out, pa.binary())], names=["doc_id", "text_key", "label", "lang", "buckets"])


class Spool(Sequence):
    """Word buckets of texts in a temporary file, read one text at a time."""

    def __init__(self, rows):
        self.file, self.keys, at = tempfile.TemporaryFile(), [], 0
        for r in rows:
            self.file.write(r.buckets)
            self.keys.append((r.doc_id, r.text_key, r.label, r.lang, at, len(r.buckets)))
            at += len(r.buckets)
        self.keys.sort(key=lambda k: k[:2])   # arrival order must not matter

    def __len__(self):
        return len(self.keys)

    def __getitem__(self, i):
        *_, at, size = self.keys[i]
        self.file.seek(at)
        return np.frombuffer(self.file.read(size), np.int32).reshape(-1, PER_WORD)


class Net:
    """Embeddings, filters and the logistic layer; plain arrays, pickled as such."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.emb = r.normal(0, 0.1, (BUCKETS + 1, DIM)).astype(np.float32)
        self.emb[BUCKETS] = 0  # between texts
        self.filters = [r.normal(0, 0.3, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = r.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.out_bias = np.float32(0)
        self.scale, self.shift = 1.0, 0.0  # calibration of the logit

    def params(self):
        return [self.emb, *self.filters, *self.bias, self.out]

    def laid_out(self, buckets, first):
        """Words with two separators before each text and two at the end, and where each text's
        separators begin. A text's windows start there and end in the next text's separators."""
        n = np.diff(first)
        start = first[:-1] + 2 * np.arange(len(n))
        flat = np.full((len(buckets) + 2 * len(n) + 2, PER_WORD), BUCKETS, np.int32)
        flat[np.arange(len(buckets)) + 2 * np.repeat(np.arange(len(n)) + 1, n)] = buckets
        return flat, start, n

    def maxima(self, flat, start, n, where=False):
        """Largest value of every filter per text (and its position); texts without words: bias only."""
        total = len(flat) - 2
        begin = start
        pooled, places = [], []
        word = self.emb[flat[:, 0]]
        for i in range(1, PER_WORD):
            word += self.emb[flat[:, i]]
        for w, f, b in zip(WIDTHS, self.filters, self.bias, strict=True):
            v = word[:total] @ f[:DIM]
            for k in range(1, w):
                v += word[k:k + total] @ f[k * DIM:(k + 1) * DIM]
            m = np.maximum.reduceat(v, begin, axis=0) if total else np.zeros((0, FILTERS), np.float32)
            if where:
                ends = np.append(begin[1:], total)
                places.append(np.stack([s + v[s:e].argmax(0) for s, e in zip(begin, ends, strict=True)]))
            pooled.append(m + b)
        return np.concatenate(pooled, axis=1), places

    def logits(self, flat, start, n):
        pooled, _ = self.maxima(flat, start, n)
        return np.maximum(pooled, 0) @ self.out + self.out_bias

    def score(self, buckets, first):
        z = self.logits(*self.laid_out(buckets, first)) if len(first) > 1 else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -40, 40)))


def _texts(rows, order):
    parts = [rows[i] for i in order]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return (np.concatenate(parts) if parts else np.zeros((0, PER_WORD), np.int32)), first


def _fit_scale(z, y):
    """Platt scaling by Newton steps on two parameters, with a weak pull to the identity."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = np.array([((p - y) * z).sum() + 1e-2 * (a - 1), (p - y).sum() + 1e-2 * b])
        s = p * (1 - p) + 1e-6
        h = np.array([[(s * z * z).sum() + 1e-2, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-2]])
        d = np.linalg.solve(h, g)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-7:
            break
    return max(a, 1e-3), b


def train(rows: Sequence[np.ndarray], labels: np.ndarray, langs: list, seed: int = 11):
    """(net, thresholds by language). ``rows``: word buckets of whole labelled texts."""
    net, y = Net(seed), labels.astype(np.float32)
    r = np.random.default_rng(seed)
    order = r.permutation(len(rows))
    n_valid = int(len(rows) * VALID)
    valid, fit = order[:n_valid], order[n_valid:]
    if len(fit) == 0 or y[fit].min() == y[fit].max():
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        net.out[:] = 0
        net.out_bias = np.float32(np.log(rate / (1 - rate)))
        return net, {}
    rate = float(y[fit].mean())
    net.out_bias = np.float32(np.log(rate / (1 - rate)))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    best, kept, step = np.inf, None, 0

    def valid_logits():
        return np.concatenate([net.logits(*net.laid_out(*_texts(rows, valid[i:i + BATCH]))) for i in range(0, n_valid, BATCH)])

    for _ in range(EPOCHS):
        r.shuffle(fit)
        for s in range(0, len(fit), BATCH):
            pick, step = fit[s:s + BATCH], step + 1
            flat, start, n = net.laid_out(*_texts(rows, pick))
            pooled, places = net.maxima(flat, start, n, where=True)
            act = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ net.out + net.out_bias, -40, 40)))
            dz = ((p - y[pick]) / len(pick)).astype(np.float32)
            net.out_bias -= np.float32(RATE * dz.sum())
            d_act = (dz[:, None] * net.out) * (pooled > 0)
            g_emb, g_f, g_b = np.zeros_like(net.emb), [], []
            for i, w in enumerate(WIDTHS):
                d = d_act[:, i * FILTERS:(i + 1) * FILTERS]          # texts x filters
                at = places[i]
                gf = np.zeros_like(net.filters[i])
                for k in range(w):
                    tok = flat[at + k]                                 # texts x filters x PER_WORD
                    vec = net.emb[tok].sum(2)                          # texts x filters x DIM
                    gf[k * DIM:(k + 1) * DIM] = np.einsum("tf,tfd->df", d, vec)
                    back = (d[:, :, None] * net.filters[i][k * DIM:(k + 1) * DIM].T[None]).reshape(-1, DIM)
                    for j in range(PER_WORD):
                        np.add.at(g_emb, tok[:, :, j].ravel(), back)
                g_f.append(gf)
                g_b.append(d.sum(0))
            g_emb[BUCKETS] = 0
            for prm, g, (m1, m2) in zip(net.params(), [g_emb, *g_f, *g_b, act.T @ dz], moments, strict=True):
                rowwise = prm is net.emb
                rows_on = np.flatnonzero(np.abs(g).sum(1)) if rowwise else slice(None)  # words of this batch only
                gg = g[rows_on] + DECAY * prm[rows_on]
                m1[rows_on] = 0.9 * m1[rows_on] + 0.1 * gg
                m2[rows_on] = 0.999 * m2[rows_on] + 0.001 * gg * gg
                prm[rows_on] -= RATE * (m1[rows_on] / (1 - 0.9 ** step)) / (np.sqrt(m2[rows_on] / (1 - 0.999 ** step)) + 1e-6)
        if n_valid:
            z = valid_logits()
            loss = float(np.mean(np.logaddexp(0, z) - y[valid] * z))
            if loss < best:
                best, kept = loss, [p.copy() for p in net.params()] + [net.out_bias]
    if kept is not None:
        for p, q in zip(net.params(), kept[:-1], strict=True):
            p[:] = q
        net.out_bias = kept[-1]
        z = valid_logits()
        if 0 < y[valid].sum() < len(valid):
            net.scale, net.shift = (float(x) for x in _fit_scale(z.astype(np.float64), y[valid]))
        p = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -40, 40)))
        return net, _thresholds(p, y[valid], [langs[i] for i in valid])
    return net, {}


def _thresholds(p, y, langs):
    """Per language the score from which the F1 measure is best; 0.5 without both classes."""
    out = {}
    for lang in sorted({x for x in langs if x is not None}):
        at = np.array([x == lang for x in langs])
        s, t = p[at], y[at]
        if t.sum() < 3 or t.sum() == len(t):
            out[lang] = 0.5
            continue
        order = np.argsort(-s, kind="stable")
        hit = np.cumsum(t[order])
        f1 = 2 * hit / (np.arange(1, len(t) + 1) + t.sum())
        out[lang] = float(s[order][int(f1.argmax())])
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled rows outside the held-out fold, distinct by id and text: the
    columns of ``docs``, label and text_key (of equal rows the smallest other columns)."""
    l = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
         .where(F.col("label").isNotNull() & F.col("_id").isNotNull() & ~held_out("_id")).distinct())
    # one label per id; an id with contradicting labels is left out of the fit
    l = l.groupBy("_id").agg(F.max("label").alias("label"), F.min("label").alias("_lo")).where("label = _lo").select("_id", "label")
    l = l.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = docs.join(F.broadcast(l), docs["doc_id"] == l["_id"], "inner").withColumn("text_key", F.xxhash64("text"))
    # an id may have many rows: the bound holds for rows
    picked = rows.select("doc_id", "text_key").distinct().orderBy(F.xxhash64("doc_id", "text_key"), "doc_id", "text_key").limit(max_rows)
    picked = picked.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"))
    rows = rows.join(F.broadcast(picked), (F.col("doc_id") == F.col("_d")) & (F.col("text_key") == F.col("_t")))
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = rows.groupBy("doc_id", "text_key", "label").agg(F.first("text").alias("text"), F.min(F.struct(*rest)).alias("_r"))
    return one.select("doc_id", "text", *[F.col("_r")[c].alias(c) for c in rest], "label", "text_key")


def _score_rows(model):
    def run(batches):
        net = Net.__new__(Net)
        net.__dict__.update(model.value)
        for batch in batches:
            data, offsets = W.utf8(batch.column("text"))
            out = [net.score(*text_buckets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])) for a, b in W.slices(offsets)]
            score = np.concatenate(out) if out else np.zeros(0)
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score, pa.float64())], names=[*keep, "score"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted, flagged for every row of ``docs``.

    Defined cases: null, empty or wordless text gets the score of a text without words; null
    languages use 0.5 as threshold for ``flagged``; null labels and ids are not learnt from;
    without labels of both classes every score is the (smoothed) rate of the class; repeated
    rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    base = in_batches(docs).select(F.col("doc_id").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").alias("text"))
    sample = labelled_sample(base, labels, "toxic", max_train).select("doc_id", "text_key", "label", "lang", "text")
    rows = sample.repartition(SENT_IN, "doc_id", "text_key").mapInArrow(_bucket_rows, "doc_id long, text_key long, label int, lang string, buckets binary")
    texts = Spool(cut(rows).toLocalIterator())      # one partition at a time
    net, thresholds = train(texts, np.array([k[2] for k in texts.keys], np.int64), [k[3] for k in texts.keys])
    model = spark.sparkContext.broadcast(vars(net))  # plain arrays of fixed size
    scored = base.mapInArrow(_score_rows(model), "doc_id long, lang string, score double")
    limit = F.lit(0.5)
    for lang, t in thresholds.items():
        limit = F.when(F.col("lang") == lang, F.lit(t)).otherwise(limit)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         (F.col("score") >= limit).alias("flagged"))


def op10_toxicity(spark, sf_dir):
    from kestrel.llm.common import table

    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels"))
