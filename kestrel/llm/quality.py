"""Quality classifier by co-training a text view and a metadata view.

The text view reads shape statistics of the whole text (character classes, word and line lengths,
repeats, sentence ends); the metadata view reads language, source and length columns, never the
text. Each is a logistic model on standardised features. Starting from a bounded sample of
labelled rows (``MAX_TRAIN``, smallest id hashes), in each round every view hands its confident
pseudo-labels, among all rows that the sample does not hold, to the other's training set. Their features
are written once, and the scores' histograms and the sums of the Newton steps are aggregates over them.
Both views are then calibrated on labelled rows that neither has seen, and a logistic model of the two
calibrated logits scores all documents in Arrow batches. Only features of the sample and sums reach the driver.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import words as W
from kestrel.llm.common import cut, in_batches
from kestrel.llm.toxicity import held_out, labelled_sample

MAX_TRAIN = 12_000
ROUNDS, CONFIDENT, SHARE = 4, 0.97, 0.1   # per round a view may hand over this share of the pool
WEIGHT, STEPS = 0.5, 25                   # of a pseudo-label; Newton steps at most, on the sample
ROUND_STEPS = 3                           # Newton steps of a round, each a pass over all rows
VIEWS = ("text", "meta")
BINS = 4_096                              # of a score's histogram
SURE = float(np.log(CONFIDENT / (1 - CONFIDENT)))
VALID = 0.3                               # share of the sample kept for calibration
MAX_REJECTED_CLEAN = 0.005                # share of clean calibration rows the cut may reject
SOURCE_SLOTS, LANG_SLOTS = 32, 8
LEAST_LINE_WORDS = 4

# Byte classes: letters (and all of non-ASCII), upper case, digits, blanks, line breaks, sentence
# marks, other punctuation of prose, symbols.
CLASSES = np.full(256, 7, np.uint8)
CLASSES[128:] = 0
for _c in range(128):
    _ch = chr(_c)
    CLASSES[_c] = (1 if _ch.isupper() else 0 if _ch.isalpha() else 2 if _ch.isdigit() else 4 if _ch in "\n\r" else
                   3 if _ch.isspace() else 5 if _ch in ".!?" else 6 if _ch in ",;:'\"()-" else 7)
N_CLASSES = 8
TEXT_FEATURES = N_CLASSES + 12


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of shape statistics per text; a text without bytes has zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, TEXT_FEATURES))
    size = np.diff(offsets).astype(float)
    if not len(data):
        return out
    safe = np.maximum(size, 1)
    cls = CLASSES[data]
    for c in range(N_CLASSES):
        run = np.concatenate([[0], np.cumsum(cls == c)])
        out[:, c] = (run[offsets[1:]] - run[offsets[:-1]]) / safe
    starts, ends, first = W.word_spans(data, offsets)
    n_words = np.diff(first).astype(float)
    some = np.maximum(n_words, 1)

    def per_text(values):
        run = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
        return (run[first[1:]] - run[first[:-1]]) / some

    length = (ends - starts).astype(float)
    symbol = cls == 7
    run = np.concatenate([[0], np.cumsum(symbol)])
    sym = run[ends] - run[starts]
    mean = per_text(length)
    out[:, 8] = mean
    out[:, 9] = np.sqrt(np.maximum(per_text(length ** 2) - mean ** 2, 0))
    out[:, 10] = per_text(sym > 0)
    out[:, 11] = per_text(sym == length)
    out[:, 12] = per_text(length <= 3)
    out[:, 13] = per_text(length >= 14)
    out[:, 14] = per_text(cls[ends - 1] == 5) if len(ends) else 0
    h = W.word_hashes(data, starts, ends)
    owner = np.repeat(np.arange(n), np.diff(first))
    _, begins = W.distinct_sets(h, owner, n)
    out[:, 15] = np.diff(begins) / some
    # lines
    brk = np.zeros(256, bool)
    brk[[10, 13]] = True
    ls, le, lf = W.word_spans(data, offsets, brk)
    lines = np.maximum(np.diff(lf), 1).astype(float)
    l_owner = np.repeat(np.arange(n), np.diff(lf))
    _, l_begins = W.distinct_sets(W.word_hashes(data, ls, le), l_owner, n)
    out[:, 16] = np.where(np.diff(lf) > 0, np.diff(l_begins) / lines, 0)
    words_in = np.searchsorted(starts, le) - np.searchsorted(starts, ls)
    short = np.concatenate([[0.0], np.cumsum(words_in < LEAST_LINE_WORDS, dtype=float)])
    out[:, 17] = (short[lf[1:]] - short[lf[:-1]]) / lines
    out[:, 18] = n_words / lines / 10
    out[:, 19] = np.log1p(n_words)
    out[size == 0] = 0
    return out


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """One row per document from its columns; null values have a slot of their own."""
    def slots(values, count):
        out = np.zeros((len(values), count + 1))
        table = {}
        for i, v in enumerate(values):
            at = table.get(v)
            if at is None:
                data = np.frombuffer(v.encode(), np.uint8) if v else np.zeros(0, np.uint8)
                ends = np.array([len(data)])
                at = count if v is None else int(W.word_hashes(data, np.array([0]), ends)[0] % np.uint64(count))
                table[v] = at
            out[i, at] = 1
        return out

    size = np.array([-1.0 if v is None else max(float(v), 0.0) for v in n_chars])
    logs = np.log1p(np.maximum(size, 0))
    return np.hstack([slots(lang, LANG_SLOTS), slots(source, SOURCE_SLOTS), logs[:, None], (logs ** 2)[:, None] / 10, (size < 0)[:, None]])


def _features_of(batch):
    data, offsets = W.utf8(batch.column("text"))
    parts = [text_features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in W.slices(offsets)]
    text = np.concatenate(parts) if parts else np.zeros((0, TEXT_FEATURES))
    return text, meta_features(*[batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")])


def _feature_rows(batches):
    for batch in batches:
        text, meta = _features_of(batch)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"),
                                          pa.array([x.tobytes() for x in text], pa.binary()),
                                          pa.array([x.tobytes() for x in meta], pa.binary())], names=["doc_id", "label", "text", "meta"])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Logistic:
    """L2-regularised logistic regression (Newton steps) on standardised features and squares."""

    def __init__(self, squares: bool = False, l2: float = 1.0):
        self.squares, self.l2 = squares, l2

    def lift(self, x):
        z = (x - self.mean) / self.sd
        z = np.hstack([z, z * z - 1]) if self.squares else z
        return np.hstack([np.clip(z, -8, 8), np.ones((len(x), 1))])

    def scale(self, n, total, squared):
        """Standardisation from a count, sums and sums of squares."""
        self.mean = total / n
        self.sd = np.sqrt(np.maximum(squared / n - self.mean ** 2, 0)) + 1e-9
        self.sd[self.sd < 1e-6] = 1.0

    def start(self, rate):
        rate = np.clip(rate, 1e-3, 1 - 1e-3)
        self.beta = np.zeros(self.lift(self.mean[None]).shape[1])
        self.beta[-1] = np.log(rate / (1 - rate))

    def sums(self, x, y, w):
        """Gradient and Hessian of the rows, without the penalty."""
        a = self.lift(x)
        p = _sigmoid(a @ self.beta)
        return a.T @ (w * (p - y)), (a * (w * p * (1 - p) + 1e-9)[:, None]).T @ a

    def step(self, grad, hess) -> bool:
        """One Newton step; whether it was the last."""
        pull = np.full(len(self.beta), self.l2)
        pull[-1] = 1e-6
        step = np.linalg.solve(hess + np.diag(pull), grad + pull * self.beta)
        self.beta = self.beta - np.clip(step, -4, 4)
        return bool(np.abs(step).max() < 1e-6)

    def fit(self, x, y):
        self.scale(*_moments(x))
        self.start(y.mean())
        for _ in range(STEPS):
            if self.step(*self.sums(x, y, np.ones(len(y)))):
                break
        return self

    def logit(self, x):
        return self.lift(x) @ self.beta


def _moments(x):
    return np.array(float(len(x))), x.sum(0), (x * x).sum(0)


def _bins(z):
    return np.clip(((z + 40) * (BINS / 80)).astype(np.int64), 0, BINS - 1)


def _given(x, draw, past):
    """Per view the pseudo-label that the past rounds hand over for each pool row (nan: none). The first one stays."""
    out = {v: np.full(len(draw), np.nan) for v in VIEWS}
    for models, limits in past:
        for view, other in (VIEWS, VIEWS[::-1]):
            z = models[view].logit(x[view])
            b = _bins(z)
            for label, sign in ((1, 1), (0, -1)):
                edge, share = limits[view][label]
                pick = (sign * z >= SURE) & ((sign * (b - edge) > 0) | ((b == edge) & (draw < share)))
                out[other][pick & np.isnan(out[other])] = label
    return out


def _pool_sums(what, past, models):
    """A function of pool rows whose results add up: ``bins`` (scores per view), or ``newton``, the sums
    for a step over the rows handed to each view so far."""
    def run(x, draw):
        if what == "bins":
            return [np.bincount(_bins(models[v].logit(x[v])), minlength=BINS).astype(float) for v in VIEWS]
        out = []
        for v, y in _given(x, draw, past).items():
            at = ~np.isnan(y)
            out += models[v].sums(x[v][at], y[at], np.full(int(at.sum()), WEIGHT))
        return out
    return run


class ArrayPool:
    """Unlabelled rows in memory."""

    def __init__(self, text, meta):
        self.x = dict(zip(VIEWS, (text, meta), strict=True))
        self.draw = W.mix64(np.arange(len(text), dtype=np.uint64)) / 2.0 ** 64
        self.size = len(text)

    def total(self, *asked):
        return _pool_sums(*asked)(self.x, self.draw)


POOL_ROWS = 200_000     # rows of features that one task of a pass reads, if there are so many
PACKS = 64              # rows that reach the driver in a pass, at most


class TablePool:
    """Unlabelled rows as a table of features (text, meta, draw); sums are Spark aggregates.

    A task packs its sums in one row; these are added up by at most ``PACKS`` tasks, whose rows the driver adds."""

    def __init__(self, rows: DataFrame):
        self.size = rows.count()
        tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-self.size // POOL_ROWS))
        self.rows = rows.coalesce(tasks)
        self.packs = max(1, min(PACKS, tasks // 16))

    def total(self, *asked):
        def run(batches):
            add, total = _pool_sums(*asked), None
            for batch in batches:
                if batch.num_rows:
                    x = {v: np.frombuffer(b"".join(batch.column(v).to_pylist())).reshape(batch.num_rows, -1) for v in VIEWS}
                    got = add(x, batch.column("draw").to_numpy(zero_copy_only=False))
                    total = got if total is None else [a + b for a, b in zip(total, got, strict=True)]
            if total is not None:
                yield _packed(total)

        def merge(batches):
            total = None
            for batch in batches:
                for raw, shapes in zip(batch.column("x").to_pylist(), batch.column("shapes").to_pylist(), strict=True):
                    got = _unpacked(raw, shapes)
                    total = got if total is None else [a + b for a, b in zip(total, got, strict=True)]
            if total is not None:
                yield _packed(total)

        schema = "x binary, shapes array<array<int>>"
        packs = self.rows.mapInArrow(run, schema).repartition(self.packs).mapInArrow(merge, schema).collect()
        sums = [_unpacked(bytes(r.x), r.shapes) for r in packs]
        return [sum(parts) for parts in zip(*sums, strict=True)]


def _packed(parts):
    return pa.RecordBatch.from_arrays([pa.array([b"".join(np.asarray(p, float).tobytes() for p in parts)], pa.binary()),
                                       pa.array([[list(np.shape(p)) for p in parts]], pa.list_(pa.list_(pa.int32())))], names=["x", "shapes"])


def _unpacked(raw, shapes):
    flat, out, at = np.frombuffer(raw), [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        out.append(flat[at:at + size].reshape(shape))
        at += size
    return out


def _limits(counts, most: int):
    """Per label the last bin and the share of it that are among the ``most`` surest rows."""
    out = {}
    for label, order in ((1, np.arange(BINS)[::-1]), (0, np.arange(BINS))):
        run = np.cumsum(counts[order])
        i = min(int(np.searchsorted(run, most, side="right")), BINS - 1)
        out[label] = int(order[i]), min(1.0, float((most - (run[i] - counts[order[i]])) / max(counts[order[i]], 1)))
    return out


def co_train(text, meta, y, pool_text, pool_meta=None, seed: int = 5):
    """(text model, metadata model, combiner, cut): see the module's text. ``pool_text`` may be a pool."""
    pool = pool_text if pool_meta is None else ArrayPool(pool_text, pool_meta)
    r = np.random.default_rng(seed)
    order = r.permutation(len(y))
    n_valid = int(len(y) * VALID)
    valid, fit = order[:n_valid], order[n_valid:]
    x = {"text": text[fit], "meta": meta[fit]}
    models = {v: Logistic(squares=v == "text").fit(x[v], y[fit]) for v in VIEWS}
    past = []           # models and limits of every round: they tell each row's pseudo-labels
    for _ in range(ROUNDS if pool.size else 0):
        counts = pool.total("bins", None, models)
        past.append((models, {v: _limits(c, int(SHARE * pool.size)) for v, c in zip(VIEWS, counts, strict=True)}))
        # each round goes on from the last one's coefficients, on the same scale
        models, done = {v: copy.copy(models[v]) for v in VIEWS}, set()
        for _ in range(ROUND_STEPS):
            got = pool.total("newton", past, models)
            for v, (grad, hess) in zip(VIEWS, (got[:2], got[2:]), strict=True):
                if v not in done:
                    own = models[v].sums(x[v], y[fit], np.ones(len(fit)))
                    if models[v].step(own[0] + grad, own[1] + hess):
                        done.add(v)
            if len(done) == len(VIEWS):
                break
    both = lambda t, m: np.stack([models["text"].logit(t), models["meta"].logit(m)], axis=1)
    combiner = Logistic(l2=0.1).fit(both(text[valid], meta[valid]), y[valid].astype(float))
    score = _sigmoid(combiner.logit(both(text[valid], meta[valid])))
    clean = np.sort(score[y[valid] == 1])
    cut = float(clean[int(MAX_REJECTED_CLEAN * len(clean))]) if len(clean) else 0.5
    return models["text"], models["meta"], combiner, min(0.5, cut)


def _score_rows(model):
    def run(batches):
        t, m, c = (Logistic() for _ in range(3))
        for x, state in zip((t, m, c), model.value, strict=True):
            x.__dict__.update(state)
        for batch in batches:
            text, meta = _features_of(batch)
            score = _sigmoid(c.logit(np.stack([t.logit(text), m.logit(meta)], axis=1))) if len(text) else np.zeros(0)
            keep = [x for x in batch.schema.names if not x.startswith("_f_")]
            yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in keep], pa.array(score, pa.float64())], names=[*keep, "score"])
    return run


def score_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars) with ``score`` and ``keep`` for every row.

    ``score`` is the calibrated probability of quality 1; ``keep`` cuts it where at most
    ``MAX_REJECTED_CLEAN`` of the clean calibration rows go, and never above 0.5.

    Defined cases: null or empty text has all-zero statistics; null language, source or length
    have slots of their own; null labels and ids, and ids with contradicting labels, are not
    learnt from as labels (such rows, null ids too, are pseudo-labelled; labelled rows of the held-out
    fold are not); without labels of both classes everything scores 1 and is kept; repeated rows
    are scored each; an empty table gives no rows; other columns are ignored.
    """
    base = in_batches(docs).select("doc_id", F.col("text").alias("text"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    schema = "doc_id long, label int, text binary, meta binary"
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    sample = labelled_sample(base, labels, "quality", max_train).select(*cols, "label")
    got = sorted(sample.mapInArrow(_feature_rows, schema).collect(), key=lambda r: (r.doc_id, bytes(r.text)))
    y = np.array([r.label for r in got], float)
    if not len(y) or y.min() == y.max():
        return base.withColumn("score", F.lit(1.0)).withColumn("keep", F.lit(True))
    spark = docs.sparkSession
    seen = spark.createDataFrame([(i,) for i in sorted({r.doc_id for r in got})], "_id long")
    seen = seen.union(labels.where(F.col("quality").isNotNull() & held_out()).select(F.col("doc_id").alias("_id")).distinct())
    feats = base.select(*cols, F.lit(None).cast("int").alias("label")).mapInArrow(_feature_rows, schema)
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text", "meta"), 11) / F.lit(2.0 ** 53)
    free = cut(feats.join(seen, F.col("doc_id") == F.col("_id"), "left_anti").select("text", "meta", draw.alias("draw")))

    def stack(rows, name, width):
        return np.array([np.frombuffer(bytes(r[name]), float) for r in rows]).reshape(len(rows), width)

    width = stack(got[:1], "meta", -1).shape[1]
    t, m, c, limit = co_train(stack(got, "text", TEXT_FEATURES), stack(got, "meta", width), y,
                              TablePool(free))
    model = spark.sparkContext.broadcast([vars(x) for x in (t, m, c)])  # plain arrays of fixed size
    types = "doc_id long, text string, lang string, source string, n_chars long, score double"
    return base.mapInArrow(_score_rows(model), types).withColumn("keep", F.col("score") >= F.lit(limit))


def op5_quality(spark, sf_dir):
    from kestrel.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    out = score_quality(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.col("keep").cast("int").alias("keep"))
