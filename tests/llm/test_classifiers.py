import collections
import random
import zlib

import numpy as np
import odd

from kestrel.llm import quality, toxicity

ROOTS = ["vequ", "lowei", "chlla"]


def corpus(seed=2, n=900):
    """Junk has symbols glued to its words; toxic texts hold a few words with known beginnings."""
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic, junk = rnd.random() < 0.25, rnd.random() < 0.3
        w = odd.prose(rnd, rnd.randint(15, 90)).split(" ")
        if toxic:
            for _ in range(3):
                w.insert(rnd.randint(0, len(w)), rnd.choice(ROOTS) + rnd.choice("abcdefgh") + rnd.choice("stuv"))
        if junk:
            w = [x + rnd.choice(["###", "$$$", "&&&"]) for x in w]
        text = " ".join(w)
        docs.append((i, text, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2"]), len(text)))
        labels.append((i, int(not junk) if rnd.random() > 0.01 else int(junk), int(toxic)))
    return docs, labels


def labels_frame(spark, rows):
    return spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, quality int, toxic int, text string")


def test_toxicity_on_rows_it_has_not_seen(spark):
    docs, labels = corpus()
    extra = [(5000, None, "en", None, None), (5001, "", None, "s1", 0), (5002, "...", "en", "s1", 3), (None, "alpha", "en", "s1", 5), (5003, "alpha beta " * 9000, "xx", "s1", 1)]
    frame, marks = odd.documents(spark, docs + extra + docs[:1]), labels_frame(spark, labels + [(None, 1, 1), (5000, None, None)])
    got = toxicity.score_documents(frame, marks).collect()
    assert len(got) == len(docs) + len(extra) + 1 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    empty = {r.score for r in got if r.doc_id in (5000, 5001, 5002)}
    assert len(empty) == 1
    # other batches add the same numbers in another order
    again = {r.doc_id: r.score for r in toxicity.score_documents(frame.repartition(5), marks).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-4 for r in got)


def test_quality_keeps_clean_and_drops_junk(spark):
    docs, labels = corpus(3)
    frame, marks = odd.documents(spark, docs + [(5000, None, None, None, None)]), labels_frame(spark, labels[:600])
    got = {r.doc_id: r for r in quality.score_quality(frame, marks).collect()}
    clean = [i for i, t, *_ in docs if not t.split(" ")[0].endswith(("#", "$", "&"))]
    junk = [i for i, t, *_ in docs if i not in set(clean)]
    assert np.mean([got[i].keep for i in clean]) > 0.98 and np.mean([got[i].keep for i in junk]) < 0.05
    assert 0 <= got[5000].score <= 1


def test_views_exchange_pseudo_labels():
    """A view whose own labels are few learns from the other's confident ones."""
    r = np.random.default_rng(1)
    y = r.integers(0, 2, 400).astype(float)
    text = y[:, None] * 3 + r.normal(size=(400, 2))
    meta = y[:, None] * 1.5 + r.normal(size=(400, 2))
    pool = r.integers(0, 2, 2000).astype(float)
    pt, pm = pool[:, None] * 3 + r.normal(size=(2000, 2)), pool[:, None] * 1.5 + r.normal(size=(2000, 2))
    t, m, c, limit = quality.co_train(text, meta, y, pt, pm)
    score = quality._sigmoid(c.logit(np.stack([t.logit(pt), m.logit(pm)], axis=1)))
    assert ((score >= 0.5) == pool).mean() > 0.97 and 0 < limit <= 0.5


def test_pseudo_labels_come_from_all_rows_outside_the_sample(spark, monkeypatch):
    docs, labels = corpus(4, 300)
    pools, co_train = [], quality.co_train

    def watched(text, meta, y, *pool):
        pools.append(pool[0])
        return co_train(text, meta, y, *pool)

    monkeypatch.setattr(quality, "co_train", watched)
    frame = odd.documents(spark, docs + docs[:1] + [(None, "alpha beta", "en", "s1", 10)] * 2)
    held = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    n = 303 - len(held) - (docs[0][0] in held)
    got = quality.score_quality(frame, labels_frame(spark, labels), max_train=100).collect()     # every id is labelled
    assert len(got) == 303 and pools[0].size in (n - 100, n - 101)
    sums = quality.ArrayPool(*(np.array([np.frombuffer(bytes(r[v])) for r in pools[0].rows.collect()]) for v in quality.VIEWS))
    sums.draw = np.array([r.draw for r in pools[0].rows.collect()])
    models = {v: quality.Logistic(squares=v == "text").fit(sums.x[v], sums.x[v][:, 0] > np.median(sums.x[v][:, 0])) for v in quality.VIEWS}
    counts = sums.total("bins", None, models)
    past = [(models, {v: quality._limits(c, 40) for v, c in zip(quality.VIEWS, counts)})]
    for what in ("bins", "moments", "newton"):
        for a, b in zip(sums.total(what, past, models), pools[0].total(what, past, models), strict=True):
            assert np.allclose(a, b) and np.shape(a) == np.shape(b)


def test_the_sample_bounds_rows_not_ids(spark):
    docs, labels = corpus(6, 60)
    i = next(d[0] for d in docs if zlib.crc32(str(d[0]).encode()) % 5)
    many = [(i, f"text {j}", "en", "s1", 6) for j in range(200)]
    frame = odd.documents(spark, docs + many + many + docs).select("doc_id", "lang", "text")
    for most in (50, 1000):
        got = toxicity.labelled_sample(frame, labels_frame(spark, labels), "toxic", most).collect()
        assert len(got) == len({(r.doc_id, r.text) for r in got}) == min(most, 200 + sum(zlib.crc32(str(d[0]).encode()) % 5 != 0 for d in docs))
        assert all(r.label == dict((d, t) for d, _, t in labels)[r.doc_id] for r in got)


def test_word_buckets_wait_in_a_file():
    rnd = np.random.default_rng(1)
    parts = [rnd.integers(0, 99, (n, toxicity.PER_WORD)).astype(np.int32) for n in (3, 0, 7)]
    Row = collections.namedtuple("Row", "doc_id text_key label lang buckets")
    spool = toxicity.Spool(Row(9 - i, 0, i % 2, None, p.tobytes()) for i, p in enumerate(parts))
    assert len(spool) == 3 and [k[0] for k in spool.keys] == [7, 8, 9]
    assert all((a == b).all() and a.shape == b.shape for a, b in zip(spool, parts[::-1], strict=True))


def test_without_labels_and_empty_tables(spark):
    none = labels_frame(spark, [])
    assert toxicity.score_documents(odd.empty(spark), none).collect() == []
    assert quality.score_quality(odd.empty(spark), none).collect() == []
    assert {r.keep for r in quality.score_quality(odd.documents(spark), none).collect()} == {True}
    assert len({r.score for r in toxicity.score_documents(odd.documents(spark), none).collect()}) == 1
    one = labels_frame(spark, [(i, 1, 0) for i in range(30)])
    assert all(r.score < 0.2 for r in toxicity.score_documents(odd.documents(spark), one).collect())
