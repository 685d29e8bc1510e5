import re

import odd
import test_decontam
import test_ngram_join
import test_pii

import corpus_pipeline as pipeline

SMALL = "/root/testdata/sf0.001"
COLUMNS = pipeline.COLUMNS


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, seen[-1], SMALL).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
        if i < len(pipeline.STAGES) - 1:
            assert seen[-1].columns == COLUMNS
    start, good, single, clean, private, mix = (texts(x) for x in seen)
    assert set(good) <= set(start) and len(good) > 0.8 * len(start)
    comp = {d: c for d, _, c in test_ngram_join.brute(good)}
    assert single == [x for x in good if comp[x[0]] == x[0]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    dirty = {x[0] for x in test_decontam.brute(single, items) if x[-1]}
    assert clean == [x for x in single if x[0] not in dirty]
    for (d, t), (e, new) in zip(clean, private):
        spans = test_pii.base_spans(t) or re.search(r"[0-9A-Fa-f]{32,}", t)
        assert d == e and (new == t or spans) and (not spans or new != t)
        assert not any(k in (0, 3) for _, k, _ in test_pii.base_spans(new))
    lengths = {r.doc_id: r.n_chars for r in seen[4].collect()}
    assert all(lengths[d] == len(t) for d, t in private)
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in private}
    taken = {}
    for r in seen[5].collect():
        assert r.text == dict(private)[r.doc_id] or len(r.text.split()) == r.n_words
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.n_words
    assert all(n <= 2 * size[d] for d, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= len({r.source for r in seen[0].collect()})


def test_near_duplicate_stage_keeps_one_of_equal_rows(spark):
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (3, "", None, None, None), (None, "x", None, None, None)]
    got = texts(pipeline.near_duplicate_stage(spark, odd.documents(spark, rows), SMALL))
    assert got == sorted([(1, "a b c d e f"), (3, ""), (None, "x")], key=str)


def test_mixing_stage_draws_each_piece_once_for_repeated_rows(spark):
    rows = [(None, "one two three four", "en", "a", 18)] * 3 + [(None, "one two three four", "de", "b", 18), (5, "five six seven", "en", "a", 14),
            (5, "five six seven", "en", "a", 14), (6, "eight nine ten", None, "b", 14), (7, "x", "en", None, 1), (8, None, "en", "a", None)]
    got = pipeline.mixing_stage(spark, odd.documents(spark, rows), SMALL).collect()
    size = {}
    for _, t, lang, source, _ in rows:
        size[source] = size.get(source, 0) + len((t or "").split())
    drawn = {}
    for r in got:
        assert len(r.text.split()) == r.n_words and (r.doc_id, r.lang, r.source) in {(i, x, s) for i, _, x, s, _ in rows}
        drawn[r.source] = drawn.get(r.source, 0) + r.n_words
    target = {r.source: r.source_target for r in got}
    assert all(abs(drawn[s] - target[s]) <= 1 and drawn[s] <= 2 * size[s] for s in drawn) and len(drawn) == 3


def test_run_registers_and_works(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run and len([q for q in entry.queries() if re.match(r"op\d+_", q)]) == 13
    assert pipeline.run(spark, SMALL).count() > 0


def _tables(spark, folder, rows):
    odd.documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    marks = [(r[0], i % 2, 0) for i, r in enumerate(rows) if r[0] is not None and i % 3]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_odd_rows_and_clashing_columns_run_through(spark, tmp_path):
    rows = odd.document_rows()
    got = pipeline.run(spark, _tables(spark, tmp_path, rows))
    known = {(r[0], w) for r in rows for w in (r[1] or "").split()}
    out = got.collect()
    assert out and all(r.n_words > 0 for r in out)
    for r in out:
        assert all((r.doc_id, w) in known or w.startswith("[") for w in r.text.split())


def test_empty_tables_run_through(spark, tmp_path):
    assert pipeline.run(spark, _tables(spark, tmp_path, [])).collect() == []
