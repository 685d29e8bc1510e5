import zlib

import numpy as np
import pyarrow as pa

from kestrel.llm import language
from tests.llm import odd


def vector_of(text, dim):
    """A text's vector, trigram by trigram."""
    low = "".join((c.lower()[0] if c.isalpha() else " ") for c in f" {text} ")
    low = " ".join(low.split())
    low = f" {low} "

    def letter(c):
        return np.random.default_rng([language.SEED, 0 if c == " " else ord(c)]).integers(0, 2, dim) * 2 - 1
    out = np.zeros(dim, np.int64)
    for i in range(1, len(low) - 1):
        if low[i] != " ":
            out += np.roll(letter(low[i - 1]), 2) * np.roll(letter(low[i]), 1) * letter(low[i + 1])
    return out, sum(c != " " for c in low)


def cosine(a, b):
    return float(a @ b / np.sqrt(float(a @ a) * float(b @ b)))


TEXTS = ["The cat sat.", "", None, "a", "...", "Été à l'ÖL 12 ß", "日本語 テキスト", "x" * 50, " lead and trail ", "line\nbreak\ttab", "Ünïcode, naïve!! words " * 9]


def test_vectors_against_brute_force():
    letters = language.Letters(64)
    for size in (1 << 21, 40):
        got, count = language.text_vectors(pa.array(TEXTS), letters, size)
        for i, t in enumerate(TEXTS):
            want, n = vector_of(t or "", 64)
            assert count[i] == n and (got[i] == want).all(), (size, t)


def test_many_codes_take_the_sorted_way(monkeypatch):
    texts = [" ".join(chr(0x4E00 + i * 7 + j) + chr(0x3041 + j) for j in range(40)) for i in range(20)]
    monkeypatch.setattr(language, "COLUMNS", 100)
    got, _ = language.text_vectors(pa.array(texts), language.Letters(32))
    assert all((got[i] == vector_of(t, 32)[0]).all() for i, t in enumerate(texts))


def test_long_text_in_pieces_is_whole():
    text = " ".join(odd.WORDS * 400)
    one, n = language.text_vectors(pa.array([text, "next"]), language.Letters(32), 1 << 22)
    many, m = language.text_vectors(pa.array([text, "next"]), language.Letters(32), 100)
    assert (one == many).all() and (n == m).all()


def run(spark, tmp_path, docs):
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in language.op13_language(spark, str(tmp_path)).collect()]


def test_query_against_brute_force(spark, tmp_path):
    rows = [r for r in odd.document_rows(n=40) if r[0] is not None or True]
    got = run(spark, tmp_path, odd.documents(spark, rows))
    crc = {r[0]: None if r[0] is None else zlib.crc32(str(r[0]).encode()) % 3 for r in rows}
    sums = {}
    for i, text, lang, *_ in rows:
        v, n = vector_of(text or "", language.DIM)
        if lang is not None and crc[i] is not None and crc[i] != 1 and n:
            sums[lang] = sums.get(lang, 0) + v / n
    want = []
    for i, text, *_ in rows:
        v, n = vector_of(text or "", language.DIM)
        near = sorted(((-round(cosine(v, p), 9), lang) for lang, p in sums.items())) if n else [(0, "und")]
        want.append((i, crc[i] == 1, near[0][1], max(0.0, -near[0][0])))
    def order(r):
        return (r[0] is not None, r[0] or 0, r[2], r[3])

    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6


def test_blocks_of_languages_change_nothing(spark):
    rows = [(f"l{i}", t) for i, t in enumerate(["der die das und", "the of and to", "le la les des", "el los las que", "il gli che di"])]
    profiles = language.language_profiles(spark.createDataFrame(rows, "lang string, text string"))
    docs = spark.createDataFrame([(i, False, t) for i, (_, t) in enumerate(rows)] + [(9, True, None), (10, True, "7 !")], "doc_id long, held_out boolean, text string")
    whole = sorted(map(tuple, language.identify(docs, profiles).collect()))
    assert whole == sorted(map(tuple, language.identify(docs, profiles, block=2).collect()))
    assert [r[2] for r in whole] == ["l0", "l1", "l2", "l3", "l4", "und", "und"]


def test_empty_and_nothing_to_learn(spark, tmp_path):
    assert run(spark, tmp_path, odd.empty(spark)) == []
    rows = [(i, "Some words here", None, "a", 1) for i in range(5)]
    assert all(r[2:] == ("und", 0.0) for r in run(spark, tmp_path, odd.documents(spark, rows)))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = language.op13_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
