import hashlib
import random
import re
from collections import Counter

import odd
import pytest

from conftest import plan_string

from kestrel.llm import suffix_dedup


def brute(docs, n):
    raw = [(t or "").encode() for _, t in docs]
    times = Counter(x[p:p + n] for x in raw for p in range(len(x) - n + 1))
    out = []
    for (d, _), x in zip(docs, raw):
        gone = [False] * len(x)
        for p in range(len(x) - n + 1):
            if times[x[p:p + n]] > 1:
                gone[p:p + n] = [True] * n
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        keep = bytes(b for b, g in zip(x, gone) if not g)
        out.append((d, len(x), sum(gone), runs, hashlib.sha256(keep).hexdigest()))
    return sorted(out, key=str)


def rows(seed):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abcdé ") for _ in range(k)) for k in (255, 300, 399, 400, 401, 700)]
    docs = [(r[0], r[1]) for r in odd.document_rows(seed)]
    for i in range(30):
        pick = rnd.sample(passages, 2)
        docs.append((500 + i, odd.prose(rnd, rnd.randint(0, 60)) + pick[0] + odd.prose(rnd, 20) + pick[1][:rnd.randint(250, 700)]))
    docs += [(600, "z" * 1500), (601, "ab" * 600), (602, "q" * 399), (603, "line of text again\n" * 40), (604, "line of text again\n" * 30)]
    return docs


@pytest.mark.parametrize("length, hot", [(400, 64), (400, 0), (300, 2)])
def test_against_brute_force(spark, monkeypatch, length, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = rows(length + hot)
    df = odd.documents(spark, [(d, t, None, None, None) for d, t in docs])
    got = suffix_dedup.remove_repeats(df, length).drop("kept", "text").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, length)


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    rnd = random.Random(9)
    x = "".join(rnd.choice("abcdef") for _ in range(9000))
    docs = [(1, x), (2, "tail" + x[2500:8200]), (3, x[100:1300] + "!" + x[100:1300])]
    got = suffix_dedup.remove_repeats(odd.documents(spark, [(*d, None, None, None) for d in docs])).drop("kept", "text").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, 400)


def test_many_equal_rows_of_one_id_and_the_kept_text(spark):
    text = "é" + "passage of words " * 40
    docs = [(7, text)] * 1000 + [(8, "own words before it. " + text + " and after"), (9, "short"), (None, None)]
    got = suffix_dedup.remove_repeats(odd.documents(spark, [(*d, None, None, None) for d in docs])).collect()
    assert len(got) == 1003 and all(r.n_removed == len(text.encode()) and r.n_spans == 1 and r.text == "" for r in got if r.doc_id == 7)
    rest = {r.doc_id: r.text for r in got}
    assert rest[8] == "own words before it.  and after" and rest[9] == "short" and rest[None] == ""


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(odd.empty(spark)).collect() == []


def brute_words(docs, n):
    texts = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for _, t in docs]
    held = Counter(w for x in texts for w in {tuple(x[p:p + n]) for p in range(len(x) - n + 1)})
    out = []
    for (d, _), x in zip(docs, texts):
        hit = [False] * len(x)
        for p in range(len(x) - n + 1):
            if held[tuple(x[p:p + n])] > 1:
                hit[p:p + n] = [True] * n
        out.append((d, sum(hit)))
    return sorted(out, key=str)


def word_rows(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5)))
    own = lambda n: " ".join(word() for _ in range(n))
    passages = [[word() for _ in range(k)] for k in (50, 51, 52, 60, 94, 95, 130)]
    docs = [(r[0], r[1]) for r in odd.document_rows(seed)]
    for i in range(40):
        a, b = rnd.sample(passages, 2)
        docs.append((500 + i, own(rnd.randint(0, 60)) + " " + rnd.choice([" ", "\n", " \t"]).join(a) + " " + own(5) + "\n" + " ".join(b[:rnd.randint(40, 130)])))
    twice = own(70)
    docs += [(600, twice + " " + own(3) + " " + twice), (601, own(51)), (602, "z " * 300), (603, "z " * 80), (604, "y " * 300), (605, own(50))]
    twice = own(60)
    docs += [(606, f"{twice} {own(2)} {twice}"), (607, own(9) + " " + twice.upper().replace("É", "é")), (608, own(20)), (608, own(55))]
    return docs + [docs[-1], docs[-1], (609, None), (610, "")]


@pytest.mark.parametrize("words, hot, size", [(51, 64, 1 << 21), (51, 0, 1 << 10), (33, 2, 1 << 12)])
def test_passages_of_words_against_brute_force(spark, monkeypatch, words, hot, size):
    """Repeats across documents, however few bytes they have; a document's own repeats are none. The other columns stay."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", size)
    docs = word_rows(words + hot)
    df = odd.documents(spark, [(d, t, None, None, None) for d, t in docs])
    got = suffix_dedup.remove_repeats(df, words=words).drop("kept", "text").collect()
    assert sorted(((r.doc_id, r.n_repeated_words) for r in got), key=str) == brute_words(docs, words)
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(docs, 400)


def test_query_catches_short_passages_of_over_50_words(spark, tmp_path):
    """Three documents with a passage of 51 words and 330 bytes: found by its words, kept by the contract's 400 bytes."""
    rnd = random.Random(3)
    own = lambda n: " ".join("".join(rnd.choice("abcdef") for _ in range(5 + (i % 2))) for i in range(n))
    passage = own(51)
    docs = [(i, f"{own(30)} {passage} {own(30)}") for i in range(3)] + [(9, own(120))]
    assert len(passage) < 400
    odd.documents(spark, [(*d, None, None, None) for d in docs]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in suffix_dedup.op6_suffix_dedup(spark, str(tmp_path)).collect()}
    assert [got[i].n_repeated_words for i in (0, 1, 2, 9)] == [51, 51, 51, 0]
    assert all(r.n_removed == 0 and r.text == dict(docs)[i] for i, r in got.items())


def test_a_shared_bucket_without_a_repeat(spark):
    """Two texts share 300 bytes and no window of 400: nothing goes, and the task without a hit does not fail."""
    rnd = random.Random(5)
    own = lambda n: "".join(rnd.choice("abcdef") for _ in range(n))
    part = own(300)
    docs = [(i, own(500) + part + own(500)) for i in range(2)]
    got = suffix_dedup.remove_repeats(odd.documents(spark, [(*d, None, None, None) for d in docs])).collect()
    assert sorted((r.doc_id, r.n_removed, r.text) for r in got) == [(i, 0, t) for i, t in docs]


def test_the_texts_are_shuffled_once(spark, tmp_path):
    """Both joins with the texts ask for the same exchange, so that Spark runs it once."""
    odd.documents(spark, [(i, f"text {i}", None, None, None) for i in range(5)]).write.parquet(str(tmp_path / "d.parquet"))
    plan = plan_string(suffix_dedup.remove_repeats(spark.read.parquet(str(tmp_path / "d.parquet")), words=51))
    inputs = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan) if re.search(r"\btext#", x)]
    assert len(inputs) > 1 and set(inputs) == {"k, doc_id, text"}
