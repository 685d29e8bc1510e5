import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kestrel.llm import token_align as T
from tests.llm import odd


@pytest.fixture(scope="module")
def aligner():
    return T.Aligner(*T.read_files(None))


def whole(aligner, text):
    """Tokens of a whole text, encoded at once; None where they do not join to the space and the text."""
    if not text:
        return None
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    raw = b" " + text.encode()
    if b"".join(aligner.a_bytes[i] for i in a) != raw or b"".join(aligner.b_bytes[i] for i in b) != raw:
        return None
    return a, b


def links_of(aligner, a, b):
    """(groups, links) byte by byte."""
    ta = [k for k, i in enumerate(a) for _ in aligner.a_bytes[i]]
    tb = [k for k, i in enumerate(b) for _ in aligner.b_bytes[i]]
    links = sorted(set(zip(ta, tb, strict=True)))
    groups, left, right = [], [], []
    for at in range(len(ta)):
        left += [a[ta[at]]] if at == 0 or ta[at] != ta[at - 1] else []
        right += [b[tb[at]]] if at == 0 or tb[at] != tb[at - 1] else []
        if at + 1 == len(ta) or ta[at] != ta[at + 1] and tb[at] != tb[at + 1]:
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            left, right = [], []
    return groups, [(a[x], b[y]) for x, y in links]


def brute(aligner, texts):
    count, seen = Counter(), []
    for t in texts:
        got = whole(aligner, t)
        seen.append((got, *links_of(aligner, *got)) if got else None)
        if got:
            count.update(seen[-1][2])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for s in seen:
        if s is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        (a, b), groups, links = s
        out.append((len(a), len(b), len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out, count, top


HARD = ["Hello world", " two  spaces and\ttab", "line\n\nbreak \n x", "<|endoftext|> is text", "</s> <s> <unk>", "naïve café ÉTÉ", "日本語 テキスト 🙂🙂", "a literal ▁ sign",
        "x\x00y \x01", "trailing ", " ", "  ", "\n", "don't can't we'll 's", "1234567890 12 34,567.89", "ab" * 300, " nbsp　wide", "é combining", "zero​width ​ x", "﻿bom",
        "-- ** ## $$$ 50% a-b_c", "a \x85 b   c", "tab\t\t end", "؀arabic ١٢ ً", "ﬁ ligature Ⅷ ½", "\U0010ffff x", "a\x1cb \x1f c", "� ퟿"]


def test_segments_encode_like_whole_texts(aligner):
    rnd = random.Random(5)
    alphabet = [*"abAB  \t\n\x0b.,'-1é 　▁​一\x00\x1c\x85", "ing ", " the", "'s ", "́", "🙂"]
    texts = [*HARD, *["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(600)]]
    for t, got in zip(texts, aligner.texts(texts), strict=True):
        want = whole(aligner, t)
        assert (got is None) == (want is None), repr(t)
        if want:
            groups, links = links_of(aligner, *want)
            assert got[:5] == (*map(len, want), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()), repr(t)
            same = Counter({(a, int(aligner.identity[a])): n for a, n in zip(*map(np.ndarray.tolist, got[5]), strict=True)})
            same.update({(x >> T.SHIFT, x & ((1 << T.SHIFT) - 1)): n for x, n in zip(*map(np.ndarray.tolist, got[6]), strict=True)})
            assert same == Counter(links), repr(t)


def test_encoding_by_rank_equals_the_tokenizer(aligner):
    """On segments of the given texts, random strings, joined vocabulary entries (the hard case for the order
    of merges) and many code points."""
    import pyarrow.parquet as pq

    rnd = random.Random(3)
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist() if t]
    segments = [*{s for t in texts for s in aligner.segments(t)}]
    words = [t.decode() for t in aligner.a_bytes if t.isascii() and t]
    segments += ["".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))).strip() for _ in range(20_000)]
    segments += [f"a{chr(c)}b {chr(c)} 1{chr(c)}.{chr(c)}  {chr(c)}{chr(c)}" for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    assert aligner.fast is not None
    want = [e.ids for e in aligner.a.encode_batch([" " + s for s in segments], add_special_tokens=False)]
    assert aligner.encode_a(segments) == want


def test_long_texts_and_a_full_store(aligner, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 50)
    monkeypatch.setattr(T, "CACHE", 5)
    rnd = random.Random(6)
    texts = [odd.prose(rnd, 400), "x" * 5000, odd.prose(rnd, 3)]
    for t, got in zip(texts, aligner.texts(texts), strict=True):
        groups, _ = links_of(aligner, *whole(aligner, t))
        assert got[4] == hashlib.sha256(";".join(groups).encode()).hexdigest()


@pytest.mark.parametrize("top", [T.TOP_PAIRS, 3])
def test_query_against_brute_force(spark, tmp_path, aligner, monkeypatch, top):
    rows = odd.document_rows(n=25) + [(1000 + i, t, "en", "a", 1) for i, t in enumerate(HARD)]
    odd.documents(spark, rows).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(T, "TOP_PAIRS", top)
    out, pairs = T.align_corpus(spark.read.parquet(f"{tmp_path}/documents.parquet"), top=top)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, count, highest = brute(aligner, [r[1] for r in rows])

    def order(r):
        return (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(map(tuple, out.collect()), key=order) == sorted([(r[0], *w) for r, w in zip(rows, want, strict=True)], key=order)
    assert {(r["a_id"], r["b_id"]): r["n"] for r in pairs.collect()} == count
    assert all(r["best"] == (r["n"] == highest[r["b_id"]]) for r in pairs.collect())


def test_empty_and_only_nulls(spark, tmp_path):
    odd.empty(spark).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert T.op11_token_align(spark, str(tmp_path)).collect() == []
    odd.documents(spark, [(1, None, "en", "a", 1), (None, "", None, None, None)]).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r[0] or 0, *r[1:]) for r in T.op11_token_align(spark, str(tmp_path)).collect()) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
