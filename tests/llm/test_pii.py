import hashlib
import random
import re

import odd
from pyspark.sql import functions as F

from kestrel.llm import pii

PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in p.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == 1 and any(int(x) > 255 for x in m[0].split("."))) or (kind == 2 and not (12 <= len(d) <= 19 and luhn(d))) \
                    or (kind == 3 and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


TRICKY = ["a@b.co c@d", "x..y@z.a-b.c,..q_@w.x.y@v.u", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.004 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
          "12 34 56 78 90 12", "+1 (017) 555-7713+49 30 1234567, +1", "é€ü a.b+c@d-e.f😀 10.0.0.1😀", "+12-3 4() 5. 6789012 34 x", "@", "+", "5" * 3000,
          "mail bob (at) example (dot) com or call (017) 555-7713 now", "1:2:3:4:5:6:7:8 server 2001:db8:0:0:0:0:0:1", ""]


def test_base_spans_against_python(spark):
    rnd = random.Random(3)
    texts = TRICKY + ["".join(rnd.choice("0123456789 .-+()@ab é") for _ in range(rnd.randint(1, 120))) for _ in range(300)]
    docs = odd.documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)] + [(9000, None, None, None, None)])
    got = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        assert [(s.start, s.kind, s.end) for s in got[i].base] == base_spans(t), t
        assert set(got[i].base) <= set(got[i].spans)
    assert got[9000].spans == []


def weak_corpus():
    rnd = random.Random(5)
    rows = []
    for i in range(120):
        area, line = rnd.randint(200, 989), rnd.randint(1000, 9999)
        rows.append(f"please call +1 ({area}) 555-{line} today")
        rows.append(f"please call ({area}) 555-{line} today")
        rows.append(f"mail me{i}@example.com or me{i} (at) example.com")
        rows.append(f"order {rnd.randint(10**15, 10**16 - 1)} shipped")
    return rows


def test_the_method_adds_loose_spans(spark):
    texts = weak_corpus()
    got = {r.doc_id: r for r in pii.find_spans(odd.documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()}
    loose = [(i, s) for i, r in got.items() for s in r.spans if s not in r.base]
    assert {texts[i][s.start:s.end][:1] for i, s in loose} >= {"("}
    found = sum(1 for i, t in enumerate(texts) if t.startswith("please call (") and got[i].spans)
    assert found >= 100
    for i, s in loose:       # loose spans never overlap base spans
        assert all(b.end <= s.start or s.end <= b.start for b in got[i].base)


def test_em_ranks_functions(spark):
    voted = pii.votes(pii.candidates(odd.documents(spark, [(i, t, None, None, None) for i, t in enumerate(weak_corpus())])))
    for r in pii.reliabilities(voted).collect():
        assert 0 < r.rates.prior < 1 and all(0 < x < 1 for x in [*r.rates.hit, *r.rates.miss])


def test_mask_and_query_columns(spark):
    t = "é a@b.co, 10.0.0.1 and +1 (017) 555-7713!"
    r = pii.find_spans(odd.documents(spark, [(1, t, None, None, None)]))
    masked = r.select(pii.mask(F.lit(t), F.col("spans")).alias("m"), pii._listed("base").alias("b")).first()
    assert masked.m == "é [EMAIL], [IP] and [PHONE]!"
    names = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base_spans(t))
    assert masked.b == names and hashlib.sha256(names.encode()).hexdigest()
    q = pii.op8_pii(spark, "/root/testdata/sf0.001")
    assert q.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def test_odd_rows_and_empty_table(spark):
    assert pii.find_spans(odd.empty(spark)).collect() == []
    docs = [(r[0], r[1]) for r in odd.document_rows()]
    assert len(pii.find_spans(odd.documents(spark)).collect()) == len(set(docs))


def test_secrets_are_found_and_words_are_not(spark):
    rnd = random.Random(8)
    keys = ["".join(rnd.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    texts = [f'some words token = "{k}" and more' for k in keys[:30]] + [f"API_KEY: {k.upper()}" for k in keys[30:]]
    plain = [f"the{'ing' * 6}and{'er' * 5} of it, item-{i}-of-the-long-named-thing order {10**17 + i}" for i in range(200)]
    got = {r.doc_id: r for r in pii.find_spans(odd.documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts + plain)])).collect()}
    secret = pii.KINDS.index("secret")
    for i, k in enumerate(keys):
        assert [texts[i][s.start:s.end].lower() for s in got[i].spans if s.kind == secret] == [k] and got[i].base == []
    assert not any(s.kind == secret for i in range(len(plain)) for s in got[len(texts) + i].spans)
    t = texts[0]
    masked = spark.createDataFrame([(t,)], "t string").join(pii.find_spans(odd.documents(spark, [(i, x, None, None, None) for i, x in enumerate(texts)])).where("doc_id = 0"))
    assert masked.select(pii.mask(F.col("t"), F.col("spans"))).first()[0] == 'some words token = "[SECRET]" and more'
