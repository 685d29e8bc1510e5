import hashlib
import random
import re

import duckdb
import odd

from kestrel.llm import decontam

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans(decontam.UPPER, decontam.LOWER)


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items):
    wins = {}
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = set()
    for d, t in docs:
        w, hit, got = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i:i + n])) in wins:
                    hit |= set(range(i, i + n))
                    got |= wins[x]
        out.add((d, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit)))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(4)
    docs = [(r[0], r[1]) for r in odd.document_rows()]
    items = [(1, None), (2, ""), (3, "..."), (4, "Alpha"), (5, "beta GAMMA delta"), (None, odd.prose(rnd, 12)), (7, odd.prose(rnd, 40)), (8, "one two"), (8, "x9")]
    for i in range(12):      # passages of documents, shared by several items
        w = docs[i][1].split()
        items.append((20 + i, " ".join(w[3:3 + rnd.choice([9, 10, 11, 30])])))
        items.append((40 + i, " ".join(w[3:20])))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(odd.documents(spark), b).drop("text_key").collect()
    assert {tuple(r) for r in got} == brute(docs, items) and len(got) == len(set(docs))


def test_query_matches_sql(spark):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = decontam.op2_decontamination(spark, SMALL)
    want = duck.execute(decontam.OP2_SQL)
    order = [got.columns.index(c[0]) for c in want.description]
    assert {tuple(r[i] for i in order) for r in got.collect()} == set(want.fetchall())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(odd.empty(spark), none).collect() == []
    got = decontam.decontaminate(odd.documents(spark, [(1, "a b c", None, None, None)]), none).collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got] == [(3, 0, 0, False)]
