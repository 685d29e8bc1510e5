"""Small tables with the cases every operator must stand: nulls, empty and long texts, repeats,
ties, and extra columns whose names clash with the operators' own."""

import random

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "Straße", "été", "x9", "--"]
EXTRA = ("score string, k string, size string, bucket string, _id string, spans string, label string, target string, text_key string, "
         "component_id string, _h string, _k string, c string, ctx string, lines string, digest string, record string, v string, cell string")


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", ",", "."]) for _ in range(n))


def document_rows(seed=1, n=30):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.randint(1, 120)), rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", None]), rnd.choice([None, 10, 500])) for i in range(n)]
    rows += [(100, None, "en", "a", None), (101, "", "en", "b", 0), (102, " \t\n ", None, "a", 3), (None, prose(rnd, 30), "en", "a", 5),
             (103, prose(rnd, 6000), "de", "c", 9), (104, rows[3][1], "en", "a", 1), (105, rows[3][1], "fr", "b", 2), (5, rows[5][1], rows[5][2], rows[5][3], rows[5][4]),
             (106, "one two", "en", "a", 7), (107, "one two", "en", "a", 7), (108, "üñí " * 50, "es", "b", 200)]
    return rows


def documents(spark, rows=None):
    rows = document_rows() if rows is None else rows
    n = len(EXTRA.split(","))
    return spark.createDataFrame([(*r, *["?"] * n) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3)


def empty(spark):
    return documents(spark, [])
