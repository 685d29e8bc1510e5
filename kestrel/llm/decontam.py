"""Benchmark decontamination by winnowed fingerprints.

A window is ``WINDOW`` consecutive words of a benchmark item. Winnowing keeps, of the
``WINDOW - K + 1`` hashed k-grams inside each window of words, the smallest one as the window's
fingerprint; neighbouring windows mostly share it, so a text sends one row per run of windows
with the same fingerprint. A window that occurs in a document has there the same k-grams, so
the same fingerprint: joining the fingerprints of documents and benchmark loses no shared span.
Each joined fingerprint is then extended: the windows of its run are compared as a whole
(hash of all their words), and a document's hit words are the union of its matching windows.

Items of fewer words are one window each; documents are searched for windows of those lengths
directly (at most ``WINDOW - 1`` lengths, and only those the benchmark has).

The joins are left to Spark: a benchmark that its statistics show to be small is broadcast, any
other is a shuffle join on the fingerprint, whose hot keys adaptive execution splits. Only
DataFrame functions are used. Hashes are 64 bits; a wrong match needs two of them to collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
K = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of lower-cased text, and the same words counted in the text as it is.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever the optimiser inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _word_hashes(text: str) -> Column:
    words = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(WORDS), F.lit(0))
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w))


def _range(n) -> Column:
    """0 .. n - 1, empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _grams(h: Column, k: int) -> Column:
    return F.transform(_range(F.size(h) - k + 1), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))


def _windows(g: Column, window: int, k: int) -> Column:
    """struct<w, f>: the hash of every window's words and its fingerprint, from its k-grams."""
    offsets = sorted({*range(0, window - k, k), window - k})   # k-grams that cover the window
    each = _range(F.size(g) - (window - k))
    return F.struct(
        F.transform(each, lambda i: F.xxhash64(*[F.get(g, i + j) for j in offsets])).alias("w"),
        F.transform(each, lambda i: F.least(*[F.get(g, i + j) for j in range(window - k + 1)])).alias("f"))


def _short(h: Column, m, i) -> Column:
    """Key of the ``m`` words from word ``i`` on (windows of short items)."""
    return F.xxhash64(F.concat(F.array(m.cast("long")), F.slice(h, i + 1, m)))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """fp, win, len, items: every window of the benchmark once, with the sorted ids that have it."""
    def of(h):
        n = F.size(h)
        full = _let(_let(_grams(h, k), lambda g: _windows(g, window, k)), lambda s: F.zip_with(
            s["f"], s["w"], lambda f, w: F.struct(f.alias("fp"), w.alias("win"), F.lit(window).alias("len"))))
        key = _short(h, n, F.lit(0))
        whole = F.array(F.struct(key.alias("fp"), key.alias("win"), n.alias("len")))
        return F.when(n >= window, full).when(n > 0, whole)

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.explode_outer(_let(_word_hashes("text"), of)).alias("_x")).select("item", "_x.*")
    return rows.where("fp is not null").groupBy("fp", "win", "len").agg(F.sort_array(F.collect_set("item")).alias("items"))


def document_runs(docs: DataFrame, key, lengths, window: int = WINDOW, k: int = K) -> DataFrame:
    """key columns, fp, start, wins, len: one row per run of windows with the same fingerprint.

    ``lengths`` is a column: array of the short window lengths to search for.
    """
    def runs(s):
        f, w = s["f"], s["w"]
        heads = F.filter(_range(F.size(f)), lambda i: (i == 0) | (F.get(f, i) != F.get(f, i - 1)))
        return _let(heads, lambda st: F.transform(st, lambda a, j: F.struct(
            F.get(f, a).alias("fp"), a.alias("start"),
            F.slice(w, a + 1, F.coalesce(F.get(st, j + 1), F.size(f)) - a).alias("wins"), F.lit(window).alias("len"))))

    def short(h):
        return F.flatten(F.transform(F.filter(lengths, lambda x: x <= F.size(h)), lambda x: F.transform(
            _range(F.size(h) - x + 1), lambda i: _let(_short(h, x, i), lambda z: F.struct(
                z.alias("fp"), i.alias("start"), F.array(z).alias("wins"), x.alias("len"))))))

    def of(h):
        return F.concat(_let(_let(_grams(h, k), lambda g: _windows(g, window, k)), runs), short(h))

    # explode_outer: an inner explode would have the optimiser test the size of the whole expression first
    return (docs.select(*key, F.explode_outer(_let(_word_hashes("text"), of)).alias("_r")).select(*key, "_r.*")
            .where("fp is not null"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated: one row per document.

    Defined cases: null or empty text has no words and no hits; rows that repeat both id and text
    are one document, an id with several texts is one row per text (``text_key`` tells them
    apart); benchmark rows with null or wordless text match nothing, those with a null id count
    as one item with an empty id; empty tables give no rows or no hits; other columns are ignored.
    """
    key = ["doc_id", "text_key"]
    d = docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))
    wins = benchmark_windows(benchmark, window, k).withColumn("cls", F.xxhash64("items"))
    lens = wins.where(F.col("len") < window).agg(F.collect_set("len").alias("l"))

    runs = document_runs(d.withColumn("_lens", lens.scalar()), key, F.col("_lens"), window, k)
    runs = runs.join(wins.select("fp", "len").distinct(), ["fp", "len"], "left_semi")
    each = runs.select(*key, "fp", "len", "start", F.posexplode("wins").alias("_i", "win"))
    hits = (each.join(wins.select("fp", "len", "win", "cls"), ["fp", "len", "win"], "inner")
            .select(*key, (F.col("start") + F.col("_i")).alias("at"), "len", "cls").distinct())

    # Items per document: the windows of one passage mostly have the same items, so the
    # distinct sets of items are taken before they are opened.
    # The filtered count keeps this branch on the distinct hits, so both branches read one exchange.
    items = (hits.groupBy(*key, "cls").agg(F.count("at").alias("_n")).where("_n > 0")
             .join(wins.select("cls", "items").distinct(), "cls", "inner")
             .select(*key, F.explode("items").alias("item")).distinct())
    words = d.select(*key, F.coalesce(F.regexp_count("text", F.lit(WORDS_ANY_CASE)), F.lit(0)).cast("long").alias("n_words"))
    null = F.lit(None)
    parts = (words.select(*key, "n_words", null.cast("struct<at:int,to:int>").alias("span"), null.cast("string").alias("item"))
             .unionByName(hits.select(*key, null.cast("long").alias("n_words"),
                                      F.struct("at", (F.col("at") + F.col("len")).alias("to")).alias("span"),
                                      null.cast("string").alias("item")))
             .unionByName(items.select(*key, null.cast("long").alias("n_words"),
                                       null.cast("struct<at:int,to:int>").alias("span"), "item")))
    got = parts.groupBy(*key).agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_set("span")).alias("_spans"),
                                  F.sort_array(F.collect_set("item")).alias("_items"))
    covered = F.aggregate("_spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda s, x: F.struct(
        F.greatest(s["end"], x["to"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), x["to"] - F.greatest(s["end"], x["at"]))).alias("n")), lambda s: s["n"])
    return (got.withColumn("n_hit", covered)
            .select(*key, "n_words", "n_hit", F.size("_items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def op2_decontamination(spark, sf_dir):
    from kestrel.llm.common import table

    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.drop("text_key")


OP2_SQL = r"""
WITH dw AS (
  SELECT DISTINCT doc_id, text, COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
d AS (SELECT *, row_number() OVER () AS k FROM dw),
b AS (
  SELECT COALESCE(item_id::VARCHAR, '') AS item, COALESCE(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark),
bl AS (SELECT item, w, LEAST(10, len(w)) AS l FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS g
       FROM (SELECT item, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM bl)),
lens AS (SELECT DISTINCT l FROM bl),
x AS (SELECT k, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d JOIN lens ON len(w) >= l),
h AS (SELECT x.k, x.i, x.l, bw.item FROM x JOIN bw ON bw.l = x.l AND bw.g = array_to_string(x.w[x.i:x.i + x.l - 1], ' ')),
hw AS (SELECT k, COUNT(DISTINCT p) AS n_hit FROM (SELECT DISTINCT k, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT k, i, l FROM h)) GROUP BY k),
hi AS (SELECT k, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM h) GROUP BY k)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, COALESCE(hw.n_hit, 0)::BIGINT AS n_hit, COALESCE(hi.n_items, 0)::BIGINT AS n_items,
       sha256(COALESCE(hi.items, '')) AS items_sha256, COALESCE(hw.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON hw.k = d.k LEFT JOIN hi ON hi.k = d.k
"""
