"""Text operators: micro fixtures (FIXTURES.md §3.1-3.2) and properties against literal
re-statements of the reference's Java text semantics."""

import random
import re

from pyspark.sql import functions as F

from kestrel.functions.text import java_ws_words, line_bigrams, split_lines
from kestrel.operators import text


# ---- literal restatements (tests only) -------------------------------------------------

def bigrams_by_sentence(line: str) -> list[str]:
    """The rule in words: cut the tokens into sentences after each one that ends in . ! or ?;
    inside a sentence clean the tokens, drop those that become empty, and pair neighbours."""
    tokens = [t for t in re.split(r"[ \t\n\r\f]+", line.lower()) if t]
    ends = [i + 1 for i, t in enumerate(tokens) if t.endswith((".", "!", "?"))]
    sentences = [tokens[a:b] for a, b in zip([0, *ends], [*ends, len(tokens)])]
    cleaned = [[c for c in (re.sub("[^a-z0-9]", "", t) for t in s) if c] for s in sentences]
    return [f"{a} {b}" for s in cleaned for a, b in zip(s, s[1:])]


def java_split_ws(s: str) -> list[str]:
    """``s.split("\\\\s+")``: leading empty kept, trailing empties dropped."""
    if s == "":
        return [""]
    parts = re.split(r"[ \t\n\x0b\f\r]+", s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def reader_lines(s: str) -> list[str]:
    parts = re.split(r"\r\n|\r|\n", s)
    if parts[-1] == "":
        parts.pop()
    return parts


def _per_row(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")
    rows = df.select("id", expr(F.col("s")).alias("out")).collect()
    return {r.id: list(r.out) for r in rows}


# ---- micro fixtures --------------------------------------------------------------------

BIGRAM_CASES = [
    ('The end. New start! x - y "quoted." next', ["the end", "new start", "x y", "y quoted", "quoted next"]),
    ("... a b", ["a b"]),
    ("a ... b", []),
    (" - a b", ["a b"]),
    ("e.. f g.h i", ["f gh", "gh i"]),
    ("Café ê bar", ["caf bar"]),
    ("a?", []),
    ("", []),
]


def test_bigram_micro(spark):
    got = _per_row(spark, [c[0] for c in BIGRAM_CASES], line_bigrams)
    for i, (_, expected) in enumerate(BIGRAM_CASES):
        assert got[i] == expected, BIGRAM_CASES[i]


WORD_CASES = [("", [""]), ("   ", []), (" a b", ["", "a", "b"]), ("a b  ", ["a", "b"]), ("a\x0bb", ["a", "b"])]


def test_word_split_micro(spark):
    got = _per_row(spark, [c[0] for c in WORD_CASES], java_ws_words)
    for i, (_, expected) in enumerate(WORD_CASES):
        assert got[i] == expected, WORD_CASES[i]


# ---- properties ------------------------------------------------------------------------

ALPHABET = list("abZ19") + [".", "!", "?", " ", "  ", "\t", "\f", "\x0b", "-", '"', "é", "İ", "x.y", "..."]


def _random_lines(seed: int, n: int, alphabet=ALPHABET, max_len=14):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, max_len))) for _ in range(n)]


def test_bigrams_equal_state_machine(spark):
    lines = _random_lines(7, 3000)
    got = _per_row(spark, lines, line_bigrams)
    for i, line in enumerate(lines):
        assert got[i] == bigrams_by_sentence(line), repr(line)


def test_words_equal_java_split(spark):
    lines = _random_lines(11, 2000)
    got = _per_row(spark, lines, java_ws_words)
    for i, line in enumerate(lines):
        assert got[i] == java_split_ws(line), repr(line)


def test_split_lines_equal_line_reader(spark):
    texts = _random_lines(5, 1500, alphabet=["a", "b", "\n", "\r", "\r\n", " "], max_len=8)
    got = _per_row(spark, texts, split_lines)
    for i, t in enumerate(texts):
        assert got[i] == reader_lines(t), repr(t)


def test_counts_and_no_python_eval(spark):
    from conftest import plan_string

    lines = spark.createDataFrame([("a b. a b",), ("A B c",), ("",)], "line string")
    bc = {r.bigram: r.n for r in text.bigram_count(lines).collect()}
    assert bc == {"a b": 3, "b c": 1}
    wc = {r.word: r.n for r in text.word_count(lines).collect()}
    assert wc == {"a": 2, "b.": 1, "A": 1, "B": 1, "c": 1, "b": 1, "": 1}
    plan = plan_string(text.bigram_count(lines))
    assert "EvalPython" not in plan and "HashAggregate" in plan


def test_text_bigrams_equal_per_line(spark):
    """A whole multi-line text gives exactly the bigrams of its lines, in order."""
    texts = _random_lines(13, 1500, alphabet=ALPHABET + ["\n", "\r", "\r\n", ".\n", "a\r"], max_len=20)
    got = _per_row(spark, texts, line_bigrams)
    for i, t in enumerate(texts):
        expected = [b for line in reader_lines(t) for b in bigrams_by_sentence(line)] if t else []
        assert got[i] == expected, repr(t)
