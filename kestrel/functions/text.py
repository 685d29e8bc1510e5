"""Column expressions for the text operators (all JVM-side, no Python UDF).

The regular expressions below are Java regex (Spark). Where the behaviour of a Java
text API must be reproduced exactly, the equivalent pattern is fixed here once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they define the semantics; keep them as they are).
# Line breaks of a line-oriented text reader: CR LF, CR, LF.
LINE_BREAK = r"\r\n|\r|\n"
# Java's \s class: space, TAB, LF, VT, FF, CR.
JAVA_WS = r"[ \t\n\x0B\f\r]+"
# A sentence ends at a token whose last character is one of . ! ? - the token is followed
# by tokenizer whitespace, a line break or the end of the value.
SENTENCE_END = r"[.!?](?:[ \t\f]+|(?=[\r\n])|\z)"
# Characters kept in a bigram word: lower-case ASCII letters and digits (plus the
# whitespace and line breaks that separate words and lines).
NOT_WORD_CHAR_OR_WS = r"[^a-z0-9 \t\f\n\r]"
# Delimiters of the default string tokenizer (space, TAB, LF, CR, FF) left in a line.
LINE_WS = r"[ \t\f]+"
# Every word that has a successor, captured together with it (overlapping matches).
WORD_PAIR = r"(?<![a-z0-9])(?=([a-z0-9]+ [a-z0-9]+))"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text) -> Column:
    """Lines of a text value as a line reader sees them.

    A final line break ends the last line instead of opening an empty one, so one
    trailing empty piece is dropped; an empty text has no lines.
    """
    t = _col(text)
    # Drop one final line break, then split once (a generator gets no common-subexpression
    # elimination, so the split must not be repeated).
    final_break = (F.when(t.endswith("\r\n"), F.lit(2))
                   .when(t.endswith("\n") | t.endswith("\r"), F.lit(1)).otherwise(F.lit(0)))
    body = t.substr(F.lit(1), F.length(t) - final_break)
    return F.when(t == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK))


def line_bigrams(line) -> Column:
    """All bigrams of a line - or of a whole text, line by line - in order, as an array.

    Four regex passes, no lambdas. Line breaks and sentence ends are hard breaks, so a
    text gives exactly the bigrams of its lines and the caller need not split it:
    (1) lower-case; (2) every ``. ! ?`` that ends a raw token becomes LF - this must look
    at the raw token, before any cleaning; (3) every char but ``[a-z0-9]``, the tokenizer
    whitespace and CR/LF is deleted, which cleans all tokens at once and makes
    pure-punctuation tokens vanish (their neighbours still pair up); (4) runs of
    space/TAB/FF become one space; (5) each word followed by one space and a word yields
    that pair. CR and LF never match the space in the pair pattern, so no bigram crosses a
    sentence end or a line.
    """
    marked = F.regexp_replace(F.lower(_col(line)), SENTENCE_END, "\n")
    cleaned = F.regexp_replace(marked, NOT_WORD_CHAR_OR_WS, "")
    spaced = F.regexp_replace(cleaned, LINE_WS, " ")
    return F.regexp_extract_all(spaced, F.lit(WORD_PAIR), 1)


def java_ws_words(line) -> Column:
    """Words of a line split as ``line.split("\\\\s+")``.

    Leading whitespace yields one empty first word, trailing whitespace yields nothing,
    an empty line yields one empty word and an all-blank line yields no word.
    """
    line = _col(line)
    trimmed = F.regexp_replace(line, JAVA_WS + r"\z", "")
    words = F.split(trimmed, JAVA_WS)
    all_blank = (line != F.lit("")) & (trimmed == F.lit(""))
    return F.when(all_blank, F.array().cast("array<string>")).otherwise(words)


def strip_last_component(c) -> Column:
    """``A.B.C.D.port`` -> ``A.B.C.D``; a value without a dot is left unchanged."""
    return F.regexp_replace(_col(c), r"[.][^.]*\z", "")


def key_prefix(c, prefix_len: int = 1) -> Column:
    """First ``prefix_len`` characters of a key (empty key -> empty prefix)."""
    return F.substring(_col(c), 1, prefix_len)
