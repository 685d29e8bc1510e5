"""Main text of web pages by differencing each page against its nearest neighbour in URL order.

1. Pages are ordered by host and URL path; a page's neighbour is the page before or after it in that
   order, on the same host, whose path shares the longer prefix. The order is cut into ranges, so a host
   with a third of all pages is many tasks, and the ends of the ranges are matched exactly.
2. Every page is read into text blocks (a block element's text). Navigation, page header and footer,
   aside, form, script, style and blocks named as advert, notice, menu, comment and the like go in any
   case. The neighbour sends the hashes of all its other blocks; blocks on a longest common subsequence
   of both pages are shared.
3. Shared blocks are deleted. An article element stays whole if any of its blocks is the page's own,
   so paragraphs that two articles share are kept; one that the neighbour repeats whole (a teaser) goes
   if the page's own text is longer. In main, shared blocks between two that stay are kept as well.
   The page's own blocks stay wherever they are. Without a neighbour, or if it repeats all blocks, all
   stay, except those outside both main and articles where there is a main.

Differencing alone deletes paragraphs that two articles share and keeps adverts that change with the
page, hence the elements and names. Pages are parsed in Arrow batches; html is shuffled once.
"""

from __future__ import annotations

import bisect
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import words as W
from kestrel.llm.common import cut, in_batches, shuffle_width

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(script|style|textarea|noscript|template|iframe|svg|title|select|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S | re.I)
ATTR = re.compile(r"""([a-zA-Z:_-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([a-zA-Z-]+)""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
# Fixed values of HTML: void elements, inline elements (they don't end a block).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
# Elements and names of blocks that are not main text.
DROPPED = frozenset("nav footer aside form button dialog menu head fieldset canvas audio video map datalist".split())
NAMED = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
                  "notice alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments commentlist reply replies "
                  "discussion disqus share sharing social related recommended newsletter subscribe subscription signup login popup modal "
                  "overlay widget toolbar pagination pager masthead copyright disclaimer topbar skip paywall hidden".split())
ARTICLE_NAMED, HEADER_NAMED = frozenset({"comment", "comments", "reply", "ad", "related"}), frozenset({"header"})
# Words before a name that say what the page has or lacks, and words after it that only hold the thing named.
STATES = frozenset("no not non without has have with is are hide show toggle".split())
HOLDERS = frozenset("area articles bar block bottom box button buttons center column container content group heading holder icon icons inner item items left "
                    "link links list main news outer panel posts primary right row secondary section slot space stories title top unit wrap wrapper "
                    "wrapping zone box1 1 2 3 4 5 6 7 8 9".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
CLOSES_SELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}


def _named(token: str, names=NAMED) -> bool:
    """Whether a class or id names boilerplate: alone, as the thing itself (main-nav), or with words that only hold
    it (ad-slot). What it has or lacks (no-sidebar), its state (menu-open) and other compounds (notice-period) do not."""
    parts = [x.lower() for x in NAME.findall(token)]
    if not parts or parts[0] in STATES:
        return False
    return parts[-1] in names or (parts[0] in names and all(x in HOLDERS or x in names for x in parts[1:]))


HARD, SOFT = "drop", "soft"       # a soft one ends where the page's main element or first article begins


def _is_noise(tag: str, attrs: str, in_article: bool) -> str | None:
    if tag == "form":
        return SOFT
    if tag in DROPPED or (tag == "header" and not in_article):
        return HARD
    if not attrs or attrs.isspace() or tag in ("html", "body", "main"):
        return None
    found = {}
    for m in ATTR.finditer(attrs):
        found.setdefault((m[1] or m[5]).lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return HARD
    if found.get("role", "").lower() in ROLES:
        return HARD
    names = [x for key in ("class", "id") for x in found.get(key, "").split()]
    if tag == "article":    # it may be a reader's comment
        return SOFT if any(_named(x, ARTICLE_NAMED) for x in names) else None
    return SOFT if any(_named(x) or (not in_article and _named(x, HEADER_NAMED)) for x in names) else None


def blocks(page: str) -> list[tuple[str, int, str]]:
    """(zone, article, text) of every non-empty block that is not dropped: zone is main or body;
    article numbers the innermost article element (0 outside)."""
    out, text = [], []
    stack = []          # (tag, zone, article) of open elements
    zone, article, n_articles, seen = "body", 0, 0, False

    def flush():
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line and zone not in (HARD, SOFT):
                out.append((zone, article, line))
            text.clear()

    for m in TOKEN.finditer(page):
        piece = m[0]
        if m[1] is not None:
            if m[1].lower() not in ("noscript", "svg", "object"):
                flush()
            continue
        if m[3] is None:
            if piece[0] != "<" or piece == "<":
                text.append(piece)
            continue
        tag = m[3].lower()
        if tag not in INLINE:
            flush()
        if m[2]:
            if any(t == tag for t, *_ in stack):
                while stack:
                    if stack.pop()[0] == tag:
                        break
        elif tag not in VOID:
            ends = CLOSES_SELF.get(tag)
            if ends and stack and stack[-1][0] in ends:
                stack.pop()
                _, zone, article = stack[-1] if stack else ("", "body", 0)
            new, inner = zone, article
            if zone != HARD:
                drop = _is_noise(tag, m[4], article > 0)
                if zone == SOFT and not drop and not seen and tag in ("main", "article"):
                    zone = new = "body"     # what seemed boilerplate by its name holds the page's main part
                if drop or zone == SOFT:
                    flush()
                    new = HARD if drop == HARD else SOFT
                elif tag == "article":
                    n_articles += 1
                    inner = n_articles
                elif tag == "main" and not article:
                    new = "main"
                seen = seen or new == "main" or inner > 0
            if not m[4].rstrip().endswith("/"):
                stack.append((tag, new, inner))
        _, zone, article = stack[-1] if stack else ("", "body", 0)
    flush()
    return out


def _hashes(lines: list[str]) -> np.ndarray:
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw]) if raw else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if raw else ends
    return W.word_hashes(data, starts, ends).view(np.int64)


def shared_lines(a, b) -> set[int]:
    """Positions in ``a`` that lie on a longest common subsequence of ``a`` and ``b``."""
    lo, end_a, end_b = 0, len(a), len(b)
    while lo < end_a and lo < end_b and a[lo] == b[lo]:
        lo += 1
    while end_a > lo and end_b > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    out = {*range(lo), *range(end_a, len(a))}
    at = {}
    for j in range(end_b - 1, lo - 1, -1):
        at.setdefault(b[j], []).append(j)
    # Hunt and Szymanski: increasing positions of b, with a link to the match before
    tails, links = [], []
    for i in range(lo, end_a):
        for j in at.get(a[i], ()):
            k = bisect.bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            elif j < tails[k]:
                tails[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def main_text(page: str, neighbour=None) -> str:
    """The main text of a page, given its neighbour's block hashes (None: no neighbour)."""
    got = blocks(page)
    stay = set()
    if neighbour is not None:
        stay = _told(got, shared_lines(_hashes([x for *_, x in got]).tolist(), list(neighbour)))
    if not stay:    # no neighbour, or a copy of it, says nothing about what is boilerplate; main does
        has_main = any(z == "main" for z, *_ in got)
        stay = {i for i, (z, a, _) in enumerate(got) if z == "main" or a or not has_main}
    return " ".join(got[i][2] for i in sorted(stay))


def _told(got, shared: set[int]) -> set[int]:
    """Blocks that stay by their elements and by the difference together; none if all are shared."""
    stay = {i for i in range(len(got)) if i not in shared}
    if not stay:
        return stay
    length = sum(len(got[i][2]) for i in stay)
    articles = {}
    for i, (_, a, _) in enumerate(got):
        if a:
            articles.setdefault(a, []).append(i)
    for rows in articles.values():
        if not stay.isdisjoint(rows) or sum(len(got[i][2]) for i in rows) >= length:
            stay.update(rows)
    inside = [i for i in stay if got[i][0] == "main"]
    if inside:
        stay.update(i for i in range(min(inside), max(inside)) if got[i][0] == "main" and not got[i][1])
    return stay


def _line_rows(batches):
    for batch in batches:
        out = [_hashes([x for _, _, x in blocks(p or "")]) for p in batch.column("html").to_pylist()]
        lens = np.cumsum([0, *[len(x) for x in out]]).astype(np.int32)
        lines = pa.ListArray.from_arrays(pa.array(lens), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64), pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("k"), lines], names=["k", "lines"])


def _text_rows(batches):
    for batch in batches:
        near = batch.column("lines").to_pylist()
        text = [main_text(p or "", n) for p, n in zip(batch.column("html").to_pylist(), near, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                                          pa.array([len(x) for x in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def neighbours(pages: DataFrame) -> DataFrame:
    """k, near: the key of every page's nearest page by URL path on its host (none: no row).

    ``pages`` has k (row key) and url. The order is cut into ranges of about equal size; lag and
    lead run inside a range, and the last row before and the first row after it come from a
    table of one row per range.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    narrow = pages.where("url is not null").select("k", host.alias("host"), path.alias("path")).distinct()
    r = shuffle_width(pages)
    order = ["host", "path", "k"]
    ranged = cut(narrow.repartitionByRange(r, *order).withColumn("range", F.spark_partition_id()))
    row = F.struct(*order)
    ends = ranged.groupBy("range").agg(F.min(row).alias("lo"), F.max(row).alias("hi"))
    by_range = Window.orderBy("range")      # one row per range
    ends = ends.select(F.col("range").alias("_r"), F.lag("hi").over(by_range).alias("_before"), F.lead("lo").over(by_range).alias("_after"))
    inside = Window.partitionBy("range").orderBy(*order)
    got = (ranged.withColumn("_p", F.lag(row).over(inside)).withColumn("_n", F.lead(row).over(inside))
           .join(F.broadcast(ends), F.col("range") == F.col("_r"), "left")      # one row per range
           .withColumn("_p", F.coalesce("_p", "_before")).withColumn("_n", F.coalesce("_n", "_after")))

    def common(x):
        n = F.least(F.length("path"), F.length(x["path"]))
        same = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(F.col("path"), i, F.lit(1)) != F.substring(x["path"], i, F.lit(1)))
        return F.when(x["host"] == F.col("host"), F.coalesce(F.get(same, F.lit(0)) - 1, n))

    got = got.withColumn("_cp", common(F.col("_p"))).withColumn("_cn", common(F.col("_n")))
    near = F.when(F.col("_cp").isNull(), F.when(F.col("_cn").isNotNull(), F.col("_n")["k"])).when(
        F.col("_cn") > F.col("_cp"), F.col("_n")["k"]).otherwise(F.col("_p")["k"])
    return got.select("k", near.alias("near")).where("near is not null")


def extract_main(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page.

    Defined cases: null or empty html gives an empty text; a null url has no neighbour; rows that
    repeat id, url and html get the same text each (and are one page in the order); unclosed
    elements end with their parent, an unclosed tag or comment with the page; an empty table gives no
    rows; other columns are ignored.
    """
    p = in_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").alias("html"))
    p = p.withColumn("k", F.xxhash64("page_id", "url", "html"))
    near = neighbours(p.select("k", "url"))
    lines = p.select("k", "html").mapInArrow(_line_rows, "k long, lines array<long>").dropDuplicates(["k"])
    pairs = near.join(lines.withColumnRenamed("k", "near"), "near").select(F.col("k").alias("_k"), "lines")
    return (p.join(pairs, F.col("k") == F.col("_k"), "left").select("page_id", "url", "html", "lines")
            .mapInArrow(_text_rows, "page_id long, url string, text string, n_chars long"))


def op4_html_extraction(spark, sf_dir):
    from kestrel.llm.common import table

    return extract_main(table(spark, sf_dir, "pages"))
