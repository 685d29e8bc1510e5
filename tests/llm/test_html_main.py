import random

from kestrel.llm import html_main


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.choice("abcde") for _ in range(rnd.randint(0, 14))] for _ in range(2))
        got = sorted(html_main.shared_lines(a, b))
        it = iter(b)
        assert len(got) == brute_lcs(a, b) and all(any(x == a[i] for x in it) for i in got)


ARTICLE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t=\"</p><article>x</article>\";</script></head><body>"
           "<header>Site</header><nav><ul><li>Home</li></ul></nav><!-- <p>no</p> --><div class=\"ad\">Buy</div><article class='post'><h1>Title &amp; more</h1>"
           "<p>One <b>bo</b>ld&nbsp;\n word<br>next<p>Two<aside>side</aside> <form><input>f</form><div class='cookie-notice'>c</div></p>"
           "<section id=comments><article class=comment>rubbish</article></section><p>Three &lt;x&gt; &eacute;</article><footer>F</footer>")


def test_structure():
    assert html_main.main_text(ARTICLE) == "Title & more One bold word next Two Three <x> é"
    assert html_main.main_text("") == "" and html_main.main_text("plain  text") == "plain text"
    assert html_main.main_text("<p>a <i>b</p><p>c") == "a b c"
    assert html_main.main_text("<main><p>m</p></main><p>outside</p>") == "m"
    assert html_main.main_text("<div><p>a<p>b</div><!-- open") == "a b"
    assert html_main.main_text("x < y & z") == "x < y & z"


def page(lines):
    return "<body>" + "".join(f"<div>{x}</div>" for x in lines)


def spark_pages(spark, rows):
    return spark.createDataFrame([(*r, "?", "?") for r in rows], "page_id long, url string, html string, k string, lines string").repartition(4)


def test_lines_shared_with_the_nearest_page_go(spark):
    rows = []
    for h in range(3):
        for i in range(12):
            rows.append((100 * h + i, f"https://H{h}.example.com/en/{i:03d}?q={i}", page([f"Menu {h}", "Login", f"Body {h} {i}", f"End {h} {i}", f"(c) {h}"])))
    rows += [(900, None, page(["alone"])), (901, "http://single.org/x", page(["Menu", "text"])), (902, "http://n/x", None), (None, "http://n/y", ""),
             (903, "http://same/a", page(["same", "page"])), (904, "http://same/b", page(["same", "page"])), (5, *rows[5][1:])]
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_main.extract_main(spark_pages(spark, rows)).collect()}
    assert len(got) == len(set(rows))
    for h in range(3):
        for i in range(12):
            text = f"Body {h} {i} End {h} {i}"
            assert got[(100 * h + i, f"https://H{h}.example.com/en/{i:03d}?q={i}")] == (text, len(text))
    assert got[(900, None)][0] == "alone" and got[(901, "http://single.org/x")][0] == "Menu text"
    assert got[(902, "http://n/x")] == ("", 0) and got[(None, "http://n/y")] == ("", 0)
    assert got[(903, "http://same/a")][0] == "same page"


def test_the_difference_takes_part_where_there_is_an_article(spark):
    teaser = "<article><p>Read our other story</p></article>"
    html = ["<html><body><main><article><p>Own paragraph of page {i}</p><p>A shared paragraph</p><p>Last of {i}</p></article>{t}</main>".format(i=i, t=teaser)
            for i in (1, 2)]
    got = {r.page_id: r.text for r in html_main.extract_main(spark_pages(spark, [(i, f"http://h/{i}", html[i - 1]) for i in (1, 2)])).collect()}
    assert got == {i: f"Own paragraph of page {i} A shared paragraph Last of {i}" for i in (1, 2)}


def test_text_outside_an_article_stays_unless_the_neighbour_has_it():
    def near(page):
        return html_main._hashes([x for *_, x in html_main.blocks(page)]).tolist()

    lead = "<main><p>{0} lead</p><article><p>{0} x</p></article><p>{0} rest</p></main>"
    assert html_main.main_text(lead.format(1)) == "1 lead 1 x 1 rest"
    assert html_main.main_text(lead.format(1), near(lead.format(2))) == "1 lead 1 x 1 rest"
    crumbs = "<div>Home and more</div><main><p>Crumbs</p><p>{0} lead</p><p>both</p><article><p>{0} x</p></article><p>See also</p></main><p>{0} after</p><p>End</p>"
    assert html_main.main_text(crumbs.format(1), near(crumbs.format(2))) == "1 lead both 1 x 1 after"
    for tag in ("div", "main"):
        teaser = f"<{tag}><p>The long main text of page {{0}}</p></{tag}><article><p>A {{1}} card</p></article>"
        assert html_main.main_text(teaser.format(1, "teaser")) == "The long main text of page 1 A teaser card"
        assert html_main.main_text(teaser.format(1, "teaser"), near(teaser.format(2, "teaser"))) == "The long main text of page 1"
        assert html_main.main_text(teaser.format(1, "first"), near(teaser.format(2, "second"))) == "The long main text of page 1 A first card"
    copy = "<article><p>An article under two addresses</p></article>"
    assert html_main.main_text(copy + "<p>Printed at 9</p>", near(copy)) == "An article under two addresses Printed at 9"


def test_neighbours_do_not_depend_on_the_ranges(spark):
    rows = [(i, f"http://h/{i // 3:02d}/{i:03d}", page([str(i)])) for i in range(60)]
    out = []
    for n in ("3", "17"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            p = spark_pages(spark, rows).selectExpr("page_id as k", "url")
            out.append(sorted(tuple(r) for r in html_main.neighbours(p).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] and len(out[0]) == 60


def test_empty_table(spark):
    assert html_main.extract_main(spark_pages(spark, [])).collect() == []


def test_wrappers_states_and_compounds_stay():
    """Names that only say what a page has, wrappers of the main part, and compounds are no boilerplate."""
    body = "<article><p>Body text</p></article>"
    for page_ in (f'<div class="layout no-sidebar">{body}</div>', f'<div id="page" class="site has-comments"><main>{body}</main></div>',
                  f'<div class="menu-open wrapper"><main>{body}</main></div>', f'<form action="/x"><div>{body}</div></form>',
                  f'<div class="sidebar"><div>{body}</div></div>', f'<div id="comments-wrapper"><main><p>Body text</p></main></div>'):
        assert html_main.main_text(page_) == "Body text", page_
    assert html_main.main_text('<main><p>One</p><p class="notice-period">Three months</p></main>') == "One Three months"
    assert html_main.main_text('<main><section id="related-work"><p>Others did this</p></section></main>') == "Others did this"


def test_named_boilerplate_still_goes():
    keep = "<main><article><p>Body</p></article></main>"
    for name in ("ad", "ads-top", "ad-slot-3", "cookie-banner", "main-nav", "site-footer", "commentList", "related-posts", "comments_list", "newsletter"):
        assert html_main.main_text(f'<div class="{name}"><p>gone</p></div>{keep}<div class="x {name}">gone</div>') == "Body", name
    assert html_main.main_text(f'{keep}<div id="comments"><article><p>reader</p></article></div>') == "Body"
    assert html_main.main_text(f'<nav><article>card</article></nav>{keep}<form><p>field</p></form>') == "Body"
    assert html_main.main_text('<form><p>only a form</p></form>') == ""
