import html
import re

import pytest

from tabsmith.llm import op7_html_text as op
from tabsmith.llm.common import table

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="layout">
<header class="top"><h1>Site</h1></header><nav><ul><li><a href="/a">Home of the site</a></li></ul></nav>
<div class="cookie-notice">We use the cookies of this site and it is good for you to accept that.</div>
<main><article><h1>Head</h1><p>The cat sat on the mat &amp; it was&nbsp;the best of all the mats that there are in the house.
<p>Short<br>one <b>bo</b>ld.</p><script>var a="</p><p>no";</script>
<aside>Aside text of the page that is long enough to be kept if it was not an aside.</aside>
<div class="ad">Buy this</div><form><p>Name</p></form>
<div class="comments"><p>First! The best of the comments that I have seen on this page for a long time.</p></div></article></main>
<footer>&copy; x</footer></body></html>"""


def test_a_page_with_everything():
    assert op.main_text(PAGE) == ("Head The cat sat on the mat & it was the best of all the mats that there are in the house. "
                                  "Short one bold.")


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p>", ""), ("plain", "plain"), ("a < b", "a < b"), ("<div><p>x</div><script>never closed", "x"),
    ("<!-- open comment <p>x</p>", ""), ("<article><p>x</article><p>", "x"), ("<nav><p>menu</p></nav>", ""),
    ("<article><p class='ad'>buy</p><p>text</p></article>", "text"), ("<p title=\"a>b\">x</p>", "x"),
    ("<article>" + "<div>" * 3000 + "deep" + "</article> ", "deep")])
def test_odd_pages(page, want):
    assert op.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', "one two three"),
    ('<article><p>one <svg class="i"/> two</p><p>x <svg><path d="M0"/><title>t</title></svg> three</p></article>', "one two x three"),
    ('<article><p>one <svg class="i"><path> two</p><p>three</p></article>', "one three"),
    ('<article><a href="#"><svg></a><p>one</p></article>', "one"),
    ("<article><div>one<object data=x> in</div><p>two</p></article>", "one two"),
    ("<article><p>one<noscript>in<p>no</p></p><p>two</p></article><p>three", "one two three"),
    ("<article><p>one</p><template><p>no</p></article><p>three", "one three"),
    ("<html><head><title>T <b>t</b></title><meta charset=x><body><p>one", "one"),
    ("<html><head><title>T</title><p>one", "one"), ("<head><title>T</title>one", "one"), ("<head><title>T<p>one", "one"),
    ("<head><noscript><div>no</div></noscript><link rel=x></head><p>one", "one"), ("<head><noscript><p>one", "one"),
    ("<head><script>var a = '</head>';</script></head><p>one", "one"), ("<p>one<iframe>x<p>no", "one"),
    ("<p>one <object data=x><p>no</p></object> two", "one two"), ("<svg/>one", "one"),
    ("<svg><foreignObject><p>no</p></foreignObject><text>no</text></svg><p>one", "one")])
def test_unread_elements_end(page, want):
    assert op.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ('<article class="post has-comments"><p>one</p></article>', "one"), ('<main class="no-sidebar"><p>one</p></main>', "one"),
    ('<article class="comments" id="form"><p>one</p></article>', "one"),
    ('<div class="sidebar"><p>two</p><article><p>one</p></article></div>', "two one"),
    ('<form><main><p>one</p></main></form><form><p>no</p></form>', "one"),
    ('<aside><article><p>no</p></article></aside><p>one', "one"),
    ('<div class="long-form"><p>one</p></div>', "one"), ('<div class="has-comments" id="no-sidebar"><p>one</p></div>', "one"),
    ('<article><div class="article-header"><h1>head</h1></div><p>one</p></article>', "head one"),
    ('<article><div class="x cookie-notice">no</div><div class="ad-1">no</div><div id="Sidebar">no</div><p>one</p></article>', "one"),
    ('<article><div role="complementary">no</div><div aria-label="Related to the story">one</div></article>', "one"),
    ('<article><p>one</p><div class="comments"><article class="x"><p>no</p></article></div></article>', "one"),
    ('<template><article></article></template><div class="ad"><p>no</p></div><p>one</p>', "one"),
    ('<article><p>one</p><figure><img src=x><figcaption>two</figcaption></figure></article>', "one two"),
    ('<article><p>one <math><mi>x</mi><mo>=</mo><mn>2</mn></math> two</p><p><math/>three</p></article>', "one x=2 two three"),
    ('<main hidden><p>no</p></main><article><p style="display: none">no</p><p>one</p></article>', "one"),
    ('<div class="menu">' * 3000 + "<main>deep" + "</div>" * 3000, "deep")])
def test_names_drop_no_article(page, want):
    assert op.main_text(page) == want


LINKED = "This is the long paragraph of the article that is a link as a whole, from its first word to its last one."


@pytest.mark.parametrize("page, want", [
    (f"<article><p><a href=x>{LINKED}</a></p><p>And this is the next sentence of the article, of some length.</p></article>",
     LINKED + " And this is the next sentence of the article, of some length."),
    ("<h1>Code</h1><pre>" + "x = f(1) + g[2];\n" * 8 + "</pre>", "Code " + " ".join(["x = f(1) + g[2];"] * 8)),
    ("<ul><li><a href=a>\u0413\u043b\u0430\u0432\u043d\u0430\u044f</a></li></ul>" + "<p>" + "\u0421\u043b\u043e\u0432\u043e \u0437\u0430 \u0441\u043b\u043e\u0432\u043e\u043c. " * 10 + "</p>" * 2,
     " ".join(["\u0421\u043b\u043e\u0432\u043e \u0437\u0430 \u0441\u043b\u043e\u0432\u043e\u043c."] * 10)),
    ("<p>" + "\u8fd9\u662f\u4e00\u4e2a\u5f88\u957f\u7684\u53e5\u5b50\u3002" * 12 + "</p>", "\u8fd9\u662f\u4e00\u4e2a\u5f88\u957f\u7684\u53e5\u5b50\u3002" * 12),
    ("<div>" + "12:30 | $5 | #77 / " * 10 + "</div>", "")])
def test_text_is_kept_for_more_than_its_stop_words(page, want):
    assert op.main_text(page) == want


@pytest.mark.parametrize("part", ["<p>ab c</p>", "<a ", "<script ", "<!x", "<div><p>x", "a < b ", "<b class='x", "</", "<a href=\"x\">"])
def test_time_grows_with_the_page(part):
    import time
    took = []
    for n in (4_000, 16_000):
        began = time.perf_counter()
        op.main_text(part * n)
        took.append(time.perf_counter() - began)
    assert took[1] < 8 * took[0] + 0.5


def test_sweeps_find_the_nearest_neighbours():
    import random
    rng = random.Random(2)
    for _ in range(300):
        found = []
        for _ in range(rng.randrange(1, 14)):
            b = op.Block("x", 0, op.Element("p", None))
            b.article, b.label, b.dropped = rng.choice([0, 1, 1, 2]), rng.choice([True, False, None, None]), False
            if b.label is False:
                b.dropped = rng.random() < 0.4
            found.append(b)
        want = []
        for i, b in enumerate(found):
            sides = []
            for step in (-1, 1):
                j = i + step
                while 0 <= j < len(found) and (not b.article or found[j].article == b.article):
                    if found[j].label is not None and not found[j].dropped:
                        sides.append((abs(j - i), not found[j].label))
                        break
                    j += step
            want.append(b.label if b.label is not None else not min(sides)[1] if sides else True)
        op.inherit(found)
        assert [b.label for b in found] == want


def test_given_pages_give_their_articles(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    rows = {r.page_id: r for r in op.extracted(pages).collect()}
    for p in pages.collect():
        t = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        t = re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", t))
        want = " ".join(html.unescape(t).split())
        assert rows[p.page_id].text == want and rows[p.page_id].n_chars == len(want)


def test_null_repeated_and_empty(spark):
    schema = "page_id long, url string, html string, text string"
    df = spark.createDataFrame([(1, "u", "<p>x", "old"), (1, "u", "<p>x", "old"), (None, None, None, None)], schema)
    assert sorted(map(tuple, op.extracted(df).collect()), key=str) == sorted(
        [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)], key=str)
    assert op.extracted(spark.createDataFrame([], schema)).collect() == []
