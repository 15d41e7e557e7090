"""Main-text extraction: written pages with known articles, tree matching against brute force, templates."""
from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from reqtrail.llm import wrappers


def extracted(spark, pages):
    df = spark.createDataFrame([(i, u, h, "x", "x") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, host string, text string").repartition(3)
    return [r.text for r in wrappers.extract(df).orderBy("page_id").collect()]


def page(i, paragraphs, extra="", article="article"):
    return (f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t='</p><article>no'</script></head><body>"
            f"<header><h2>Site</h2></header><nav><ul><li><a href='/x'>menu {i}</a><li>two</ul></nav><!-- <p>hidden</p> --><div class=\"ad\">buy {i}</div>"
            f"<{article}><h1>Head &amp; {i}</h1>{''.join(f'<p>{p}' for p in paragraphs)}{extra}</{article}>"
            f"<aside>side {i}</aside><div id='comments'><article class='comment'><p>nice {i}</p></article></div><footer>&copy; {i}</footer></body></html>")


def test_article_without_what_surrounds_it(spark):
    pages = [(f"http://a.example/{i}", page(i, [f"first  {i}\n<b>bold</b>", "a<br>b &lt;tag&gt; &eacute; &#x1F600;", "same words"],
                                            "<form><p>mail</p></form><div class='share-links'>share</div><ul><li>one<li>two</ul>")) for i in range(8)]
    got = extracted(spark, pages)
    assert got == [f"Head & {i}\n\nfirst {i} bold\n\na b <tag> é \U0001F600\n\nsame words\n\none\n\ntwo" for i in range(8)]


def test_wrapper_finds_template_where_no_article_is_marked(spark):
    rnd = random.Random(1)
    body = lambda i: " ".join(rnd.choice("abcdefgh") * 4 for _ in range(30)) + f" {i}"
    texts = [(body(i), body(i)) for i in range(12)]
    pages = [("https://u:p@B.example:80/q", f"<html><title>t{i}</title><body><div class=top><div>Welcome to our site</div></div><div>{'<div>Sale today</div>' if i % 2 else ''}"
              f"<div><p>{a}</p><p>{b}</p></div></div><div><a href=1>one</a> <a href=2>two {i}</a></div><div><span>All rights kept</span></div></body></html>") for i, (a, b) in enumerate(texts)]
    got = extracted(spark, pages)
    for i, (a, b) in enumerate(texts):
        assert f"{a}\n\n{b}" in got[i] and "Welcome" not in got[i] and "rights" not in got[i] and "two" not in got[i]


def test_copies_of_one_page_keep_their_article(spark):
    pages = [("http://c.example/1", page(0, ["only text", "more text"]))] * 20
    assert extracted(spark, pages) == ["Head & 0\n\nonly text\n\nmore text"] * 20


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain  text &amp; more", "plain text & more"), ("<p>one<p>two", "one\n\ntwo"), ("<article><p>cut of", "cut of"),
    ("<div><b>x</div>y</b> z", "x\n\ny z"), ("a < b > c <", "a < b > c <"), ("<p title=\"a>b\">t</p>", "t"), ("<p title='open>t</p>", "t"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"), ("<p>a&nbsp;&nbsp;b\x85c</p>", "a b c"), ("<script>x", ""), ("<!-- x", ""),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"), ("<main><article>in</article>out</main>", "in\n\nout"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\n\nx"),
])
def test_markup(spark, html, text):
    table = type("None", (), {"find": staticmethod(lambda keys: __import__("numpy").zeros((len(keys), 1), int))})
    known = type("Any", (), {"slots": staticmethod(lambda host, root: ((lambda t: (dict.fromkeys(range(len(t.labels)), 1), t))(wrappers.Tree(root))))})
    assert wrappers.main_text(html or "", "", known, table) == text


@pytest.mark.parametrize("html, text", [
    ("<div class='content no-sidebar'><article><p>one</p></article></div>", "one"), ("<div class='layout with-sidebar'><p>one</p></div>", "one"),
    ("<div class='social-enabled'>one</div>", "one"), ("<div class='sidebar'><article><p>one</p></article></div>", "one"),
    ("<article><h2 id='legal-history'>a</h2><section id='comments-on-method'><p>b</p></section><p class='notice'>c</p><div class='share-price'>d</div>"
     "<p class='ad-hoc'>e</p><div class='notice'>f</div><div class='promo'><p>g</p></div></article>", "a\n\nb\n\nc\n\nd\n\ne\n\nf\n\ng"),
    ("<p>x <math><mi>y</mi></math></p>", "x y"), ("<form><h1>a</h1><p>all of the page</p></form>", "a\n\nall of the page"),
    ("<div class='sidebar'>s</div><div id='cookieBanner'>c</div><ul class='share-links'><li>l</ul><p>the text of the page</p>", "the text of the page"),
    ("<article><div class='share-links'>s</div><div class='ad'>s</div><p>text</p></article>", "text"), ("<article id='comment-on-x'><p>text</p></article>", "text"),
])
def test_names_drop_no_content(spark, html, text):
    test_markup(spark, html, text)


def test_template_inside_marked_articles(spark):
    rnd = random.Random(2)
    body = lambda: " ".join(rnd.choice("abcdefgh") * 4 for _ in range(30))
    texts = [(body(), body()) for _ in range(8)]
    pages = [("http://e.example/", f"<title>Site</title><article><p>Subscribe to our letter</p><p>{a}</p><div>All rights kept</div><p>{b}</p></article>") for a, b in texts]
    assert extracted(spark, pages) == [f"{a}\n\n{b}" for a, b in texts]
    # one article on all pages, with other words around it
    copies = [("http://f.example/", f"<title>t{i}</title><article><p>{texts[0][0]}</p><p>{texts[0][1]}</p><p>{a[:9]} x{chr(97 + i)}</p></article><div>{a[:20]}</div>") for i, (a, _) in enumerate(texts)]
    assert all(t.startswith(f"{texts[0][0]}\n\n{texts[0][1]}") for t in extracted(spark, copies))


def test_template_of_few_pages_without_titles_and_of_several_layouts(spark):
    rnd = random.Random(4)
    body = lambda: " ".join(rnd.choice("abcdefgh") * 4 for _ in range(30))
    few = [(f"http://g.example/{i}", f"<div>Welcome to our site</div><div><p>{body()}</p></div><div>All rights kept</div>") for i in range(4)]
    same = [(f"http://h.example/{i}", f"<title>Site</title><div>Welcome to our site</div><div><p>{body()}</p></div><div>All rights kept</div>") for i in range(9)]
    # layouts with boilerplate of their own at the same labels, and nodes before them that not all pages have
    layouts = [(f"http://i.example/{i}", f"<div class='{'abc'[i % 3]}'>top {'abc'[i % 3]}</div>{'<section>now</section>' * (i % 2)}<div><p>{body()}</p></div>"
                f"{f'<div class=x><ul><li>{body()}</ul></div>' * (i % 5 == 0)}<div>Only layout {'abc'[i % 3]}</div>") for i in range(36)]
    for got in (extracted(spark, few), extracted(spark, same), extracted(spark, layouts)):
        assert not any(w in t for t in got for w in ("Welcome", "rights", "Only", "top")) and all(len(t) >= 100 for t in got)


@pytest.mark.parametrize("html, text", [
    ("<div id='content'><p>the long text of the page</p></div><article>more</article>", "the long text of the page"),
    ("<div><p>the long text of the page</p></div><article>more</article>", "the long text of the page\n\nmore"),
    ("<div><p>short</p></div><article>the long text of the page</article>", "the long text of the page"),
])
def test_teaser_article_does_not_hide_the_text(spark, html, text):
    got = extracted(spark, [(None, html)])[0]
    assert got.startswith(text)


def test_deep_and_long_pages(spark):
    deep = "<div>" * 20_000 + "bottom" + "<b>" * 5000
    long = "<article>" + "".join(f"<p>paragraph {i}</p>" for i in range(5000)) + "</article>"
    got = extracted(spark, [("http://d.example/", deep), ("http://d.example/", long), (None, "<p>x</p>"), ("not a url", None), ("http://d.example/", long)])
    assert got == ["bottom", "\n\n".join(f"paragraph {i}" for i in range(5000)), "x", "", "\n\n".join(f"paragraph {i}" for i in range(5000))]


def test_empty_table(spark):
    assert wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute(a, b) -> int:
    """Most matching nodes, over all ways to pair children in order."""
    if a[0] != b[0]:
        return 0
    x, y, best = a[1], b[1], 0
    for k in range(min(len(x), len(y)) + 1):
        for i in itertools.combinations(range(len(x)), k):
            for j in itertools.combinations(range(len(y)), k):
                best = max(best, sum(brute(x[p], y[q]) for p, q in zip(i, j)))
    return 1 + best


def test_simple_tree_matching():
    rnd = random.Random(3)

    def tree(depth, counter):
        node = [rnd.choice("ab") if depth < 3 else "r", [], counter[0]]
        counter[0] += 1
        node[1] = [tree(depth - 1, counter) for _ in range(rnd.randrange(4))] if depth else []
        return node

    for _ in range(60):
        a, b = tree(3, [0]), tree(3, [0])
        n, pairs = wrappers.match(a, b)
        assert n == brute(a, b) == len(pairs) and len({p for p, _ in pairs}) == len({q for _, q in pairs}) == n
        assert wrappers.read_tree(wrappers.dumped(a)) == a


def test_alignment_of_long_lists():
    """By blocks of rows, against the whole table."""
    rnd = random.Random(5)
    for _ in range(40):
        kinds = rnd.randrange(1, 5)
        gain = np.array([[rnd.randrange(4) for _ in range(kinds)] for _ in range(kinds)], np.int32)
        x, y = (np.array([rnd.randrange(kinds) for _ in range(rnd.randrange(1, 40))]) for _ in range(2))
        best = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, p in enumerate(x, 1):
            for j, q in enumerate(y, 1):
                best[i, j] = max(best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + gain[p, q])
        got = wrappers.align(x, y, gain)
        assert sum(gain[x[i], y[j]] for i, j in got) == best[-1, -1]
        assert all(i > k and j > m for (i, j), (k, m) in zip(got, got[1:]))


@pytest.mark.parametrize("row, other", [("<div><p>a</p><span>b</span></div>", "<div><p>a</p><span>b</span></div>"),
                                        ("<div><p>a</p><ul><li>b</li></ul></div>", "<div><ul><li>b</li></ul></div>")])
def test_pages_of_20000_rows(row, other):
    started = time.monotonic()
    a, b = (wrappers.Tree(wrappers.parse(f"<body><div>{(row + other) * (n // 2)}<h2>end</h2></div></body>")[0]).top for n in (20_000, 19_000))
    n, pairs = wrappers.match(a, b)
    want = wrappers.Shapes()
    assert n == len(pairs) == want.nodes[want.of(b)]  # all of the smaller
    assert time.monotonic() - started < 60  # one to two seconds on a free machine


def test_lists_of_many_different_rows():
    rnd = random.Random(6)
    rows = ["<div>" + "".join(rnd.choice(["<p>x</p>", "<ul><li>x</li></ul>", "<h3>x</h3>"]) for _ in range(8)) + "</div>" for _ in range(800)]
    page = lambda part: wrappers.Tree(wrappers.parse(f"<body>{''.join(part)}</body>")[0]).top
    started = time.monotonic()
    n, pairs = wrappers.match(page(rows), page(rows[::2]))
    assert n == len(pairs) == wrappers.match(page(rows[::2]), page(rows[::2]))[0]
    assert time.monotonic() - started < 60


def test_template_decides_where_tags_do_not(spark):
    """Plain containers without names: what all pages of the host say is left out; a page alone keeps it."""
    pages = [f"<div><div>Shop Home Contact</div><div><p>Story number {w} of the {w} valley.</p></div><div>Write to us any time.</div></div>"
             for w in ("red", "green", "old", "wide", "quiet", "northern")]
    got = extracted(spark, [("http://plain.example/", p) for p in pages])
    assert got == [f"Story number {w} of the {w} valley." for w in ("red", "green", "old", "wide", "quiet", "northern")]
    alone = extracted(spark, [("http://plain.example/", pages[0])])[0]
    assert "Shop Home Contact" in alone and "Write to us any time." in alone


def test_driver_pages_have_no_markup_left(spark):
    import os

    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("driver test tables not present")
    got = wrappers.extract(spark.read.parquet(path))
    assert got.where(F.col("text").rlike("</|<p>|&amp;amp")).count() == 0 and got.where("length(text) > 0").count() == got.count()
