"""Main-text extraction on hand-made pages and on the whole small table."""

from __future__ import annotations

import html
import math
import os
import random
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from probelens.llm.html_extract import extract, main_text  # noqa: E402

P = [f"Paragraph {i} tells a story of some length, with commas, and goes on for quite a few words more." for i in range(6)]
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Topic {i}</a></li>' for i in range(12)) + "</ul>"
ARTICLE = "<h1>A title</h1>" + "".join(f"<p>{p}</p>" for p in P)
EXPECTED = "\n\n".join(["A title", *P])

PAGES = {
    "semantic": f"<html><head><title>t</title><style>p{{}}</style></head><body><header>Site name</header><nav>{MENU}</nav><article>{ARTICLE}</article><aside>Read more {MENU}</aside><footer>Imprint &copy;</footer></body></html>",
    "plain div": f"<body><div id=top>{MENU}</div><div class='content'>{ARTICLE}</div><div>{MENU}<a href=/x>Imprint</a></div></body>",
    "sections": f"<body><div id=menu>{MENU}</div><div id=c><div><h1>A title</h1><p>{P[0]}</p><p>{P[1]}</p></div><div>{''.join(f'<p>{p}</p>' for p in P[2:])}</div></div><div class=footer>{MENU}</div></body>",
    "table": f"<table><tr><td>{MENU}<td>{ARTICLE}</table>",
    "notices": f"<body><div class='cookie-notice'><p>{P[0]} We use cookies, and this notice is rather long as such notices are.</p></div><div class=page><main>{ARTICLE}<form><p>Subscribe <input name=q></p></form></main><section id='comments'><p>{P[1]} says a reader</p><p>{P[2]} says another</p></section></div><div class='sidebar'><p>{P[3]}</p></div></body>",
    "adverts inside": f"<body><article><h1>A title</h1><p>{P[0]}</p><div class='ad-slot'>Buy it now</div>{''.join(f'<p>{p}</p>' for p in P[1:])}<div class='reader-comments'><p>{P[0]}</p></div></article></body>",
    "unclosed": f"<body><div><p><b>A title<br>{''.join(f'<p>{p}' for p in P)}</div><div><ul><li><a href=/1>one</a><li><a href=/2>two</a></ul></div>",
    "layout classes": f"<body><div class='left-sidebar'><p>{P[4]}</p></div><div class='page no-sidebar has-comments'><div id=story>{ARTICLE}</div></div><div id='commentList'><p>{P[0]}</p></div></body>",
    "hidden": f"<body><article>{ARTICLE}<p hidden>{P[0]}</p><div style='display: none'>{P[1]}</div><div aria-hidden='true'>{P[2]}</div></article></body>",
    "script text": f"<body><script>var a='</p><p>not text</p>';</script><article>{ARTICLE}<script>if (a < b) c('<p>')</script><!-- <p>note</p> --></article><noscript><p>{P[0]}</p></noscript></body>",
}


HINTED = {
    "slug on a heading": f"<body><article><h1 id='social-history'>A title</h1>{''.join(f'<p>{p}</p>' for p in P)}</article></body>",
    "slugs on sections": f"<body><article><h1>A title</h1><section id='share-prices'><p>{P[0]}</p></section><section id=privacy>{''.join(f'<p>{p}</p>' for p in P[1:5])}</section><section id='related-work'><p>{P[5]}</p></section></article></body>",
    **{f"wrapper {c}": f"<body><div class='{c}'><nav>{MENU}</nav><article>{ARTICLE}</article></div></body>" for c in ("footer-fixed", "ad-free", "menu-open", "sidebar-left")},
    "wrapper of main": f"<body><div id='sidebar-left'><main>{ARTICLE}</main></div></body>",
    "wrapper of text": f"<body><div class='menu-open'><div>{ARTICLE}</div></div></body>",
    "many comments": f"<body><article>{ARTICLE}</article><div class=comments>{''.join(f'<div class=comment><p>{p}</p></div>' for p in P * 3)}</div></body>",
    "advert longer than the article": f"<body><div class=ad>{''.join(f'<p>{p}</p>' for p in P * 2)}</div><article>{ARTICLE}</article></body>",
    "comments as articles": f"<body><main><article>{ARTICLE}</article><div id=comments>{''.join(f'<article class=comment><p>{p}</p></article>' for p in P)}</div></main></body>",
    "section of comments": f"<body><article>{ARTICLE}<section id=comments><p>{P[0]}</p></section></article></body>",
}


@pytest.mark.parametrize("name", HINTED)
def test_hints_need_the_text_to_agree(name):
    assert main_text(HINTED[name]) == EXPECTED


def test_formulas_stay():
    assert main_text(f"<article><p>{P[0]}</p><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>") == f"{P[0]}\n\nwhere x=2 holds"


TEASERS = "".join(f"<div><h3><a href=/t{i}>Teaser {i}</a></h3><p>Short {i}</p></div>" for i in range(9))
REPLIES = "".join(f"<article><p>Reader {i}</p><p>{P[i % 6]}</p></article>" for i in range(12))


def _layout(name, said):
    """A page of six paragraphs and ``said`` comments, in one of the usual layouts."""
    items = [f"<li><p>Reader {i} says: {P[i % 6]}</p></li>" for i in range(said)]
    flat = "".join(f"<div class=comment><p>Reader {i} says: {P[i % 6]}</p></div>" for i in range(said))
    return {
        "list in article": f"<body><article>{ARTICLE}<ol id='comments'>{''.join(items)}</ol></article></body>",
        "section in article": f"<body><article>{ARTICLE}<section class='comments'>{flat}</section></article></body>",
        "main": f"<body><nav>{MENU}</nav><main>{ARTICLE}<div class='comments'>{flat}</div></main></body>",
        "beside": f"<body><div id='content'>{ARTICLE}</div><div id='comments'>{flat}</div></body>",
        "wrapper": f"<body><div class='page'>{ARTICLE}<div class='comment-list'>{flat}</div></div></body>",
        "layout wrapper": f"<body><div class='comments-open'><div>{ARTICLE}</div><div id='disqus_thread'>{flat}</div></div><p>All rights reserved.</p></body>",
    }[name]


@pytest.mark.parametrize("said", [1, 2, 3, 5, 9, 60])
@pytest.mark.parametrize("name", ["list in article", "section in article", "main", "beside", "wrapper", "layout wrapper"])
def test_comments_go_whatever_their_share(name, said):
    assert main_text(_layout(name, said)) == EXPECTED


def test_other_hints_of_any_size():
    short = f"<body><article><p>{P[0]}</p><div class='promo-box'><p>{P[1]}</p><p>{P[2]}</p></div></article></body>"
    assert main_text(short) == P[0]
    side = f"<body><div class=sidebar>{''.join(f'<p>{p}</p>' for p in P * 2)}</div><div>{ARTICLE}</div></body>"
    assert main_text(side) == EXPECTED
    # A page that is nothing else is kept.
    assert main_text(f"<body><div class=widget>{ARTICLE}</div><p>Imprint</p></body>") == EXPECTED
    assert main_text(f"<body><div id=comments>{ARTICLE}</div></body>") == EXPECTED


# ------------------------------------------- density alone, by brute force
def _random_page(rng):
    """Nested divs with paragraphs and links: no article, no hint, no list."""

    def node(depth):
        kids = []
        for _ in range(rng.randint(1, 4)):
            if depth and rng.random() < 0.6:
                kids.append(node(depth - 1))
            else:
                said = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90)))
                linked = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 30))) if rng.random() < 0.4 else ""
                kids.append(("p", [said] + ([("a", [linked])] if linked else [])))
        return ("div", kids)

    return ("body", [node(3) for _ in range(rng.randint(1, 3))])


def _markup(node):
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(_markup, node[1]))}</{node[0]}>"


def _measure(node, in_link=False):
    """(characters, characters in links, tags below, links below) of a node, by recursion."""
    if isinstance(node, str):
        return len(node), len(node) * in_link, 0, 0
    parts = [_measure(k, in_link or node[0] == "a") for k in node[1]]
    below = [k for k in node[1] if not isinstance(k, str)]
    return sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts) + len(below), sum(p[3] for p in parts) + sum(k[0] == "a" for k in below)


def _brute_selection(page):
    c0, l0, _, _ = _measure(page)

    def density(node):
        c, lc, t, lt = _measure(node)
        base = math.log(c / max(1, c - lc) * lc + l0 / c0 * c + math.e)
        t, lc, lt = max(1, t), max(1, lc), max(1, lt)
        return c / t * (math.log(c * t / (lc * lt)) / math.log(base) if base > 1 + 1e-9 else 1.0)

    def total(node):
        return density(node) if node[0] == "p" else sum(density(k) for k in node[1])

    found = []

    def walk(node, path):
        found.append((total(node), node, path))
        for k in node[1]:
            if not isinstance(k, str) and k[0] != "a":
                walk(k, [*path, node])

    walk(page, [])
    best = max(found, key=lambda f: f[0])  # the first in page order
    threshold = min(density(n) for n in [best[1], *best[2]])
    taken = [best[1]] if best[1][0] == "body" or not best[2] else [k for k in best[2][-1][1] if k is best[1] or density(k) >= threshold]
    out = []

    def texts(node):
        if node[0] == "p":
            out.append("".join(k if isinstance(k, str) else k[1][0] for k in node[1]))
        elif not (node is not best[1] and node in taken_lists and density(node) < threshold):
            for k in node[1]:
                texts(k)

    def mostly_links(node):
        c, lc, _, _ = _measure(node)
        return node[0] == "div" and lc * 2 > c

    taken_lists = [n for _, n, _ in found if mostly_links(n)]
    for node in taken:
        texts(node)
    return "\n\n".join(out)


def test_density_alone_against_brute_force():
    rng, cut = random.Random(11), 0
    for _ in range(400):
        page = _random_page(rng)
        got = main_text(_markup(page))
        assert got == _brute_selection(page)
        cut += len(got.replace("\n", "")) < _measure(page)[0]
    assert cut > 200  # the selection decides


INSIDE = {
    "link list": f"<body><article><h1>A title</h1>{''.join(f'<p>{p}</p>' for p in P[:3])}<div>{MENU}</div>{''.join(f'<p>{p}</p>' for p in P[3:])}</article></body>",
    "advert": f"<body><article><h1>A title</h1><div><div>{''.join(f'<p>{p}</p>' for p in P)}</div></div><div><p>Buy <a href=/b>now</a></p><p><a href=/c>or later</a></p></div></article></body>",
    "teasers": f"<body><main><h1>A title</h1><div>{''.join(f'<p>{p}</p>' for p in P)}</div><div>{TEASERS}</div></main></body>",
    "nested": f"<body><article>{ARTICLE}<section><h2>Readers say</h2>{REPLIES}</section></article></body>",
    "nested in main": f"<body><main><article>{ARTICLE}{REPLIES}</article></main></body>",
    "wrapper": f"<body><article><article>{ARTICLE}</article></article></body>",
}


@pytest.mark.parametrize("name", INSIDE)
def test_selection_inside_article_or_main(name):
    """Junk without a hint, inside the element that bounds the article."""
    assert main_text(INSIDE[name]) == EXPECTED


@pytest.mark.parametrize("name", PAGES)
def test_article_only(name):
    assert main_text(PAGES[name]) == EXPECTED


def test_entities_white_space_and_blocks():
    page = "<article><p>a &amp; b&nbsp;&lt;c&gt; &#233;&#x1F600;\n\t <i>in</i>line<br>new line</p>loose text<p> </p><ul><li>one<li>two</ul></article>"
    assert main_text(page) == "a & b <c> é😀 inline new line\n\nloose text\n\none\n\ntwo"


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<script>x</script>", "<nav>only a menu</nav>", "<!-- never closed"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_odd_pages_do_not_fail():
    assert main_text("just text, no tag at all") == "just text, no tag at all"
    assert main_text("<p>one<p>two") == "one\n\ntwo"
    deep = "<div>" * 3000 + "<p>deep down there is text</p>" + "</div>" * 3000
    assert main_text(deep) == "deep down there is text"
    assert main_text("</div></p><article><p>ends first</p>") == "ends first"
    long = "word " * 200_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_all_pages_of_the_table(spark):
    """The table's pages hold one article each: its blocks, by splitting the markup with patterns."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = re.search(r"(?s)<article>(.*?)(?:</article>|$)", r.html)[1]
        blocks = re.split(r"</?(?:p|h1)>", body)
        text = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
        want = "\n\n".join(b for b in text if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_awkward_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x</p>"), (2, "u", ""), (3, "v", PAGES["semantic"])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars", "map('a', 1) AS m")
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in extract(df).collect())
    assert got == Counter([(1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1), (2, "u", "", 0), (3, "v", EXPECTED, len(EXPECTED))])
    assert extract(df.limit(0)).count() == 0
