import html
import re

import pytest

from tidemark.llm import mainpage
from tidemark.llm.frames import table
from tidemark.llm.mainpage import extract, main_text

SF = "/root/testdata/sf0.01"


def test_whole_table_against_the_article(spark):
    """All pages here have one article; its text by regular expressions is the main text."""
    pages = table(spark, SF, "pages")
    out = {r.page_id: r for r in extract(pages).collect()}
    assert len(out) == pages.count()
    for r in pages.collect():
        part = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", r.html, re.S)[1]
        part = re.sub(r"</?(?:p|h1|br)>", " ", part)
        want = " ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", part)).split())
        assert out[r.page_id].text == want, r.page_id
        assert out[r.page_id].n_chars == len(want)


LONG = "A sentence of some length that tells what happened, with commas and all. "
NEWS = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body class="with-sidebar">
<header><h1>Site</h1><a href=/>home</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div id="cookie-notice">We use cookies.</div>
<div class="layout"><div class="story"><h1>Title &amp; more</h1><p>{LONG * 3}<p>Short <b>bo</b>ld&nbsp;&#233;&hellip;<br>next
   line</p><ul><li>first<li>second</ul><script>var x = "<p>no</p>";</script>
<!-- <p>no</p> --><p hidden>no</p><div class="ad">Buy!</div><p>{LONG * 2}</p></div>
<aside>{LONG}</aside><div class="sidebar"><p>{LONG}</p></div></div>
<section id="comments"><h2>Comments</h2><p>{LONG * 8}</p></section>
<form><label>Mail</label><input><textarea>no</textarea></form><footer>&copy; 2020</footer></body></html>"""


def test_a_page_without_article():
    story = " ".join(f"Title & more {LONG * 3} Short bold é… next line first second {LONG * 2}".split())
    assert main_text(NEWS) == story


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<", "<"),
        ("plain  text\n here", "plain text here"),
        ("<p>1 < 2 &amp; 3 > 2</p>", "1 < 2 & 3 > 2"),
        ("<article><p>open <b>bold<p>next", "open bold next"),
        ("<article>cut <a href=\"x", "cut"),
        ("<script>x", ""),
        ("<!-- a", ""),
        ("<article><header><h1>Head</h1></header><p>text</p><footer>by</footer></article>", "Head text"),
        ("<body><p>only</p></body>", "only"),
        ("<div></p></div></b>x", "x"),
        ("<article><p>a<table><tr><td>b<td>c<tr><td>d</table>e</article>", "a b c d e"),
        ("<ARTICLE><P CLASS=AD>no</P><P>yes</ARTICLE>", "yes"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_hostile_tables(spark):
    rows = [(1, "u", None, "n"), (1, "u", "<p>x", None), (None, None, "", ""), (2, "v", "<div>" * 5000 + "deep", "x")]
    rows += [(3, "w", "<article>" + "<p>word" * 100_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = sorted((r.n_chars, r.text[:8]) for r in extract(pages).collect())
    assert out == [(0, ""), (0, ""), (1, "x"), (4, "deep"), (499_999, "word wor")]
    assert extract(pages.limit(0)).count() == 0


PROSE = "word " * 60


@pytest.mark.parametrize("wrapper", [
    "<div class='layout has-sidebar'>{}</div>", "<div id='page-with-menu'>{}</div>", "<div class='social-sciences'>{}</div>",
    "<div class='no-popup'>{}</div>", "<div class='search-for-meaning'>{}</div>", "<section class='related-work'>{}</section>",
])
def test_a_word_in_a_wrappers_name_is_no_hint(wrapper):
    for body in ("<article><p>" + PROSE + "</p></article>", "<p>" + PROSE + "</p>"):
        assert mainpage.main_text(wrapper.format(body)) == PROSE.strip()


def test_hinted_parts_go_but_for_those_round_the_article():
    page = ("<div class='sidebar-layout'><article><p>" + PROSE + "</p></article><div class='sidebar'><p>aside " + PROSE + "</p></div>"
            "<section id='comments'><article><p>a reader says</p></article></section><div class='social-share'>share</div></div>")
    assert mainpage.main_text(page) == PROSE.strip()


def test_blocks_of_links_within_the_article_go():
    links = "<{0}>" + "".join(f"<li><a href='{i}'>another page {i}</a></li>" for i in range(8)) + "</{0}>"
    for name in ("ul", "div"):
        page = "<main><p>" + PROSE + "</p>" + links.format(name) + "<p>The <a href='x'>end</a> of it.</p></main>"
        assert mainpage.main_text(page) == PROSE + "The end of it."


def test_densities_against_a_plain_recursion():
    """Composite density by its definition, subtree by subtree."""
    import math
    import random

    for seed in range(20):
        pick = random.Random(seed)

        def make(depth):
            inner = "".join(make(depth - 1) if depth and pick.random() < 0.7 else "text " * pick.randrange(4) for _ in range(pick.randrange(4)))
            name = pick.choice(["div", "section", "span", "a", "b"])
            return f"<{name}>{inner}</{name}>"

        tree = mainpage._Tree("<body>" + "".join(make(4) for _ in range(4)) + "</body>")
        density, total, _, _ = mainpage._densities(tree)
        children = [[j for j in range(len(tree.name)) if tree.parent[j] == i] for i in range(len(tree.name))]
        own = [sum(len(t.replace(" ", "")) for t, node in tree.pieces if node == i) for i in range(len(tree.name))]

        def under(i, linked=False):
            """(characters, of them linked, tags, of them links) below a node, and its own characters."""
            linked = linked or tree.name[i] == "a"
            c, lc, t, lt = own[i], own[i] * linked, 0, 0
            for j in children[i]:
                x = under(j, linked)
                c, lc, t, lt = c + x[0], lc + x[1], t + x[2] + 1, lt + x[3] + (tree.name[j] == "a")
            return c, lc, t, lt

        def above(i):
            return i > 0 and (tree.name[i] == "a" or above(tree.parent[i]))

        page = under(0)
        share = page[1] / max(1, page[0])
        for i in range(len(tree.name)):
            c, lc, t, lt = under(i, above(i))
            want = 0.0
            if c:
                base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
                want = c / max(1, t) * max(0.0, math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / (math.log(base) if base > math.e else 1.0))
            assert density[i] == pytest.approx(want, rel=1e-6)
        for i, mine in enumerate(children):
            assert total[i] == pytest.approx(sum(density[j] for j in mine))


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(n):
        begin = time.perf_counter()
        mainpage.main_text("<div>" * n + "x" + "</section>" * n)
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.01)
