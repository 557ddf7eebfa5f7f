"""HTML extraction on small pages and on the given ones."""

from __future__ import annotations

import html
import re

import pytest
from pricevault.llm.html_text import extract_text, main_text

PARAS = ["First paragraph of the text, long enough to be one.", "Second paragraph with a few more words than that.", "Third and last one, as plain as the others are."]
BODY = "".join(f"<p>{x}</p>" for x in PARAS)
CASES = [
    (f"<html><body><nav><a href=1>Home</a></nav><article><h1>Title</h1>{BODY}</article><footer>(c) Us</footer></body></html>", ["Title", *PARAS]),
    (f"<body><div id=main-menu><a>x</a></div><div class='post'>{BODY}</div><div class='sidebar'>{BODY}</div><form>Search {BODY}</form>", PARAS),
    (f"<div class='cookie-notice'><p>{'We use cookies. ' * 40}</p></div><div><div>{BODY}</div></div>", PARAS),
    (f"<main><header><h1>Kept title</h1></header>{BODY}<section class='comments'><p>{'I say so. ' * 50}</p></section></main>", ["Kept title", *PARAS]),
    (f"<article>{BODY}<article class='comment'>{'Reader says. ' * 30}</article></article>", PARAS),
    ("<div><ul>" + "".join(f"<li><a href={i}>Link number {i} of many</a></li>" for i in range(30)) + f"</ul></div><div>{BODY}</div>", PARAS),
    ("<article><p>a  b\n c<br>d<p>x &amp; y &lt;z&gt; &eacute;&#233;&am</article>", ["a b c d", "x & y <z> éé&am"]),
    ("<article><p>one<script>var x='</p>'</script><style>p{}</style><!-- no > --> two</p><p>three</arti", ["one two", "three"]),
    ("<article><table><tr><td>c<td>d<tr><td>e</table><ul><li>f<li>g</ul></article>", ["c", "d", "e", "f", "g"]),
    ("<article><p>1 < 2 and 3 <4</p></article>", ["1 < 2 and 3 <4"]),
    ("plain text only", ["plain text only"]),
    ("<nav><a>only a menu</a></nav>", []),
    ("<p", []),
    ("<!-- never closed <p>x</p>", []),
    ("", []),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_small_pages(case):
    page, blocks = CASES[case]
    assert main_text(page) == "\n".join(blocks)


def test_deep_and_long_pages():
    assert main_text("<div>" * 20000 + "deep") == "deep"
    assert len(main_text("<article>" + "<p>word word</p>" * 20000 + "</article>")) == 20000 * 10 - 1
    assert main_text("<p " + "a='" * 5000) == ""


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for row in extract_text(pages.withColumnRenamed("url", "text")).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row.html, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)(?:>|$)", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", x)).split()) for x in blocks]
        assert row.text == "\n".join(x for x in blocks if x)


def test_null_and_empty_table(spark):
    kind = "page_id long, html string"
    assert [r.text for r in extract_text(spark.createDataFrame([(1, None), (None, "")], kind)).collect()] == ["", ""]
    assert extract_text(spark.createDataFrame([], kind)).collect() == []


def test_pictures_and_formulas():
    page = "<article><p>one <svg class=i/> two <math/> three</p><p>four</p></article>"
    assert main_text(page) == "one two three\nfour"
    page = "<article><p>one <svg><g><svg><text>a</text></svg><text>b</text></g></svg> two</p>"
    page += "<template><template>c</template>d</template><p>three</p></article>"
    assert main_text(page) == "one two\nthree"
    assert main_text("<article><p>one <svg><path><p>two</p><p>three</p></article>") == "one\ntwo\nthree"
    assert main_text("<article><p>a<svg><foreignObject><p>b</p></foreignObject><text>c</text></svg>d</p></article>") == "ad"


KEPT = [
    f"<body><div class='layout has-sidebar'><article>{BODY}</article></div><footer>(c) Us</footer>",
    f"<body class=x><form id='aspnetForm'><div>{BODY}</div><div class=footer>(c) Us</div></form>",
    f"<head><meta name=a><body><div>{BODY}</div>",
    f"<div class=sidebar-layout><div class=content-with-menu>{BODY}</div></div>",
    f"<div class=widget><div>{BODY}</div></div><footer>(c) Us</footer>",
]


@pytest.mark.parametrize("page", KEPT)
def test_wrappers_that_hold_the_text(page):
    assert [x for x in main_text(page).split("\n") if x in PARAS] == PARAS


def test_slugs_code_and_formulas_in_an_article():
    page = f"<article><h2 id='social-history'>History</h2>{BODY}<h2 id=disclaimer>Cookies</h2><section id='related-work'><p>Others.</p></section>"
    page += "<pre><span class='comment'># c</span> x</pre><p>so <math><mi>a</mi><mo>=</mo><annotation>tex</annotation></math>"
    page += " <object data=x><b>fallback</b></object></p><div class='related-posts'>Read on</div><section id=comments>I say</section></article>"
    assert main_text(page).split("\n") == ["History", *PARAS, "Cookies", "Others.", "# c x", "so a= fallback"]
