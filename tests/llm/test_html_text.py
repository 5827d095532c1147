import html
import re

import pytest

from stayline.llm import html_text
from stayline.llm.html_text import main_text

P = "The first paragraph, which is long enough, has commas, and says something about its subject."
Q = "Another one follows it; this one is also of a fair length, with a comma or two, as usual."


def article_of(page):
    """Brute force for the given pages: the article's blocks, cut by patterns."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))).split())
              for b in re.split("</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    got = html_text.op11_html_text(spark, sf).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(got) == len(pages) > 0
    for r in got:
        assert r.text == article_of(pages[r.page_id].html) and r.url == pages[r.page_id].url
        assert r.n_chars == len(r.text) > 0


@pytest.mark.parametrize("left_out", [
    "<nav><ul><li><a href=/a>Home, sweet home</a></li></ul></nav>", f"<header><p>{Q}</p></header>", f"<footer>{Q}</footer>",
    f"<aside><p>{Q}</p></aside>", f"<div class='sidebar left'><p>{Q}</p></div>", f"<div id=cookie-notice><p>{Q}</p></div>",
    f'<div class="ad">{Q}</div>', f"<form><p>{Q}</p><input value=x></form>", f"<script>var p = '<p>{Q}</p>';</script>",
    f"<style>p{{}} /* <p>{Q} */</style>", f"<section class='comments-area'><p>{Q}</p></section>", f"<!-- <p>{Q}</p> -->",
    f'<ol class="commentlist"><li class="comment"><p>{Q}</p></li></ol>', f"<div role=complementary><p>{Q}</p></div>",
    f"<div hidden><p>{Q}</p></div>", f"<div style='display: none'><p>{Q}</p></div>", f"<noscript><p>{Q}</p></noscript>",
    "<ul><li><a href=1>First related story</a><li><a href=2>Second story</a><li><a href=3>Third story</a></ul>",
])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div id=main-content class='content with-sidebar'>{}</div>",
                                    "<div><div><div>{}</div></div></div>"])
def test_no_article_text(left_out, around):
    body = f"<h1>Title &amp; more</h1><p>{P}</p>{{}}<p>Short.</p><p>{Q}</p>"
    want = f"Title & more\n{P}\nShort.\n{Q}"
    inside = f"<body>{around.format(body.format(left_out))}</body>"
    beside = f"<html><body class=has-sidebar>{left_out}{around.format(body.format(''))}{left_out}</body></html>"
    assert main_text(inside) == want
    assert main_text(beside) == want


def test_blocks_and_white_space():
    assert main_text("<article><p>a\n  b<br>c <b>d</b>e&nbsp;f</p>g<ul><li>h<li>i</ul><pre>j\n\tk</pre></article>") == (
        "a b c de f\ng\nh\ni\nj k")
    assert main_text("<p>one<p>two<div>three</div>four") == "one\ntwo\nthree\nfour"
    assert main_text("<table><tr><td>a<td>b<tr><td>c</table>") == "a\nb\nc"


def test_embedded_elements_leave_the_line_whole():
    assert main_text("<p>a <button>Buy <div>now</div></button> b <svg><text>x</text></svg>c<svg/> d <button>e</p><p>f") == "a b c d e\nf"
    assert main_text(f"<article><p>{P} <span class='ad'>Buy <span>this</span> now</span>end</p></article>") == f"{P} end"


def test_references():
    assert main_text("<p>&lt;b&gt; &#233;&#xe9;&eacute; &amp;amp; &am &ampx &quot &nosuch;</p>") == (
        "<b> ééé &amp; &am &x \" &nosuch;")


def test_article_in_sections():
    page = f"<main><article><section><h2>A</h2><p>{P}</p></section><section><p>Tiny.</p></section></article></main>"
    assert main_text(page) == f"A\n{P}\nTiny."
    assert main_text(f"<article><header><h1>T</h1><p class=byline>by me</p></header><p>{P}</p></article>") == f"T\n{P}"


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text(" \n ") == main_text("<nav>a</nav>") == ""
    assert main_text("just text & no tags") == "just text & no tags"
    assert main_text("a < b, 1 <2") == "a < b, 1 <2"
    assert main_text(f"<article><p>{P}<!-- never closed <p>x") == P
    assert main_text(f"<article><p>{P}<script>never closed <p>x") == P
    assert main_text('<p title="a > b">c</p><p title="unclosed>d</p>') == "c\nd"
    assert main_text("</p></div></article>x") == "x"
    assert main_text(f"<ARTICLE><P CLASS=lead>{P}</P></ARTICLE>") == P
    assert main_text("<div>" * 20_000 + P) == P


def test_long_page():
    paras = [f"{P} {i}" for i in range(20_000)]
    assert main_text("<article>" + "".join(f"<p>{p}</p>" for p in paras) + "</article>") == "\n".join(paras)


def test_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", f"<p>{P}"), (3, "u", f"<p>{P}"), (None, "v", "<p>x")]
    d = spark.createDataFrame([(*r, "extra", "old") for r in rows], "page_id long, url string, html string, chars string, text string")
    got = html_text.extract(d)
    assert got.columns == ["page_id", "url", "chars", "text"]
    assert sorted((r.page_id or 0, r.text) for r in got.collect()) == [(0, "x"), (1, ""), (2, ""), (3, P), (3, P)]
    assert html_text.extract(d.limit(0)).count() == 0
