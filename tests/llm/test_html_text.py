import html
import re
import time

import pyarrow.parquet as pq
import pytest

from quillmark.llm import queries
from quillmark.llm.html_text import main_text

LONG = "The committee met on Monday, and after a long debate, it agreed to publish all of its findings, in full."
MORE = "Nobody had expected this; yet the vote was clear, and the chair, who had doubts, accepted it at once."
TAIL = "Done."
ARTICLE = f"<h1>A title</h1><p>{LONG}</p><h2>Part two</h2><p>{MORE}</p><ul><li>one</li><li>two</li></ul><p>{TAIL}</p>"
TEXT = "\n\n".join(["A title", LONG, "Part two", MORE, "one", "two", TAIL])
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul>'

# What is no article, around it or in it.
ASIDE = [
    f"<nav>{MENU}</nav>", f"<header><h1>The Paper</h1>{MENU}</header>", f"<footer><p>{LONG}</p></footer>", f"<aside><p>{MORE}</p></aside>",
    f'<div class="sidebar"><p>{LONG}</p></div>', f'<div id="cookie-notice"><p>{MORE}</p></div>', f'<div class="ad">{LONG}</div>',
    f"<form action='/s'><p>{LONG[:40]}</p><input name=q><button>Go</button></form>", f'<section class="comments"><p>{LONG}</p><p>{MORE}</p></section>',
    f'<ol class="commentlist"><li><article class="comment"><p>{LONG} {MORE}</p></article></li></ol>', "<script>if (a < b) { x = '</p>'; }</script>",
    "<style>p > a { color: red }</style>", "<!-- <p>not here</p> -->", f"<noscript><p>{LONG}</p></noscript>", f'<div role="navigation">{MENU}</div>',
    f'<div style="display: none"><p>{LONG}</p></div>', f"<div hidden><p>{LONG}</p></div>", f'<div class="ShareBar socialLinks">{MENU}</div>',
    "<select><option>one<option>two</select>", f'<div class="advert-slot">{MORE}</div>', f"<template><p>{LONG}</p></template>",
]


@pytest.mark.parametrize("part", ASIDE)
@pytest.mark.parametrize("page", [
    "<!DOCTYPE html><html><head><title>T</title></head><body>{part}<article>{text}</article>{part}</body></html>",
    "<html><body><div class='page has-sidebar'><main><article>{text}{part}</article></main>{part}</div>",
    "<body>{part}<div class='content'>{text}</div>{part}",
    "<div id='wrap'>{part}<div><div class='post'>{text}</div></div></div>",
])
def test_the_article_without_the_rest(page, part):
    if part.startswith("<header") and "{part}</article>" in page:
        part = ""
    assert main_text(page.format(text=ARTICLE, part=part)) == TEXT


def test_unmarked_parts_score_low():
    links = "".join(f'<div><a href="/{i}">Story {i}</a></div>' for i in range(20))
    page = f"<body><div class=x>{MENU}{links}</div><div class=y>{ARTICLE}</div><div class=z>Imprint</div>"
    assert main_text(page) == TEXT


def test_a_page_in_a_form():
    assert main_text(f"<body><form id=aspnet>{ARTICLE}</form></body>") == TEXT


def test_broken_markup():
    assert main_text(f"<article><p><b>Bold start.<br><p>{LONG}<p>{MORE}<li>x") == f"Bold start.\n\n{LONG}\n\n{MORE}\n\nx"
    assert main_text(f"<article><p class='a title=x>{LONG}</p></article>") == LONG
    assert main_text(f"<article><p title=\"a > b\">{LONG}</p></b></div></article><p") == LONG
    assert main_text(f"<nav><ul><li>Menu<article><p>{LONG}</p></article>") == LONG
    assert main_text(f"<p>{LONG}<!-- never closed <p>x</p>") == LONG
    assert main_text(f"<title>T<p>{LONG}</p>") == f"T\n\n{LONG}"


def test_references_and_white_space():
    page = "<article><p>a &amp; b&lt;c&gt; &eacute;&#8211;&#x2014; \n\t <i>d</i><b>e</b> &nbsp; f<br>g &amp;amp; 1 < 2</p></article>"
    assert main_text(page) == "a & b<c> é–— de f g &amp; 1 < 2"


def test_links_inside_prose_stay():
    page = f'<article><h1><a href="/x">A title</a></h1><p>See <a href="/y">this report</a>, {LONG}</p></article>'
    assert main_text(page) == f"A title\n\nSee this report, {LONG}"


@pytest.mark.parametrize("source", [None, "", " \n", "<html></html>", "<nav>Menu</nav>", "<script>x", "<!--", "<", "<p"])
def test_pages_without_text(source):
    assert main_text(source) in ("", "<")


def test_plain_text_is_one_block():
    assert main_text("just  text") == "just text"


@pytest.mark.parametrize("piece", [
    "<p>Some words, here.</p>", "<div>", "<li>", "<div class='sidebar'><article>x", '<a b="', "<a<a<", "<!--", "<b>", "</div>", "<p title='", "<td>x",
    "<span class=ad>", "=<a =", "<a href=x>y",
])
def test_time_grows_with_the_page(piece):
    def seconds(n):
        source = piece * (n // len(piece))
        start = time.process_time()
        main_text(source)
        return time.process_time() - start
    small = max(seconds(200_000), 0.02)
    assert seconds(800_000) < 12 * small


def _article(source):
    """The article of a page of the tables, by its known frame."""
    inner = re.split("</article>|<footer>", source.split("<article>")[1])[0]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", part)).split()) for part in re.split("</?(?:p|h1)>", inner))
    return "\n\n".join(block for block in blocks if block)


def test_query_equals_the_articles_of_the_pages(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/pages.parquet").to_pylist()
    got = queries.QUERIES["op11_html_extraction"](spark, sf_dir)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    wanted = {r["page_id"]: (r["url"], _article(r["html"]), len(_article(r["html"]))) for r in table}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == wanted


def test_awkward_rows(spark):
    from quillmark.llm.html_text import extract
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", f"<p>{LONG}</p>", "x", "y")] * 2 + [(None, None, None, None, None), (2, None, "", "x", None),
            (3, "u", "<p>" + "é " * 2_000_000 + "</p>", None, None)]
    got = sorted(extract(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert [tuple(r) for r in got if r["page_id"] != 3] == sorted([(1, "u", LONG, len(LONG))] * 2 + [(None, None, "", 0), (2, None, "", 0)], key=str)
    assert next(r["n_chars"] for r in got if r["page_id"] == 3) == 3_999_999
    assert extract(spark.createDataFrame([], schema)).collect() == []
