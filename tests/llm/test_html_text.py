import html
import re

import numpy as np
import pytest

from wattlake.llm import html_text
from wattlake.llm.html_text import main_text
from wattlake.llm.queries import page_text

LONG = "This is a paragraph of the article that has quite a few words in it, so that it counts."
PAGES = "page_id long, url string, html string"


def test_pages_equal_what_their_articles_say(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = page_text(spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article))
        text = "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert (r.text, r.n_chars, r.url) == (text, len(text), pages[r.page_id].url)


@pytest.mark.parametrize("beside", [
    "<nav><a href=/>Home</a> and more text in the menu of this page, which is long</nav>",
    "<header><p>{0}</p></header>", "<footer>{0}</footer>", "<aside><p>{0}</p></aside>", "<form><p>{0}</p><input></form>",
    "<div class='ad'>{0}</div>", "<div class='cookie-notice'><p>{0}</div>", "<div id='Sidebar'>{0}</div>",
    "<section class='comments'><article class='comment'><p>{0}</p></article></section>", "<div role='navigation'>{0}</div>",
    "<script>var x = '<p>{0}</p>';</script>", "<style>p {{ }}</style>", "<!-- <p>{0}</p> -->", "<noscript>{0}</noscript>",
    "<div style='display: none'>{0}</div>", "<select><option>{0}</select>", "<ul class='menu'><li>{0}<li>{0}</ul>",
])
def test_what_surrounds_an_article_goes(beside):
    other = beside.format("Other words that are no part of it, though there are as many of them as there.")
    article = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}"
    inside = [] if "<header>" in beside else [f"<article>{article}{other}</article>"]  # an article's own header is part of it
    for page in (f"{other}<article>{article}</article>{other}", f"<body>{other}<div>{article}</div>{other}</body>", *inside):
        assert main_text(page) == f"Title\n\n{LONG}\n\nShort.\n\n{LONG}", page


def test_references_white_space_and_open_elements():
    assert main_text("<article><p>a &amp; b&nbsp;&#233;\n\t c<br>d<p><b>e<p>f &am</article>") == "a & b é c d\n\ne\n\nf &am"
    assert main_text("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>x<li>y</ul></article>") == "a b\n\nc\n\nx\n\ny"
    assert main_text("<main><div><p>one</main>") == "one"
    assert main_text("a < b and <c") == "a < b and <c" or main_text("a < b and <c").startswith("a < b and")


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<nav>x</nav>", "<article></article>"])
def test_nothing_gives_nothing(page):
    assert main_text(page) == ""


def test_long_pages_are_read_in_pieces(monkeypatch):
    page = "<article>" + "".join(f"<p>{LONG} {i} &eacute;</p>" for i in range(3000)) + "</article>"
    whole = main_text(page)
    assert whole.count("\n\n") == 2999 and whole.endswith("2999 é")
    monkeypatch.setattr(html_text, "_PIECE", 17)
    assert main_text(page) == whole
    assert len(main_text("<div>" * 20_000 + "x")) == 1


def test_smoothing_and_clusters():
    values = np.array([0.0, 0, 10, 0, 0])
    smoothed = html_text.smooth(values, 1.0)
    kernel = np.exp(-0.5 * np.arange(-3, 4) ** 2)
    assert np.isclose(smoothed[2], 10 * kernel[3] / kernel[1:6].sum())
    assert 1 < html_text.two_means(np.array([0, 1, 0, 9, 10, 11.0])) < 9


def test_odd_rows_have_defined_results(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (None, "u", "<p>a</p>", "t"), (None, "u", "<p>a</p>", "t")], PAGES + ", text string")
    got = sorted((tuple(r) for r in html_text.extract_text(pages).collect()), key=repr)
    assert got == [(1, None, "", 0), (None, "u", "a", 1), (None, "u", "a", 1)]
    assert html_text.extract_text(spark.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize("sizes", [
    [200] * 6 + [3000] + [200] * 6, [400] * 6 + [2000] + [400] * 6, [300] * 5 + [900, 1000, 1200] + [300] * 5, [6000] + [200] * 8,
])
@pytest.mark.parametrize("around", ["<div>{0}</div>", "{0}", "<section><div>{0}</div></section>"])
def test_uneven_paragraphs_without_an_article_element_all_stay(sizes, around):
    paragraphs = [(f"{i} " + LONG * (size // len(LONG) + 1))[:size].strip() for i, size in enumerate(sizes)]
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(12)) + "</ul>"
    body = around.format("<h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs))
    assert main_text(f"<body>{menu}{body}<div><a href=/x>More of this</a></div></body>") == "\n\n".join(["Title", *paragraphs])


@pytest.mark.parametrize("wrapper", [
    "<div class='has-sidebar'>{0}</div>", "<div class='layout-with-nav'>{0}</div>", "<div class='page share-enabled'>{0}</div>",
    "<div id='no-sidebar'>{0}</div>", "<section class='widget-area'>{0}</section>", "<form action='/' method='post'>{0}</form>",
    "<form><div class='widget'><div class='header'>{0}</div></div></form>",
])
@pytest.mark.parametrize("article", ["<article>{0}</article>", "<main>{0}</main>", "<div>{0}</div>"])
@pytest.mark.parametrize("title", ["<h1>Title</h1>", "<h2>Title</h2>"])
def test_names_around_an_article_do_not_empty_it(wrapper, article, title):
    text = f"{title}<p>{LONG}</p><section id='related-work'><h2 id='login'>Related</h2><p>{LONG}</p></section><p>{LONG}</p>"
    page = f"<body><nav><a href=/>Home</a></nav>{wrapper.format(article.format(text))}<footer>By me</footer></body>"
    assert main_text(page) == "\n\n".join(["Title", LONG, "Related", LONG, LONG])


def test_comments_and_boxes_go_however_long_they_are():
    many = "".join(f"<div class='comment-body'><p>{LONG} {i}</p></div>" for i in range(20))
    cards = "".join(f"<article><h3>Card {i}</h3><p>{LONG}</p></article>" for i in range(4))
    for beside in (f"<section class='comments'>{many}</section>", f"<div class='related-posts'>{cards}</div>", f"<div class='ad-slot'><p>{LONG * 9}</p></div>"):
        assert main_text(f"<article><h1>Title</h1><p>{LONG}</p></article>{beside}") == f"Title\n\n{LONG}"
    assert main_text(f"<div><h1>Title</h1><p>{LONG}</p></div><section class='comments'>{many}</section>") == f"Title\n\n{LONG}"
