"""Main text of pages: templates by counting, boilerplate by meaning, any markup without a crash."""

import html as entities
import re
import time

import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import clash

from wattline.llm.html import extract_main_text, hash_subtrees, main_text, parse, template_marks

PAGES = "page_id long, url string, html string"


def text(page, templates=()):
    root = parse(page)
    hash_subtrees(root)
    return main_text(root, frozenset(templates))


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("<p>a  <b>b</b>\n c</p><p>d", "a b c\nd"),
        ("<article><h1>T</h1><p><b>x<br><p>y</article><footer>f</footer>", "T\nx\ny"),
        ("<body><nav>n</nav><main><p>m</p><aside>s</aside></main><p>out</p>", "m"),
        ("<div class='cookie-banner'>c</div><p>t</p><div id='comments'>r</div>", "t"),
        ("<p>adverb and <span class='shade'>shadows</span></p>", "adverb and shadows"),
        ("<form>f</form><script>var a='</p>';<p></script><style>p{}</style><p>t", "t"),
        ("<p>&lt;b&gt; &amp;amp; &#233;&nbsp;&eacute; &amp</p>", "<b> &amp; é é &"),
        ("<ul><li>1<li>2</ul><table><tr><td>a<td>b</table>", "1\n2\na\nb"),
        ("a < b <!-- <p>c</p> --> d", "a < b d"),
        ("<header><p>site</p></header><article><header><h1>T</h1></header>x</article>", "T\nx"),
        ("<p title='a>b'>q</p>", "q"),
        ("<script>never closed <p>x</p>", ""),
        ("", ""),
        ("plain", "plain"),
    ],
)
def test_main_text(page, wanted):
    assert text(page) == wanted


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-abp\"'= &;#1\n", max_size=60))
def test_any_text_is_read(page):
    assert "\n\n" not in text(page)
    template_marks(parse(page))


def test_recurring_subtrees_go_and_sentences_stay(spark):
    rows = []
    for i in range(8):
        box = "<div><p>Seen on every page of the site</p></div>"
        rows.append((i, f"http://a.example/{i}", f"{box}<div><p>Own {i}</p></div>"))
        rows.append((100 + i, f"http://b.example/{i}", f"<article><p>Same sentence</p><p>Own {i}</p></article>"))
    rows.append((200, "http://c.example/1", "<div><p>Seen on every page of the site</p></div>x"))
    pages = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    assert got[3] == "Own 3"
    assert got[103] == "Same sentence\nOwn 3"
    assert got[200] == "Seen on every page of the site\nx"
    few = {r.page_id: r.text for r in extract_main_text(pages, min_pages=9).collect()}
    assert few[3] == "Seen on every page of the site\nOwn 3"


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "deep<p>text"
    rows = [
        (1, None, None), (1, "http://a/", ""), (None, "u", "<p>x"), (2, "HTTP://A.b/c", "<p>y</p>" * 2000),
        (3, "http://d/", deep), (4, "http://d/", "<p>x"), (4, "http://d/", "<p>x"),
    ]
    df = clash(spark.createDataFrame(rows, PAGES))
    got = sorted((tuple(r) for r in extract_main_text(df).collect()), key=repr)
    assert len(got) == len(rows)
    assert {(r[0], r[2]) for r in got} == {
        (1, ""), (None, "x"), (2, "\n".join(["y"] * 2000)), (3, "deep\ntext"), (4, "x"),
    }
    assert all(r[3] == len(r[2]) for r in got)
    empty = extract_main_text(clash(spark.createDataFrame([], PAGES)))
    assert empty.count() == 0 and empty.columns == ["page_id", "url", "text", "n_chars"]


def test_given_pages_against_another_reading(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for row in pages.collect():
        body = row.html.split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?p>|<br>|</?h1>", re.sub("</?b>", "", body))
        lines = [" ".join(entities.unescape(x).split()) for x in parts]
        assert got[row.page_id] == "\n".join(x for x in lines if x)


def test_deep_pages_are_read_like_others():
    deep = "<header>site</header><article>" + "<span>" * 4000 + "<p>one</p><p>two</p><nav>n</nav>"
    assert text(deep) == "one\ntwo"
    assert text("<div>" * 5000 + "deep<p>text") == "deep\ntext"
    root = parse("<div>" * 5000 + "deep<div>box</div>")
    assert len(template_marks(root)) == 5001


def test_copies_of_an_article_keep_their_text(spark):
    rows = []
    for i in range(6):
        rows.append((i, f"http://copies.example/{i}", "<body><div><p>The same page</p></div></body>"))
        rows.append((10 + i, f"http://art.example/{i}", f"<nav>{i}</nav><article><div>The same text</div></article>"))
    prose = "<div><p>One article of more than ten words that stands on five of fifty pages</p></div>"
    menu = "<div><a href='/'>Front page</a></div>"
    table = "<table><tr><td>7</td></tr></table>"
    for i in range(60):
        held = prose if i < 6 else f"<p>Own text number {i}</p>" + (table if i < 11 else "")
        rows.append((100 + i, f"http://big.example/{i}", f"{menu}{held}<p>{i}</p>"))
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "The same page" and got[13] == "The same text"
    assert got[102] == "One article of more than ten words that stands on five of fifty pages\n2"
    assert got[108] == "Own text number 8\n7\n8" and got[130] == "Own text number 30\n30"


@pytest.mark.parametrize(
    "html, wanted",
    [
        ('<div class="layout has-sidebar"><p>Text of it</p></div>', "Text of it"),
        ('<article><div class="post with-comments"><p>Text of it</p></div></article>', "Text of it"),
        ('<section id="toc-and-content" class="share-enabled"><p>Text of it</p></section>', "Text of it"),
        ('<article><div class="article-header"><h1>Title</h1></div><p>Text</p></article>', "Title\nText"),
        ('<div class="article-header"><h1>Title</h1></div><p>Text</p>', "Title\nText"),
        ('<article><div class="related-work"><p>Others did so</p></div></article>', "Others did so"),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", "So x=2 holds"),
        ('<article><p>Text</p><article class="comment"><p>First!</p></article></article>', "Text"),
        ('<main><p>Text</p></main><article class="user-comment reply"><p>First!</p></article>', "Text"),
        ('<article><p>Text</p><div class="comment-list"><p>First!</p></div></article>', "Text"),
        ('<div class="sidebar-left">x</div><div id="main-menu">y</div><p>Text</p>', "Text"),
        ('<div class="site-header">Site</div><div class="ads-1">Buy</div><p>Text</p>', "Text"),
    ],
)
def test_class_words_are_weighed(html, wanted):
    assert main_text(parse(html)) == wanted


@pytest.mark.parametrize(
    "html",
    [
        "<a " * 350_000, "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000,
        "<b>" * 50_000 + "<div></div>" * 50_000, "<!" * 300_000, "<a '" * 200_000, "<script>" + "</script " * 100_000,
        "<p><b>" * 50_000 + "</p>" * 50_000,
    ],
)
def test_broken_markup_takes_linear_time(html):
    start = time.time()
    main_text(parse(html))
    assert time.time() - start < 3
