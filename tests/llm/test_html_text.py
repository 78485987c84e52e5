import html as h
import re
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyworks.llm import html_text


def expected(page):
    """By the markup that all given pages share; the operator does not know it."""
    m = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1|li|ul|div)\b[^>]*>", m[1]) if m else []
    texts = [" ".join(h.unescape(re.sub(r"<(?!br)[^>]*>", "", b).replace("<br>", " ")).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_whole_table_equals_its_markup(spark):
    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = html_text.op5_html_text(spark, d).collect()
    assert {r.page_id: r.text for r in got} == {k: expected(v) for k, v in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)


def content(page):
    return [w for kind, text, *_ in html_text.walk(page, {}) if kind == "block" for w in text.split() if html_text.is_content(w)]


@pytest.mark.parametrize("held_out", html_text.TEMPLATES)
def test_templates_that_were_not_learnt(held_out):
    weights = html_text.learn(html_text.pages([t for t in html_text.TEMPLATES if t is not held_out]))
    hit = found = wanted = 0
    for page in html_text.pages([held_out]):
        got, want = set(html_text.extract(page, weights).split()), set(content(page))
        hit, found, wanted = hit + len(got & want), found + len(got), wanted + len(want)
    assert hit / found > 0.9 and hit / wanted > 0.9


@given(st.lists(st.integers(-6, 6)))
def test_region_equals_brute_force(scores):
    first, last = html_text.best_region([float(s) for s in scores])
    sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    assert sum(scores[first:last]) == max([0, *sums])


@pytest.mark.parametrize(
    "page, text",
    [
        ("<nav><ul><li>Home</li></ul></nav><article><p>one two three</p></article>", "one two three"),
        ("<nav><a>Home</a></nav>", ""),
        ('<nav><a>Home</a></nav><article class="post has-comments"><p>It is here now</p></article>', "It is here now"),
        ('<nav>Home</nav><div class="main-content with-sidebar"><p>It is here now</p></div>', "It is here now"),
        ('<nav>Home</nav><article class="article no-ads"><p>It is here</p></article>', "It is here"),
        ('<article><p>As the <span class="author">Jane Roe</span> said this</p></article>', "As the Jane Roe said this"),
        ('<article><p>one <span class="text">two</span> three</p></article>', "one two three"),
        ('<article><p>Body text that is long enough</p></article><div class="feedback-list"><p>I liked it very much</p></div>', "Body text that is long enough"),
        ('<article><p>First part</p><div class="ad">' + "buy now " * 400 + '</div><p>Second part</p></article>', "First part\n\nSecond part"),
        ('<article><p><a href=x>All of this is a link</a></p><p>and this is not</p></article>', "All of this is a link\n\nand this is not"),
        ('<body class="sidebar-left comments-on"><div class=zzz><p>Words of a page without a known class</p></div></body>', "Words of a page without a known class"),
    ],
)
def test_what_decides(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize("piece", ["<div>", "<div>x", "<a '", "<b>x", "</span>", "<!--", "<", "<a ", "<script>", '<a href="', "<a b='>", "<p><b>", "&", "<div class=a x=\">"])
def test_a_long_page_takes_seconds(piece):
    page = piece * (1_000_000 // len(piece))
    began = time.process_time()
    html_text.extract(page)
    assert time.process_time() - began < 5


def test_matter_to_leave_out():
    page = """<html><head><title>Site - Tale</title></head><body><header id="masthead" class="site-header"><a href=/>Home</a></header>
    <nav><ul><li><a>A</a><li><a>B</a></ul></nav><div class="cookie-banner">We use cookies a lot</div>
    <article><header><h1>A &amp; B</h1></header><p>First&nbsp;part <b>bold</b>\n text<script>var x = "<p>no</p>";</script></p>
    <div class="ad">Buy ten of these great things now please do</div><p>Second part 1 &lt; 2<br>goes on</p>
    <form><input name=q><button>Send</button></form><section class="comments"><p>I liked it</p></section></article>
    <aside class="sidebar">More <p>links</p></aside><footer>&copy; all</footer></body></html>"""
    assert html_text.extract(page) == "A & B\n\nFirst part bold text\n\nSecond part 1 < 2 goes on"


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "no markup at all", None), (4, "<p>" + "long words " * 200000, "a"), (4, "<<<>>> <a <b", "a"), (5, "<!-- open", "a"), (6, "<script>x", "a"), (7, "</div></p>" * 1000, "a")]
    got = html_text.extract_pages(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    texts = [r.text for r in got]
    assert texts[:3] == ["", "", "no markup at all"] and len(texts[3]) == 2199999 and texts[5:] == ["", "", ""]
    assert html_text.extract_pages(spark.createDataFrame([], "page_id long, html string")).count() == 0


BODY = "<h1>About the town</h1><p>The first of the paragraphs of this text</p><p>And then the second one of them</p>"
WANT = "About the town\n\nThe first of the paragraphs of this text\n\nAnd then the second one of them"
WORDS = sorted({w for words in html_text.KINDS.values() for w in words})


def test_no_class_word_loses_the_article():
    page = "<body><nav><ul><li><a>Home</a></li><li><a>News</a></li></ul></nav>{}<footer><p>All rights reserved</p></footer></body>"
    lost = [w for w in WORDS if html_text.extract(page.format(f'<article class="{w}">{BODY}</article>')) != WANT]
    lost += [w for w in WORDS if html_text.extract(page.format(f'<article class="post tag-{w}">{BODY}</article>')) != WANT]
    lost += [w for w in WORDS if html_text.extract(page.format(f'<div class="post category-{w}">{BODY}</div>')) != WANT]
    assert not lost


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<article class="post"><header class="entry-header"><h1>The Title</h1></header><div class="entry-content">{BODY}</div></article>', f"The Title\n\n{WANT}"),
        (f'<div id="post-7"><header class="entry-header"><h2>The Title</h2></header><div class="entry-content">{BODY}</div></div>', f"The Title\n\n{WANT}"),
        (f'<body><header class="site-header"><h1>The Site</h1></header><div class="entry-content">{BODY}</div></body>', WANT),
        (f'<div class="post"><h2 class="share-title">Share of wallet</h2>{BODY}</div>', f"Share of wallet\n\n{WANT}"),
        (f'<div id="kopf">Startseite Kontakt</div><div id="inhalt">{BODY}</div><div id="fuss">Impressum</div>', WANT),
        (f'<article>{BODY}<div style="display:none">Not to be seen by anybody here</div></article>', WANT),
        (f'<article>{BODY}</article><section class="comments">' + "<article class='comment'><p>I liked it so much</p></article>" * 30 + "</section>", WANT),
        (f'<article class="post">{BODY}</article><div class="comments">' + "<p>I liked it so much</p>" * 30 + "</div>", WANT),
    ],
)
def test_what_pages_do(page, text):
    assert html_text.extract(page) == text
