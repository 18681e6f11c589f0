"""Main text of pages."""

import os
import random
import re
import time
from html import unescape

import pandas as pd
import pytest

from landledger.llm import extraction
from landledger.llm.extraction import main_text

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
BODY = ("First paragraph, with some, commas and a reasonable amount of text in it.",
        "Second one, also long enough to be a paragraph, indeed.")
PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>
<div id="cookie-notice"><p>We use cookies, yes, really, to improve, your experience here.</p></div>
<header><h1>Site</h1></header><div class="menu"><a href=x>Home</a></div>
{open}<h2>Title &eacute;</h2><p>{0}<p>{1}<ul><li>item one<li>item two</ul>{close}
<div class="sidebar"><p>Sidebar text, that is long, with commas, and more, and more text.</p></div>
<div class="ad-box"><p>Buy this, and that, and everything else, now, at once, for money.</p></div>
<div id="comments"><p>Nice post, really, I liked it, a lot, thanks for sharing this.</p></div>
<form><p>Subscribe, please, to this, newsletter here now, it is free.</p></form>
<script>var x = "</p><p>not, a, paragraph, at, all, but, code";</script>
<footer><p>All rights, and so on, reserved, by us, the owners, of this.</p></footer>"""
TEXT = f"Title é {BODY[0]} {BODY[1]} item one item two"


@pytest.mark.parametrize("open_,close", [
    ("<article>", "</article>"), ("<main><div>", "</div></main>"),
    ("<div class='wrap'><div class='post-content'>", "</div></div>"), ("<section>", "</section>")])
def test_container_is_found(open_, close):
    assert main_text(PAGE.format(*BODY, open=open_, close=close)) == TEXT


def test_sections_of_an_article_are_kept_whole():
    parts = "".join(f"<section><h3>S{i}</h3><p>{BODY[i % 2]}</p><p>Ok.</p></section>"
                    for i in range(4))
    text = main_text(f"<body><nav><a>x</a></nav><article>{parts}</article></body>")
    assert text == " ".join(f"S{i} {BODY[i % 2]} Ok." for i in range(4))


@pytest.mark.parametrize("html,text", [
    ("", ""), ("plain text", "plain text"), ("<p>a", "a"), ("<<<>>>", "<<<>>>"),
    ("<p>a&amp;b &lt;c&gt; &#233;&nbsp;d</p>", "a&b <c> é d"), ("<p>a<b>b</b>c<br>d</p>", "abc d"),
    ("<p>one</p><!-- <p>two</p> --><p>three", "one three"), ("<p>cut <a href='x", "cut"),
    ("<nav><p>only a menu, with, commas, in it, and more</p></nav>", ""),
    ("<div class='main-nav'><p>no</p></div><div class='content has-sidebar'><p>yes</p></div>", "yes"),
    ("<article><div class='entry-header'><h1>t</h1></div><p>x</p><div class='post-footer'>no</div>"
     "<p class='notice'>no</p></article>", "t x"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes")])
def test_small_pages(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("part", ["<div>", "<p>x", "<nav>", "<a '", "<b>x", "</i>", "&", "<li>x"])
def test_long_strange_pages_end(part):
    main_text(part * 30_000)


def test_articles_of_the_sample(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    got = dict(extraction.report(spark.read.parquet(f"{SF}/pages.parquet"))
               .select("page_id", "text").collect())
    for number, html in zip(pages.page_id, pages.html):
        article = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)[1]
        blocks = re.split(r"</?p>|<br>|</?h1>", re.sub(r"<[^>]*\Z", "", article))
        lines = [" ".join(unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
        assert got[number] == " ".join(x for x in lines if x)


def test_awkward_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, None, "m"), (1, "u", "", "m"), (None, "u", "<p>x</p>", None)],
        "page_id long, url string, html string, main string")
    rows = sorted((tuple(r) for r in extraction.report(pages).collect()), key=repr)
    assert rows == [(1, "u", "", 0), (1, None, "", 0), (None, "u", "x", 1)]
    assert extraction.report(pages.where("false")).count() == 0
    assert extraction.extract(pages, out="text").columns == [*pages.columns, "text"]


@pytest.mark.parametrize("part,text", [
    ("<h2>Sources</h2><ul><li><a href=a>One book</a><li><a href=b>Two books</a></ul>",
     "Sources One book Two books"),
    ("<h2 id='related-work'>Related work</h2>", "Related work"),
    ("<h1 class='page-header'>Title</h1>", "Title"),
    ("<section id='discussion'><h2>Discussion</h2><p>Text.</p></section>", "Discussion Text."),
    ("<p id='social-impact'>Text.</p>", "Text."),
    ("<div class='related discussion'><p>Text.</p></div>", "Text."),
    ("<pre>x = 1 <span class='hljs-comment'># one</span></pre>", "x = 1 # one"),
    ("<p title='the hidden valley'>Text.</p>", "Text."),
    ("<p class='md:flex hidden lg:block'>Text.</p>", "Text."),
    ("<p hidden=''>No.</p><p class=a hidden>No.</p><p style='display:none'>No.</p>", ""),
    ("<nav><ul><li><a href=a>No</a></ul></nav><ul class='menu'><li><a href=a>No</a></ul>", ""),
    ("<div id='comments'><p>No.</p></div><div class='ad-box'>No.</div><div class='comment'>No</div>",
     "")])
@pytest.mark.parametrize("around", ["article", "main"])
def test_nothing_else_of_an_article_is_dropped(around, part, text):
    html = f"<body><{around}><p>{BODY[0]}</p>{part}<p>{BODY[1]}</p></{around}></body>"
    assert main_text(html) == " ".join(x for x in (BODY[0], text, BODY[1]) if x)


def test_attributes_and_headings_outside_an_article():
    page = (f"<div><h2 id='related-work'>Related work</h2><p title='a hidden valley'>{BODY[0]}</p>"
            f"<p hidden>No, not this, it is hidden, as one sees.</p><p>{BODY[1]}</p></div>")
    assert main_text(page) == f"Related work {BODY[0]} {BODY[1]}"


LONG = "".join(f"<p>{BODY[i % 2]}</p>" for i in range(6))
LONG_TEXT = " ".join(BODY[i % 2] for i in range(6))
BESIDE = ("<nav><a href=x>Home</a></nav><div class='sidebar'><p>Read this too, and that, and more, "
          "now.</p></div><footer><p>All rights, and so on, reserved, by us, here.</p></footer>")


@pytest.mark.parametrize("open_,close", [
    ("<form id=aspnetForm>", "</form>"), ("<div class='layout sidebar-right'>", "</div>"),
    ("<div class='social-science'>", "</div>"), ("<div id='post-widget-theory'>", "</div>"),
    ("<form><div class='page with-menu-left'><div id='related-stories-x'>", "</div></div></form>"),
    ("<fieldset>", "</fieldset>")])
@pytest.mark.parametrize("inner", ["{}", "<div>{}</div>", "<article>{}</article>"])
def test_frames_with_names_of_other_parts(open_, close, inner):
    page = f"<body>{open_}{inner.format(LONG)}{BESIDE}{close}</body>"
    assert main_text(page) == LONG_TEXT


@pytest.mark.parametrize("mark", ["class='comments'", "id=comments", "class='widget social'",
                                  "role=search", "hidden", "class='post-comments'"])
def test_marked_parts_stay_out_beside_an_article(mark):
    text = "<p>Nice, really, I liked it, a lot, thanks for sharing this.</p>" * 3
    assert main_text(f"<body><div>{LONG}</div><div {mark}>{text}</div></body>") == LONG_TEXT


@pytest.mark.parametrize("part,text", [
    ("<p>We know <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here.</p>", "We know x=2 here."),
    ("<p class='social'>Text.</p>", "Text."), ("<div class='promotion'><p>Text.</p></div>", "Text.")])
def test_parts_of_an_article_that_were_lost(part, text):
    assert main_text(f"<article>{LONG}{part}</article>") == f"{LONG_TEXT} {text}"


def test_short_blocks_and_lists_of_links_outside_an_article():
    assert main_text(f"<body><div><div>{LONG}</div><div><p>The end.</p></div></div></body>"
                     ) == f"{LONG_TEXT} The end."
    links = "<ul><li><a href=a>One book</a><li><a href=b>Two books</a></ul>"
    assert main_text(f"<body><div>{LONG}<h2>Sources</h2>{links}</div></body>"
                     ) == f"{LONG_TEXT} Sources One book Two books"
    assert main_text(f"<body><div>{links}{LONG}</div></body>") == LONG_TEXT


@pytest.mark.parametrize("part", ["<div class=a>", "<div id=b><p>x, y</p>", "<b class=note>",
                                  "<div class='x sidebar-y'>", "<article class=z>"])
def test_deep_pages_with_classes_take_linear_time(part):
    start = time.perf_counter()
    main_text(part * 100_000)
    assert time.perf_counter() - start < 20


def plain_tree(rng, depth=0):
    """A small tree as nested lists: tag and children."""
    if depth == 4 or rng.random() < 0.3:
        return ["p", "word, " * rng.randint(1, 30) + "end"]
    return ["div", *(plain_tree(rng, depth + 1) for _ in range(rng.randint(1, 4)))]


def written(tree):
    inner = "".join(x if isinstance(x, str) else written(x) for x in tree[1:])
    return f"<{tree[0]}>{inner}</{tree[0]}>"


def brute(tree):
    """Main text of such a tree by the definition: every pair of a paragraph and an
    element around it, looked at anew."""
    elements = []  # (path, tree)

    def walk(node, path):
        elements.append((path, node))
        for i, child in enumerate(node[1:]):
            if not isinstance(child, str):
                walk(child, (*path, i))
    walk(["html", tree], ())
    def text(node):
        return " ".join(c if isinstance(c, str) else text(c) for c in node[1:])

    def value(path):
        total = 0.0
        for other, node in elements:
            if node[0] == "p" and len(node[1]) >= 25 and other[:len(path)] == path != other:
                level = len(other) - len(path)
                points = 1 + node[1].count(",") + min(len(node[1]) // 100, 3)
                if level <= 5:
                    total += points / (1 if level == 1 else 2 if level == 2 else 3 * level)
        return total
    best = max(elements, key=lambda e: value(e[0]))[0]  # the first of equal ones
    if value(best) <= 0 or not best:
        return text(tree)
    least = max(3.0, 0.2 * value(best))
    return " ".join(text(node) for path, node in elements if len(path) == len(best)
                    and path[:-1] == best[:-1] and (path == best or value(path) >= least
                                                    or node[0] == "p" or "p" in str(node)))


def test_equals_a_plain_scorer_on_small_trees():
    rng = random.Random(11)
    for _ in range(300):
        tree = ["div", *(plain_tree(rng) for _ in range(rng.randint(1, 4)))]
        assert main_text(written(tree)) == brute(tree), written(tree)
