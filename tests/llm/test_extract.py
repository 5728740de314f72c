import html
import re
import time

import pytest
from pyspark.sql import functions as F

from fraudlake.llm.common import table
from fraudlake.llm.extract import extract_text, op5_extract
from fraudlake.llm.line_blocks import main_text

BODY = "<h1>Title &amp; more</h1><p>First  <b>bold</b>\n text.</p><p>Short.</p><p>Tea&nbsp;&#8364; 5 <a href='x'>link</a> end.<br>after</p>"
TEXT = "Title & more First bold text. Short. Tea € 5 link end. after"
LONG = "<p>" + "A sentence of the story that goes on for a while. " * 4 + "</p>"
LONG_TEXT = ("A sentence of the story that goes on for a while. " * 4).strip()


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain words only", "plain words only"),
        (f"<html><head><title>T</title></head><body><nav><ul><li>a</li></ul></nav><article>{BODY}</article><footer>f</footer></body></html>", TEXT),
        (f"<body><header>site</header><main>{BODY}<aside>side</aside></main><form><p>name</p><input></form></body>", TEXT),
        (f"<article>{BODY}<div class='ad'>buy</div><section id='comments'><p>nice!</p></section></article>", TEXT),
        (f"<article><header>{BODY}</header></article>", TEXT),
        (f"<div class='cookie-notice'>we use cookies</div><article>{BODY}", TEXT),
        (f"<nav><ul><li>never closed<article>{BODY}</article>", TEXT),
        (f"<div class='sidebar'><p>x</p></div><div class='content'>{LONG}<p>Be.</p></div><div class='footer'>y</div>", LONG_TEXT + " Be."),
        (f"<ul><li><a href=a>one</a></li><li><a href=b>two</a></li></ul><div>{LONG}</div>", LONG_TEXT),
        (f"<body class='has-sidebar'><div><article class='post comments-open'>{BODY}</article></div></body>", TEXT),
        (f"<article>{BODY}</article><section id='comments'><article><p>me too</p></article></section>", TEXT),
        (f"<main>{BODY}<article class='comment-12'><p>nice</p></article></main>", TEXT),
        (f"<nav><li>not closed<article class='post'>{BODY}</article>", TEXT),
        ("<nav>only</nav><footer>furniture</footer>", ""),
        ("<article><p>a < b and c > d &am</article>", "a < b and c > d &am"),
        ("<article><script>var t='</p><p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p></article>", "yes"),
        ("<article><p title='a > b'>in</p><p class=\"load\">reading thread</p><p", "in reading thread"),
        ("<article>" + "<p>w</p>" * 20_000 + "</article>", " ".join("w" * 20_000)),
        ("<div " + "a" * 50_000, ""),
        ("<" * 20_000, "<" * 20_000),
    ],
)
def test_pages(page, want):
    assert main_text(page) == want


def test_query_against_the_article_element(spark, sf_dir):
    def article(page):
        body = page[page.index("<article>") :].split("</article>")[0].replace("<b>", "")
        return " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", body)).split())

    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    got = op5_extract(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        want = article(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_hard_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "k0": F.lit("z")})
    got = extract_text(pages, ["page_id", "url"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, None, ""), (None, "u", ""), (2, "u", "x"), (2, "u", "x")], key=str)
    assert extract_text(pages.limit(0), ["page_id"]).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<article style='overflow:hidden'>{BODY}</article>", TEXT),
        (f"<div title='The hidden river'>{LONG}</div>", LONG_TEXT),
        (f"<article>{BODY}<div hidden>x</div><p style='color:red; visibility: hidden'>y</p><p style='display:none'>z</p></article>", TEXT),
        (f"<div class='content-with-sidebar'>{LONG}</div><div class='sidebar'><p>x</p></div>", LONG_TEXT),
        (f"<div class='right-sidebar'>{LONG}</div><div class='left-sidebar'><p>x</p></div>", LONG_TEXT),
        (f"<section class='article-ad-free'>{LONG}</section><p class='ad-slot'>x</p><ul id='related-posts'><li>y</ul>", LONG_TEXT),
        (f"<div class='elementor-widget elementor-widget-text-editor'>{LONG}</div>" * 3, " ".join([LONG_TEXT] * 3)),
        (f"<div data-id='menu' data-testid='ad'>{LONG}</div>", LONG_TEXT),
        (f"<form id='page'><div class='menu'>m</div><div>{LONG}</div></form>", LONG_TEXT),
        (f"<div class='ad'>{LONG}</div><article>{BODY}</article>", TEXT),
        (f"<div>{LONG}</div><section class='comments'>{LONG * 5}</section>", LONG_TEXT),
    ],
)
def test_marks_are_whole_words_of_parsed_attributes(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<div>{LONG}<div class=ad>x</div><p>Short closing line.</p></div>", LONG_TEXT + " Short closing line."),
        (f"<div><h1>Title</h1><div class=share>x</div>{LONG}</div><div><p>Else.</p></div>", "Title " + LONG_TEXT + " Else."),
        (f"<div>{LONG}<p><a href=a>one link</a></p><p>End.</p></div>", LONG_TEXT + " one link End."),
        (f"<div>{LONG}</div><div class=ad>x</div><div>End.</div>", LONG_TEXT + " End."),
        (f"<div>{LONG * 2}</div><div class=ad>x</div><div><p>Beside</p><p>it.</p></div>", LONG_TEXT + " " + LONG_TEXT),
        (f"<div class='ad'>{LONG}</div><article><h1>Head.</h1><p>Short.</article>", "Head. Short."),
        (f"<div>{LONG * 2}</div><nav>n</nav><article><p>A teaser.</p></article>", LONG_TEXT + " " + LONG_TEXT),
        (f"<main>{LONG}</main><div><p>Beside it.</p></div>", LONG_TEXT),
        ("<p>Short.</p><p><a href=a>link</a></p><p>End.</p>", "Short. link End."),
        ("<ul><li><a href=a>one</a></li></ul>", ""),
        ("<div><p>w</p>" * 20_000, " ".join("w" * 20_000)),
    ],
)
def test_windows_bound_one_region_per_container(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</span>" * 70_000, "<svg>" * 200_000, "<div><svg>a</p>" * 70_000, "</div>" * 170_000])
def test_a_megabyte_of_broken_markup_takes_a_second(page):
    start = time.perf_counter()
    main_text(page + "<p>The end.</p>")
    assert len(page) > 900_000 and time.perf_counter() - start < 5


def test_windows_decide_without_names(spark):
    """The given pages without article, nav, footer and other names, and without class, id and role."""
    pages = [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    plain = [re.sub(r"<(/?)(article|main|nav|aside|footer|header|form)\b", r"<\1div", p) for p in pages]
    plain = [re.sub(r"""\s(class|id|role)=("[^"]*"|'[^']*'|[^\s>]+)""", "", p) for p in plain]
    same = sum(main_text(a) == main_text(b) for a, b in zip(plain, pages))
    assert same >= 0.95 * len(pages)
