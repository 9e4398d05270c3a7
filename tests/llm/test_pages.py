"""Main texts against the marked content of the pages, read by another parser, and on pages of other makes; edge cases."""

import html
import itertools
import random
import re
import time

from chartloom.llm import pages
from chartloom.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.01"


def marked_content(page):
    """The text of the only article of a page of the given table, whose markup is known."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.DOTALL).group(1)
    inner = re.sub(r"<[^>]*\Z", "", inner)
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
    lines = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_table(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    df = QUERIES["op12_main_text"](spark, FOLDER)
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == marked_content(rows[r.page_id].html), r.page_id
        assert r.url == rows[r.page_id].url and r.n_chars == len(r.text)


def learned(spark):
    return pages.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_words_score_above_zero_and_tags_below(spark):
    w = learned(spark)
    assert w.word > 0 and w.tags and all(v < 0 for v in w.tags.values())
    assert w.tag("li") < w.tag("p") and w.tag("footer") < w.tag("b")


def test_other_pages(spark):
    w = learned(spark)
    para = "Some plain sentence of a story with enough words to stand alone."
    chrome = '<div id="cookie-notice">We use cookies on this site, and want your consent for all of them now.</div>'
    menu = '<div class="main-menu"><ul>' + "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(12)) + "</ul></div>"
    cases = [
        # no article at all: header, menu, sidebar, footer, comments around paragraphs
        (f"<body><header><h1>Site name</h1></header>{menu}{chrome}<div class=content><h2>Title here</h2><p>{para}</p><p>Short.</p><p>{para}</p></div>"
         f'<div class="sidebar-right"><p>{para} {para}</p></div><div id="comments"><p>{para}</p></div><footer>{para}</footer></body>',
         f"Title here\n{para}\nShort.\n{para}"),
        # inside an article: advert, form, script, aside, nested comments
        (f'<main><article class="post"><header><h1>A title</h1></header><p>{para}</p><div class="ad-slot">{para}</div><form><label>Mail</label><p>{para}</p></form>'
         f'<script>if (a < b) document.write("<p>no</p>")</script><aside>{para}</aside><p>The <em>e</em>nd &lt;x&gt; &#8364;&nbsp;5.</p>'
         f'<section class="comment-list"><article class="comment"><p>{para}</p></article></section></article></main>',
         f"A title\n{para}\nThe end <x> € 5."),
        (f'<form action="/"><nav>Home</nav><article><p>{para}</p></article></form>', para),
        (f'<form action="/"><div><p>{para}</p></div></form>', para),
        (f"<nav>Home<article><p>{para}</article><footer>no", para),
        ("just text &amp; more", "just text & more"),
        ("a <b>c</b>d<br>e <!-- <p>x --> f < g", "a cd e f < g"),
        (f'<body class="has-sidebar"><p>{para}<ul><li>{para}<li class="ad">two<li>{para}</ul></body>', f"{para}\n{para}\n{para}"),
        ('<p title="a > b">x</p>', "x"),
        ('<p title="never closed>words here<p>more words', "words here\nmore words"),
    ]
    for page, expected in cases:
        assert pages.main_text(page, w) == expected, page
    assert pages.main_text(cases[0][0], pages.Weights()) == cases[0][1]


def test_best_stretch_is_the_best():
    pick = random.Random(2)
    for _ in range(200):
        scores = [pick.choice([-3, -1, -0.5, 1, 2]) for _ in range(pick.randint(0, 12))]
        sums = {(i, j): sum(scores[i:j]) for i, j in itertools.combinations(range(len(scores) + 1), 2)}
        begin, end = pages.best_stretch(scores)
        best = max(sums.values(), default=0)
        assert sum(scores[begin:end]) == max(best, 0)


def test_edges(spark):
    rows = [(1, None, None), (2, "", "u"), (None, "<p>x", None), (3, "<p></p>", "u"), (3, "<p></p>", "u"), (4, "&am", "u"), (5, "<", "u"), (6, "<a hr", "u"),
            (7, "<!-- a", "u"), (8, "<script>x", "u"), (9, "</p></div>a", "u"), (10, "<P>A</P><ScRiPt>b</sCrIpT >c", "u")]
    df = spark.createDataFrame([(i, u, h, "t", 1) for i, h, u in rows], "page_id long, url string, html string, text string, n_chars int")
    w = pages.fit(df)
    assert w == pages.Weights()  # nothing is labelled
    got = sorted(((r.page_id, r.url, r.text) for r in pages.extract(df, w).collect()), key=str)
    assert got == sorted([(1, None, ""), (2, "u", ""), (None, None, "x"), (3, "u", ""), (3, "u", ""), (4, "u", "&am"), (5, "u", "<"), (6, "u", ""),
                          (7, "u", ""), (8, "u", ""), (9, "u", "a"), (10, "u", "A\nc")], key=str)
    assert pages.extract(df.limit(0), w).count() == 0


def test_time_follows_the_length():
    w = pages.Weights()
    for page in ('<a "' * 200_000, "<" * 400_000, "<b>" * 200_000 + "</i>" * 200_000, "<script>" * 100_000, "<div class='ad'>x" * 50_000 + "</b>" * 50_000,
                 "<p><b>x" * 100_000, "<!-- " * 200_000, "<textarea></x" * 60_000, "&am" * 300_000, "<p a=\"b' c='d\" " * 100_000):
        started = time.perf_counter()
        pages.main_text(page, w)
        assert time.perf_counter() - started < 6, page[:20]
