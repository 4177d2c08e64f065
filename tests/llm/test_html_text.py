from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from panelwright.llm import html_text

TREE = html_text.fit_tree(*html_text.labelled_table())


def text(page):
    blocks, features = html_text.page_blocks(page)
    return " ".join(b for b, keep in zip(blocks, TREE.predict(features)) if keep)


def test_the_tree_fits_its_table():
    rows, labels = html_text.labelled_table()
    assert (TREE.predict(rows) == labels).all()


#: Blocks of pages that the tree has not seen, in the form of its table.
UNSEEN = """
- plain 2 2 | - plain 3 3 | + plain 6 0 | + plain 77 2 | + plain 41 0 | - plain 3 0 | - plain 7 7 | - plain 9 8 | - plain.notice 8 0
- outside.element 1 1 | + article 7 0 | + article 5 5 | + article 88 3 | - article.class 12 0 | - outside 40 0 | - outside.notice 9 0
- plain 1 1 | - plain 4 0 | - plain 5 5 | + plain 10 0 | + plain 33 3 | + plain 8 8 | + plain 54 0 | + plain 25 0 | - plain 2 0 | - plain 4 4 | - plain 5 4
- plain.class 15 0 | + plain 66 0 | + plain 14 0 | + plain 120 9 | - plain.element 12 2 | - plain 6 6 | - plain 2 2
+ plain 12 0 | + plain 49 0 | + plain 7 7 | + plain 95 4 | - plain 4 0 | - plain 8 8 | - plain 7 7 | - plain 9 9
- plain 3 3 | - plain 2 0 | - plain 3 3 | - plain 1 1 | + plain 11 0 | + plain 58 0 | + plain 21 1 | - plain 5 5
"""


def test_words_and_neighbours_decide():
    rows, labels = html_text.block_rows(UNSEEN)
    right = (TREE.predict(rows) == labels).mean()
    assert right > 0.95
    used = {html_text.FEATURES[f] for f in TREE.feature if f >= 0}
    assert {"words", "link_density", "words_after", "link_density_after"} <= used
    rng = np.random.default_rng(4)
    for group in (["words"], ["link_density"], ["words_after", "link_density_after"]):
        wrong = rows.copy()
        at = [html_text.FEATURES.index(name) for name in group]
        losses = []
        for _ in range(50):
            wrong[:, at] = rows[rng.permutation(len(rows))][:, at]
            losses.append(right - (TREE.predict(wrong) == labels).mean())
        assert np.mean(losses) > 0.01, group


def test_the_article_is_kept_and_what_is_around_it_goes_whatever_their_words():
    grid = np.array(list(itertools.product([1, 8, 30, 500], [0, 0.5, 1], [0, 8, 500], [0, 1], [0, 2, 40, 500], [0, 0.3, 1])), float)
    state = lambda *values: np.c_[grid, np.tile(values, (len(grid), 1))]
    assert TREE.predict(state(0, 0, 1, 0)).all() and TREE.predict(state(0, 0, 1, 1)).all()
    for around in [(0, 0, -1, 0), (0, 0, -1, 1), (1, 0, -1, 0), (0, 1, -1, 0), (1, 0, 1, 0), (0, 1, 1, 0), (1, 0, 0, 0), (0, 1, 0, 0)]:
        assert not TREE.predict(state(*around)).any()


LONG = "<p>" + "word " * 40 + "</p>"


@pytest.mark.parametrize("page,expected", [
    (f"{LONG}<p>Copyright 2020 Example. All rights reserved.</p>", ("word " * 40).strip()),
    (f"{LONG}<div>You may also like</div><div><a href=x>Ten tips for a garden</a></div>", ("word " * 40).strip()),
    ("<article><div class='article-social-body'><p>kept text</p></div></article>", "kept text"),
    ("<div id='share'><article><p>kept text</p></article></div>", "kept text"),
    ("<article><p>kept</p><div class='article-comments'><p>first!</p></div></article><div class='sidebar-content'>no</div>", "kept"),
    ("<aside><article><p>teaser</p></article></aside><main><p>kept</p></main>", "kept"),
    (f"{LONG}<p><a href=x>see the list</a></p>{LONG}", " ".join(["word"] * 40 + ["see the list"] + ["word"] * 40)),
])
def test_layouts(page, expected):
    assert text(page) == expected


@pytest.mark.parametrize("page,expected", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""),
    ("<nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>One  two\n three</p></article><footer>x</footer>", "Title One two three"),
    ("<article><p>a<br>b</p><p>c<b>d</b>e</p></article>", "a b cde"),
    ("<article><p>&lt;b&gt; &amp; &eacute;&#8217;&#x41; &am</article>", "<b> & é’A &am"),
    ("<article><p>kept<script>var t='</p>';</script><style>p{}</style><p>too", "kept too"),
    ("<article><p>body text</p><form><input><p>name</p></form><div class='comments'><p>first!</p></div></article>", "body text"),
    ("<header>Site</header><main><header><h1>Head</h1></header><p>Text</p></main><aside>side</aside>", "Head Text"),
    ("<article><p>see <a href='x'>this link here</a></p></article><div class='cookie-notice'>We use</div>", "see this link here"),
    ("<div class='has-sidebar'><article><p>inside</p></article></div><div id='sidebar'><p>no</p></div>", "inside"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one two a b"),
    ("<body><p>" + "word " * 60 + "</p><ul><li><a>x</a><li><a>y</a></ul></body>", ("word " * 60).strip()),
    ("<article>a < b && c</article>", "a < b && c"),
    ("<article>" + "<p><b>x" * 3 + "</article><nav>no</nav>", "x x x"),
    ("<article><div class=ad>no</div>in <span class='ad'>no</span>line</article></div></nav> after", "in line"),
    ("<article><ul><li>a<ul><li>b</ul><li>c</ul></article>", "a b c"),
    ("<!-- <article>no</article> --><article>yes</article>", "yes"),
])
def test_pages(page, expected):
    assert text(page) == expected


def test_operator(spark):
    rows = [(1, "u", "<article>Ä b</article>", "old"), (1, "u", "<article>Ä b</article>", "old"), (None, None, None, "old"),
            (2, "v", "<article>" + "x " * 200_000 + "</article>", "old")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in got.collect()), key=repr)
    assert found == sorted([(1, "Ä b", 3), (1, "Ä b", 3), (None, "", 0), (2, ("x " * 200_000).strip(), 399_999)], key=repr)
    assert html_text.main_text(df.limit(0)).collect() == []


def test_unclosed_and_unmatched_tags_cost_no_more_than_others():
    text("<article>" + "<b>" * 50_000 + "<p>x" * 50_000 + "</i>" * 50_000)
    text("<div>" * 50_000 + "</section>" * 50_000)


@pytest.mark.parametrize("page,expected", [
    ("<html><head><title>t</title><meta charset=x><body><article><p>kept</p></article></body></html>", "kept"),
    ("<head><title>t</title><script>var a</script><article><p>kept</p></article>", "kept"),
    ("<head><noscript><style>p{}</style></noscript><link href=x><main><p>kept</p></main></head><article>too</article>", "kept too"),
    ("<head><title>t</title><noscript><img src=x><body><article><p>kept</p></article>", "kept"),
    ("<head><template><p>no</p></template><title>no</title></head><body><article>kept</article>", "kept"),
])
def test_a_head_left_open_ends_where_the_page_begins(page, expected):
    assert text(page) == expected


def test_malformed_markup_is_read(spark):
    pages = [
        "<article>a b</article><![foo[ x ]]> c", "<![ x> <p>hello", "<p>x</p><!-- unfinished", "<p>x</p><!unfinished", "<p>x</p><![CDATA[ y",
        "<![if IE]><p>x</p><![endif]>", "<script><!-- s</script><p>x</p>", "<p>x</p><", "<p>x</p></", "<p>x</p><a href='", "<p>x &#xZZ; &#99999999999; y", "<",
        "<!", "<!-", "<!DOCTYPE", "<?php", "]]>", "\x00<p\x00>",
    ]
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(rows).collect()}
    assert len(got) == len(pages)
    assert (got[1], got[2], got[3], got[4], got[5], got[6]) == ("hello", "x", "x", "x", "x", "x")
    assert got[0].startswith("a b")


def test_no_bytes_stop_the_parser():
    rng = random.Random(1)
    parts = ["<!", "<![", "]]>", "<!--", "-->", "<", ">", "/", "a", "p", " ", "'", '"', "=", "&", "#", ";", "script", "x1", "[", "]", "?", "\n", "é"]
    for _ in range(3000):
        html_text.page_blocks("".join(rng.choices(parts, k=rng.randint(1, 25))))
