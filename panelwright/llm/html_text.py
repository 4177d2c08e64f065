"""Main text of web pages: flat text blocks, classified by a decision tree trained on a small labelled table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from panelwright.llm.tables import read

# Element names and class words as pages use them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output progress q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset(
    "script style noscript template head title textarea select option button svg math iframe object canvas audio video".split()
)
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form dialog menu fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices popup modal overlay newsletter subscribe subscription signup login sidebar widget related recommended"
    " share sharing social comment comments reply replies respond discussion disqus menu navbar nav navigation breadcrumb"
    " breadcrumbs pagination pager footer header masthead topbar toolbar copyright disclaimer".split()
)
#: Words before a class word that make it a statement about a layout (``has-sidebar``).
LAYOUT_WORDS = frozenset("has with no without is not".split())
#: First and last words of a class word that names a part of the article, whatever stands between them (``article-social-body``).
ARTICLE_WORDS = frozenset("article body content entry main post story text".split())
#: Beginnings and phrases of notices of rights.
NOTICES = ("©", "(c) ", "copyright ")
RESERVED = "all rights reserved"
#: Elements that end an open element of the same row.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}

#: Elements that leave an open head open; any other, and text, ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())

FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "element", "class_word", "place", "notice",
]


@dataclass
class Block:
    """A run of text between two block borders."""

    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    #: In an element that is never an article; under a class word of boilerplate; in the article.
    element: bool = False
    classed: bool = False
    main: bool = False

    @property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


class Blocks(HTMLParser):
    """The flat text blocks of one page, in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        #: Open elements, but for inline ones that change nothing: name, unseen, element, classed, main.
        self.open: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
        self.names: Counter[str] = Counter()
        self.in_link = False
        self.current: Block | None = None

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![`` begins no section in HTML: like any unknown declaration it is a comment up to the next ``>``."""
        return self.parse_bogus_comment(i)

    def close(self) -> None:
        # a comment or declaration that is not closed goes to the end of the page
        if self.cdata_elem is None and self.rawdata.startswith("<!"):
            self.rawdata = ""
        super().close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.in_link = True
        inline = tag in INLINE
        self.end_head(tag)
        if not inline:
            self.current = None
            self.end_implied(tag)
        if tag in VOID or (inline and not attrs):
            return
        before = self.open[-1][1:]
        unseen, element, classed, main = before
        is_main = tag in MAIN or any(n == "role" and v == "main" for n, v in attrs)
        unseen = unseen or tag in UNSEEN
        element = element or (tag in ASIDE and not (tag == "header" and main)) or any(
            n == "role" and v in ASIDE_ROLES for n, v in attrs
        )
        if is_main and not main:
            # classes of the article and of what holds it are about the layout
            classed = False
        elif tag not in ("html", "body"):
            classed = classed or has_aside_word(attrs)
        state = (unseen, element, classed, main or is_main)
        if inline and state == before:
            return
        if state != before:
            self.current = None
        self.open.append((tag, *state))
        self.names[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.current = None

    def close_element(self, name: str) -> None:
        """Close the innermost open element of a name and all in it."""
        before = self.open[-1][1:]
        while (inner := self.open.pop()[0]) != name:
            self.names[inner] -= 1
        self.names[name] -= 1
        if self.open[-1][1:] != before:
            self.current = None

    def end_implied(self, tag: str) -> None:
        """A block ends an open paragraph, an item or cell ends the one before it."""
        ends = CLOSES.get(tag, frozenset()) | {"p"}
        while (name := self.open[-1][0]) in ends or (name in INLINE and any(self.names[e] for e in ends)):
            self.close_element(name)

    def end_head(self, tag: str) -> None:
        """What cannot stand in a head ends one that was left open, but for what is in an element of it; a body ends it anyway."""
        if not self.names["head"] or tag in IN_HEAD:
            return
        if self.open[-1][0] in ("head", "title") or (tag == "body" and not self.names["template"]):
            self.close_element("head")

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        elif tag not in INLINE:
            self.current = None
        if self.names[tag]:
            self.close_element(tag)

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] == "head" and not data.isspace():
            self.close_element("head")
        _, unseen, element, classed, main = self.open[-1]
        if unseen:
            return
        if self.current is None:
            if data.isspace():
                return
            self.current = Block(element=element, classed=classed, main=main)
            self.blocks.append(self.current)
        self.current.pieces.append(data)
        if self.in_link:
            self.current.linked.append(data)


def has_aside_word(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether a class or an id names boilerplate, and neither a layout nor a part of the article."""
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.lower().split():
                parts = token.replace("_", "-").split("-")
                inside = parts[0] in ARTICLE_WORDS and parts[-1] in ARTICLE_WORDS
                if parts[0] not in LAYOUT_WORDS and not inside and not ASIDE_WORDS.isdisjoint(parts):
                    return True
    return False


def is_notice(text: str) -> bool:
    start = text[:200].lower()
    return start.startswith(NOTICES) or RESERVED in start


def page_blocks(html: str | None) -> tuple[list[str], np.ndarray]:
    """Texts and features of a page's blocks.  A null page has none."""
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    blocks = [(b, b.text) for b in parser.blocks]
    blocks = [(b, text) for b, text in blocks if text]
    texts = [text for _, text in blocks]
    words = np.array([len(text.split()) for text in texts], float)
    linked = np.array([len("".join(b.linked).split()) for b, _ in blocks], float)
    density = linked / np.maximum(words, 1)
    has_main = any(b.main and not (b.element or b.classed) for b, _ in blocks)
    before, after = (lambda x: np.r_[0.0, x[:-1]] if len(x) else x), (lambda x: np.r_[x[1:], 0.0] if len(x) else x)
    columns = [
        words, density, before(words), before(density), after(words), after(density),
        np.array([b.element for b, _ in blocks], float),
        np.array([b.classed for b, _ in blocks], float),
        np.array([(1 if b.main else -1) if has_main else 0 for b, _ in blocks], float),
        np.array([is_notice(text) for text in texts], float),
    ]
    return texts, np.stack(columns, axis=1) if texts else np.empty((0, len(FEATURES)))


#: The labelled table: blocks of invented pages of several layouts, one page a line; ``+`` marks main text.
#: A block is its label, its place, its words and its linked words.  Places: ``article``, ``outside`` of the page's article,
#: ``plain`` (a page without one), each with ``.element`` (navigation, footer, ...), ``.class`` (a class word) or ``.notice``.
LABELLED = """
- outside.element 1 1 | - outside.element 1 1 | - outside.class 9 0 | + article 8 0 | + article 41 0 | + article 120 2 | - outside.element 14 0
- outside.element 3 3 | - outside.class 25 0 | + article 5 0 | + article 1 0 | + article 300 0 | + article 3 3 | + article 17 4 | - outside.class 60 2
- outside 12 0 | + article 9 0 | + article 2 0 | + article 75 0 | - outside.class 80 1 | - outside 45 0 | - outside 30 0 | - outside 6 6
- outside 2 2 | - outside 150 0 | + article 12 0 | + article 33 33 | + article 4 0 | - article.element 5 0 | - outside 40 3 | - outside.notice 8 1
+ article 2 0 | + article 1 0 | - outside 1 0 | - outside 500 0 | + article 6 0 | + article 650 20 | - outside.class 700 0 | - outside.notice 6 0
+ article 6 6 | + article 1 1 | + article 2 2 | + article 90 0 | + article 4 4 | + article 5 5 | - article.class 1 0 | + article 14 0
+ article 3 0 | + article.notice 9 0 | + article 11 0 | - article.class 60 0 | - article.class 6 6 | + article 22 22 | - article.element 3 2
+ article 7 0 | + article 3 3 | + article 1 1 | + article 8 8 | + article 12 12 | + article 2 2 | + article 30 15 | + article.notice 4 0 | + article.notice 40 3
+ article 40 0 | + article 1 1 | + article 2 2 | + article 1 1 | + article 9 9 | + article.notice 6 6 | + article 26 18 | + article 60 60 | + article 1 0
+ article 5 5 | + article 2 1 | + article 3 2 | + article 18 9 | + article 7 7 | + article 200 110 | + article 4 4 | + article.notice 11 1 | + article 2 2
- outside 30 6 | - outside 45 9 | - outside 5 5 | - outside 60 30 | - outside 4 4 | - outside 50 0 | - outside 90 50 | - outside 40 40 | + article 30 0
- outside 8 8 | - outside 40 12 | - outside 7 2 | - outside 80 0 | + article 50 0 | - outside 28 20 | - outside 33 0 | - outside 6 6 | - outside 35 10 | - outside.notice 30 3
- plain 3 3 | - plain 6 0 | - plain 40 38 | - plain 30 28 | + plain 45 12 | + plain 8 0 | + plain 60 15 | + plain 50 0 | + plain 4 4 | + plain 37 9 | + plain 29 0
+ plain 12 0 | + plain 80 20 | + plain 3 3 | + plain 90 0 | + plain 34 4 | - plain 5 0 | - plain 27 27 | - plain 35 33 | - plain 8 8
- article.class 2 2 | - article.class 30 0 | + article 8 8 | + article 70 0 | - article.class 7 7 | - article.class 16 0 | - article.class 250 4 | + article 6 5
- article.element 6 6 | - article.element 40 0 | + article 2 2 | + article 35 0 | - article.element 2 0 | - article.element 120 3 | - article.element 5 5
- article.element 18 0 | + article 4 0 | + article 3 3 | - article.class 3 0 | + article 90 0 | - article.class 45 1 | - article.element 70 0 | - article.element 1 1
- plain.element 60 0 | - plain.element 4 0 | + plain 10 0 | + plain 75 0 | + plain 50 1 | - plain.element 33 0 | - plain.element 200 5 | - plain.element 16 0
- plain.class 20 0 | - plain.class 65 2 | + plain 6 0 | + plain 110 0 | + plain 20 0 | - plain.class 48 0 | - plain.class 8 0 | - plain.notice 15 0 | - plain.notice 30 1
- plain.element 2 2 | - plain.element 2 2 | + plain 9 0 | + plain 52 0 | + plain 4 0 | - plain.element 25 3 | - plain.class 31 0 | - plain.class 140 0
- plain 1 1 | - plain 2 2 | - plain 1 1 | + plain 7 0 | + plain 90 1 | + plain 64 0 | + plain 12 0 | + plain 55 0 | - plain 4 4 | - plain.notice 7 0
- plain 3 3 | - plain 5 5 | + plain 9 0 | + plain 130 6 | + plain 22 0 | + plain 48 0 | - plain 2 0 | - plain 6 6 | - plain 1 1 | - plain.notice 5 0
- plain.class 4 0 | + plain 35 0 | + plain 3 0 | + plain 18 2 | + plain 200 0 | - plain.class 110 0 | - plain.element 7 7 | - plain 3 0 | - plain 3 3
- plain 2 2 | - plain 8 8 | - plain 1 0 | - plain 2 2 | + plain 15 0 | + plain 28 0 | + plain 6 0 | + plain 70 1 | - plain 4 0 | - plain 10 9 | - plain 2 2
+ plain 11 0 | + plain 2 0 | + plain 1 0 | - plain.class 3 0 | + plain 400 0 | + plain 5 0 | - plain.class 1 0 | - plain.notice 12 0
+ plain 8 0 | + plain 44 0 | + plain 6 6 | + plain 61 2 | + plain 38 0 | + plain 9 9 | + plain 80 0 | - plain 3 0 | - plain 5 5 | - plain 7 7 | - plain 6 6
- plain 1 1 | - plain 1 1 | - plain 1 0 | - plain 1 1 | + plain 10 0 | + plain 72 0 | + plain 5 5 | + plain 33 0 | - plain 4 0 | - plain 9 9 | - plain 8 8
- plain 2 2 | + plain 6 0 | + plain 24 0 | + plain 31 8 | + plain 12 12 | + plain 40 0 | + plain 19 0 | - plain 2 0 | - plain 4 3 | - plain 12 11 | - plain.notice 20 2
+ plain 1 0
+ plain 30 0 | + plain 2 0 | + plain 3 0 | + plain 1 0
+ plain 60 0 | - plain 1 1 | - plain 1 1
+ plain 9 0 | + plain 55 0 | + plain 12 0 | - plain 1 1 | - plain 2 2 | - plain 6 0 | - plain 9 9
+ plain 40 0 | + plain 11 0 | - plain 3 3 | - plain 3 3
"""


def block_rows(table: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of a labelled table."""
    features, labels = [], []
    for line in table.strip().splitlines():
        blocks = [block.split() for block in line.split("|")]
        words = [float(b[2]) for b in blocks]
        density = [float(b[3]) / float(b[2]) for b in blocks]
        for i, (label, place, _, _) in enumerate(blocks):
            neighbours = [
                words[i - 1] if i else 0, density[i - 1] if i else 0,
                words[i + 1] if i + 1 < len(blocks) else 0, density[i + 1] if i + 1 < len(blocks) else 0,
            ]
            where, _, what = place.partition(".")
            inside = {"article": 1.0, "outside": -1.0, "plain": 0.0}[where]
            features.append([words[i], density[i], *neighbours, float(what == "element"), float(what == "class"), inside, float(what == "notice")])
            labels.append(label == "+")
    return np.array(features), np.array(labels)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled blocks."""
    return block_rows(LABELLED)


@dataclass
class Tree:
    """A fitted decision tree as arrays: children and a threshold for each node, -1 as feature of a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), int)
        while (inner := self.feature[node] >= 0).any():
            at = np.flatnonzero(inner)
            n = node[at]
            node[at] = np.where(rows[at, self.feature[n]] <= self.threshold[n], self.low[n], self.high[n])
        return self.share[node] > 0.5


def fit_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 9, least: int = 2) -> Tree:
    """A classification tree by the Gini index; ties go to the first feature and the lowest threshold."""
    nodes: list[list[float]] = []

    def impurity(y: np.ndarray) -> float:
        return len(y) * y.mean() * (1 - y.mean()) if len(y) else 0.0

    def grow(x: np.ndarray, y: np.ndarray, level: int) -> int:
        here = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(y.mean())])
        found = (impurity(y) - 1e-9, None)
        if level < depth and 0 < y.mean() < 1:
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    left = x[:, f] <= cut
                    if min(left.sum(), (~left).sum()) >= least:
                        cost = impurity(y[left]) + impurity(y[~left])
                        if cost < found[0] - 1e-12:
                            found = (cost, (f, cut))
        if found[1] is not None:
            f, cut = found[1]
            left = x[:, f] <= cut
            nodes[here][:4] = [f, cut, grow(x[left], y[left], level + 1), grow(x[~left], y[~left], level + 1)]
        return here

    grow(rows, labels.astype(float), 0)
    columns = np.array(nodes).T
    return Tree(columns[0].astype(int), columns[1], columns[2].astype(int), columns[3].astype(int), columns[4])


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """The columns of ``pages``, but with ``text`` and ``n_chars`` in place of ``html``.

    Each page is cut into flat text blocks at the borders of block elements.  A
    block is described by its words, its link density, those of its neighbours,
    whether it stands in an element that is never an article, under a class word
    of boilerplate, inside or outside the page's article, and whether it is a
    notice of rights; the tree decides which blocks are main text.  Character
    references are decoded, white space inside a block becomes one space, and
    blocks are joined by one space.

    Null and empty pages, and pages without main text, give an empty text;
    markup of any form is read, comments and declarations without end go to the
    end of the page.
    Rows are handled one by one, so repeated rows stay and no rows give none; an
    input column named ``text`` or ``n_chars`` is replaced.
    """
    tree = fit_tree(*labelled_table())
    kept = [f for f in pages.schema.fields if f.name not in (html, "text", "n_chars")]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [page_blocks(page) for page in batch[html]]
            every = np.concatenate([features for _, features in parsed]) if parsed else np.empty((0, len(FEATURES)))
            chosen = iter(tree.predict(every).tolist())
            texts = [" ".join([t for t in blocks if next(chosen)]) for blocks, _ in parsed]
            yield batch[[f.name for f in kept]].assign(text=texts, n_chars=[len(t) for t in texts])

    schema = StructType([*kept, StructField("text", StringType()), StructField("n_chars", LongType())])
    return pages.select(*[f.name for f in kept], html).mapInPandas(extract, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
