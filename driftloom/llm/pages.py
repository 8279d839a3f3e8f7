"""Main text of web pages: flat text blocks, features of each block and its neighbours, and a decision tree.

A page is read once into a flat list of blocks. Each block has its number of words and its link density, those of the blocks
before and after it, what its open containers say (its place), and what else the page has (`FEATURES`). A decision tree,
trained here on the labelled rows below, tells main text from the rest. A long text under the name of a side part (comments,
sidebars, notices, adverts, footers, forms) is main text only where the page has hardly any other.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from driftloom.llm.common import kernel

# Elements whose start or end ends a block.
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose text is never shown as text of the page.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select option datalist button textarea".split())
BOXES = BREAKS - frozenset("p h1 h2 h3 h4 h5 h6 li dt dd hr tr td th tbody thead tfoot caption legend summary".split())
SIDE_TAGS = frozenset("nav header footer aside menu dialog".split())
MAIN_TAGS = frozenset("article main".split())
# Words of class, id and role values that name a side part or the main part of a page.
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies dialog disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notification "
    "overlay pager pagination paywall popup promo promotion recommended related replies reply search share sharing sidebar signup "
    "social sponsor sponsored subscribe teaser toolbar widget".split()
)
MAIN_NAMES = frozenset("article main content post entry story articlebody".split())
# Doubtful: a main part named inside a side part, or both in one name; a form may hold a field or the whole page.
UNKNOWN_PLACE, MAIN_PLACE, SIDE_PLACE, DOUBTFUL_PLACE, FORM_PLACE, HIDDEN_PLACE = range(6)
# Elements that hold a part of a page; lists, tables and quotes belong to the part around them.
PARTS = frozenset("article aside dialog div footer form header main nav section".split())
# Words that turn a name into a remark about the page: has-sidebar is no sidebar.
REMARKS = frozenset("has with no without".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# Of a block: its words and link density, those of its neighbours, its place, the share of the page's words that its part
# holds itself (`around`), and the page's words outside side places (`elsewhere`) and share of words in main places (`main`).
# All but `words` count words outside links; densities and shares are hundredths.
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place", "around", "elsewhere", "main")


def _labelled(answer: int, place: int, around: tuple, elsewhere: tuple, main: tuple, rows: list[list[int]]) -> np.ndarray:
    """The blocks in every combination of what the page may have beside them: the context alone must not give a block away."""
    return np.array([[*row, place, *rest, answer] for row in rows for rest in product(around, elsewhere, main)])


_TEXTS = [
    [45, 0, 30, 0, 60, 0], [1, 0, 40, 0, 80, 0], [8, 0, 3, 100, 50, 0], [120, 5, 10, 0, 90, 0], [12, 50, 60, 0, 40, 0],
    [3, 0, 0, 0, 0, 0], [300, 0, 8, 0, 9, 0], [2, 100, 70, 0, 66, 0], [25, 10, 0, 0, 4, 100], [5, 0, 90, 0, 10, 0],
    [60, 0, 2, 100, 2, 100], [9, 0, 14, 0, 0, 0], [3, 0, 2, 100, 1, 100], [4, 0, 3, 50, 2, 0], [6, 0, 0, 0, 3, 100],
    [2, 0, 5, 0, 4, 0], [8, 40, 4, 100, 3, 100], [5, 0, 4, 0, 0, 0], [2, 100, 45, 0, 80, 0], [40, 30, 25, 0, 3, 100],
]
_LINK_LISTS = [
    [2, 100, 2, 100, 2, 100], [1, 100, 0, 0, 1, 100], [5, 80, 40, 0, 6, 90], [6, 100, 3, 100, 0, 0], [20, 90, 10, 80, 15, 95],
    [4, 100, 5, 100, 30, 0], [3, 100, 80, 0, 2, 100], [7, 90, 2, 0, 4, 100],
]
_LONG_TEXTS = [
    [60, 0, 50, 0, 45, 0], [110, 0, 20, 10, 15, 0], [250, 0, 6, 0, 80, 0], [45, 0, 1, 0, 70, 0], [80, 5, 0, 0, 0, 0], [50, 10, 90, 0, 2, 100],
]
_REMARKS = [
    [1, 100, 1, 100, 1, 100], [14, 0, 1, 100, 8, 0], [9, 0, 70, 0, 0, 0], [18, 0, 50, 0, 45, 0], [3, 0, 0, 0, 1, 100], [25, 20, 90, 0, 30, 0],
    [2, 0, 2, 0, 2, 0], [70, 80, 20, 10, 15, 0], [6, 100, 40, 0, 5, 100], [22, 0, 1, 100, 12, 0], [18, 60, 5, 50, 7, 0], [90, 100, 6, 0, 80, 0],
]
_SCRAPS = [
    [3, 0, 2, 100, 1, 100], [4, 0, 3, 50, 2, 0], [6, 0, 0, 0, 3, 100], [2, 0, 5, 0, 4, 0], [8, 40, 4, 100, 3, 100], [5, 0, 4, 0, 0, 0],
    [9, 0, 0, 0, 2, 100], [7, 0, 1, 100, 0, 0],
]
_SHORT_TEXTS = [
    [1, 0, 6, 0, 5, 0], [3, 0, 2, 100, 1, 100], [4, 0, 3, 50, 2, 0], [6, 0, 0, 0, 3, 100], [2, 0, 5, 0, 4, 0], [5, 0, 4, 0, 0, 0],
    [9, 0, 0, 0, 0, 0], [2, 0, 0, 0, 0, 0], [8, 40, 4, 0, 3, 0], [14, 0, 2, 0, 3, 0],
]
_PARAGRAPHS = [
    [35, 5, 3, 0, 70, 0], [90, 10, 1, 100, 2, 100], [70, 0, 0, 0, 0, 0], [40, 0, 1, 0, 1, 0], [30, 0, 2, 0, 3, 100], [24, 0, 0, 0, 4, 0],
    [33, 20, 1, 0, 2, 0], [20, 0, 45, 0, 30, 0], [16, 0, 30, 0, 25, 0], [28, 20, 31, 0, 44, 0],
]
_BETWEEN = [
    [7, 0, 60, 0, 55, 0], [6, 0, 2, 100, 80, 0], [4, 0, 38, 0, 64, 5], [5, 0, 1, 0, 47, 0], [1, 0, 0, 0, 40, 0], [1, 0, 40, 0, 50, 0],
]
_ANY = (0, 3, 15, 30, 100)
# Labelled blocks: the features in their order, then 1 for main text.
LABELLED = np.concatenate(
    [
        # paragraphs, headings and single words within the main part, whatever its size; lists of links within it
        _labelled(1, MAIN_PLACE, _ANY, (3, 12, 300, 3000), (0, 0.2, 60, 100), _TEXTS + _LONG_TEXTS),
        _labelled(0, MAIN_PLACE, _ANY, (3, 12, 300, 3000), (0, 0.2, 60, 100), _LINK_LISTS),
        # menus, headers, footers, adverts, comments, notices, also long ones, where the page has text elsewhere
        _labelled(0, SIDE_PLACE, _ANY, (12, 70, 3000), (0,), _REMARKS + _LONG_TEXTS),
        _labelled(0, SIDE_PLACE, _ANY, (3, 12, 3000), (0.2, 60), _REMARKS + _LONG_TEXTS),
        # long texts under the name of a side part, where there is nothing else
        _labelled(1, SIDE_PLACE, _ANY, (0, 3, 5), (0,), _LONG_TEXTS),
        _labelled(0, SIDE_PLACE, _ANY, (0, 3, 5), (0,), _REMARKS + _LINK_LISTS),
        # main parts inside side parts, and forms
        _labelled(0, DOUBTFUL_PLACE, _ANY, (12, 70, 3000), (0,), _TEXTS + _LONG_TEXTS + _LINK_LISTS),
        _labelled(0, DOUBTFUL_PLACE, _ANY, (3, 12, 3000), (0.2, 60), _TEXTS + _LONG_TEXTS + _LINK_LISTS),
        _labelled(1, DOUBTFUL_PLACE, _ANY, (0, 3, 5), (0,), _TEXTS + _LONG_TEXTS),
        _labelled(0, DOUBTFUL_PLACE, _ANY, (0, 3, 5), (0,), _LINK_LISTS),
        # no container that says anything: long texts and what stands between them, scraps beside the text, short texts of its part
        _labelled(1, UNKNOWN_PLACE, _ANY, (30, 300, 3000), (0, 0.2, 60), _LONG_TEXTS + _PARAGRAPHS),
        _labelled(1, UNKNOWN_PLACE, _ANY, (60, 300, 3000), (0, 0.2, 30), _BETWEEN),
        _labelled(0, UNKNOWN_PLACE, (0, 3, 15), (60, 300, 3000), (0, 0.2, 60), _SCRAPS),
        _labelled(0, UNKNOWN_PLACE, (40,), (60, 300, 3000), (60,), _SCRAPS),
        _labelled(1, UNKNOWN_PLACE, (45, 80, 100), (2, 6, 25, 300, 3000), (0, 10), _SHORT_TEXTS),
        _labelled(0, UNKNOWN_PLACE, _ANY, (0, 25, 300, 3000), (0, 0.2, 60), _LINK_LISTS),
    ]
)


@dataclass(frozen=True)
class Tree:
    """Node i asks feature[i] <= limit[i] and goes to low[i] or high[i]; a leaf has feature -1 and its answer in low."""

    feature: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return self.low[at].astype(bool)
            go = x[np.arange(len(x)), np.maximum(self.feature[at], 0)] <= self.limit[at]
            at = np.where(inner, np.where(go, self.low[at], self.high[at]), at)


def train(rows: np.ndarray = LABELLED, depth: int = 12) -> Tree:
    """Gini splits, best first feature and lowest limit on ties; a leaf answers with its majority, main text on ties."""
    nodes: list[list[float]] = []

    def impurity(y):
        p = y.mean() if len(y) else 0.0
        return len(y) * p * (1 - p)

    def grow(part, left):
        me = len(nodes)
        nodes.append([-1, 0, float(part[:, -1].mean() >= 0.5), 0])
        y = part[:, -1]
        best = (impurity(y) - 1e-9, None)
        if left and 0 < y.mean() < 1:
            for f in range(part.shape[1] - 1):
                values = np.unique(part[:, f])
                for limit in (values[:-1] + values[1:]) / 2:
                    low = part[:, f] <= limit
                    cost = impurity(y[low]) + impurity(y[~low])
                    if cost < best[0]:
                        best = (cost, (f, limit))
        if best[1]:
            f, limit = best[1]
            low = part[:, f] <= limit
            nodes[me] = [f, limit, grow(part[low], left - 1), grow(part[~low], left - 1)]
        return me

    grow(np.asarray(rows, float), depth)
    table = np.array(nodes)
    return Tree(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int))


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    place: int
    part: int  # number of the part of the page that holds the block
    alone: bool  # the place is that of the block's own element


class _Reader(HTMLParser):
    """Collects the blocks that have text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked: list[str] = []
        self.link = False
        self.open: list[tuple[str, int, int]] = []
        self.place = UNKNOWN_PLACE
        self.part, self.parts = 0, 0
        self.own: int | None = None  # place that the block's own element says
        self.silent: list[str] = []

    def end_block(self) -> None:
        if self.text:
            words = "".join(self.text).split()
            place = self.place if self.own is None else self.own
            if words and place != HIDDEN_PLACE:
                linked = min(len("".join(self.linked).split()), len(words))
                self.blocks.append(Block(" ".join(words), len(words), linked, place, self.part, self.own is not None))
        self.text, self.linked, self.own = [], [], None

    def _place(self, tag: str, attrs) -> int:
        side, main, hidden = False, tag in MAIN_TAGS or tag == "h1", False
        # a header within the main part, and a form around anything, tell nothing by that name
        silent = {"form"} if tag == "form" else {"header"} if self.place == MAIN_PLACE else set()
        for key, value in attrs:
            if key in ("class", "id", "role") and tag not in ("html", "body"):
                for one in (value or "").split():
                    names = {x.lower() for x in _NAME.findall(one)} - silent
                    if not names & REMARKS:
                        side, main = side or bool(names & SIDE_NAMES), main or bool(names & MAIN_NAMES)
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search((value or "").lower())):
                hidden = True
        if hidden or self.place == HIDDEN_PLACE:
            return HIDDEN_PLACE
        if side:
            return DOUBTFUL_PLACE if main and self.place not in (MAIN_PLACE, SIDE_PLACE) else SIDE_PLACE
        if tag in ("main", "h1"):
            return MAIN_PLACE
        if self.place in (SIDE_PLACE, DOUBTFUL_PLACE):
            return DOUBTFUL_PLACE if main else self.place
        if tag in SIDE_TAGS and not (tag == "header" and self.place == MAIN_PLACE):
            return SIDE_PLACE
        if tag == "form":
            return FORM_PLACE
        return MAIN_PLACE if main else self.place

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent.append(tag)
        elif tag in BREAKS:
            self.end_block()
            if tag in ("body", "article", "main", "div", "p"):
                self.silent = []  # a silent element that was never closed ends where the page goes on
            if tag in BOXES:
                self.open.append((tag, self.place, self.part))
                self.place = self._place(tag, attrs)
                if tag in PARTS:
                    self.parts += 1
                    self.part = self.parts
            elif attrs or tag == "h1":
                self.own = self._place(tag, attrs)
        elif tag == "a":
            self.link = True
        elif tag == "br":
            self.handle_data(" ")

    def handle_startendtag(self, tag, attrs):
        if tag in BREAKS:
            self.end_block()
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in SILENT:
            if tag in self.silent:
                del self.silent[self.silent.index(tag) :]
        elif tag in BREAKS:
            self.end_block()
            self.link = False
            if tag in BOXES:
                for i in range(len(self.open) - 1, -1, -1):
                    if self.open[i][0] == tag:
                        _, self.place, self.part = self.open[i]
                        del self.open[i:]
                        break
        elif tag == "a":
            self.link = False

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)
            if self.link:
                self.linked.append(data)


def blocks(html: str) -> list[Block]:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.end_block()
    return reader.blocks


def features(found: list[Block]) -> np.ndarray:
    words = np.array([b.words for b in found], float)
    linked = np.array([b.linked for b in found], float)
    place = np.array([b.place for b in found])
    part = np.array([b.part for b in found])
    plain = words - linked
    density = 100 * linked / np.maximum(words, 1)
    shift = lambda a, k: np.concatenate([[0], a[:-1]]) if k > 0 else np.concatenate([a[1:], [0]])
    clear = place <= MAIN_PLACE
    elsewhere = plain[clear].sum()
    main = plain[(place == MAIN_PLACE) & ~np.array([b.alone for b in found])].sum()
    held = np.bincount(part, np.where(clear, plain, 0))
    everywhere = lambda value: np.full(len(found), value)
    return np.stack(
        [
            words, density, shift(words, 1), shift(density, 1), shift(words, -1), shift(density, -1),
            np.minimum(place, DOUBTFUL_PLACE), 100 * held[part] / max(elsewhere, 1), everywhere(elsewhere), everywhere(100 * main / max(plain.sum(), 1)),
        ],
        1,
    )


def main_text(html: Column, tree: Tree | None = None) -> Column:
    """struct(text, n_blocks, n_main) of each whole page.

    White space inside a block becomes one space, blocks are trimmed and joined by one space in page order, character
    references are decoded. Null, empty and textless pages give the empty text; an empty table gives none. Pages don't depend
    on one another, so repeated rows give equal results. Nothing is capped.
    """
    tree = tree or train()

    def run(column: pa.Array) -> pa.Array:
        texts, sizes, mains = [], [], []
        for html_text in column.to_pylist():
            found = blocks(html_text) if html_text else []
            keep = tree.predict(features(found)) if found else []
            texts.append(" ".join(b.text for b, k in zip(found, keep, strict=True) if k))
            sizes.append(len(found))
            mains.append(int(sum(keep)))
        parts = [pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(mains, pa.int64())]
        return pa.StructArray.from_arrays(parts, ["text", "n_blocks", "n_main"])

    return kernel(run, "text string, n_blocks long, n_main long")(html)
