"""HTML extraction (3): flat text blocks, described by their word count and link
density and those of their neighbours, classified by a decision tree that is
trained on a small labelled table.

A page is cut into flat blocks at block-level tags.  Scripts, styles, comments,
the head, form controls and hidden elements give no text.  Besides the counts, a
block tells whether it stands inside an element that names itself an article or
main content, how far the names around it speak of navigation, footer, advert,
notice, form or comments (0, 0.5 where an element's names disagree, 1), and whether
it is a list item or a heading.  Where names disagree, or a name of clutter holds the
page's only article, and on pages without names, the words and link densities of the
block and its neighbours decide.  The tree (CART, Gini impurity) is grown at run time
from ``LABELLED``; the blocks that it calls content are joined in page order.

Defined cases: null, empty and text-less pages give an empty text; a page of plain
text is its own main text.  Very long or deeply nested pages take time in proportion
to their length.  Unclosed
tags end with the element around them, a stray end tag is ignored, text after
an unfinished tag is text up to it.  Repeated rows stay; other columns are not
read.
"""

from __future__ import annotations

import html as html_lib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOKEN = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
SILENT = set("head svg math select option datalist button label object audio video canvas map dialog".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q ruby rb rp rt s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
_ITEMS = ("li", "dd", "dt", "td", "th")
CONTENT_TAGS, CLUTTER_TAGS = {"article", "main"}, {"nav", "footer", "aside", "form", "menu"}
CONTENT_NAMES = set("article content main post entry story body text prose".split())
CLUTTER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended recommendations sidebar aside widget "
    "widgets breadcrumb breadcrumbs menu menubar nav navbar navigation navigate footer foot masthead comment comments commentlist disqus reply replies "
    "respond discussion pagination pager toolbar search skip copyright legal disclaimer tags hidden".split()
)
CLUTTER_ROLES = set("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split())


@dataclass
class Block:
    text: str
    words: int
    linked: float
    article: bool
    clutter: float
    item: bool
    heading: bool


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html_lib.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(raw)} if raw.strip(" /") else {}


def _named(value: str) -> tuple[int, int]:
    """How many names of a class or id attribute speak of clutter, and how many of content alone; a compound
    (``post-comments``) that has a word of clutter speaks of clutter."""
    words = [set(_TOKEN.findall(name.lower())) for name in _CAMEL.sub(r"\1-\2", value).split()]
    clutter = sum(bool(w & CLUTTER_NAMES) for w in words)
    return clutter, sum(bool(w & CONTENT_NAMES) and not w & CLUTTER_NAMES for w in words)


def _kind(tag: str, raw: str, in_article: bool) -> tuple[bool, float, bool]:
    """Whether an element is an article, how far its names speak of clutter (0, 0.5 where they disagree, 1), and whether it shows nothing."""
    attributes = _attributes(raw)
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}" if tag not in ("html", "body") else ""
    against, for_ = _named(names)
    role = attributes.get("role", "").lower()
    style = attributes.get("style", "").replace(" ", "").lower()
    silent = tag in SILENT or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
    header = tag == "header" or "header" in _TOKEN.findall(_CAMEL.sub(r"\1 \2", names).lower())
    if tag in CLUTTER_TAGS or role in CLUTTER_ROLES or (header and not in_article and not for_):
        clutter = 1.0
    else:
        clutter = 0.0 if not against else 0.5 if for_ or tag == "main" or role == "main" else 1.0
    article = tag in CONTENT_TAGS or role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody" or for_ > 0
    return article and clutter < 1, clutter, silent


def page_blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, float, bool]] = []  # open elements, each with what holds around it
    count: Counter[str] = Counter()  # of their tags
    article = silent = False
    clutter = 0.0
    parts: list[str] = []
    link_parts: list[str] = []
    link = False
    tag_now = ""

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(parts)).split())
        if text:
            words = len(text.split())
            linked = len(html_lib.unescape("".join(link_parts)).split()) / words
            out.append(Block(text, words, min(linked, 1.0), article, clutter, any(count[t] for t in _ITEMS), tag_now in ("h1", "h2", "h3", "h4", "h5", "h6")))
        parts.clear()
        link_parts.clear()

    def push(tag: str) -> None:
        stack.append((tag, article, clutter, silent))
        count[tag] += 1

    def pop() -> tuple[bool, float, bool]:
        tag, *around = stack.pop()
        count[tag] -= 1
        return tuple(around)

    def add(text: str) -> None:
        if not silent and text:
            parts.append(text)
            if link:
                link_parts.append(text)

    at, end = 0, len(page)
    while at < end:
        found = _MARKUP.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = max(found.end(), found.start() + 1)
        if not found[2]:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if tag in RAW and not closing:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            if tag not in ("script", "style", "title"):
                flush()
            continue
        if tag == "br":
            add("\n")
            if link:
                link_parts.append(" ")
            continue
        if tag == "a":
            link = not closing
            link_parts.append(" ")
            continue
        inline = tag in INLINE or (tag not in _BLOCKS and tag not in SILENT)
        if inline and closing and not count[tag]:
            continue
        if inline and not closing:
            if found[3]:  # an inline element may be hidden or an advert too
                now = _kind(tag, found[3], article)
                if (now[1] or now[2]) and not found[3].endswith("/"):
                    flush()
                    push(tag)
                    clutter, silent = max(clutter, now[1]), silent or now[2]
                elif count[tag]:
                    push(tag)
            elif count[tag]:
                push(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        flush()
        if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            tag_now = "" if closing else tag
            if not closing and found[3].strip(" /"):
                now = _kind(tag, found[3], article)
                if now[1] or now[2]:
                    push(tag)
                    clutter, silent = max(clutter, now[1]), silent or now[2]
                    continue
            if not closing:
                # a paragraph ends the one before it
                if stack and stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                    article, clutter, silent = pop()
                continue
            if stack and stack[-1][0] == tag:
                article, clutter, silent = pop()
            continue
        if closing:
            if count[tag]:  # ends what is open inside it too
                while stack[-1][0] != tag:
                    pop()
                article, clutter, silent = pop()
                link = False
            continue
        if found[3].endswith("/") and tag in SILENT:
            continue
        now = _kind(tag, found[3], article)
        push(tag)
        article, clutter, silent = article or now[0], max(clutter, now[1]), silent or now[2]
    flush()
    return out


_BLOCKS = set(
    "address article aside blockquote body caption center col colgroup dd details dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)

FEATURES = ("words", "linked", "words_before", "linked_before", "words_after", "linked_after", "article", "clutter", "item", "heading", "page_has_article")

#: Labelled blocks, by FEATURES; the last value is 1 for content.
LABELLED = [
    # inside an article: paragraphs of any length, headings, quotes, lists of prose
    (120, 0.00, 80, 0.00, 90, 0.00, 1, 0, 0, 0, 1, 1), (45, 0.05, 120, 0.00, 60, 0.00, 1, 0, 0, 0, 1, 1), (8, 0.00, 30, 0.00, 40, 0.00, 1, 0, 0, 0, 1, 1),
    (1, 0.00, 1, 0.00, 25, 0.00, 1, 0, 0, 0, 1, 1), (1, 0.00, 0, 0.00, 3, 0.00, 1, 0, 0, 0, 1, 1), (3, 0.00, 0, 0.00, 0, 0.00, 1, 0, 0, 0, 1, 1),
    (12, 0.00, 6, 0.00, 70, 0.00, 1, 0, 0, 1, 1, 1), (2, 0.00, 9, 1.00, 55, 0.00, 1, 0, 0, 1, 1, 1), (30, 0.40, 20, 0.00, 8, 0.00, 1, 0, 0, 0, 1, 1),
    (9, 0.00, 9, 0.00, 11, 0.00, 1, 0, 1, 0, 1, 1), (2, 0.00, 3, 0.00, 2, 0.00, 1, 0, 1, 0, 1, 1), (6, 0.00, 1, 1.00, 14, 0.00, 1, 0, 0, 0, 1, 1),
    (22, 0.00, 12, 0.00, 6, 1.00, 1, 0, 0, 0, 1, 1), (5, 1.00, 40, 0.00, 50, 0.00, 1, 0, 0, 0, 1, 1), (14, 0.20, 15, 0.10, 12, 0.00, 1, 0, 1, 0, 1, 1),
    (25, 0.00, 3, 1.00, 4, 1.00, 1, 0, 0, 0, 1, 1),
    # linked texts that stand among others, but not in an article
    (5, 1.00, 40, 0.00, 50, 0.00, 0, 1, 0, 0, 1, 0), (5, 1.00, 40, 0.00, 50, 0.00, 1, 1, 0, 0, 1, 0), (5, 1.00, 40, 0.00, 50, 0.00, 0, 0, 0, 0, 1, 0),
    (5, 1.00, 40, 0.00, 50, 0.00, 0, 0, 0, 0, 0, 0), (5, 1.00, 40, 0.00, 50, 0.00, 0, 1, 0, 0, 0, 0),
    # inside an article: lists of links
    (2, 1.00, 2, 1.00, 3, 1.00, 1, 0, 1, 0, 1, 0), (4, 1.00, 30, 0.00, 3, 1.00, 1, 0, 1, 0, 1, 0), (3, 1.00, 3, 1.00, 40, 0.00, 1, 0, 1, 0, 1, 0),
    (6, 0.95, 5, 1.00, 5, 1.00, 1, 0, 1, 0, 1, 0),
    # inside elements that name themselves clutter, in or out of an article
    (1, 1.00, 0, 0.00, 1, 1.00, 0, 1, 1, 0, 1, 0), (1, 1.00, 1, 1.00, 7, 0.00, 0, 1, 1, 0, 1, 0), (7, 0.00, 1, 1.00, 9, 0.00, 0, 1, 0, 0, 1, 0),
    (40, 0.00, 1, 1.00, 12, 0.00, 0, 1, 0, 0, 1, 0), (15, 0.10, 60, 0.00, 0, 0.00, 0, 1, 0, 0, 1, 0), (90, 0.00, 80, 0.00, 75, 0.00, 0, 1, 0, 0, 1, 0),
    (25, 0.00, 70, 0.00, 60, 0.00, 1, 1, 0, 0, 1, 0), (3, 0.00, 55, 0.00, 30, 0.00, 1, 1, 0, 1, 1, 0), (12, 0.50, 20, 0.00, 3, 1.00, 1, 1, 1, 0, 1, 0),
    (60, 0.00, 4, 0.00, 25, 0.00, 1, 1, 0, 0, 1, 0), (80, 0.00, 70, 0.00, 90, 0.00, 0, 1, 0, 0, 0, 0), (5, 0.00, 60, 0.00, 0, 0.00, 0, 1, 0, 0, 0, 0),
    (2, 1.00, 2, 1.00, 2, 1.00, 0, 1, 1, 0, 0, 0), (35, 0.00, 12, 0.00, 30, 0.00, 0, 1, 0, 1, 0, 0),
    # outside the article of a page that has one
    (10, 0.00, 0, 0.00, 12, 0.00, 0, 0, 0, 0, 1, 0), (50, 0.00, 70, 0.00, 9, 0.00, 0, 0, 0, 0, 1, 0), (4, 0.50, 2, 1.00, 60, 0.00, 0, 0, 0, 0, 1, 0),
    (6, 0.00, 0, 0.00, 80, 0.00, 0, 0, 0, 1, 1, 0), (2, 1.00, 40, 0.00, 2, 1.00, 0, 0, 1, 0, 1, 0), (85, 0.02, 0, 0.00, 90, 0.00, 0, 0, 0, 0, 1, 0),
    # pages without an article: long texts and what stands among them
    (120, 0.02, 90, 0.00, 100, 0.00, 0, 0, 0, 0, 0, 1), (40, 0.10, 3, 1.00, 60, 0.00, 0, 0, 0, 0, 0, 1), (25, 0.00, 60, 0.00, 2, 1.00, 0, 0, 0, 0, 0, 1),
    (18, 0.00, 20, 0.00, 45, 0.00, 0, 0, 0, 0, 0, 1), (9, 0.00, 40, 0.00, 50, 0.00, 0, 0, 0, 0, 0, 1), (4, 0.00, 35, 0.00, 60, 0.00, 0, 0, 0, 1, 0, 1),
    (3, 0.00, 2, 1.00, 70, 0.00, 0, 0, 0, 1, 0, 1), (8, 0.00, 50, 0.00, 30, 0.00, 0, 0, 1, 0, 0, 1), (6, 0.00, 4, 0.00, 40, 0.00, 0, 0, 0, 0, 0, 1),
    (2, 1.00, 2, 1.00, 2, 1.00, 0, 0, 0, 0, 0, 0), (3, 1.00, 0, 0.00, 4, 1.00, 0, 0, 1, 0, 0, 0), (5, 0.80, 60, 0.00, 3, 1.00, 0, 0, 0, 0, 0, 0),
    (15, 0.90, 12, 0.90, 14, 1.00, 0, 0, 0, 0, 0, 0), (4, 0.00, 2, 1.00, 3, 1.00, 0, 0, 0, 0, 0, 0), (6, 0.00, 3, 0.90, 0, 0.00, 0, 0, 0, 0, 0, 0),
    (30, 0.70, 5, 1.00, 6, 1.00, 0, 0, 0, 0, 0, 0), (4, 1.00, 30, 0.00, 30, 0.00, 0, 0, 1, 0, 0, 0),
    # pages of one text
    (200, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0, 0, 1), (30, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0, 0, 1), (2, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0, 0, 1),
    (3, 1.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0, 0, 0),
    # pages without an article, short texts: what stands beside them decides
    (10, 0.00, 30, 0.00, 25, 0.00, 0, 0, 0, 0, 0, 1), (12, 0.00, 25, 0.00, 14, 0.00, 0, 0, 0, 0, 0, 1), (9, 0.00, 26, 1.00, 25, 1.00, 0, 0, 0, 0, 0, 0),
    (12, 0.00, 14, 1.00, 20, 0.90, 0, 0, 0, 0, 0, 0), (8, 0.00, 18, 0.90, 30, 1.00, 0, 0, 1, 0, 0, 0),
    # names that disagree (an article that is called "post tags", a column "main sidebar-right"): texts beside texts, or beside links
    (60, 0.00, 40, 0.00, 55, 0.00, 1, 0.5, 0, 0, 1, 1), (25, 0.05, 70, 0.00, 20, 0.00, 1, 0.5, 0, 0, 1, 1), (8, 0.00, 45, 0.00, 50, 0.00, 1, 0.5, 0, 0, 1, 1),
    (6, 0.00, 0, 0.00, 60, 0.00, 1, 0.5, 0, 1, 1, 1), (5, 0.00, 2, 1.00, 40, 0.00, 1, 0.5, 0, 1, 1, 1), (30, 0.00, 50, 0.00, 0, 0.00, 1, 0.5, 0, 0, 1, 1),
    (1, 0.00, 12, 0.00, 9, 0.00, 1, 0.5, 0, 0, 1, 1), (10, 0.00, 12, 0.00, 14, 0.00, 1, 0.5, 1, 0, 1, 1), (3, 0.00, 0, 0.00, 0, 0.00, 1, 0.5, 0, 0, 1, 1),
    (22, 0.00, 12, 0.00, 6, 1.00, 1, 0.5, 0, 0, 1, 1), (4, 0.00, 3, 1.00, 2, 1.00, 1, 0.5, 0, 0, 1, 0), (7, 0.10, 22, 1.00, 55, 1.00, 1, 0.5, 0, 0, 1, 0),
    (5, 0.00, 14, 1.00, 13, 0.90, 1, 0.5, 1, 0, 1, 0), (30, 0.10, 9, 1.00, 4, 1.00, 1, 0.5, 0, 0, 1, 0), (3, 1.00, 4, 1.00, 2, 1.00, 1, 0.5, 1, 0, 1, 0),
    (2, 1.00, 30, 0.00, 3, 1.00, 1, 0.5, 1, 0, 1, 0), (6, 0.90, 40, 0.00, 30, 0.00, 1, 0.5, 0, 0, 1, 0),
    # an article inside an element with a name of clutter, and none elsewhere: a name of the page's layout, unless links stand around
    (50, 0.00, 40, 0.00, 60, 0.00, 1, 1, 0, 0, 0, 1), (30, 0.05, 60, 0.00, 45, 0.00, 1, 1, 0, 0, 0, 1), (12, 0.00, 35, 0.00, 40, 0.00, 1, 1, 0, 0, 0, 1),
    (5, 0.00, 0, 0.00, 45, 0.00, 1, 1, 0, 1, 0, 1), (1, 0.00, 1, 1.00, 30, 0.00, 1, 1, 0, 1, 0, 1), (40, 0.00, 2, 1.00, 30, 0.00, 1, 1, 0, 0, 0, 1),
    (35, 0.00, 30, 0.00, 3, 1.00, 1, 1, 0, 0, 0, 1), (40, 0.00, 0, 0.00, 0, 0.00, 1, 1, 0, 0, 0, 1), (6, 0.00, 2, 1.00, 3, 1.00, 1, 1, 0, 0, 0, 0),
    (3, 1.00, 2, 1.00, 2, 1.00, 1, 1, 1, 0, 0, 0), (25, 0.00, 4, 1.00, 6, 1.00, 1, 1, 0, 0, 0, 0), (9, 0.80, 30, 0.00, 20, 0.00, 1, 1, 0, 0, 0, 0),
]


class Tree:
    """A CART decision tree: splits by least Gini impurity, leaves by majority."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        impurity = lambda y: 2 * y.mean() * (1 - y.mean()) * len(y) if len(y) else 0.0
        self.label = int(labels.mean() >= 0.5)
        self.feature, self.below, self.above = -1, None, None
        best = (impurity(labels) - 1e-9, -1, 0.0)
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for cut in (values[1:] + values[:-1]) / 2:
                left = rows[:, feature] < cut
                best = min(best, (impurity(labels[left]) + impurity(labels[~left]), feature, cut))
        _, self.feature, self.cut = best
        if self.feature >= 0:
            left = rows[:, self.feature] < self.cut
            self.below, self.above = Tree(rows[left], labels[left]), Tree(rows[~left], labels[~left])

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.label)
        left = rows[:, self.feature] < self.cut
        out = np.empty(len(rows), int)
        out[left], out[~left] = self.below.predict(rows[left]), self.above.predict(rows[~left])
        return out


def _of_any_length(row: tuple) -> list[tuple]:
    """On pages with an article, a labelled block stands for blocks of other lengths with neighbours of other lengths."""
    words, linked, before, linked_before, after, linked_after, *rest = row
    if not row[FEATURES.index("page_has_article")]:
        return [row]
    return [(int(words * x + 0.75), linked, int(before * y + 0.75), linked_before, int(after * z + 0.75), linked_after, *rest) for x, y, z in itertools.product((0.25, 1, 4), repeat=3)]


def train(labelled: list[tuple] = LABELLED) -> Tree:
    table = np.unique(np.array([x for row in labelled for x in _of_any_length(row)], float), axis=0)
    return Tree(table[:, :-1], table[:, -1])


def features(blocks: list[Block]) -> np.ndarray:
    has_article = any(b.article and b.clutter < 1 for b in blocks)
    own = [(b.words, b.linked) for b in blocks]
    edge = [(0, 0.0)]
    return np.array(
        [(*now, *before, *after, b.article, b.clutter, b.item, b.heading, has_article) for b, now, before, after in zip(blocks, own, (edge + own)[: len(own)], (own + edge)[1:], strict=True)],
        float,
    ).reshape(-1, len(FEATURES))


def main_text(page: str | None, tree: Tree) -> tuple[str, list[Block], np.ndarray]:
    """The page's text, its blocks and which of them are content."""
    blocks = page_blocks(page or "")
    content = tree.predict(features(blocks)) == 1
    return " ".join(b.text for b, c in zip(blocks, content, strict=True) if c), blocks, content


def extract(pages: DataFrame, tree: Tree | None = None, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``pages``: the id, the columns named in ``keep``, text, n_chars, n_blocks and n_content."""
    sent = pages.sparkSession.sparkContext.broadcast(tree or train())
    own = pages.select(F.struct(id_col, *keep).alias("row"), F.col(html_col).alias("html"))
    out = own.mapInArrow(partial(_extract, sent), f"row {own.schema['row'].dataType.simpleString()}, text string, n_chars bigint, n_blocks bigint, n_content bigint")
    return out.select("row.*", "text", "n_chars", "n_blocks", "n_content")


def _extract(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = sent.value
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            found = [main_text(page.as_py(), tree) for page in batch.column("html").slice(first, 256)]
            texts = [t for t, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(first, 256), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([len(b) for _, b, _ in found], pa.int64()), pa.array([int(c.sum()) for _, _, c in found], pa.int64())],
                ["row", "text", "n_chars", "n_blocks", "n_content"],
            )
