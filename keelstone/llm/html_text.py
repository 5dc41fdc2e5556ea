"""Main text of web pages from flat text blocks.

A page is cut into flat blocks at block-level tags. Each block has its word count and
link density, those of the blocks before and after it, and what its surroundings say
(navigation, advert, article, ...). A decision tree, trained here on the small labelled
table below, tells the blocks of the article from the rest.
"""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's block-level elements, elements whose content is no text of the
# page, elements and name parts that mark surroundings.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset(
    "script style noscript template title head textarea select button svg math iframe object canvas".split()
)
#: Of these, what ends only at its own end tag; the others may be left open.
RAW_TAGS = frozenset("script style title textarea head".split())
#: Of these, what holds no other of its kind: one that begins before the end leaves it open.
FLAT_TAGS = frozenset("button select iframe canvas".split())
CHROME_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notification pagination popup promo promoted related replies reply respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that say that furniture is beside an element, and states of a whole page.
MODIFIERS = frozenset("with without has no not is show hide layout".split())
STATES = frozenset("open opened closed collapsed active enabled disabled visible hidden on off layout page template".split())
ARTICLE_TAGS = frozenset(["article", "main"])
ARTICLE_NAMES = frozenset("article content entry main post story".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|"
    r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_PART = re.compile(r"[A-Za-z]+")

FEATURES = (
    "words", "link_density", "words_before", "density_before", "words_after", "density_after",
    "in_chrome", "in_article", "heading",
)
# The labelled blocks, in the order of FEATURES, last the label. Long and
# short paragraphs, headings, lists of links, adverts, notices, comments and footers of
# pages with and without article markup.
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0),
    (2, 1.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0),
    (14, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0), (6, 0.0, 1, 1.0, 10, 0.0, 1, 0, 0, 0),
    (40, 0.0, 2, 1.0, 9, 0.0, 1, 0, 0, 0), (11, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0, 0),
    (25, 0.1, 90, 0.0, 0, 0.0, 1, 0, 0, 0), (7, 0.0, 4, 0.0, 0, 0.0, 1, 0, 0, 0),
    (30, 0.0, 120, 0.0, 22, 0.0, 1, 1, 0, 0), (22, 0.0, 30, 0.0, 15, 0.0, 1, 1, 0, 0),
    (2, 0.0, 80, 0.0, 30, 0.0, 1, 1, 1, 0), (80, 0.0, 30, 0.0, 3, 1.0, 1, 0, 0, 0),
    (3, 0.0, 2, 1.0, 6, 0.0, 1, 0, 1, 0), (16, 0.0, 0, 0.0, 60, 0.0, 1, 0, 0, 0),
    (8, 0.0, 14, 0.0, 25, 0.0, 0, 1, 1, 1), (9, 0.0, 40, 0.0, 60, 0.0, 0, 1, 1, 1),
    (1, 0.0, 14, 0.0, 1, 0.0, 0, 1, 1, 1), (25, 0.0, 8, 0.0, 70, 0.0, 0, 1, 0, 1),
    (70, 0.0, 25, 0.0, 90, 0.0, 0, 1, 0, 1), (1, 0.0, 30, 0.0, 45, 0.0, 0, 1, 0, 1),
    (2, 0.0, 1, 0.0, 12, 0.0, 0, 1, 0, 1), (4, 0.0, 2, 0.0, 11, 0.0, 0, 1, 0, 1),
    (120, 0.05, 60, 0.0, 11, 0.0, 0, 1, 0, 1), (18, 0.3, 50, 0.0, 60, 0.0, 0, 1, 0, 1),
    (900, 0.0, 8, 0.0, 11, 0.0, 0, 1, 0, 1), (3, 0.0, 9, 0.0, 11, 0.0, 0, 1, 0, 1),
    (12, 0.0, 9, 0.0, 14, 0.0, 0, 1, 0, 1), (2, 1.0, 80, 0.0, 60, 0.0, 0, 1, 0, 1),
    (5, 1.0, 40, 0.0, 3, 1.0, 0, 1, 0, 0), (3, 1.0, 5, 1.0, 4, 1.0, 0, 1, 0, 0),
    (6, 0.9, 3, 1.0, 5, 1.0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0),
    (2, 1.0, 2, 1.0, 8, 0.0, 0, 0, 0, 0), (3, 0.8, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (12, 0.7, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (4, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (5, 0.0, 2, 1.0, 3, 0.5, 0, 0, 0, 0), (6, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (3, 0.0, 4, 1.0, 0, 0.0, 0, 0, 0, 0), (7, 0.0, 5, 0.0, 0, 0.0, 0, 0, 0, 0),
    (8, 0.2, 6, 0.5, 0, 0.0, 0, 0, 0, 0), (45, 0.0, 60, 0.0, 80, 0.0, 0, 0, 0, 1),
    (80, 0.02, 45, 0.0, 30, 0.0, 0, 0, 0, 1), (30, 0.0, 80, 0.0, 6, 0.0, 0, 0, 0, 1),
    (60, 0.1, 2, 1.0, 40, 0.0, 0, 0, 0, 1), (9, 0.0, 70, 0.0, 65, 0.0, 0, 0, 0, 1),
    (6, 0.0, 40, 0.0, 50, 0.0, 0, 0, 1, 1), (7, 0.0, 3, 1.0, 50, 0.0, 0, 0, 1, 1),
    (5, 0.0, 1, 1.0, 35, 0.0, 0, 0, 1, 1), (22, 0.0, 7, 0.0, 40, 0.0, 0, 0, 0, 1),
    (200, 0.0, 5, 0.0, 4, 0.0, 0, 0, 0, 1), (35, 0.0, 6, 0.0, 28, 0.0, 0, 0, 0, 1),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 1, 0), (4, 0.0, 30, 0.0, 2, 1.0, 0, 0, 1, 0),
]
# Plain text of any length, beside blocks of any length, is the article's where the page
# says so and is not where it stands in page furniture, inside an article or not.
LABELLED += [
    (words, 0.0, before, float(before == 2), after, float(after == 2), chrome, article, 0, 1 - chrome)
    for words in (1, 6, 40, 150)
    for before in (0, 2, 7, 80)
    for after in (0, 2, 9, 70)
    for chrome, article in ((0, 1), (1, 0), (1, 1))
]
# Links alone are lists of links.
LABELLED += [
    (words, 1.0, before, density, after, 0.0, 0, 0, 0, 0)
    for words in (1, 2, 5)
    for before, density in ((0, 0.0), (2, 1.0), (40, 0.0), (120, 0.0))
    for after in (0, 2, 25, 60)
]
# Where the page says nothing, long blocks are text, and short ones between long ones.
LABELLED += [
    (words, 0.0, before, 0.0, after, 0.0, 0, 0, 0, int(words > 10 or min(before, after) > 30))
    for words in (2, 6, 20, 60, 200)
    for before in (0, 3, 40)
    for after in (0, 3, 40)
]
# Sentences of an article may be half links.
LABELLED += [
    (words, density, before, 0.0, after, 0.0, 0, 1, 0, 1)
    for words in (6, 12, 40)
    for density in (0.2, 0.5)
    for before in (1, 30)
    for after in (0, 30)
]


@dataclass
class Node:
    """A node of the tree: a split, or a leaf where ``feature`` is None."""

    label: int
    feature: int | None = None
    bound: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def decide(self, row) -> int:
        node = self
        while node.feature is not None:
            node = node.below if row[node.feature] <= node.bound else node.above
        return node.label


def train(table: np.ndarray, depth: int = 6) -> Node:
    """A binary decision tree by Gini impurity; ties go to the earlier feature and lower bound."""
    rows, labels = table[:, :-1], table[:, -1]
    node = Node(label=int(labels.mean() >= 0.5))
    if depth == 0 or labels.min() == labels.max():
        return node
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for bound in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= bound
            impurity = sum(
                part.size * part.mean() * (1 - part.mean()) for part in (labels[low], labels[~low])
            )
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(bound), low)
    if best is None:
        return node
    _, node.feature, node.bound, low = best
    node.below, node.above = train(table[low], depth - 1), train(table[~low], depth - 1)
    return node


@functools.cache
def _tree() -> Node:
    return train(np.array(LABELLED, dtype=float))


def names_furniture(name: str) -> bool:
    """Whether one class, id or role names page furniture.

    Furniture that a name only mentions does not count: after a modifier
    (``layout-with-sidebar``), before a state (``menu-open``), or between the article and
    another word (``content-sidebar-wrap``).
    """
    parts = [x.lower() for x in NAME_PART.findall(name)]
    first = next((k for k, x in enumerate(parts) if x in CHROME_NAMES), None)
    if first is None or MODIFIERS.intersection(parts[:first]) or parts[-1] in STATES:
        return False
    return parts[-1] in CHROME_NAMES or not ARTICLE_NAMES.intersection(parts[:first])


def _surroundings(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element marks page furniture, and whether it marks an article.

    An article is furniture only where a whole name says so, as for readers' comments
    and teasers; the main element and the page itself never are.
    """
    names: list[str] = []
    if attributes:
        for match in NAMES.finditer(attributes):
            names += next(filter(None, match.groups()), "").split()
    parts = {x.lower() for name in names for x in NAME_PART.findall(name)}
    content = tag in ARTICLE_TAGS or bool(parts & ARTICLE_NAMES)
    if tag in ("body", "html", "main"):
        return False, content
    if tag == "article":
        return any(x.lower() in CHROME_NAMES or x.lower().startswith("comment-") for x in names), content
    return tag in CHROME_TAGS or any(map(names_furniture, names)), content


class _Open:
    """The open elements with their surroundings; an end tag without a start costs nothing."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, chrome: bool, article: bool):
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, chrome, article))

    def close(self, tag: str):
        """Close the innermost element of this name and all within it."""
        if self.places.get(tag):
            place = self.places[tag][-1]
            while len(self.stack) > place:
                self.places[self.stack.pop()[0]].pop()


def blocks(page: str) -> list[tuple[str, float, bool, bool, bool]]:
    """Text, link density, in_chrome, in_article, heading of each flat block in page order."""
    out: list[tuple] = []
    parts: list[tuple[str, bool]] = []
    opened = _Open()
    stack = opened.stack
    ends: dict[str, re.Match | None] = {}  # the next end of each dropped element
    links = at = 0
    heading = False

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                linked = " ".join(html.unescape("".join(t for t, link in parts if link)).split())
                chrome, article = stack[-1][1:] if stack else (False, False)
                out.append((text, min(1.0, len(linked) / len(text)), chrome, article, heading))
            parts.clear()

    def add(text):
        if text:
            parts.append((text, links > 0))

    size = len(page)
    while at < size:
        match = TOKEN.search(page, at)
        if not match:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        closing, tag, attributes = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK_TAGS:
                flush()
                heading = False
                opened.close(tag)
            continue
        if tag in DROPPED_TAGS:
            if not attributes.endswith("/>"):
                # a head may be left open: it ends where the body begins
                pattern = r"</head\s*>|(?=<body\b)" if tag == "head" else rf"</{tag}\s*>"
                if tag not in ends or ends[tag] and ends[tag].start() < at:
                    ends[tag] = re.compile(pattern, re.I).search(page, at)
                end = ends[tag]
                if end and tag in FLAT_TAGS and re.compile(rf"<{tag}\b", re.I).search(page, at, end.start()):
                    end = None  # the end belongs to the next one
                if end:
                    at = end.end()
                elif tag in RAW_TAGS and tag != "head":
                    at = size
                add(" ")
        elif tag == "a":
            links += 1
        elif tag == "br":
            add(" ")
        elif tag in BLOCK_TAGS:
            flush()
            links = 0
            heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            if tag in VOID_TAGS or attributes.endswith("/>"):
                continue
            if tag == "p" and stack and stack[-1][0] == "p":
                opened.close("p")  # a paragraph ends the one before it
            chrome, article = _surroundings(tag, attributes)
            if stack and tag != "main":  # the main element lies in no furniture
                chrome, article = chrome or stack[-1][1], article or stack[-1][2]
            opened.push(tag, chrome, article)
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks, one per line; null, empty and textless pages give an empty text."""
    found = blocks(page) if page else []
    sizes = [(len(b[0].split()), b[1]) for b in found]
    tree, kept = _tree(), []
    for k, (text, density, chrome, article, heading) in enumerate(found):
        before = sizes[k - 1] if k else (0, 0.0)
        after = sizes[k + 1] if k + 1 < len(sizes) else (0, 0.0)
        if tree.decide((sizes[k][0], density, *before, *after, chrome, article, heading)):
            kept.append(text)
    return "\n".join(kept)


def _extracted(batches):
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``.

    Null html counts as empty. Repeated rows, null ids and null addresses are kept as
    they are, other columns are not read. Works page by page, without a shuffle.
    """
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"),
    ).mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
