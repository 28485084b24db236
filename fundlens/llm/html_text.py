"""Main text of web pages from flat text blocks.

A page is a list of text blocks. A decision tree tells text from the rest by the word
count and link density of a block and its neighbours (Kohlschuetter et al., "Boilerplate
Detection using Shallow Text Features", 2010). Blocks that these leave open, such as a
one-word paragraph against a one-line advert, are told apart by what encloses them too.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fundlens.llm.html_examples import EXAMPLES

# Elements by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
RAW = frozenset("script style noscript template textarea title iframe object svg math select button video audio canvas".split())
CONTAINERS = frozenset("article main section div nav header footer aside form ul ol dl table body figure blockquote details dialog menu fieldset".split())
SIDE = frozenset("nav footer aside menu dialog".split())
ENDED_BY_NEXT = frozenset("li dt dd tr td th option".split())
# Words of class, id and role: those that name a part other than the article, and those that only hint at one.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent notice gdpr popup modal "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer masthead topbar comment comments commentlist "
    "replies respond disqus newsletter subscribe subscription signup login search pagination pager copyright contentinfo "
    "complementary".split()
)
HINT_WORDS = frozenset(
    "side rail widget banner overlay header foot social share sharing related recommended recommendations promo promotion "
    "teaser discussion reply toolbar tags legal disclaimer alert skip form".split()
)
MAIN_WORDS = frozenset("article main content post entry story body text".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_NAMING = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
_WRAPPED = re.compile(r"<(?:article|main|h1)[\s>]", re.I)
_FORM_END = re.compile(r"</form", re.I)
DENSITIES = 6
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "side", "main")


def _kind(tag: str, attributes: str, inside: tuple[int, int]) -> tuple[int, int]:
    """(side, main) of what an element encloses; ``side`` is 2 for a part that is no article, 1 for a hint of one.

    A part stays what it is within; an article's own header is part of the article.
    """
    side, main = inside
    names = {w for m in _NAMING.finditer(attributes) for w in re.findall(r"[a-z]+", m[1].lower())} if attributes else set()
    if tag in SIDE or _HIDDEN.search(attributes) or (tag == "header" and not main):
        side = 2
    elif tag not in ("article", "main", "body", "html"):
        if names & SIDE_WORDS:
            side = 2
        elif names & HINT_WORDS and not (main and names <= {"header", "post", "entry", "article"}):
            side = max(side, 1)
    if tag in ("article", "main"):
        side, main = (0 if side == 1 else side), 1
    elif names & MAIN_WORDS:
        main = 1
    return side, main


class _Forms:
    """Tells a form that wraps a whole page, with an article or a title in it, from one that is a part of a page."""

    def __init__(self, page: str):
        self.ends = [m.start() for m in _FORM_END.finditer(page)]
        self.titles = [m.start() for m in _WRAPPED.finditer(page)] if "<form" in page.lower() else []
        self.length = len(page)

    def wraps(self, at: int) -> bool:
        end = bisect_left(self.ends, at)
        title = bisect_left(self.titles, at)
        return title < len(self.titles) and self.titles[title] < (self.ends[end] if end < len(self.ends) else self.length)


def text_blocks(page: str | None) -> list[tuple[str, int, int, int, int]]:
    """(text, words, linked words, side, main) of each block in page order; blocks without text are left out.

    A link stays open over blocks until it, its container or the next link ends it. A paragraph that
    is not closed ends at the next block, a list item or cell at the next of its kind.
    """
    page, blocks = page or "", []
    forms = _Forms(page)
    stack: list[tuple[str, tuple[int, int]]] = []
    state, link, parts = (0, 0), None, []

    def close() -> None:
        text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
        if text:
            links = len(html.unescape(" ".join(p for p, linked in parts if linked)).split())
            words = len(text.split())
            blocks.append((text, words, min(links, words), *state))
        parts.clear()

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        parts.append((page[at : token.start() if token else len(page)], link is not None))
        if not token:
            break
        at = token.end()
        if not token[2]:
            continue
        tag, closing, empty = token[2].lower(), bool(token[1]), token[3].endswith("/")
        if tag in RAW:
            if not closing and not empty:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            parts.append((" ", False))
        elif tag == "a":
            link = len(stack) if not closing and _HREF.search(token[3]) else None
        elif tag in ("br", "img", "wbr"):
            parts.append((" ", link is not None))
        elif tag not in INLINE:
            close()
            if not closing:
                while stack and (stack[-1][0] == "p" or (tag in ENDED_BY_NEXT and stack[-1][0] == tag)):
                    state = stack.pop()[1]
                if not empty and (tag in CONTAINERS or _NAMING.search(token[3]) or _HIDDEN.search(token[3])):
                    stack.append((tag, state))
                    if tag != "form":
                        state = _kind(tag, token[3], state)
                    elif not forms.wraps(at):
                        state = (2, state[1])
            elif tag in CONTAINERS:
                if any(name == tag for name, _ in stack):
                    while True:
                        name, state = stack.pop()
                        if name == tag:
                            break
            elif stack and stack[-1][0] == tag:
                state = stack.pop()[1]
            if link is not None and len(stack) < link:
                link = None
    close()
    return blocks


def block_features(blocks: list[tuple[str, int, int, int, int]]) -> np.ndarray:
    """One row per block in the order of :data:`FEATURES`; a missing neighbour has no words."""
    own = np.array([[b[1], b[2] / b[1]] for b in blocks], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    before, after = np.vstack([none, own[:-1]]), np.vstack([own[1:], none])
    return np.hstack([own, before[: len(own)], after[: len(own)], np.array([b[3:5] for b in blocks], float).reshape(-1, 2)])


def best_split(rows: np.ndarray, labels: np.ndarray, features: range, least: int) -> tuple[int, float] | None:
    """(feature, cut) of the least Gini impurity, ``least`` rows on either side; None if nothing gets better."""
    share = labels.mean()
    best, split = len(labels) * share * (1 - share) - 1e-9, None
    for feature in features:
        order = np.argsort(rows[:, feature], kind="stable")
        values, ones = rows[order, feature], np.cumsum(labels[order])
        cuts = np.flatnonzero(values[1:] > values[:-1]) + 1
        cuts = cuts[(cuts >= least) & (len(labels) - cuts >= least)]
        if not len(cuts):
            continue
        low, high = ones[cuts - 1], ones[-1] - ones[cuts - 1]
        n, m = cuts, len(labels) - cuts
        impurity = low * (1 - low / n) + high * (1 - high / m)
        i = int(np.argmin(impurity))
        if impurity[i] < best:
            best, split = float(impurity[i]), (feature, float((values[cuts[i] - 1] + values[cuts[i]]) / 2))
    return split


class BlockTree:
    """Binary decision tree with Gini splits; a leaf holds the share of text blocks.

    It asks for words and link densities of a block and its neighbours first. Only where they leave
    both kinds mixed it asks what encloses the block as well.
    """

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 5, least: int = 300, deeper: int = 6, few: int = 2):
        self.depth, self.least, self.deeper, self.few = depth, least, deeper, few
        self.root = self._grow(rows, labels, depth, range(DENSITIES))

    def _grow(self, rows: np.ndarray, labels: np.ndarray, depth: int, features: range):
        share = float(labels.mean())
        if share in (0.0, 1.0):
            return share
        by_text = len(features) == DENSITIES
        split = best_split(rows, labels, features, self.least if by_text else self.few) if depth else None
        if split is None:
            return self._grow(rows, labels, self.deeper, range(rows.shape[1])) if by_text else share
        low = rows[:, split[0]] < split[1]
        return (*split, self._grow(rows[low], labels[low], depth - 1, features), self._grow(rows[~low], labels[~low], depth - 1, features))

    def asked(self, row: np.ndarray) -> list[int]:
        """The features on the way of a block to its leaf."""
        node, way = self.root, []
        while isinstance(node, tuple):
            way.append(node[0])
            node = node[2] if row[node[0]] < node[1] else node[3]
        return way

    def share(self, row: np.ndarray) -> float:
        node = self.root
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] < node[1] else node[3]
        return node

    @classmethod
    def fit(cls, examples: list[str] = EXAMPLES) -> BlockTree:
        """Learn from example pages in which the words of text blocks start with ``T`` and those of others with ``x``."""
        rows, labels = [], []
        for page in examples:
            blocks = text_blocks(page)
            rows.append(block_features(blocks))
            labels += [b[0].startswith("T") for b in blocks]
        return cls(np.vstack(rows), np.array(labels, float))


def main_text(page: str | None, tree: BlockTree) -> str:
    """Text blocks of a page, one per line; empty if it has none."""
    blocks = text_blocks(page)
    keep = [tree.share(row) >= 0.5 for row in block_features(blocks)]
    return "\n".join(b[0] for b, k in zip(blocks, keep) if k)


def extract_pages(pages: DataFrame, tree: BlockTree | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A null page is empty and gives an empty text; character references are decoded,
    white space in a block is one blank; repeated rows stay, other columns are left out.
    """
    tree = tree or BlockTree.fit()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, tree) for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return narrow.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
