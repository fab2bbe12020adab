"""Main text of HTML pages by a minimum cut between content and boilerplate.

A page is cut into text blocks. A linear classifier on a block's words, links,
punctuation and element, with what the elements around it say about themselves,
gives log odds for content. These are the capacities to the two terminals of a
graph; neighbouring blocks and blocks of the same parent element are joined by
smoothness edges. A maximum flow gives the cheapest division.

The classifier starts from set weights and is fitted, on a bounded sample of
pages, to blocks whose elements name their part (``article`` or ``main`` against
``nav``, ``footer``, ``aside`` and the like).
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that the classifier is fitted to, at most.
SAMPLE = 400
#: Log odds that cannot be outvoted, that an article or main element gives, that a word in a class or id gives, and of text
#: outside an article where there is one.
CERTAIN, NAMED, WORDED, OUTSIDE = 60.0, 6.0, 6.0, -4.0
#: Smoothness between neighbours in one parent, in different ones, and between blocks of one parent.
SAME, OTHER, SIBLING = 1.0, 0.25, 0.75

_DROPPED = frozenset("script style noscript template title svg iframe canvas audio video".split())
_BOILERPLATE = frozenset("nav footer aside form menu dialog".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul caption".split())
_VOID = frozenset("hr br img input link meta area base col embed source track wbr".split())
_CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
} | {f"h{k}": {"p"} for k in range(1, 7)}
_BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "copyright disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices "
    "popup promo promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription teaser toolbar widget widgets gdpr alert".split())
_ABOUT = frozenset("has no with without".split())
_GOOD_WORDS = frozenset("article content entry main post story text body".split())
_PRIOR = np.array([-1.0, 2.0, -4.0, 1.0, 0.7, 0.8, -0.8])


def _names(values: dict[str, str | None]) -> set[str]:
    """The words in an element's class and id, but for names like ``has-sidebar``, which tell what else the page has."""
    names = f"{values.get('class') or ''} {values.get('id') or ''}".lower().split()
    parts = [[x for x in re.split(r"[^a-z]+", name) if x] for name in names]
    return {word for words in parts if words and words[0] not in _ABOUT for word in words}


class Block(NamedTuple):
    """A text block: its element's tag, the share of its characters in links, its parent, and what its elements say."""

    text: str
    tag: str
    links: float
    parent: int
    says: float


class _Element(NamedTuple):
    tag: str
    number: int
    says: float
    article: bool


class _Reader(HTMLParser):
    """Collects the blocks of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.has_article = False
        self._open = [_Element("html", 0, 0.0, False)]
        self._count = 0
        self._dropped: list[str] = []
        self._parts: list[str] = []
        self._link_chars = 0
        self._in_link = False

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            own = self._open[-1]
            chars = sum(len(x) for x in self._parts)
            holder = self._open[-2] if len(self._open) > 1 and own.tag not in ("div", "section", "article", "main", "body") else own
            self.blocks.append(Block(text, own.tag, self._link_chars / max(1, chars), holder.number, own.says))
        self._parts, self._link_chars = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._dropped:
            if tag == self._dropped[-1]:
                self._dropped.append(tag)
            return
        values = dict(attrs)
        if tag in _DROPPED or "hidden" in values and tag not in _VOID:
            if tag in _BLOCKS:
                self._flush()
            if tag not in _VOID:
                self._dropped.append(tag)
            return
        if tag == "a":
            self._in_link = True
        elif tag == "br":
            self._parts.append(" ")
        elif tag == "hr":
            self._flush()
        elif tag in _BLOCKS:
            self._flush()
            self._in_link = False
            closes = _CLOSES.get(tag, {"p"})
            while len(self._open) > 1 and self._open[-1].tag in closes:
                self._open.pop()
            self._count += 1
            around = self._open[-1]
            article = around.article or tag in ("article", "main")
            self.has_article |= tag in ("article", "main")
            self._open.append(_Element(tag, self._count, self._says(tag, values, around), article))

    def _says(self, tag: str, values: dict[str, str | None], around: _Element) -> float:
        """Log odds that an element and those around it state.

        What an element's kind or role states holds for all inside. What a word in a
        class or id states is a guess: it is as strong as a few units, and an article
        or main element inside starts anew.
        """
        if around.says <= -CERTAIN:
            return around.says
        if tag in _BOILERPLATE or (values.get("role") or "").lower() in _ROLES or (tag == "header" and not around.article):
            return -CERTAIN
        said = around.says
        if tag in ("article", "main"):
            # A reader's comment is often an article inside the article.
            said = said if around.article and said < 0 else NAMED
        if tag not in ("body", "html", "article", "main") or tag == "article" and around.article:
            names = _names(values)
            if names & _BAD_WORDS and not (tag in ("header", "h1", "h2", "h3") and around.article):
                return min(said, 0.0) - (WORDED / 2 if names & _GOOD_WORDS else WORDED)
            if names & _GOOD_WORDS and said >= 0:
                return max(said, NAMED / 2)
        return max(said, -CERTAIN / 2)

    def handle_endtag(self, tag: str) -> None:
        if self._dropped:
            if tag == self._dropped[-1]:
                self._dropped.pop()
            return
        if tag == "a":
            self._in_link = False
        elif tag in _BLOCKS and tag not in _VOID:
            at = len(self._open) - 1
            while at > 0 and self._open[at].tag != tag:
                at -= 1
            if at > 0:
                self._flush()
                del self._open[at:]
            elif tag == "p":
                self._flush()
            self._in_link = False

    def handle_data(self, data: str) -> None:
        if not self._dropped:
            self._parts.append(data)
            if self._in_link:
                self._link_chars += len(data)

    def finish(self) -> None:
        self.close()
        self._flush()


def read_blocks(html: str) -> tuple[list[Block], bool]:
    """The text blocks of a page, and whether it has an ``article`` or ``main`` element."""
    reader = _Reader()
    reader.feed(html)
    reader.finish()
    return reader.blocks, reader.has_article


def features(block: Block) -> list[float]:
    return [
        1.0,
        min(math.log1p(block.text.count(" ") + 1) / 3, 2.0),
        block.links,
        float(block.text[-1] in ".!?…\"'”’»"),
        float(block.tag in ("h1", "h2", "h3")),
        float(block.tag in ("p", "blockquote", "pre")),
        float(block.tag in ("li", "td", "th", "dt", "dd", "legend", "caption")),
    ]


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side: positive odds are capacities from it, negative ones to the sink.

    Augmenting paths by levels, as Dinic's method finds them; between equal cuts,
    the one with fewest nodes on the source's side.
    """
    n = len(odds)
    excess = [max(x, 0.0) for x in odds]
    demand = [max(-x, 0.0) for x in odds]
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for i, j, weight in edges:
        out[i].append(len(to))
        out[j].append(len(to) + 1)
        to += [j, i]
        room += [weight, weight]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if excess[i] > tiny)
        for i in queue:
            level[i] = 0
        while queue:
            i = queue.popleft()
            for e in out[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not any(level[i] >= 0 and demand[i] > tiny for i in range(n)):
            return [x >= 0 for x in level]
        at = [0] * n
        for start in range(n):
            if level[start]:
                continue
            while excess[start] > tiny:
                path, node = [], start
                while demand[node] <= tiny:
                    while at[node] < len(out[node]):
                        e = out[node][at[node]]
                        if room[e] > tiny and level[to[e]] == level[node] + 1:
                            break
                        at[node] += 1
                    if at[node] < len(out[node]):
                        path.append(out[node][at[node]])
                        node = to[path[-1]]
                    elif path:
                        node = to[path.pop() ^ 1]
                        at[node] += 1
                    else:
                        break
                if demand[node] <= tiny:
                    break
                flow = min([excess[start], demand[node], *(room[e] for e in path)])
                excess[start] -= flow
                demand[node] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def content_blocks(html: str, weights: np.ndarray) -> list[str]:
    """The texts of the blocks that the cut takes for content, in page order."""
    blocks, has_article = read_blocks(html)
    if not blocks:
        return []
    odds, edges, last_of = [], [], {}
    own = weights.tolist()
    for k, block in enumerate(blocks):
        value = sum(w * x for w, x in zip(own, features(block), strict=True)) + block.says
        if has_article and block.says < NAMED:
            value += OUTSIDE
        odds.append(value)
        if k:
            edges.append((k - 1, k, SAME if blocks[k - 1].parent == block.parent else OTHER))
        if block.parent in last_of and last_of[block.parent] < k - 1:
            edges.append((last_of[block.parent], k, SIBLING))
        last_of[block.parent] = k
    return [block.text for block, kept in zip(blocks, minimum_cut(odds, edges), strict=True) if kept]


def fit(pages: list[str], rounds: int = 200) -> np.ndarray:
    """Weights of the classifier, kept near the set ones; without named blocks of both kinds, the set ones."""
    rows, marks = [], []
    for html in pages:
        for block in read_blocks(html)[0]:
            if abs(block.says) >= NAMED:
                rows.append(features(block))
                marks.append(block.says > 0)
    x, y = np.array(rows, np.float64).reshape(-1, len(_PRIOR)), np.array(marks, np.float64)
    if not 0 < y.sum() < len(y):
        return _PRIOR
    balance = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    weights = _PRIOR.copy()
    for _ in range(rounds):
        error = balance * (1 / (1 + np.exp(-x @ weights)) - y)
        weights -= 0.5 * (x.T @ error + 0.02 * (weights - _PRIOR))
    return weights


def main_text(
    df: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", sample: int = SAMPLE
) -> DataFrame:
    """Per row: the id, the URL, ``text`` (its content blocks, two line feeds between) and ``n_chars``.

    Null and empty pages, and pages without content, have an empty text. A page is
    read as a whole, in one piece. Rows are judged one by one; ids may repeat or be
    null, other columns play no part.
    """
    chosen = df.filter(F.col(html).isNotNull()).orderBy(F.xxhash64(id_column, html)).select(F.col(html).alias("html")).limit(sample)
    weights = fit(chosen.toArrow()["html"].to_pylist())

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(content_blocks(page or "", weights)) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["id", "url", "text", "n_chars"])

    named = df.select(F.col(id_column).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    out = named.mapInArrow(extract, f"id {dict(df.dtypes)[id_column]}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_column, "url": url})
