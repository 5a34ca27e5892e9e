"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's streaming parser reports tags and text; text between two block
borders is a line.  A line's ratio is its text length per tag met in it; the ratios are
smoothed with a Gaussian, and lines above a threshold (the spread of the smoothed ratios)
cluster to the content regions.  What is never content goes: scripts, styles, menus,
headers and footers of the page, sidebars, notices, adverts, forms and comments, known by
their element or by a word of their class, id or role.  A class or an id that only ends in
such a word may be the article's own, so inside an article its block goes only if it lies
low in the smoothed ratios or consists of links.

The article is all <article> or else <main> elements that are left; without them the
innermost element with all of the clusters' text, all of its lines, the short ones too.
If that is the body itself, the clusters are the article: from the first to the last of a
cluster's lines that are high by themselves, and headings before them.  Nothing is cut off.

A page is parsed once, elements are numbered as they open, and every decision is one walk
over the numbers, so that neither depth nor size of a page matters for the work per tag.

NULL, empty and text-free pages give the empty text, an empty table no rows.  Unclosed and
stray tags are accepted, very long pages are read whole.  Each row is treated by itself, so
repeated rows give equal results.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyward.llm.common import map_batches, texts_of

SCHEMA = "page_id long, url string, text string, n_chars long"
#: Width of the Gaussian, in lines.
SIGMA = 1.0

#: Elements that end a line.
BLOCKS = frozenset(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol "
    "option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements without text of the page.
NEVER = frozenset("script style noscript template iframe object embed svg canvas audio video".split())
#: Elements without content of the article.
DROPPED = NEVER | frozenset("head nav footer aside form button select textarea input label dialog menu".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that may be chosen as the article's element.
HOLDERS = frozenset("article main section div td body".split())
#: Words of a class, an id or a role that mark what is not the article.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside "
    "complementary notice notices alert cookie cookies consent gdpr popup modal overlay dialog "
    "comment comments discussion disqus reply replies respond form search login signup subscribe "
    "newsletter share sharing social related recommended pagination pager widget toolbar "
    "contentinfo tags skip".split()
)
#: Words that say no more than that something is a block.
_PLAIN = frozenset(
    "area bar block blocks body box buttons card cards container content group inner item items left "
    "links list main outer panel post posts right row section slot thread wrap wrapper unit".split()
)
#: An element that closes an open one of the same kind in its parent.
_SIBLINGS = {"p": {"p"}, "li": {"li"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
             "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_CLOSES_P = BLOCKS - {"br", "body", "html", "head", "title", "option", "select", "caption",
                      "tbody", "td", "tfoot", "th", "thead", "tr", "legend"}
#: Elements beyond which no sibling is looked for.
_SCOPES = HOLDERS | {"ul", "ol", "table", "dl", "select", "blockquote"}
_WORD = re.compile(r"[a-z]+")
#: Elements that a head may have; any other closes it.
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Marks that an article's own parts bear too.
_OF_ARTICLE = frozenset("header masthead tags".split())
#: Readers' words, whatever holds them.
_COMMENTS = frozenset("comment comments disqus reply replies respond".split())
#: Words of an aside that is the article's.
_QUOTES = frozenset("pullquote quote blockquote epigraph".split())
#: First words of a class that says what the page has, not what the element is.
_STATES = frozenset("has no with without is".split())

# What speaks against an element: it goes in any case, unless it wraps the article, if it
# is not part of an article, or if it is low in the ratios.
_KEEP, _LOW, _WRAP, _GONE = range(4)


@dataclass
class Line:
    """A line of text: the tags met in it, the innermost element around, its characters in
    links, and whether it is a heading."""

    text: str
    tags: int
    element: int
    links: int
    heading: bool


def _tokens(value: str) -> list[list[str]]:
    found = (_WORD.findall(each) for each in value.lower().split())
    return [words for words in found if words and words[0] not in _STATES]


def judge_element(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    """What speaks against an element, by its tag and attributes."""
    given = {name: value or "" for name, value in attrs}
    if tag in NEVER or "hidden" in given or given.get("aria-hidden") == "true":
        return _GONE
    classes, ids, roles = (_tokens(given.get(name, "")) for name in ("class", "id", "role"))
    if tag in ("html", "body", "main", "h1"):
        return _KEEP
    whole = {words[0] for words in classes + roles if len(words) == 1}
    # A class of several words marks its element by the first of them if the others are plain.
    whole |= {words[0] for words in classes if len(words) > 1 and _PLAIN.issuperset(words[1:])}
    part = {words[-1] for words in classes if len(words) > 1}
    named = set() if tag in HEADINGS else {words[0] for words in ids if len(words) == 1 or _PLAIN.issuperset(words[1:])}
    if (whole | part | named) & _COMMENTS:
        return _GONE
    strong, weak = whole & MARKED, (part | named) & MARKED
    if tag == "aside" and (whole | part) & _QUOTES:
        return _KEEP
    if tag in DROPPED or (tag == "header" and not in_article):
        return _WRAP if tag == "form" else _GONE
    if in_article and tag != "article":
        strong, weak = strong - _OF_ARTICLE, weak - _OF_ARTICLE
        return _WRAP if strong else _LOW if weak else _KEEP
    return _WRAP if strong | weak else _KEEP


class _Events(HTMLParser):
    """Elements of a page, numbered as they open, and its lines of text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[int] = []
        self.count: Counter[str] = Counter()  # open elements by tag
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.against: list[int] = []
        self.sizes: list[int] = []  # characters of text directly in the element
        self.lines: list[Line] = []
        self.held: list[str] = []
        self.met = self.linked = 0
        self._add("", -1, _KEEP)  # around all elements

    def _add(self, tag: str, parent: int, against: int) -> None:
        self.tags.append(tag)
        self.parents.append(parent)
        self.against.append(against)
        self.sizes.append(0)

    def _innermost(self) -> int:
        return self.open[-1] if self.open else 0

    def end_line(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                heading = any(self.count[tag] for tag in HEADINGS)
                self.lines.append(Line(text, self.met, self._innermost(), self.linked, heading))
            self.held = []
        self.met = self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.met += 1
        if self.count["head"] and (tag == "body" or (self.tags[self._innermost()] == "head" and tag not in _IN_HEAD)):
            self._close("head")
        if tag in VOID:
            return
        self._close_sibling(tag)
        in_article = bool(self.count["article"] or self.count["main"])
        self._add(tag, self._innermost(), judge_element(tag, attrs, in_article) if attrs or tag in DROPPED or tag == "header" else _KEEP)
        self.open.append(len(self.tags) - 1)
        self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, *tags: str) -> None:
        """Close elements up to the innermost open one of these tags."""
        if any(self.count[tag] for tag in tags):
            while True:
                tag = self.tags[self.open.pop()]
                self.count[tag] -= 1
                if tag in tags:
                    return

    def _close_sibling(self, tag: str) -> None:
        closes = _SIBLINGS.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
        if not any(self.count[each] for each in closes):
            return
        for element in reversed(self.open):
            name = self.tags[element]
            if name in closes:
                self._close(name)
                return
            if name in _SCOPES:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.met += 1
        self._close(tag)

    def handle_data(self, data: str) -> None:
        element = self._innermost()
        if self.tags[element] in ("script", "style"):
            return
        self.sizes[element] += len(data.strip())
        self.held.append(data)
        if self.count["a"]:
            self.linked += len(data)


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing that keeps its weight at the ends."""
    reach = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(np.ones(len(ratios)), weights)[reach : reach + len(ratios)]
    return np.convolve(ratios, weights)[reach : reach + len(ratios)] / total


@dataclass
class Ratios:
    """Text-to-tag ratios of lines, the smoothed ones, and their threshold."""

    sizes: np.ndarray
    plain: np.ndarray
    smoothed: np.ndarray
    least: float
    links: np.ndarray  # lines that are mostly links

    @classmethod
    def of(cls, lines: list[Line]) -> Ratios:
        sizes = np.array([len(line.text) for line in lines], float)
        plain = sizes / np.array([max(1, line.tags) for line in lines])
        smoothed = smooth(plain)
        links = np.array([line.links for line in lines]) > 0.5 * sizes
        return cls(sizes, plain, smoothed, min(smoothed.std(), smoothed.max()), links)

    def high(self) -> np.ndarray:
        return (self.smoothed >= self.least) & ~self.links


def _sums(values: list[float], parents: list[int]) -> list[float]:
    """The values of each element and all below it."""
    sums = list(values)
    for element in range(len(sums) - 1, 0, -1):
        sums[parents[element]] += sums[element]
    return sums


def _wrappers(page: _Events) -> set[int]:
    """Elements that bear a mark but hold the article, or most of the page's text."""
    against, parents = page.against, page.parents
    size = len(against)
    wraps, gone = [0] * size, [False] * size  # marked elements down to this one
    for element in range(1, size):
        parent = parents[element]
        wraps[element] = wraps[parent] + (against[element] == _WRAP)
        gone[element] = gone[parent] or against[element] == _GONE
    articles = [e for e in range(size) if page.tags[e] in ("article", "main") and not gone[e]]
    # An article bears its own mark, the others are around it.
    around = {e: wraps[e] - (against[e] == _WRAP) for e in articles}
    plain = [e for e in articles if against[e] != _WRAP] or articles
    if plain:
        depth = min(around[e] for e in plain)
        holds = [0.0] * size
        for element in plain:
            holds[element] = 1.0
        holds = _sums(holds, parents)
        return {e for e in range(size) if against[e] == _WRAP and wraps[e] <= depth and holds[e]} | (
            set(plain) if plain is articles else set()
        )
    sizes = _sums(page.sizes, parents)
    return {e for e in range(size) if against[e] == _WRAP and not gone[e] and 2 * sizes[e] > sizes[0]}


def _dropped(page: _Events) -> list[bool]:
    """Which elements go, with all in them."""
    against, parents = page.against, page.parents
    spared = _wrappers(page)
    dropped = [False] * len(against)
    low: list[int] = []
    for element in range(1, len(against)):
        own = against[element] in (_WRAP, _GONE) and element not in spared
        dropped[element] = dropped[parents[element]] or own
        if against[element] == _LOW and not dropped[element]:
            low.append(element)
    if not low:
        return dropped
    lines = [line for line in page.lines if not dropped[line.element]]
    if lines:
        ratios = Ratios.of(lines)
        high = [0.0] * len(against)
        every = [0.0] * len(against)
        for line, size, good in zip(lines, ratios.sizes, ratios.high(), strict=True):
            every[line.element] += size
            high[line.element] += size * good
        every, high = _sums(every, parents), _sums(high, parents)
        for element in low:
            dropped[element] = 2 * high[element] < every[element]
        for element in range(1, len(against)):
            dropped[element] = dropped[element] or dropped[parents[element]]
    return dropped


def _within(chosen: set[int], parents: list[int]) -> list[bool]:
    inside = [False] * len(parents)
    for element in range(1, len(parents)):
        inside[element] = element in chosen or inside[parents[element]]
    return inside


def _clusters(lines: list[Line], ratios: Ratios) -> list[str]:
    """The lines of the clusters, from the first to the last that is high by itself, with the
    headings right before them."""
    high, strong = ratios.high(), (ratios.plain >= ratios.least) & ~ratios.links
    kept: list[str] = []
    start = 0
    for at in range(len(lines) + 1):
        if at < len(lines) and high[at]:
            continue
        places = start + np.flatnonzero(strong[start:at])
        if len(places):
            first, last = int(places[0]), int(places[-1])
            while first and lines[first - 1].heading and not ratios.links[first - 1]:
                first -= 1
            kept += [line.text for line in lines[first : last + 1]]
        start = at + 1
    return kept


def main_text(html: str) -> str:
    page = _Events()
    page.feed(html)
    page.close()
    page.end_line()
    dropped = _dropped(page)
    lines = [line for line in page.lines if not dropped[line.element]]
    if not lines:
        return ""
    held = [0.0] * len(page.tags)
    for line in lines:
        held[line.element] += 1
    held = _sums(held, page.parents)
    for tag in ("article", "main"):
        chosen = {element for element, name in enumerate(page.tags) if name == tag and held[element]}
        if chosen:
            inside = _within(chosen, page.parents)
            return "\n".join(line.text for line in lines if inside[line.element])
    ratios = Ratios.of(lines)
    weight = np.where(ratios.high(), ratios.sizes, 0.0)
    if not weight.any():
        weight = ratios.sizes
    held = [0.0] * len(page.tags)
    for line, part in zip(lines, weight.tolist(), strict=True):
        held[line.element] += part
    held = _sums(held, page.parents)
    enough = [e for e, name in enumerate(page.tags) if name in HOLDERS and held[e] >= held[0] - 0.5]
    if enough and page.tags[max(enough)] != "body":
        inside = _within({max(enough)}, page.parents)
        return "\n".join(line.text for line in lines if inside[line.element])
    return "\n".join(_clusters(lines, ratios))


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: its id, its address, the article's text and its code points."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([main_text(html) for html in texts_of(batch.column(2))], pa.string())
        sizes = pc.cast(pc.utf8_length(texts), pa.int64())
        columns = [pc.cast(batch.column(0), pa.int64()), batch.column(1), texts, sizes]
        return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return map_batches(pages, [id_col, url_col, html_col], work, SCHEMA)
