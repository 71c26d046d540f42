"""Main text of web pages from the standard library's parser events.

The parser's events are turned into lines, one for each block of the page, with the characters outside
links and the tags in each. The text-to-tag ratios are smoothed with a Gaussian along the page and split
into two clusters; lines of the upper cluster are content. Where content lies in an article or main
element, the region is that element, so its headings and short paragraphs are kept. Elsewhere the ratios are
clustered by their logarithms, which one long paragraph does not rule, and the region is the run of content
lines and what stands beside them in the same element. Lines inside menus, headers, footers, sidebars,
notices, adverts, forms and comments count as tags without text and are never kept. A form, or an element that
only its class or id gives such a name, keeps its lines if it turns out to hold the article (``_strays``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import in_small_batches

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(
    "head script style noscript template svg math iframe object canvas audio video title textarea select datalist button".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table caption tbody thead tfoot tr ul".split()
)
_CELLS = frozenset(("br", "td", "th"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PAGE = frozenset(("html", "body"))
_REGION = frozenset(("article", "main"))
#: Elements that hold no part of an article; a header may, inside one.
_BESIDE = frozenset("nav footer aside menu dialog search".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
#: Words in class and id that mark what surrounds an article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted "
    "sidebar aside nav navbar navigation menu breadcrumb breadcrumbs footer cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies respond pagination pager "
    "toolbar widget widgets banner skip masthead".split()
)
#: Of these, what also marks an article element itself.
_NOT_ARTICLES = frozenset("ad ads advert advertisement sponsored promo comment comments reply related".split())
_HEADERS = frozenset(("header", "masthead"))
#: Marks of what readers wrote, however much it is.
_READERS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Words behind a mark that change nothing: a name's last word but these says what the element is.
_NEUTRAL = frozenset(
    "area bar block bottom box button buttons column container content form group inner item items left link links list "
    "module outer panel posts right row section slot stories top unit wrap wrapper".split()
)
#: Names with one of these say that something else has or lacks the thing.
_ABOUT = frozenset("has have no not with without".split())
#: Elements that end where another of the same kind begins.
_SIBLINGS = {name: frozenset((name,)) for name in ("li", "tr", "option")}
_SIBLINGS |= {name: frozenset(("dt", "dd")) for name in ("dt", "dd")} | {name: frozenset(("td", "th")) for name in ("td", "th")}
#: An end tag, or an element that ends where a sibling begins, reaches no further out than these.
_WALLS = frozenset("article aside body div footer form header main nav section table td th ul ol dl".split())
_WORDS = re.compile(r"[a-z]+")
_PIECE = 1 << 20
SIGMA = 2.0


@dataclass(slots=True)
class Line:
    text: str
    outside_links: int
    tags: int
    region: int
    beside: bool
    heading: bool
    mark: int
    block: int


@dataclass(slots=True)
class Mark:
    """A form or an element named by class or id like what surrounds an article; ``main`` if main text or an h1 is in it."""

    above: int
    readers: bool
    main: bool = False


class Element(NamedTuple):
    tag: str = ""
    silent: bool = False
    beside: bool = False
    region: int = 0
    link: bool = False
    #: The innermost mark that it is in, 0 for none.
    mark: int = 0
    #: The innermost block that it is in, itself included.
    block: int = 0


class _Lines(HTMLParser):
    """Turns events into lines. ``blocks`` holds the name of each block and the one that it is in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Element] = []
        self.count: dict[str, int] = {}
        self.regions = 0
        self.marks = [Mark(0, False)]
        self.anchors: list[tuple[int, bool]] = []
        self.blocks: list[tuple[str, int]] = [("", 0)]
        self.parts: list[str] = []
        self.links = self.tags = 0
        self.now = Element()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCK:
            self._end_line()
            if self.count.get("p"):
                self._close("p", wall=True)
        elif tag in _CELLS:
            self.parts.append(" ")
        if tag in _SIBLINGS:
            for name in _SIBLINGS[tag]:
                if self.count.get(name):
                    self._close(name, wall=True)
        self.tags += 1
        if tag in _VOID:
            return
        _, silent, beside, region, link, mark, block = self.now
        if not silent:
            silent = tag in _SILENT
            beside = beside or self._is_beside(tag, attrs, region)
            if not beside:
                words = self._marks_of(tag, attrs, region)
                if words:
                    self.marks.append(Mark(mark, bool(words & _READERS)))
                    mark = len(self.marks) - 1
                if tag in _REGION and not words and not region:
                    self.regions += 1
                    region = self.regions
                if tag == "h1" or tag in _REGION and not words:
                    self.anchors.append((mark, tag != "h1"))
                    above = mark if tag != "article" else 0
                    while above and not self.marks[above].main:
                        self.marks[above].main = True
                        above = self.marks[above].above
        if tag in _BLOCK:
            self.blocks.append((tag, block))
            block = len(self.blocks) - 1
        self.now = Element(tag, silent, beside, region, link or tag == "a", mark, block)
        self.open.append(self.now)
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in _BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK:
            self._end_line()
        elif tag in _CELLS:
            self.parts.append(" ")
        self.tags += 1
        if self.count.get(tag):
            self._close(tag, wall=tag not in _WALLS)

    def handle_data(self, data: str) -> None:
        if not self.now.silent:
            self.parts.append(data)
            if self.now.link:
                self.links += len(data)

    def finish(self) -> list[Line]:
        self.close()
        self._end_line()
        return self.lines

    def _close(self, tag: str, wall: bool) -> None:
        """Ends the innermost such element and all in it, unless a wall stands between."""
        at = len(self.open) - 1
        while at >= 0 and self.open[at].tag != tag:
            if wall and self.open[at].tag in _WALLS:
                return
            at -= 1
        if at < 0:
            return
        for element in self.open[at:]:
            self.count[element.tag] -= 1
        del self.open[at:]
        self.now = self.open[-1] if self.open else Element()

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            tag, _, beside, region, _, mark, block = self.now
            self.lines.append(Line(text, max(0, len(text) - self.links), self.tags, region, beside, tag in _HEADINGS, mark, block))
        self.parts.clear()
        self.links = self.tags = 0

    @staticmethod
    def _is_beside(tag: str, attrs: list, region: int) -> bool:
        if tag in _PAGE:
            return False
        if tag in _BESIDE or tag == "header" and not region:
            return True
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if not value:
                continue
            if name == "role" and value.strip().lower() in _ROLES:
                return True
            if name == "style" and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    @staticmethod
    def _marks_of(tag: str, attrs: list, region: int) -> set[str]:
        """The marks in an element's names; headings have none, as their ids are anchors."""
        if tag in _PAGE or tag in _HEADINGS:
            return set()
        found = {"form"} if tag == "form" else set()
        known = _NOT_ARTICLES if tag in _REGION else _MARKS
        for name, value in attrs:
            if value and name in ("class", "id"):
                for token in value.split():
                    words = _WORDS.findall(token.lower())
                    while len(words) > 1 and words[-1] in _NEUTRAL or len(words) > 1 and len(words[-1]) == 1:
                        words.pop()
                    if words and not _ABOUT.intersection(words):
                        if words[-1] in known or not region and tag not in _REGION and words[-1] in _HEADERS:
                            found.add(words[-1])
        return found


def _strays(parser: _Lines) -> None:
    """Sets ``beside`` for the lines in marked elements, unless the mark is void.

    A mark is void if main or an h1 lies in its element. If all article and main elements lie in marked ones, or
    there is none, a mark is also void where its element holds more than half of the page's text outside links;
    not so that of what readers wrote, if an h1 lies outside.
    """
    lines, marks = parser.lines, parser.marks
    live = [bool(k) and not mark.main for k, mark in enumerate(marks)]

    def inside(mark: int) -> bool:
        while mark and not live[mark]:
            mark = marks[mark].above
        return bool(mark)

    free = [whole for mark, whole in parser.anchors if not inside(mark)]
    if not any(free):
        held = [0] * len(marks)
        for line in lines:
            if not line.beside:
                held[line.mark] += line.outside_links
        for k in range(len(marks) - 1, 0, -1):  # what is in an element comes after it
            held[marks[k].above] += held[k]
        live = [x and (2 * held[k] <= held[0] or marks[k].readers and bool(free)) for k, x in enumerate(live)]
    for line in lines:
        line.beside = line.beside or inside(line.mark)


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian means; the kernel's weights are those within the page."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    n = len(values)
    total = np.convolve(values, kernel)[reach:reach + n]
    return total / np.convolve(np.ones(n), kernel)[reach:reach + n]


def two_means(values: np.ndarray) -> float:
    """The border between two clusters of numbers."""
    low, high = float(values.min()), float(values.max())
    for _ in range(100):
        border = (low + high) / 2
        upper = values >= border
        if upper.all() or not upper.any():
            break
        after = float(values[~upper].mean()), float(values[upper].mean())
        if after == (low, high):
            break
        low, high = after
    return (low + high) / 2


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The article's blocks, joined by blank lines; empty for a null, empty or textless page.

    Character references are decoded and white space in a block becomes one space. Pages are read whole, in
    pieces; elements left open end with what holds them.
    """
    parser = _Lines()
    for start in range(0, len(html or ""), _PIECE):
        parser.feed(html[start:start + _PIECE])
    lines = parser.finish()
    _strays(parser)
    if not any(line.text and not line.beside for line in lines):
        return ""
    ratios = np.array([0.0 if line.beside else line.outside_links / max(1, line.tags) for line in lines])
    own = np.array([bool(line.text) and not line.beside for line in lines])
    content = _upper(ratios, sigma) & own
    if not content.any():
        content = own
    regions = {lines[i].region for i in np.flatnonzero(content)} - {0}
    if regions:
        kept = [line.text for line, o in zip(lines, own, strict=True) if o and line.region in regions]
    else:
        content = _upper(np.log1p(ratios), sigma) & own
        kept = [lines[i].text for i in np.flatnonzero(_run(lines, content if content.any() else own, parser.blocks) & own)]
    return "\n\n".join(kept)


def _upper(ratios: np.ndarray, sigma: float) -> np.ndarray:
    smoothed = smooth(ratios, sigma)
    return smoothed >= two_means(smoothed)


def _run(lines: list[Line], content: np.ndarray, blocks: list[tuple[str, int]]) -> np.ndarray:
    """Without an article element: content lines, what stands beside them, all between, and the headings right before.

    Beside a content line is what lies in the element that its block is in; right in the page, only blocks of the same
    name and headings. Lines that are mostly links are left out.
    """
    def holder(block: int) -> int:
        up = blocks[block][1]
        return 0 if blocks[up][0] in _PAGE else up

    kept = content.copy()
    spots = np.flatnonzero(content)
    holders = {holder(lines[i].block) for i in spots} - {0}
    names = {blocks[lines[i].block][0] for i in spots if not holder(lines[i].block)}
    near = [False] * len(blocks)  # a block comes after what it is in
    for k in range(1, len(blocks)):
        near[k] = k in holders or near[blocks[k][1]]
    for i, line in enumerate(lines):
        at_page = bool(names) and not holder(line.block) and (line.heading or blocks[line.block][0] in names)
        if spots[0] <= i <= spots[-1] or at_page or near[line.block]:
            kept[i] |= 2 * line.outside_links >= len(line.text)
    i = int(np.flatnonzero(kept)[0]) - 1
    while i >= 0 and (lines[i].heading or not lines[i].text):
        kept[i] = True
        i -= 1
    return kept


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; ``n_chars`` counts code points. Repeated rows are kept."""
    source = pages.select("page_id", "url", F.col(html).alias("html"))

    def extract(batches):
        for rows in batches:
            texts = [main_text(value) for value in rows.column(2).to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

    kinds = dict(source.dtypes)
    return in_small_batches(source).mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
