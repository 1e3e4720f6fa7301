"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams a page into lines, one for each block of text, each with the
number of tags met since the line before. Lines inside elements that never hold the article (menus,
headers, footers, scripts) are left out; forms, and elements whose class, id or role names such a
thing, are marked. A mark does not count on what holds the article, and a name that may mean other
things does not count on what reads like the article: see ``_wrappers``. The ratio of text to tags of
the other lines is smoothed by a Gaussian over neighbours, and lines above a threshold form clusters.
The element that holds most of the clustered text leads to the content region. Where that is an
article or main element, all unmarked lines there are the text, short ones included. Else the page
says nothing about its parts, and the clusters are the text, without links at their ends and with
the headings right before them.

Open elements, marks and regions are kept as trees and counted as they open and close, so a page
takes time in proportion to its length, however deep it is nested.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import chunks

#: Elements that begin a new block.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text is never part of an article.
SKIPPED = frozenset(
    "script style head title noscript template iframe object svg canvas nav footer aside "
    "button select textarea input menu dialog".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that can be a content region.
REGIONS = frozenset("article main section div body td".split())
ITEMS = frozenset("li dt dd tr td th option".split())
#: Elements whose items are their own.
SCOPES = frozenset("ul ol menu dl table".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end an open paragraph.
ENDS_P = BLOCKS - {"body", "html", "tr", "td", "th", "tbody", "thead", "tfoot"}
_NAMES = re.compile(
    r"(?:^|[_-])(ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|notification|"
    r"popup|modal|newsletter|subscri\w*|nav\w*|menu|breadcrumbs?|sidebar|aside|widget|related|"
    r"shar(?:e|ing)(?=$|[_-](?:buttons?|bars?|links?|icons?|box|tools?|widget|list|counts?|this|post|"
    r"wrap\w*|container|menu|block|top|bottom)(?:$|[_-]))|"
    r"social|comment(?:s|list|area|box|form|thread|section|wrap\w*)?|replies|disqus|respond|footer|masthead|header|login|signup|search|"
    r"pagination|toolbar)(?:$|[_-])"
)
#: From here on, a name says what an element has or how it is, not what it is.
_MODIFIER = re.compile(
    r"(?:^|[_-])(?:has|no|not|with|without|hide|show)[_-].*|"
    r"(?:^|[_-])[a-z]+[_-](?:open|opened|closed|visible|enabled|disabled|on|off)$"
)
_READERS = re.compile(r"comment|repl|disqus|respond")
_SPACE = re.compile(r"\s+")
SIGMA = 2.0


def _named(tag: str, value: str) -> str:
    """The listed word that a class or id names, or nothing. Tables, mostly data, have to be named
    by the whole word."""
    for name in value.lower().split():
        found = _NAMES.search(_MODIFIER.sub("", name))
        if found and (tag != "table" or found.group(1) == name):
            return found.group(1)
    return ""


#: Names that say less of a paragraph, and, inside an article, of what reads like it.
_VAGUE = re.compile(r"nav|menu|header|footer|masthead|search|toolbar|banner|widget|pagination|login|signup")


@dataclass
class Line:
    text: str
    tags: int  #: since the line before
    mark: int  #: the innermost, 0 for none
    region: int  #: the innermost, 0 for none
    heading: bool
    linked: bool  #: all of it links


@dataclass
class Mark:
    parent: int
    region: int  #: around it
    readers: bool = False
    vague: bool = False


@dataclass
class Region:
    parent: int
    mark: int  #: around it
    name: str = ""


class Lines(HTMLParser):
    """The blocks of a page, the marks on its elements, and the elements that can be its region.

    Marks and regions are numbered as they open, each after its parent; 0 stands for the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.marks, self.regions = [Mark(0, 0)], [Region(0, 0)]
        self.open: list[tuple[str, int, int, bool]] = []  # name, mark and region before, never
        self.places: defaultdict[str, list[int]] = defaultdict(list)  # of open elements, by name
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.borders: list[int] = []  # elements that bear a mark or are never article
        self.text: list[str] = []
        self.tags = self.never = self.headings = self.mark = self.region = 0
        self.bare = False  # whether there is text outside of links

    def _flush(self):
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        linked, self.bare = not self.bare, False
        self.text.clear()
        if text:
            if not self.never:
                self.lines.append(
                    Line(text, self.tags, self.mark, self.region, self.headings > 0, linked)
                )
            self.tags = 0

    def _inside(self, *names: str) -> bool:
        return any(self.places[n] for n in names)

    def _is_never(self, tag: str, given: dict) -> bool:
        if tag in SKIPPED or tag == "header" and not self._inside("article", "main"):
            return True
        if "hidden" in given or (given.get("aria-hidden") or "").lower() == "true":
            return True
        return (given.get("role") or "").lower() in ROLES

    def _marked(self, tag: str, given: dict) -> Mark | None:
        if tag in ("article", "main", "body", "html", "h1"):
            return None
        names = [n for n in (_named(tag, given.get(k) or "") for k in ("class", "id")) if n]
        if tag == "p":
            names = [n for n in names if not _VAGUE.match(n)]
        if not names:
            return Mark(self.mark, self.region) if tag == "form" else None
        return Mark(
            self.mark, self.region, any(map(_READERS.match, names)), all(map(_VAGUE.match, names))
        )

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
            if tag in ENDS_P and self.places["p"]:
                self._close(self.places["p"][-1])
        elif tag == "br":
            self.text.append("\n")
        if tag in VOID:
            return
        if tag in ITEMS and self.places[tag] and self.places[tag][-1] > (self.scopes or [-1])[-1]:
            self._close(self.places[tag][-1])
        given, at = dict(attrs), len(self.open)
        never = self._is_never(tag, given)
        mark = None if never else self._marked(tag, given)
        if never or mark:
            self._flush()
            self.borders.append(at)
        self.open.append((tag, self.mark, self.region, never))
        self.places[tag].append(at)
        if tag in BLOCKS:
            self.blocks.append(at)
        if tag in SCOPES:
            self.scopes.append(at)
        if tag in REGIONS:
            self.regions.append(Region(self.region, self.mark, tag))
            self.region = len(self.regions) - 1
        if mark:
            self.marks.append(mark)
            self.mark = len(self.marks) - 1
        self.never += never
        self.headings += tag in HEADINGS

    def _close(self, at: int):
        if (self.blocks or [-1])[-1] >= at or (self.borders or [-1])[-1] >= at:
            self._flush()
        while len(self.open) > at:
            tag, self.mark, self.region, never = self.open.pop()
            self.places[tag].pop()
            self.never -= never
            self.headings -= tag in HEADINGS
        for places in (self.blocks, self.scopes, self.borders):
            while places and places[-1] >= at:
                places.pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash closes void elements only

    def handle_endtag(self, tag):
        self.tags += 1
        if self.places[tag]:
            at = self.places[tag][-1]
            # An inline end tag does not close blocks around it.
            if tag in BLOCKS or tag in SKIPPED or (self.blocks or [-1])[-1] < at:
                self._close(at)
        elif tag in BLOCKS:
            self._flush()

    def handle_data(self, data):
        self.text.append(data)
        self.bare = self.bare or not self.places["a"] and not data.isspace()

    def finish(self) -> list[Line]:
        self.close()
        self._flush()
        return self.lines


def _clustered(ratio: np.ndarray, sigma: float) -> np.ndarray:
    """Lines whose smoothed ratio exceeds the threshold: half a standard deviation, or the mean if
    that is smaller."""
    reach = int(3 * sigma)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratio, weights)[reach : reach + len(ratio)]
    smooth = total / np.convolve(np.ones(len(ratio)), weights)[reach : reach + len(ratio)]
    return smooth >= min(smooth.std() / 2 if smooth.std() > 0 else 0.0, smooth.mean())


def _sums(parents: list[int], own) -> np.ndarray:
    """What each node of a tree holds with all below it."""
    out = np.array(own, np.int64)
    for k in range(len(parents) - 1, 0, -1):
        out[parents[k]] += out[k]
    return out


def _way(parents: list[int], k: int) -> list[int]:
    """A node and those around it, innermost first."""
    out = []
    while k:
        out.append(k)
        k = parents[k]
    return out


class Page:
    """Sums over the marks and regions of a page's lines."""

    def __init__(self, parser: Lines):
        self.lines, self.marks, self.regions = parser.lines, parser.marks, parser.regions
        self.over_mark = [m.parent for m in self.marks]
        self.over_region = [r.parent for r in self.regions]
        self.size = np.array([len(x.text) for x in self.lines])

    def by_mark(self, value) -> np.ndarray:
        own = np.bincount([x.mark for x in self.lines], value, len(self.marks))
        return _sums(self.over_mark, own)

    def by_region(self, value) -> np.ndarray:
        own = np.bincount([x.region for x in self.lines], value, len(self.regions))
        return _sums(self.over_region, own)

    def outermost(self, kind: str) -> list[int]:
        """For each region the outermost one of the kind around it, itself included, or 0."""
        out = [0] * len(self.regions)
        for k, r in enumerate(self.regions[1:], 1):
            out[k] = out[r.parent] or (k if r.name == kind else 0)
        return out


def _wrappers(page: Page) -> list[bool]:
    """Of each mark, whether it does not count.

    Such a mark is around a main element, or, where none is free of marks, around an article
    longer than all unmarked text, or has most of the text of its article, or of the page if no
    article stands outside. Readers' comments are not the article because of their length. A vague
    name inside an article does not count on what has as much text for its tags as the article, nor
    on its first heading. Where everything is marked, no mark counts.
    """
    marks, regions, size = page.marks, page.regions, page.size
    total, free = int(size.sum()), int(sum(len(x.text) for x in page.lines if not x.mark))
    held, scope = page.by_mark(size), page.by_region(size)
    # Text of a region outside of further marks: only regions under the same marks pass it on.
    inner = np.zeros(len(regions), np.int64)
    for x in page.lines:
        inner[x.region] += len(x.text) * (x.mark == regions[x.region].mark)
    for k in range(len(regions) - 1, 0, -1):
        if regions[regions[k].parent].mark == regions[k].mark:
            inner[regions[k].parent] += inner[k]
    kinds = {k: [i for i, r in enumerate(regions) if r.name == k] for k in ("article", "main")}
    open_ = {k: any(inner[i] and not regions[i].mark for i in own) for k, own in kinds.items()}
    out = [False] * len(marks)

    def uncount(mark: int) -> None:
        while mark and not out[mark]:
            out[mark] = True
            mark = marks[mark].parent

    for i in kinds["main"]:
        if scope[i]:
            uncount(regions[i].mark)
    if not open_["article"] and not open_["main"]:
        readers = [False] * len(marks)
        for k, m in enumerate(marks[1:], 1):
            readers[k] = readers[m.parent] or m.readers
        for i in kinds["article"]:
            if inner[i] > free and not readers[regions[i].mark]:
                uncount(regions[i].mark)
    around = {k: page.outermost(k) for k in ("article", "main")}
    tags = page.by_mark([x.tags for x in page.lines])
    plain = np.array([x.mark == regions[x.region].mark for x in page.lines])
    article_tags = page.by_region(np.array([x.tags for x in page.lines]) * plain)
    titles = page.by_mark([x.heading for x in page.lines])
    for k, m in enumerate(marks[1:], 1):
        whole = total
        for kind in ("article", "main"):
            if around[kind][m.region]:
                whole = scope[around[kind][m.region]]
                break
            if open_[kind]:
                whole = 2 * held[k]  # the article is elsewhere
                break
        if not m.readers and 2 * held[k] > whole:
            out[k] = True
        inside = around["article"][m.region] or around["main"][m.region]
        if m.vague and inside and held[k]:
            reads = held[k] / max(tags[k], 1) >= 0.5 * inner[inside] / max(article_tags[inside], 1)
            title = titles[k] and not titles[1:k].any() and 2 * held[k] < inner[inside]
            out[k] = out[k] or bool(reads and held[k] >= 80) or bool(title)
    if not any(page_free(out, marks, x.mark) for x in page.lines):
        out = [True] * len(marks)
    return out


def page_free(out: list[bool], marks: list[Mark], mark: int) -> bool:
    """Whether no mark around counts."""
    while mark and out[mark]:
        mark = marks[mark].parent
    return not mark


def _region(page: Page, chosen: np.ndarray) -> int:
    """The content region, or 0 for the whole page.

    An article around most of the clustered text is taken whole; what stands beside it belongs to
    it only inside of a common main element. Without article and main, the region holds every
    clustered line and heading.
    """
    weight, total = page.by_region(page.size * chosen), int((page.size * chosen).sum())
    holding = [k for k in range(1, len(weight)) if 2 * weight[k] > total]
    if not holding:
        return 0
    path = _way(page.over_region, holding[-1])  # they lie in each other, the last is the deepest
    path.reverse()
    names = [page.regions[k].name for k in path]
    articles = [k for k, n in zip(path, names) if n == "article"]
    whole = [k for k, n in zip(path, names) if n in ("article", "main")]
    # From the first article or main inside to the outermost: the deepest that holds all.
    limit = whole[0] if whole else 0
    least = path.index((articles or whole)[0]) if whole else len(path) - 1
    needed = chosen | np.array([x.heading for x in page.lines])
    if limit:
        needed = needed & _within(page, limit)
    held, every = page.by_region(needed), int(needed.sum())
    for k in path[least::-1]:
        if k == limit or held[k] == every:
            return k
    return 0


def _within(page: Page, region: int) -> np.ndarray:
    """Which lines lie in a region."""
    inside = [not region] * len(page.regions)
    for k in range(1, len(inside)):
        inside[k] = k == region or inside[page.over_region[k]]
    return np.array([inside[x.region] for x in page.lines])


def _trimmed(page: Page, chosen: np.ndarray) -> np.ndarray:
    """The clusters without links at their ends, where smoothing reaches over the border, and with
    the headings right before them."""
    out, lines = chosen.copy(), page.lines
    for way in (range(len(out)), range(len(out) - 1, -1, -1)):
        edge = True
        for k in way:
            edge = not out[k] or edge and lines[k].linked and not lines[k].heading
            out[k] = out[k] and not edge
    for k in range(len(out) - 2, -1, -1):
        out[k] = out[k] or lines[k].heading and out[k + 1]
    return out


def main_text(html: str, sigma: float = SIGMA, clusters: bool = True) -> str:
    """The text of a page's content region, one line for each block; without ``clusters``, all
    unmarked text."""
    parser = Lines()
    parser.feed(html)
    parser.finish()
    page = Page(parser)
    if len(parser.marks) > 1 and page.lines:
        wrappers = _wrappers(page)
        counts = [False] * len(parser.marks)  # whether a mark around, itself included, counts
        for k, m in enumerate(parser.marks[1:], 1):
            counts[k] = counts[m.parent] or not wrappers[k]
        parser.lines = [x for x in page.lines if not counts[x.mark]]
        page = Page(parser)
    if not page.lines:
        return ""
    if not clusters:
        return "\n".join(x.text for x in page.lines)
    ratio = np.array([len(x.text) / max(x.tags, 1) for x in page.lines])
    chosen = _clustered(ratio, sigma)
    region = _region(page, chosen)
    kept = _within(page, region)
    if not any(page.regions[k].name in ("article", "main") for k in _way(page.over_region, region)):
        kept &= _trimmed(page, chosen)
    return "\n".join(x.text for x, use in zip(page.lines, kept) if use)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` from the whole html.

    A null or empty page has the empty text, as has a page without any text outside of what is
    marked. Broken markup is read as the parser reads it. Repeated rows and null ids are rows like
    any other; other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        for batch in chunks(batches, column="html"):
            texts = [main_text(x or "") for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array(list(map(len, texts)), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
