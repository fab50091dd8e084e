"""Main text of HTML pages by text-to-tag ratio.

The standard library's parser streams events; block elements cut the page into
lines, each with a ratio of text characters to tags. Elements that are marked as
something else (menus, headers, forms, adverts, notices, reader comments ...)
give no lines. The ratios are smoothed with a Gaussian, lines above a threshold
form the content cluster, and the cluster decides where the article is: in the
smallest section-like container around all lines of the cluster that are long
themselves (smoothing also lifts short neighbours, which widen nothing) and the
headings before them. Elements named article or main only settle what the ratios
leave open: how far around that region the article goes, and, where long lines
are scattered, which element holds most of the cluster. Of the region every line
counts, short ones too.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import small_batches

# HTML elements by their role.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article aside blockquote body center details dialog div dl fieldset figure footer form header hgroup main menu nav ol search section table tbody td tfoot th thead tr ul".split())
SECTIONS = frozenset("page article body center div main section".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED = frozenset("script style noscript template head title iframe object svg canvas audio video select option textarea button".split())
BESIDE = frozenset("nav header footer aside form menu dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose end tag may be missing: what a start tag closes, and where the search for it ends.
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset("tbody thead tfoot".split()), frozenset(["table"])),
    "thead": (frozenset("tbody thead tfoot".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot".split()), frozenset(["table"])),
}
# Words in class names and ids that mark something beside the article, and words that may stand with them.
MARKS = frozenset(
    "ad ads adbox adslot adunit advert adverts advertisement advertisements advertising adsense alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright dialog disqus footer gdpr header lightbox login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promos promoted promotion recommendation recommendations recommended related replies respond search share sharing sidebar signup skiplink social sponsor sponsored sponsors submenu subscribe subscription toolbar widget widgets".split()
)
BESIDE_MARKS = frozenset(
    "a and area article articles author bar block body bottom box btn button buttons by col column container content count desktop div entry first fixed form global google group hidden icon icons inner item items js label last left level link links list main mini mobile more outer page panel post posts primary reader readers right row secondary section side site skip slot small sticky stories story text the thread title to toggle top unit user users visitor wrap wrapper".split()
)
OF_THE_ARTICLE = frozenset("article entry post story content section".split())
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
SPACES = re.compile(r"\s+")
BETWEEN_LINKS = re.compile(r"[\s|/\xb7\u2022\xbb\u203a>-]*")


def marks(name: str) -> bool:
    """Whether a class name or id marks its element as beside the article: all its words are marks or go with one, as in ad-slot-2, not in related-work."""
    words = [w.lower() for w in PARTS.findall(name)]
    if not any(w in MARKS for w in words) or not all(w in MARKS or w in BESIDE_MARKS for w in words):
        return False
    return not ("header" in words and any(w in OF_THE_ARTICLE for w in words))


class Line(NamedTuple):
    text: str
    tags: int
    node: int
    heading: bool


class Open(NamedTuple):
    tag: str
    container: bool
    beside: bool
    node: int


class Lines(HTMLParser):
    """Collects the lines of a page; node is the number of the innermost container that a line is in.

    Numbers grow in page order and a container has all numbers up to its ends
    entry. Lines inside skipped or marked elements are not collected; their tags
    count for nothing. Rows of links with nothing but signs between them are
    menus. An end tag closes what is open inside its element; missing end tags
    of paragraphs, list items, rows and cells are supplied; unknown end tags are
    ignored, and what is open at the end of the page is closed.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.kinds, self.parents, self.ends = ["page"], [-1], [-1]
        self.open: list[Open] = []
        #: Places in open of each tag, of containers, and of paragraphs and headings, so that nothing has to be searched.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.containers: list[int] = []
        self.paragraphs: list[int] = []
        self.node = self.off = self.pre = self.articles = 0
        self.skip: list[str] = []
        self.text: list[str] = []
        self.outside: list[str] = []
        self.links = self.tags = 0
        self.in_link = self.heading = False

    def cut(self) -> None:
        text = SPACES.sub(" ", "".join(self.text)).strip()
        menu = self.links > 2 and BETWEEN_LINKS.fullmatch("".join(self.outside))
        if text and not menu:
            self.lines.append(Line(text, self.tags, self.node, self.heading))
            self.tags = 0
        self.text.clear()
        self.outside.clear()
        self.links = 0

    def push(self, tag: str, container: bool, beside: bool, main: bool) -> None:
        self.places[tag].append(len(self.open))
        if container:
            self.containers.append(len(self.open))
        if tag == "p" or tag in HEADINGS:
            self.paragraphs.append(len(self.open))
        self.open.append(Open(tag, container, beside, self.node))
        self.off += beside
        self.articles += tag == "article"
        if container:
            self.kinds.append("main" if main else tag)
            self.parents.append(self.node)
            self.ends.append(-1)
            self.node = len(self.kinds) - 1

    def pop(self, keep: int) -> None:
        """Closes all but the first keep of the open elements."""
        while len(self.open) > keep:
            tag, container, beside, node = self.open.pop()
            self.places[tag].pop()
            if self.paragraphs and self.paragraphs[-1] == len(self.open):
                self.paragraphs.pop()
            self.off -= beside
            self.articles -= tag == "article"
            if container:
                self.containers.pop()
                self.ends[self.node] = len(self.kinds) - 1
                self.node = node

    def inline(self) -> int:
        """How many elements are open, without the non-containers on top."""
        return self.containers[-1] + 1 if self.containers else 0

    def implied(self, tag: str) -> None:
        """Closes what the start of tag closes."""
        at = bisect_left(self.paragraphs, self.inline())
        if at < len(self.paragraphs):
            self.pop(self.paragraphs[at])
        closed, until = CLOSES.get(tag, ((), ()))
        if any(self.places[t] for t in closed):
            for n in range(len(self.open) - 1, max(-1, len(self.open) - 65), -1):
                if self.open[n].tag in until:
                    break
                if self.open[n].tag in closed:
                    self.pop(n)
                    break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.cut()
            self.heading = tag in HEADINGS
            if tag != "html" and self.skip and self.skip[0] == "head":
                self.skip.clear()
            if tag not in ("br", "hr"):
                self.implied(tag)
        if tag in SKIPPED:
            if not (tag == "option" and self.skip and self.skip[-1] == "option"):
                self.skip.append(tag)
            return
        self.tags += 1
        if tag in VOID:
            return
        if tag in ("pre", "code"):
            self.pre += 1
        if tag == "a":
            self.links += 1
            self.in_link = True
        whole = tag in ("html", "body", "article", "main")
        named = not whole and not (self.pre and tag not in BLOCKS) and self.marked(tag, attrs)
        beside = named or (tag in BESIDE and not (tag == "header" and self.articles))
        if tag in CONTAINERS or beside:
            self.push(tag, tag in CONTAINERS, beside, tag == "main" or ("role", "main") in attrs)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """A slash closes void elements only."""
        if tag in VOID or tag not in SKIPPED:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.cut()
            self.heading = False
        if tag in SKIPPED:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if tag == "a":
            self.in_link = False
        if tag in ("pre", "code"):
            self.pre = max(0, self.pre - 1)
        if self.skip and tag in CONTAINERS:
            self.skip.clear()
        if self.places[tag] and self.places[tag][-1] >= (0 if tag in CONTAINERS else self.inline()):
            self.pop(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        if not self.off and not self.skip:
            self.text.append(data)
            if not self.in_link:
                self.outside.append(data)

    def marked(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if not value:
                continue
            if (name == "class" and any(map(marks, value.split()))) or (name == "id" and tag not in HEADINGS and marks(value)):
                return True
            if (name == "role" and value.lower() in ROLES) or (name == "style" and HIDDEN.search(value)):
                return True
        return False

    def finish(self) -> None:
        self.close()
        self.cut()
        self.pop(0)
        self.ends[0] = len(self.kinds) - 1


def smoothed(ratios: np.ndarray, radius: int, sigma: float) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel is cut and its weights are scaled up."""
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    total = np.convolve(ratios, kernel, "full")[radius : radius + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel, "full")[radius : radius + len(ratios)]


def region(page: Lines, radius: int, sigma: float, most: float) -> list[str]:
    """The texts of the lines in the region that holds the content cluster."""
    lines, kinds, parents, ends = page.lines, page.kinds, page.parents, page.ends
    sizes = np.array([len(x.text) for x in lines], dtype=float)
    own = sizes / np.maximum([x.tags for x in lines], 1)
    ratios = smoothed(own, radius, sigma)
    least = min(ratios.std(), ratios.max())
    content = ratios >= least
    held = content & (own >= least)
    if not held.any():
        held = content.copy()
    for i in range(len(lines) - 2, -1, -1):
        held[i] |= lines[i].heading and held[i + 1]
    nodes = np.array([x.node for x in lines])
    first, last = int(nodes[held].min()), int(nodes[held].max())
    best = first
    while ends[best] < last or kinds[best] not in SECTIONS:
        best = parents[best]

    weight = np.bincount(nodes, np.where(content, sizes, 0), minlength=len(kinds))
    for k in range(len(kinds) - 1, 0, -1):
        weight[parents[k]] += weight[k]
    around = best
    while around > 0 and kinds[around] not in ("article", "main"):
        around = parents[around]
    if around > 0:
        best = around
    else:
        # Long lines are scattered over the page: one element may still hold most of the cluster. The outer one of equals counts.
        named = [k for k in range(1, len(kinds)) if kinds[k] in ("article", "main") and weight[k] >= most * weight[0]]
        best = max(named, key=lambda k: (weight[k], -k), default=best)
    return [x.text for x in lines if best <= x.node <= ends[best]]


def main_text(html: str | None, radius: int = 2, sigma: float = 1.0, most: float = 0.8) -> str:
    """The article of a page, one line per block. Null, empty or text-less pages give an empty string. Time and memory grow with the page."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.finish()
    return "\n".join(region(page, radius, sigma, most)) if page.lines else ""


def extract_text(pages: DataFrame, html_col: str = "html", radius: int = 2, sigma: float = 1.0, most: float = 0.8) -> DataFrame:
    """pages with column text: the main text of html_col.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by line feeds in page order. Null html counts as
    empty, text is never null. A column named text is replaced; all others stay.
    Repeated rows each get their result; an empty table gives an empty result.
    A page has to fit a task's memory a few times over; Arrow batches are
    bounded in bytes.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([main_text(h, radius, sigma, most) for h in part], dtype=object)

    return pages.withColumn("text", text_of(F.col(html_col)))
