"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams tags and text. Block elements and ``br`` cut the page into lines, the blocks of the result; a line's ratio is its
characters per tag. The ratios are smoothed by a Gaussian along the page and split into two clusters; lines of the upper one
mark where the content is.

1. What is never content by its tag (menus, footers, forms, scripts and the like) counts as zero and is left out.
2. Elements whose class, id or role names them as an advert, a notice, a comment list and so on are left out as well, unless the clusters say
   otherwise: an element that holds most of the upper cluster's text is content whatever it is called.
3. The innermost article, or else the innermost element, that holds most of the upper cluster's text bounds the region. In it lines of the upper cluster stay;
   lines of the lower one stay too, as headings and short paragraphs do, unless they mostly consist of links. Without an article the
   region begins at the first line of the upper cluster, with the headings before it, and ends at the last; lines beside them in the same
   element belong to it as well, unless that is the whole page.

All steps take time in proportion to the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SIGMA = 1.0  # lines
HOLDS_CONTENT = 0.8  # share of content that an element must hold to be entered
OVERRULES = 0.5  # share of the upper cluster's text from which on an element is content whatever its class is
LINK_LINE = 0.6  # share of linked characters from which on a line of the lower cluster is a menu

_BREAKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form head iframe input map menu nav noscript object "
    "optgroup option script search select style svg template textarea title video".split()
)
_ARTICLE = frozenset(("article", "main"))
_HOLDERS = frozenset("article main section div td body".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_HINTS = frozenset(
    "ad ads adbox banner breadcrumb breadcrumbs comment comments consent cookie cookies discussion disqus foot footer "
    "gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pagination popup promo promoted related "
    "replies respond share sharing sidebar skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
_HINT_STARTS = ("advert", "cookie", "comment", "newsletter", "sidebar", "sponsor", "subscri")
# words that say nothing of their own when they are part of a name such as site-footer
_GENERIC = frozenset("area bar block bottom box container content item left list main page panel right section site top wrap wrapper".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def _names_no_content(word: str) -> bool:
    """Whether a class or id is a listed word, or made of listed and generic ones only."""
    parts = [part.lower() for part in _PART.findall(word)]
    listed = [part in _HINTS or part.startswith(_HINT_STARTS) for part in parts]
    return any(listed) and all(known or part in _GENERIC for known, part in zip(listed, parts))


def _invisible(attributes: dict[str, str | None]) -> bool:
    return (
        "hidden" in attributes or attributes.get("aria-hidden") == "true"
        or "display:none" in (attributes.get("style") or "").replace(" ", "")
    )


def _hinted(attributes: dict[str, str | None]) -> bool:
    """Whether class, id or role say that an element is not content."""
    if (attributes.get("role") or "").lower() in _ROLES:
        return True
    return any(_names_no_content(word) for name in ("class", "id") for word in (attributes.get(name) or "").split())


class Line:
    __slots__ = ("parts", "tags", "linked", "outside", "scope", "heading")

    def __init__(self, outside: bool, scope: int, heading: bool) -> None:
        self.parts: list[str] = []
        self.tags, self.linked, self.outside, self.scope, self.heading = 0, 0, outside, scope, heading


class PageLines(HTMLParser):
    """Collects the lines of a page, and its scopes: elements that can hold content or are named as none. Scopes are numbered
    as they open and know their parent; 0 is the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents, self.kinds = [0], ["page"]  # kinds: page, article, holder or hinted
        self._open: list[tuple[str, bool, bool]] = []  # tag, whether it is never content, whether it is a scope
        self._scopes = [0]
        self._named: Counter[str] = Counter()  # open elements by tag
        self._outside = self._tags = 0
        self._fresh = True

    def updatepos(self, i, j):
        return j  # line numbers of the source are not needed

    def handle_starttag(self, tag, attrs):
        self._tags += 1
        if tag in _BREAKS:
            self._fresh = True
            if self._open and self._open[-1][0] == "p":
                self._close(len(self._open) - 1)
            while self._open and self._open[-1][0] in _CLOSED_BY.get(tag, ()):
                self._close(len(self._open) - 1)
        if tag in _VOID:
            return
        if tag in _ARTICLE and (self._named["nav"] or self._named["header"] or self._named["head"]):
            # never inside a menu that was left open
            self._close(next(k for k, one in enumerate(self._open) if one[0] in ("nav", "header", "head")))
        outside = tag in _NEVER or (tag == "header" and not (self._named["article"] or self._named["main"]))
        kind = "article" if tag in _ARTICLE else "page" if tag == "body" else "holder" if tag in _HOLDERS else ""
        if not outside and attrs and tag not in ("html", "body"):
            own = dict(attrs)
            outside = _invisible(own) and tag not in _ARTICLE
            if not outside and tag not in _ARTICLE and _hinted(own):
                kind = "hinted"
        self._open.append((tag, outside, bool(kind)))
        self._named[tag] += 1
        self._outside += outside
        if kind:
            self.parents.append(self._scopes[-1])
            self.kinds.append(kind)
            self._scopes.append(len(self.kinds) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._tags += 1
        if tag in _BREAKS:
            self._fresh = True
        if self._named[tag]:
            at = len(self._open) - 1
            while self._open[at][0] != tag:
                at -= 1
            self._close(at)

    def _close(self, k: int) -> None:
        """Close the element at place ``k`` and all in it."""
        for tag, outside, scope in self._open[k:]:
            self._named[tag] -= 1
            self._outside -= outside
            if scope:
                self._scopes.pop()
        del self._open[k:]

    def handle_data(self, data):
        outside = self._outside > 0
        if self._fresh or not self.lines or self.lines[-1].outside != outside or self.lines[-1].scope != self._scopes[-1]:
            if data.isspace():
                return
            self.lines.append(Line(outside, self._scopes[-1], any(one[0] in _HEADINGS for one in self._open[-3:])))
            self._fresh = False
        line = self.lines[-1]
        line.parts.append(data)
        line.tags += self._tags
        self._tags = 0
        if self._named["a"]:
            line.linked += len(data)


def _parsed(html: str) -> PageLines:
    page = PageLines()
    try:
        page.feed(html)
        page.close()
    except AssertionError:  # a declaration the parser cannot read: what is left counts as text from there on
        rest, page.rawdata = page.rawdata, ""
        page.feed(rest.replace("<!", "&lt;!"))
        page.close()
    return page


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Weighted means of neighbouring values; at the ends of the page only those count that are there."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    within = lambda x: np.convolve(x, kernel)[reach:reach + len(x)]
    return within(values) / within(np.ones(len(values)))


def threshold(values: np.ndarray, rounds: int = 20) -> float:
    """The middle between two cluster means, found by alternating assignment and means. Where the lower mean is not below
    half of the upper one the lines are of one kind, and the smallest value is the threshold."""
    values = np.sort(values)
    sums = np.concatenate([[0.0], np.cumsum(values)])
    cut, apart = (values[0] + values[-1]) / 2, False
    for _ in range(rounds):
        k = int(np.searchsorted(values, cut))
        if not 0 < k < len(values):
            break
        low, high = sums[k] / k, (sums[-1] - sums[k]) / (len(values) - k)
        before, cut, apart = cut, (low + high) / 2, low < high / 2
        if cut == before:
            break
    return float(cut if apart else values[0])


def main_text(html: str | None) -> str:
    """The content blocks of a page in order, one per line; empty if there are none."""
    if not html:
        return ""
    page = _parsed(html)
    texts = [" ".join("".join(line.parts).split()) for line in page.lines]
    found = [(line, text) for line, text in zip(page.lines, texts) if text]
    ratios = np.array([0.0 if line.outside else len(text) / max(1, line.tags) for line, text in found])
    if not ratios.any():
        return ""
    smooth = smoothed(ratios)
    upper = (smooth >= threshold(smooth)) & (ratios > 0)
    if not upper.any():
        upper = ratios > 0

    def held(within: list[bool]) -> list[int]:
        """Characters of the upper cluster in each scope, inner ones included; ``within`` tells the scopes that count."""
        sums = [0] * len(page.parents)
        for (line, text), one in zip(found, upper):
            if one and within[line.scope]:
                sums[line.scope] += len(text)
        for scope in range(len(sums) - 1, 0, -1):
            sums[page.parents[scope]] += sums[scope]
        return sums

    sums, content = held([True] * len(page.parents)), [True]
    for scope in range(1, len(page.parents)):
        named = page.kinds[scope] == "hinted" and sums[scope] < OVERRULES * sums[0]
        content.append(content[page.parents[scope]] and not named)
    sums = held(content)
    articles = [scope for scope, kind in enumerate(page.kinds) if kind == "article" and sums[scope]]
    most = max((sums[scope] for scope in articles), default=sums[0])
    # the innermost such, as scopes are numbered from outside in
    chosen = max(scope for scope in articles or range(len(sums)) if sums[scope] >= HOLDS_CONTENT * most)
    inside = [chosen == 0]
    for scope in range(1, len(page.parents)):
        inside.append(scope == chosen or inside[page.parents[scope]])
    region = [inside[line.scope] and content[line.scope] and not line.outside for line, _ in found]
    first, last = 0, len(found) - 1
    if not articles:
        marked = [k for k in np.flatnonzero(upper).tolist() if region[k]] or [0]
        first, last = marked[0], marked[-1]

        def goes_on(k: int, scope: int) -> bool:
            """Whether a line next to the region belongs to it: a heading, or a neighbour in the same element that is no menu."""
            if not 0 <= k < len(found) or not region[k]:
                return False
            line, text = found[k]
            beside = line.scope == scope and page.kinds[scope] != "page" and line.linked < LINK_LINE * len(text)
            return beside or (k < first and line.heading)

        while goes_on(first - 1, found[first][0].scope):
            first -= 1
        while goes_on(last + 1, found[last][0].scope):
            last += 1
    return "\n".join(
        text for k, (line, text) in enumerate(found)
        if region[k] and first <= k <= last and (upper[k] or line.linked < LINK_LINE * len(text))
    )


def extracted(df: DataFrame, key: str = "page_id", html: str = "html", also: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: key, the columns ``also`` as they are, and the page's main text (empty for null or empty
    pages).

    A block is what stands between two block elements or ``br``; its white space becomes single blanks. Pages of any length and depth are
    read in one go. Pages are independent of each other: repeated rows and null keys need nothing special, columns not named are not looked at,
    and an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(page) for page in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], texts], names)

    rows = df.select(F.col(html).alias("_html"), F.col(key), *also)
    names = [key, *also, "text"]
    shape = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in (key, *also)) + ", `text` string"
    return rows.mapInArrow(run, shape)
