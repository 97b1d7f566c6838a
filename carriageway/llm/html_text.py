"""Main text of web pages, from the standard parser's event stream.

Per page: the events give lines (one per block element), each with its length
and number of tags. The text-to-tag ratios of the lines are smoothed with a
Gaussian and split into two clusters; the lines above the threshold vote for
the element that holds the article, and the blocks of that element are the
text. Parts that their markup names as menus, headers, footers, sidebars,
notices, adverts, forms, reader comments or hidden never count.

A page is one row; nothing is shuffled, and memory is bounded by one Arrow
batch.

End tags that HTML lets out are implied, that of the head among them. Open
elements are found by their places, so a page of any nesting takes time in
proportion to its length.

Defined results: null or empty html gives an empty text; html cut off anywhere
is read as far as it goes; where all text lies in parts beside the article that
were never closed, those are read; plain text without any tag is one block; repeated
rows are treated one by one and alike; an empty table gives no rows; further
columns of the input are not carried.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
RADIUS = 2
#: A plain element holds the article if it has this share of the characters voted for.
HOLDS = 0.9
LINK_SHARE = 0.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split())
_NOISE = frozenset(
    "script style noscript template nav footer aside form iframe object svg canvas button select textarea datalist dialog menu head title "
    "search audio video map applet frameset".split())
_HOLDERS = frozenset("html body main article section div td table center".split())
_ARTICLE = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_NEVER = frozenset(("html", "body", "main"))
#: What an open head may hold; anything else ends it.
_IN_HEAD = frozenset("base link meta title style script noscript template".split())
_HEADINGS = frozenset(("h1", "h2", "h3"))
#: An open element of the key ends where one of the values starts, unless one of the third stands between.
_LIST = frozenset(("ul", "ol", "dl", "table", "menu"))
_SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_LEVELS = _LIST | frozenset().union(*_SAME_LEVEL.values())

_BEFORE = ("site|page|top|bottom|left|right|main|global|primary|secondary|user|reader|sub|inline|js|cookie|related|social|google|text|"
           "display|native|sticky|mobile|post|entry|article|story|content|blog|web|email|e|view|leave|add|in|house|third|party|privacy|legal|back")
_NAMES = ("ad|ads|advert|adverts|adv|advertisement|advertisements|advertising|adsense|adsbygoogle|sponsor|sponsors|sponsored|promo|promos|promotion|"
          "promotions|promoted|banner|banners|cookie|cookies|consent|gdpr|notice|notices|notification|notifications|alert|alerts|popup|popover|"
          "modal|overlay|lightbox|sidebar|sidebars|aside|rail|menu|menus|nav|navs|navbar|navigation|breadcrumb|breadcrumbs|footer|footers|"
          "foot|comment|comments|commentlist|disqus|respond|reply|replies|discussion|feedback|share|shares|sharing|social|"
          "related|recommended|recommendations|teaser|teasers|newsletter|subscribe|subscription|signup|login|toolbar|pagination|pager|"
          "widget|widgets|hidden|invisible|copyright|disclaimer|paywall|skip|tags|tagcloud|outbrain|taboola")
_AFTER = ("box|bar|block|area|list|section|wrap|wrapper|container|inner|outer|unit|slot|content|banner|link|links|item|items|form|text|"
          "widget|message|messages|thread|panel|row|col|column|zone|space|holder|top|bottom|left|right|main|menu|buttons|button|header|"
          "title|body|count|note|notice|popup|overlay|modal|card|cards|posts|post|articles|stories|nav|to|us|below|above|frame|label|region")
_BY_NAME = re.compile(rf"(?:(?:{_BEFORE})[-_]*)*(?:{_NAMES})(?:[-_]*(?:{_AFTER}|[0-9]+))*")
_HEADER_NAME = re.compile(r"(?:(?:site|page|top|main|global|web)[-_]*)*(?:header|masthead|head)(?:[-_]*(?:box|bar|wrap|wrapper|container|inner|area|[0-9]+))*")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_GAP = re.compile(r"\s+")


class _Element:
    __slots__ = ("tag", "noise", "holder", "in_article")

    def __init__(self, tag, noise, holder, in_article):
        self.tag, self.noise, self.holder, self.in_article = tag, noise, holder, in_article


class _Lines(HTMLParser):
    """Lines of a page: [text, tags, link characters, noise root or None, holder, starts in an article, heading]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.stack: list[_Element] = [_Element("", None, 0, False)]
        self.parents, self.holder_tags = [0], [""]
        self.text: list[str] = []
        self.tags = self.link_chars = 0
        self.links = 0
        self.closed: dict[int, bool] = {}
        self.rescued: set[int] = set()
        # Places in the stack: of each tag, of blocks, and of what lists and tables are made of. No look-up walks the stack.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.levels: list[int] = []

    def flush(self) -> None:
        if self.text:
            words = _GAP.sub(" ", "".join(self.text)).strip()
            if words:
                top = self.stack[-1]
                heading = any(self.stack[k].tag in _HEADINGS for k in self.blocks[-2:])
                self.lines.append([words, max(1, self.tags), self.link_chars, top.noise, top.holder,
                                   top.noise in self.rescued and top.in_article, heading])
            self.text = []
        self.tags = self.link_chars = 0

    def handle_starttag(self, tag, attrs):
        if tag not in _IN_HEAD and self.places.get("head"):
            self.end_head()
        if tag in _VOID:
            if tag in ("br", "wbr"):
                self.text.append(" " if tag == "br" else "")
            elif tag == "hr":
                self.flush()
            self.tags += 1
            return
        if tag in _BLOCK:
            self.flush()
            self.end_implied(tag)
        self.tags += 1
        top = self.stack[-1]
        noise, in_article = top.noise, top.in_article
        if noise is None:
            if is_noise(tag, attrs, in_article):
                noise = len(self.closed)
                self.closed[noise] = False
                in_article = False
        elif tag in _ARTICLE:
            self.rescued.add(noise)
        in_article = in_article or tag in _ARTICLE
        holder = top.holder
        if tag in _HOLDERS:
            holder = len(self.parents)
            self.parents.append(top.holder)
            self.holder_tags.append(tag)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in _BLOCK:
            self.blocks.append(len(self.stack))
        if tag in _LEVELS:
            self.levels.append(len(self.stack))
        self.stack.append(_Element(tag, noise, holder, in_article))
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag in ("script", "style", "iframe", "svg", "path", "textarea"):
            self.handle_endtag(tag)

    def end_head(self) -> None:
        """A head without end tag ends before the first thing that it cannot hold."""
        self.flush()
        self.pop_to(self.places["head"][-1], True)

    def end_implied(self, tag) -> None:
        # A block ends the paragraph around it: an open one with nothing but inline elements between.
        if (open_p := self.places.get("p")) and self.blocks[-1] == open_p[-1]:
            self.pop_to(open_p[-1], False)
        if ends := _SAME_LEVEL.get(tag):
            for k in reversed(self.levels):
                if self.stack[k].tag in ends:
                    self.pop_to(k, False)
                    break
                if self.stack[k].tag in _LIST:
                    break

    def pop_to(self, k: int, by_own_tag: bool) -> None:
        for e in self.stack[k:]:
            self.links -= e.tag == "a"
            self.places[e.tag].pop()
        first = self.stack[k]
        if first.noise is not None and self.stack[k - 1].noise is None and (by_own_tag or first.tag in ("p", "li", "td", "th", "dd", "dt", "option")):
            self.closed[first.noise] = True
        for places in (self.blocks, self.levels):
            while places and places[-1] >= k:
                places.pop()
        del self.stack[k:]

    def handle_endtag(self, tag):
        if tag in _VOID:
            if tag == "br":
                self.text.append(" ")
            return
        if not self.places.get(tag):
            if tag == "p":
                self.flush()
            return
        k = self.places[tag][-1]
        self.tags += 1
        last_block = self.blocks[-1] if self.blocks else 0
        # An inline element left open ends with the block around it, never the other way round.
        if tag not in _BLOCK and last_block > k:
            return
        if last_block >= k:
            self.flush()
        self.pop_to(k, True)

    def handle_data(self, data):
        if self.stack[-1].tag in ("script", "style"):
            return
        if self.stack[-1].tag == "head" and data.strip():
            self.end_head()
        self.text.append(data)
        if self.links > 0:
            self.link_chars += len(data)


def is_noise(tag: str, attrs: list, in_article: bool) -> bool:
    """Whether the markup itself names an element as something beside the article."""
    if tag in _NOISE or tag == "header" and not in_article:
        return True
    if not attrs or tag in _NEVER:
        return False
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if not value:
            continue
        if name == "role" and value.strip().lower() in _ROLES and not (in_article and value.strip().lower() == "banner"):
            return True
        if name == "style" and _HIDDEN_STYLE.search(value.lower()):
            return True
        if name in ("class", "id"):
            for word in value.lower().split():
                if _BY_NAME.fullmatch(word) or not in_article and _HEADER_NAME.fullmatch(word):
                    return True
    return False


def smoothed(values: list[float]) -> list[float]:
    """Gaussian-weighted means; at the ends the weights that exist count."""
    weights = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(RADIUS + 1)]
    out = []
    for i in range(len(values)):
        total = mass = 0.0
        for j in range(max(0, i - RADIUS), min(len(values), i + RADIUS + 1)):
            w = weights[abs(i - j)]
            total += w * values[j]
            mass += w
        out.append(total / mass)
    return out


def threshold(values: list[float]) -> float:
    """Border between the two clusters of one-dimensional 2-means; the least value if all are alike."""
    low, high = min(values), max(values)
    if low == high:
        return low
    for _ in range(50):
        border = (low + high) / 2
        below, above = [v for v in values if v < border], [v for v in values if v >= border]
        next_low, next_high = sum(below) / len(below), sum(above) / len(above)
        if (next_low, next_high) == (low, high):
            break
        low, high = next_low, next_high
    return (low + high) / 2


def main_text(html: str | None) -> str:
    """The article's blocks in page order, one per line."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = [x for x in parser.lines if x[3] is None or x[5] and not parser.closed[x[3]]]
    if not lines:  # something beside the article was left open before it: what follows is all there is
        lines = [x for x in parser.lines if not parser.closed[x[3]]]
    if not lines:
        return ""
    ratios = smoothed([len(x[0]) / x[1] for x in lines])
    border = threshold(ratios)
    votes = [len(x[0]) if r >= border else 0 for x, r in zip(lines, ratios)]
    # Holders are numbered in page order, so those inside one are the numbers from its own up to ``end``.
    parents, n = parser.parents, len(parser.parents)
    own, end, below, in_article = [0] * n, [0] * n, [[] for _ in range(n)], [False] * n
    for line, vote in zip(lines, votes):
        own[line[4]] += vote
    for h in range(n - 1, -1, -1):
        end[h] = max(end[h], h + 1)
        if h:
            own[parents[h]] += own[h]
            end[parents[h]] = max(end[parents[h]], end[h])
            below[parents[h]].append(h)
    voted_in = []
    for h in range(1, n):
        article = parser.holder_tags[h] in _ARTICLE
        if article and not in_article[parents[h]] and own[h]:
            voted_in.append(h)
        in_article[h] = in_article[parents[h]] or article
    if voted_in and sum(own[h] for h in voted_in) >= HOLDS * own[0]:
        return "\n".join(x[0] for x in lines if any(h <= x[4] < end[h] for h in voted_in[bisect_right(voted_in, x[4]) - 1:][:1]))
    at = 0
    while True:
        heavy = [h for h in below[at] if own[h] and own[h] >= HOLDS * own[at]]
        if len(heavy) != 1:
            break
        at = heavy[0]
    inside = [k for k, x in enumerate(lines) if at <= x[4] < end[at]]
    linked = {k for k in inside if lines[k][2] > LINK_SHARE * len(lines[k][0])}
    if parser.holder_tags[at] in ("", "html", "body"):
        # No element of its own holds the article: the region from the first to the last line voted for,
        # with the headings before it and the lines that the smoothing reaches behind it.
        voted = [k for k in inside if votes[k]]
        first, last = voted[0], voted[-1] + RADIUS
        for k in reversed([k for k in inside if k < first]):
            if k in linked:
                break
            if lines[k][6]:
                first = k
        inside = [k for k in inside if first <= k <= last]
    return "\n".join(lines[k][0] for k in inside if votes[k] or k not in linked)


def extracted(pages: DataFrame, key: str = "page_id", html: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """(key, carried columns, text, n_chars) per page."""
    rows = pages.select(F.col(key), *[F.col(c) for c in carry], F.col(html).cast("string").alias("_html"))
    kept = [key, *carry]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(x) for x in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                [*kept, "text", "n_chars"])

    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(texts, ", ".join(f"`{c}` {fields[c]}" for c in kept) + ", text string, n_chars long")
