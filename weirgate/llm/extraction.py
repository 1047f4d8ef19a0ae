"""The main text of web pages.

A page goes through the standard library's parser as a stream of events. Blocks of text, the page's lines, are
collected with the number of tags and the share of link text in them. Parts that are furniture by their element or
role never become lines. Lines of parts that are furniture by class or id are put aside, unless such a part holds
most of the page's text, or all of it. The ratio of text to tags is smoothed over neighbouring lines with a
Gaussian, and a threshold between its two clusters tells dense lines from thin ones. The region with most of the
dense text is the article: an article element if there is one, a main one, or the innermost container that has
nearly all of it. All lines of the region belong to the text, short ones too, but for runs of nothing but links
before or behind its dense lines that have no heading. If the region is no such element, dense lines outside it belong to the text as well, with the
headings and short lines between and next to them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import free_name

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "article aside blockquote body center details dialog div fieldset figure footer form header html main menu nav"
    " section table td".split()
)
FURNITURE = frozenset(
    "applet aside audio button canvas dialog embed footer form head iframe input label legend map menu nav noscript"
    " object script select style svg template textarea title video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog directory feed form menu menubar navigation note"
    " search status tablist toolbar".split()
)
NAMES = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs captcha cmp"
    " comment comments consent cookie cookies disclaimer disqus footer gdpr hidden login masthead menu"
    " modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup"
    " promo promoted promotion promotions recommendations recommended related replies reply rss search share"
    " sharing sidebar signup skip skyscraper social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Furniture at the top of a page, but part of an article inside one.
TOP = frozenset({"header", "topbar", "top"})
#: Words that may stand beside a name in one class or id; any other word makes it the name of something else.
BESIDE = frozenset(
    "area article bar block body bottom box btn button buttons center column container count desktop entry feed field"
    " first fixed float form global group header icon icons inline inner input item items label last left line link links"
    " list main media message mobile module outer page panel policy popular post posts primary right row secondary section"
    " site slot small social sticky stories story tab text title top unit wide wrap wrapper".split()
)
#: Furniture also where it is longer than the article; the other names may be those of a layout or theme.
LONG = frozenset(
    "ad ads adsense advert advertisement advertising adverts cmp comment comments consent cookie cookies disclaimer"
    " disqus gdpr newsletter paywall promo promoted promotion promotions recommendations recommended related replies"
    " reply rss sponsor sponsored subscribe subscription".split()
)
#: A start tag of one of these ends an open one of the same row.
IMPLIED = {t: group for group in (("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",)) for t in group}
TABLE = frozenset({"table"})
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LISTS = CONTAINERS | {"ul", "ol", "dl", "select"}
TAG = re.compile("<[a-zA-Z/!?]")
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")

SPREAD = (2, 1.0)
#: Share of the dense text that the innermost container must have, and of links in a line of links.
NEARLY_ALL = 0.8
#: Share of the longest article's dense text from which other articles of the page stay beside it.
COMPARABLE = 0.5
LINKS = 0.9
LINK_RUN = 3


class Line:
    __slots__ = ("text", "tags", "links", "node", "heading", "aside")

    def __init__(self, text: str, tags: int, links: int, node: int, heading: bool, aside: int) -> None:
        self.text, self.tags, self.links, self.node = text, tags, links, node
        self.heading, self.aside = heading, aside

    def linked(self) -> bool:
        return self.links >= LINKS * len(self.text)


class Reader(HTMLParser):
    """Lines of a page, each with the container it lies in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.kinds: list[str] = ["page"]  # of containers, by number; what a container lies in has a smaller one
        self.parents: list[int] = [0]
        self.node = 0
        self.open: list[tuple[str, bool, int | None, int | None]] = []  # tag, furniture, container and part outside it
        self.asides: list[int] = [0]  # parts that are furniture by name: the one around each, 0 for none
        self.longer: list[bool] = [False]  # whether they are that also where they hold most of the text
        self.aside = 0
        self.count: Counter[str] = Counter()
        self.skipped = 0
        self.ending = False
        self.parts: list[str] = []
        self.tags = self.links = 0

    def close(self) -> None:
        self.ending = True
        super().close()

    def parse_comment(self, i: int, report: int = 1) -> int:
        """Where a comment ends; one that is never closed goes to the end of the page."""
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 and self.ending else end

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i, report)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                heading = any(self.count[t] for t in HEADINGS)
                self.lines.append(Line(text, self.tags, min(self.links, len(text)), self.node, heading, self.aside))
            self.parts = []
        self.tags = self.links = 0

    def furniture(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in FURNITURE or tag == "header" and not (self.count["article"] or self.count["main"]):
            return True
        for name, value in attrs:
            if tag in ("body", "html", "article", "main"):
                return False
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if value and name == "role" and value.lower() in ROLES:
                return True
        return False

    def named(self, tag: str, attrs: list[tuple[str, str | None]]) -> frozenset[str]:
        """The names of furniture that an element has for a class or id, alone or with words that go beside them."""
        if tag in ("body", "html", "article", "main") or tag in HEADINGS:
            return frozenset()
        known = NAMES if self.count["article"] or self.count["main"] else NAMES | TOP
        found: set[str] = set()
        for name, value in attrs:
            if value and (name == "class" or name == "id" and tag != "p"):
                for token in value.split():
                    words = {w.lower() for w in WORDS.findall(token)}
                    if words & known and words <= known | BESIDE:
                        found |= words & known
        return frozenset(found)

    def pop(self, to: int) -> None:
        while len(self.open) > to:
            tag, skipped, outside, around = self.open.pop()
            if around is not None:
                self.flush()
                self.aside = around
            self.count[tag] -= 1
            self.skipped -= skipped
            if outside is not None:
                self.node = outside

    def close_up_to(self, tags: tuple[str, ...], scope: frozenset[str]) -> None:
        """End the innermost open one of the tags, unless an element of the scope stands between."""
        if any(self.count[t] for t in tags):
            for at in range(len(self.open) - 1, -1, -1):
                tag = self.open[at][0]
                if tag in tags:
                    self.pop(at)
                    return
                if tag in scope:
                    return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag != "br":
                self.close_up_to(("p",), CONTAINERS)
        if tag in IMPLIED:
            self.close_up_to(IMPLIED[tag], TABLE if tag in ("td", "th", "tr") else LISTS)
        self.tags += 1
        if tag in VOID:
            return
        skipped = self.furniture(tag, attrs)
        names = self.named(tag, attrs) if attrs and not skipped and not self.skipped else None
        around = None
        if skipped or names:
            self.flush()
        if names:
            around, self.aside = self.aside, len(self.asides)
            self.asides.append(around)
            self.longer.append(bool(names & LONG))
        outside = None
        if tag in CONTAINERS:
            outside, self.node = self.node, len(self.kinds)
            self.parents.append(outside)
            main = tag == "main" or any(n == "role" and v == "main" or n == "itemprop" and v == "articleBody" for n, v in attrs)
            self.kinds.append("article" if tag == "article" else "main" if main else tag)
        self.open.append((tag, skipped, outside, around))
        self.count[tag] += 1
        self.skipped += skipped

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.close_up_to((tag,), frozenset() if tag in CONTAINERS else CONTAINERS)

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.parts.append(data)
            if self.count["a"]:
                self.links += len(data)


def proper(reader: Reader) -> list[Line]:
    """Lines that are not furniture by class or id; all lines, if there are no others.

    Where article or main elements have lines, only text in those counts for what most of it is.
    """
    inside = [kind in ("article", "main") for kind in reader.kinds]
    for node in range(1, len(inside)):
        inside[node] = inside[node] or inside[reader.parents[node]]
    elements = any(inside[line.node] and not line.aside for line in reader.lines)
    mass = [0] * len(reader.asides)
    for line in reader.lines:
        if inside[line.node] or not elements:
            mass[line.aside] += len(line.text) - line.links
    for part in range(len(mass) - 1, 0, -1):
        mass[reader.asides[part]] += mass[part]
    out = [False] * len(mass)
    for part in range(1, len(mass)):
        out[part] = out[reader.asides[part]] or reader.longer[part] or 2 * mass[part] <= mass[0]
    return [line for line in reader.lines if not out[line.aside]] or reader.lines


def smoothed(values: list[float], radius: int = SPREAD[0], sigma: float = SPREAD[1]) -> list[float]:
    """Gaussian mean over the neighbours that there are."""
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-radius, radius + 1)]
    out = []
    for at in range(len(values)):
        low, high = max(0, at - radius), min(len(values), at + radius + 1)
        weights = kernel[low - at + radius : high - at + radius]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """The value halfway between the means of the two clusters that it divides the values into."""
    cut = sum(values) / len(values)
    for _ in range(20):
        low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not low or not high:
            break
        middle = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(middle - cut) < 1e-9:
            break
        cut = middle
    return cut


def region(reader: Reader, lines: list[Line], dense: list[bool], alone: list[bool]) -> list[bool]:
    """For each line whether it is in the article; ``alone`` are the lines that are dense without their neighbours."""
    size = len(reader.kinds)
    mass = [0] * size
    for line, thick in zip(lines, dense, strict=True):
        if thick:
            mass[line.node] += len(line.text)
    for node in range(size - 1, 0, -1):
        mass[reader.parents[node]] += mass[node]
    tops: set[int] = set()
    for kind in ("article", "main"):
        named = [n for n in range(size) if reader.kinds[n] == kind and mass[n]]
        if named and not tops:
            most = max(mass[n] for n in named)
            tops = {n for n in named if mass[n] >= (COMPARABLE if kind == "article" else 1) * most}
    whole = bool(tops)
    if not whole:
        tops = {max(n for n in range(size) if mass[n] >= NEARLY_ALL * mass[0])}
    inside = [False] * size
    for node in range(size):
        inside[node] = node in tops or node > 0 and inside[reader.parents[node]]
    article = [inside[line.node] for line in lines]
    if whole:
        return article
    for line, thick, single in zip(lines, dense, alone, strict=True):
        if single and not thick:
            mass[line.node] += len(line.text)
    return around(lines, [a or b for a, b in zip(dense, alone, strict=True)], article, mass)


def around(lines: list[Line], dense: list[bool], article: list[bool], mass: list[int]) -> list[bool]:
    """The article and what belongs to it outside its container, ``mass`` being the dense text in each container.

    That is every dense line, and what is not a line of links: between dense lines all of it, before the first one
    from a heading on, and before and behind them lines of a container that has dense text.
    """
    kept = [a or thick and not line.linked() for line, thick, a in zip(lines, dense, article, strict=True)]
    if True not in kept:
        return kept
    first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
    for k in range(first, last):
        kept[k] = kept[k] or not lines[k].linked() or mass[lines[k].node] > 0
    start, k = first, first - 1
    while k >= 0 and not lines[k].linked():
        if lines[k].heading or mass[lines[k].node]:
            start = k
        k -= 1
    end = last + 1
    while end < len(lines) and not lines[end].linked() and mass[lines[end].node]:
        end += 1
    for k in [*range(start, first), *range(last + 1, end)]:
        kept[k] = True
    return kept


def without_open_tag(html: str) -> str:
    """A page up to a tag that it ends in."""
    end = html.rfind(">") + 1
    tag = TAG.search(html, end)
    return html if tag is None else html[: tag.start()]


def main_text(html: str | None) -> str:
    """The main text of a page, one block a line; empty if there is none."""
    if not html:
        return ""
    reader = Reader()
    reader.feed(without_open_tag(html))
    reader.close()
    reader.flush()
    lines = proper(reader)
    if not lines:
        return ""
    own = [(len(line.text) - line.links) / (1 + line.tags) for line in lines]
    ratios = smoothed(own)
    cut = threshold(ratios)
    dense = [r >= cut for r in ratios]
    if True not in dense:
        # The ratios are all the same, and their mean is rounded up: nothing tells lines apart but links.
        dense = [not line.linked() for line in lines]
        if True not in dense:
            dense = [True] * len(lines)
    article = region(reader, lines, dense, [r >= cut for r in own])
    inside = [k for k in range(len(lines)) if article[k]]
    solid = [k for k in inside if dense[k] and not lines[k].linked()]
    kept: list[str] = []
    run: list[str] = []
    held = headed = False  # whether the run begins between dense lines or under a heading
    for k in [*inside, None]:
        if k is not None and not dense[k] and lines[k].linked():
            held = held or bool(solid) and solid[0] < k < solid[-1]
            run.append(lines[k].text)
            continue
        if len(run) < LINK_RUN or held or headed:
            kept += run
        run, held = [], False
        if k is not None:
            headed = lines[k].heading
            kept.append(lines[k].text)
    return "\n".join(kept)


def _extract(text: str, length: str):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            texts = [main_text(html) for html in batch.column(last).to_pylist()]
            columns = [batch.column(i) for i in range(last)]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], text, length])

    return extract


def extract_main_text(pages: DataFrame, html: str = "html", text: str = "text", length: str = "n_chars") -> DataFrame:
    """Pages with the text instead of the markup: all columns but ``html``, then ``text`` and ``length``.

    Columns of the pages that have those names are replaced. Null and empty pages have the empty text; repeated
    rows are treated alike, an empty table gives an empty one.
    """
    drop = {html.lower(), text.lower(), length.lower()}
    kept = [c for c in pages.columns if c.lower() not in drop]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html).alias(free_name(pages, "_html")))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(_extract(text, length), ", ".join([*fields, f"`{text}` string", f"`{length}` bigint"]))
