"""Main text of web pages by text-to-tag ratio.

The standard library's streaming parser gives events. A block element ends a
line; each line has its characters of text, the characters among them that are
links, and the tags met on the way. The text-to-tag ratio of the lines is
smoothed with a Gaussian, and lines are clustered by a threshold relative to
the page's spread: runs above it are content regions. The main text is the
innermost element that holds all content, with all its lines and the headings just
before it, so that short paragraphs between long ones survive. Where that is the page
itself, it goes from the first content line, or the headings before it, to the last.

Lines inside elements that are never content by their tag or role (navigation,
footers, forms, ...) do not take part. All other marks only weigh: ratios of lines in a part that the page marks as its article
(``article``, ``main``, ``itemprop=articleBody``) are multiplied by ``MARKED``. A class or id (``sidebar``, ``comments``,
``widget``, ...) is a hint: all lines are clustered without it
first. If little of the content lies in a hinted element and in the
others that its word names, and it is not what encloses the page's article, its ratios are multiplied by ``HINTED``, and the
lines are clustered anew; those of its lines that are still content stay. To an
``articleBody`` without h1 belongs the h1 above it.

Defined results: null, empty or unparsable html gives an empty text; unclosed
and misnested tags end with the nearest enclosing element that matches;
character references are decoded; repeated rows are judged each alone. Nothing
is capped.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Standard deviation of the Gaussian, in lines.
SIGMA = 1.5
#: Lines above this share of the standard deviation of smoothed ratios are content.
SHARE = 0.5
#: A hinted element, or all that one word names, stays if it holds this share of the content, in characters.
LARGE = 0.5
#: What the smoothed ratios of lines in a marked part, and of lines in a hinted element that holds little, are multiplied by.
MARKED, HINTED = 8.0, 0.0625

# Element and attribute names of HTML.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th
thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("""script style noscript template head title nav footer aside form button select option textarea iframe object svg math
canvas audio video map menu dialog label input""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist note".split())
HINTS = frozenset("""ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent
disqus footer form gdpr header links masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted
promotion recommended related replies respond share sharing sidebar sidenav signup skip social sponsor sponsored subscribe tags toolbar
widget""".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend", "summary", "li", "dd", "dt"}
SAME = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ARTICLE = frozenset({"article", "main"})
#: In a name, what comes behind one of these is told of the element around it: no-sidebar, has-comments.
TELLS = frozenset({"no", "not", "has", "have", "with", "without"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})

_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _never(tag: str, attrs: dict[str, str | None], marked: bool) -> bool:
    if tag in NEVER or "hidden" in attrs or (attrs.get("aria-hidden") or "") == "true" or (attrs.get("role") or "").lower() in ROLES:
        return True
    return tag == "header" and not marked  # an article's own header holds its title


def _hints(tag: str, attrs: dict[str, str | None], marked: bool) -> frozenset[str]:
    """Words of the class and id that hint at something else than content."""
    if tag in ("html", "body") or tag in ARTICLE:
        return frozenset()
    found = set()
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        for word in _SPLIT.split(_CAMEL.sub("-", name).lower()):
            if word in TELLS:
                break
            if word in HINTS and not (marked and word == "header"):
                found.add(word)
    return frozenset(found)


class Lines(HTMLParser):
    """Collects what lines are made of: texts and tags, each with the hinted element it lies in, and the ends of lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int, int]] = []  # tag, never content, marked part, element, hinted element
        self.events: list[tuple] = []  # (text, hinted element, linked), (hinted element,) of a tag, (part, element, heading, None) of an end
        self.above: list[int] = [0]  # of each element the one around it; 0 is the page
        self.tops: set[int] = set()  # elements that are h1
        self.hinted: list[tuple[int, frozenset[str]]] = [(0, frozenset())]  # of each hinted element the one around it, and its words
        self.parts: list[tuple[str, int]] = [("", 0)]  # of each marked part the tag and the hinted element around it
        self.anchors = 0
        self.blocks: list[int] = []  # places of block elements in open
        self.places: dict[str, list[int]] = {}  # and of the elements of each tag

    def _top(self) -> tuple[bool, int, int]:
        return (self.open[-1][1], self.open[-1][2], self.open[-1][4]) if self.open else (False, 0, 0)

    def flush(self) -> None:
        tag, _, part, element, _ = self.open[-1] if self.open else ("", False, 0, 0, 0)
        self.events.append((part, element, tag in HEADINGS, None))

    def lines(self, dropped: set[int]) -> list[tuple[str, int, int, int, int, bool, list[tuple[int, int]], bool]]:
        """Text, link characters, tags, marked part, element, heading or not, the characters by hinted element, and whether all of it
        lies in ``dropped`` elements. Of other lines what lies in these is left out."""
        lines, pieces, aside, tags, tags_aside = [], [], [], 0, 0
        for event in self.events:
            if len(event) == 3:
                (aside if event[1] in dropped else pieces).append(event)
            elif len(event) == 1:
                tags += event[0] not in dropped
                tags_aside += event[0] in dropped
            elif pieces or aside:
                words = "".join(text for text, *_ in pieces).split()
                hinted = not words
                if hinted:
                    pieces = aside
                    words = "".join(text for text, *_ in pieces).split()
                if words:
                    linked = sum(len(text) for text, _, inside in pieces if inside)
                    lines.append((" ".join(words), linked, tags_aside if hinted else tags, *event[:3], [(hint, len(text.strip())) for text, hint, _ in pieces], hinted))
                    if hinted:
                        tags_aside = 0
                    else:
                        tags = 0
                pieces, aside = [], []
        return lines

    def _close(self, place: int) -> None:
        self.flush()
        self._cut(place)

    def _cut(self, place: int) -> None:
        for tag, *_ in self.open[place:]:
            self.anchors -= tag == "a"
            self.places[tag].pop()
        del self.open[place:]
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    def handle_starttag(self, tag, attrs):
        never, part, hint = self._top()
        if not never:
            self.events.append((hint,))
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br" and not never:
                self.events.append((" ", hint, False))
            return
        if tag in BLOCKS:
            self.flush()
            until = SAME.get(tag)
            for place in reversed(self.blocks):
                name = self.open[place][0]
                if (until and name == tag) or (name == "p" and tag in CLOSES_P):
                    self._close(place)
                    break
                if name in (until or ()) or name != "p":
                    break
            never, part, hint = self._top()
        attributes = dict(attrs)
        if not never and not part and (tag in ARTICLE or (attributes.get("itemprop") or "").lower() == "articlebody"):
            self.parts.append((tag, hint))
            part = len(self.parts) - 1
        never = never or _never(tag, attributes, part > 0)
        words = frozenset() if never else _hints(tag, attributes, part > 0)
        if words:
            self.hinted.append((hint, words))
            hint = len(self.hinted) - 1
        self.anchors += tag == "a"
        above = self.open[-1][3] if self.open else 0
        if tag in BLOCKS and tag not in ("html", "body"):
            self.above.append(above)
            above = len(self.above) - 1
            if tag == "h1":
                self.tops.add(above)
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, never, part, above, hint))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        never, _, hint = self._top()
        if not never:
            self.events.append((hint,))
        place = self.places[tag][-1] if self.places.get(tag) else -1
        block = self.blocks[-1] if self.blocks else -1
        if place < 0 or (tag not in BLOCKS and place < block):
            return  # an end tag without its start, or an inline one from outside the block
        if block >= place:
            self._close(place)
        else:
            self._cut(place)

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)  # as browsers read <![...>

    def handle_data(self, data):
        never, _, hint = self._top()
        if not never:
            self.events.append((data, hint, self.anchors > 0))


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Convolution with a Gaussian, normalised at the ends."""
    reach = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratio, kernel)[reach : reach + len(ratio)]
    return full / np.convolve(np.ones(len(ratio)), kernel)[reach : reach + len(ratio)]


def clustered(lines: list[tuple], weights: list[float] | None = None) -> np.ndarray:
    """Which lines are content; ``weights`` of their smoothed ratios are 1 by default."""
    ratio = np.array([max(0, len(text) - 2 * linked) / max(1, tags) for text, linked, tags, *_ in lines], float)
    line = smoothed(ratio) * (np.ones(len(lines)) if weights is None else weights)
    content = line >= SHARE * line.std()
    return content & ((ratio > 0) | ~(ratio[content] > 0).any())


def _dropped(parser: Lines, lines: list[tuple], content: np.ndarray) -> set[int]:
    """Hinted elements that are no content, with all inside them."""
    weight, depth = [0] * len(parser.hinted), [0] * len(parser.hinted)
    held = [0] * len(parser.parts)
    marked = {part for _, _, _, part, *_ in lines} - {0}
    for (_, _, _, part, _, _, pieces, _), chosen in zip(lines, content):
        for hint, n in pieces if chosen else ():
            weight[hint] += n
            held[part] += n
    free = weight[0]  # content outside all hinted elements
    for hint in range(len(weight) - 1, 0, -1):
        weight[parser.hinted[hint][0]] += weight[hint]
    for hint in range(1, len(depth)):
        depth[hint] = depth[parser.hinted[hint][0]] + 1
    large = LARGE * weight[0]
    stay = {hint for hint in range(1, len(weight)) if weight[hint] >= large}
    # The article is what lies in the fewest hinted elements; the articles of a list of comments or teasers are not.
    least = min((depth[parser.parts[part][1]] for part in marked), default=0)
    for part in marked:
        tag, hint = parser.parts[part]
        if depth[hint] == least and (tag == "main" or held[part] >= free):
            while hint:
                stay.add(hint)
                hint = parser.hinted[hint][0]
    named: dict[str, int] = {}
    inside: list[frozenset[str]] = [frozenset()]  # words of the elements around, which count those within
    for hint, (around, words) in enumerate(parser.hinted[1:], 1):
        inside.append(inside[around] if hint in stay else inside[around] | words)
        for word in words - inside[around] if hint not in stay else ():
            named[word] = named.get(word, 0) + weight[hint]
    dropped: set[int] = set()
    for hint, (around, words) in enumerate(parser.hinted[1:], 1):
        if around in dropped or (hint not in stay and any(named[word] < large for word in words if word in named)):
            dropped.add(hint)
    return dropped


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    while parser.open:
        parser._close(len(parser.open) - 1)
    parser.flush()
    lines = parser.lines(set())
    if not lines:
        return ""
    content = clustered(lines)
    if len(parser.hinted) > 1:
        dropped = _dropped(parser, lines, content)
        lines = parser.lines(dropped) if dropped else lines
    content = clustered(lines, [HINTED if hinted else MARKED if part else 1.0 for _, _, _, part, _, _, _, hinted in lines])
    main = _main_element(lines, content, parser.above)
    kept = np.array([_within(element, main, parser.above) for _, _, _, _, element, *_ in lines] if main else content)
    first, last = int(kept.argmax()), len(kept) - 1 - int(kept[::-1].argmax())
    while first and lines[first - 1][5]:
        first -= 1
    kept[first : last + 1] = True
    # Inside the region, what is hinted at stays only if it is content, and so does what is unmarked between marked parts that have all content.
    marked = np.array([part > 0 for _, _, _, part, *_ in lines])
    aside = np.array([hinted for *_, hinted in lines]) | (~marked & marked[content].all())
    kept &= content | ~aside
    parts = {part for (_, _, _, part, *_), own in zip(lines, kept) if part and own}
    if parts and all(parser.parts[part][0] not in ARTICLE for part in parts):
        _add_title(kept, lines, parser.tops)
    return "\n\n".join(text for (text, *_), own in zip(lines, kept) if own)


def _add_title(kept: np.ndarray, lines: list[tuple], tops: set[int]) -> None:
    """Adds the last h1 above the first kept line, if there is none among them, and the headings just before."""
    if any(own and line[4] in tops for line, own in zip(lines, kept)):
        return
    at = first = int(kept.argmax())
    while first and lines[first - 1][5]:
        first -= 1
        kept[first] = True
    while at:
        at -= 1
        if lines[at][4] in tops:
            kept[at] = True
            return


def _main_element(lines: list[tuple], content: np.ndarray, above: list[int]) -> int:
    """The innermost element with all content; 0 for the page."""
    weight = [0] * len(above)
    for (_, _, _, _, element, *_), chosen in zip(lines, content):
        weight[element] += bool(chosen)
    for element in range(len(above) - 1, 0, -1):  # an element is opened after those around it
        weight[above[element]] += weight[element]
    inner = max(e for e in range(len(above)) if weight[e] == weight[0])
    # One long paragraph is not the element that was meant; what stands around it is.
    return above[inner] if sum(_within(e, inner, above) for _, _, _, _, e, *_ in lines) == 1 else inner


def _within(element: int, main: int, above: list[int]) -> bool:
    while element > main:
        element = above[element]
    return element == main


def _extract(batches):
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points). Map-only: nothing is shuffled."""
    source = pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(html).cast("string"))
    return source.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
