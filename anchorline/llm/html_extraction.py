"""Main text of web pages: parser events, text-to-tag ratios, smoothing, clustering.

The standard library's parser streams a page's tags and texts. Text between block tags is a
line. Its ratio of characters to tags is smoothed over neighbouring lines by a Gaussian, and
lines above the page's threshold are content. The elements that hold the content, articles
where the page has them, are the region. Of its lines those that are content are the text, and
those between them that are no run of links; parts that tags or names mark as something else
are left out, or, where a name only hints at that, kept as far as they are content.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import arrow_map, blocks, text_of

CHUNK = 1 << 16
SIGMA, RADIUS = 1.0, 2
#: A region without an article or main element holds this share of the content at least.
SHARE = 0.8
#: There, a line that is not content stays unless so much of it is links.
LINKED = 0.5

#: Element names by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
UNSEEN = set("head script style noscript template iframe svg canvas object math title".split())
ASIDE = set("nav footer aside form button select textarea dialog menu fieldset".split())
#: Words of class, id and role that mark what is no article, wherever it stands.
NOT_TEXT = set(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion "
    "cookie cookies consent gdpr comment comments disqus respond reply replies share sharing "
    "social related recommended newsletter subscribe subscription signup popup modal overlay "
    "notice alert breadcrumb breadcrumbs pagination pager footer copyright contentinfo hidden "
    "complementary dialog search".split()
)
#: Words that mark it unless an article or main element stands inside.
LAYOUT = set("sidebar nav navbar navigation menu header masthead topbar banner widget toolbar".split())
#: Words that may stand beside those: with others a name only hints.
NEUTRAL = set(
    "area articles bar block body box button buttons container content div entry footer form "
    "group header icons inner item items link links list main message outer panel post posts "
    "row section slot stories text thread title top unit widget wrap wrapper".split()
)
#: Names of an article that is none, if the page has another.
NO_ARTICLE = set("comment comments comment-body reply related teaser sponsored advert ad promo".split())
_KEPT, _HINTED, _LAYOUT, _MARKED, _UNSEEN = range(5)
_HOME = ("article", "main")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

TEXTS = "page_id long, url string, text string, n_chars long"


class Element:
    """An element of a page; `mark` is its own, the other flags follow from those above."""

    __slots__ = ("tag", "above", "mark", "home", "unseen", "holds", "size", "depth",
                 "shadow", "dropped", "hinted", "inside", "top", "mass", "chosen")

    def __init__(self, tag: str, above: Element | None, mark: int, home: bool):
        self.tag, self.above, self.mark, self.home = tag, above, mark, home
        self.unseen = mark == _UNSEEN or above is not None and above.unseen
        self.depth = 0 if above is None else above.depth + 1
        self.size, self.mass, self.holds = 0, 0.0, False
        self.shadow = self.dropped = self.hinted = self.inside = self.top = self.chosen = False


def part_mark(names: list[str]) -> int:
    """What an element's names say: marked if nothing else is in one, hinted if more is."""
    found = _KEPT
    for name in names:
        words = {w.lower() for w in _PARTS.findall(name)}
        if words & NOT_TEXT:
            plain = all(w in NOT_TEXT or w in NEUTRAL or w.isdigit() for w in words)
            found = max(found, _MARKED if plain else _HINTED)
        elif words & LAYOUT:
            found = max(found, _LAYOUT)
    return found


class Lines(HTMLParser):
    """The lines of a page: text, tags, and the element each stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = self.root = Element("", None, _KEPT, False)
        self.elements = [self.root]
        self.lines: list[tuple[str, int, Element, float]] = []
        self.pieces: list[str] = []
        self.tags = self.linked = 0
        self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            share = min(self.linked / len(text), 1.0)
            self.lines.append((text, self.tags, self.open, share))
            self.open.size += len(text)
            self.tags = 0
        self.linked = 0

    def enter(self, tag: str, attrs: list) -> None:
        given = dict(attrs)
        names = [n for x in ("class", "id", "role") for n in (given.get(x) or "").split()]
        home = tag in _HOME or "main" in (given.get("role") or "").split()
        if (
            tag in UNSEEN
            or "hidden" in given
            or given.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none", given.get("style") or "")
        ):
            mark = _UNSEEN
        elif tag in ("html", "body"):
            mark = _KEPT
        elif home:
            mark = _MARKED if NO_ARTICLE & {n.lower() for n in names} else _KEPT
        elif tag in ASIDE:
            mark = _MARKED
        else:
            mark = max(part_mark(names), _LAYOUT if tag == "header" else _KEPT)
        self.open = Element(tag, self.open, mark, home and mark != _UNSEEN)
        self.elements.append(self.open)
        at = self.open.above
        while self.open.home and at is not None and not at.holds:
            at.holds = True
            at = at.above

    def settle(self) -> None:
        """What is dropped, hinted at, and inside an article, from the top down.

        Outside of articles a marked element that holds one, or most of the page's text in a
        form, stays, unless there is an article that no mark overshadows.
        """
        for e in reversed(self.elements):  # sizes of what elements hold
            if e.above is not None:
                e.above.size += e.size
        for e in self.elements:
            e.shadow = e.mark == _MARKED or e.above is not None and e.above.shadow
        clean = any(e.home and not e.shadow and not e.unseen for e in self.elements)
        for e in self.elements:
            up = e.above
            inside = up is not None and up.inside
            if e.mark == _MARKED:
                most = e.tag == "form" and not self.root.holds and 2 * e.size >= self.root.size
                kept = not inside and ((e.home or e.holds) and not clean or most)
            elif e.mark == _LAYOUT:
                kept = inside or e.holds
            else:
                kept = not e.unseen
            e.dropped = not kept or up is not None and up.dropped
            e.top = e.home and not e.dropped and not inside
            e.inside = inside or e.top
            e.hinted = not e.home and (e.mark == _HINTED and not (e.holds and not inside) or up is not None and up.hinted)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        self.links += tag == "a"
        if tag == "br":
            self.pieces.append(" ")
        if tag in BLOCK:
            self.flush()
            self.close_open(tag)
        if tag not in VOID:
            self.enter(tag, attrs)

    def close_open(self, tag: str) -> None:
        """A block ends a paragraph before it, an item the item before it."""
        ends = {"p"} | ({"li"} if tag == "li" else {"dt", "dd"} if tag in ("dt", "dd") else set())
        at = self.open
        while at.above is not None and (at.tag not in BLOCK or at.tag in ends):
            if at.tag in ends:
                self.open = at.above
                return
            at = at.above

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        self.links = max(self.links - (tag == "a"), 0)
        if tag in BLOCK:
            self.flush()
        at = self.open
        while at.above is not None and at.tag != tag:
            if tag not in BLOCK and at.tag in BLOCK:
                return  # an inline end tag closes no block
            at = at.above
        if at.above is not None:
            self.open = at.above

    def handle_data(self, data):
        if not self.open.unseen:
            self.pieces.append(data)
            if self.links:
                self.linked += len(data.strip())


def smoothed(ratios: np.ndarray) -> np.ndarray:
    at = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(at**2) / (2 * SIGMA**2))
    return np.convolve(ratios, kernel / kernel.sum(), "full")[RADIUS : RADIUS + len(ratios)]


def regions(page: Lines) -> list[Element]:
    """The elements whose lines may be the text: all articles that stand in no other; the main
    element where it holds more outside of them; else the deepest that holds most content."""
    tops = [e for e in page.elements if e.top and e.mass]
    out = []
    for top in tops:
        nested = [
            e for e in page.elements
            if e.tag == "article" and e.mass and not e.dropped and top in outer(e)
        ] if top.tag != "article" and top.holds else []
        whole = sum(e.mass for e in nested) < 0.5 * top.mass
        out += [top] if whole else nested
    if out:
        return out
    root = page.root
    enough = [
        e for e in page.elements
        if e.mass >= SHARE * root.mass and e.tag != "p" and e.tag in BLOCK and not e.dropped
    ]
    return [max(enough, key=lambda e: e.depth, default=root)]


def outer(element: Element):
    """The elements that hold it, up to the next article."""
    element = element.above
    while element is not None:
        yield element
        if element.tag == "article":
            return
        element = element.above


def main_text(html: str) -> str:
    """The lines of the content regions, joined by line feeds; empty if there is none."""
    page = Lines()
    html = html.replace("<![", "<!")  # marked sections are comments in HTML
    for at in range(0, len(html), CHUNK):
        page.feed(html[at : at + CHUNK])
    page.close()
    page.flush()
    page.settle()
    lines = [x for x in page.lines if not x[2].dropped]
    if not lines:
        return ""
    sizes = np.array([len(text) for text, *_ in lines], float)
    single = sizes / np.maximum([tags for _, tags, *_ in lines], 1)
    ratios = smoothed(single)
    links = np.array([share >= LINKED for *_, share in lines])
    # A line of links is not content by its neighbours' ratios alone.
    content = (ratios >= ratios.std()) & (~links | (single >= ratios.std()))
    if not content.any():
        content[:] = True
    for size, is_content, (_, _, element, _) in zip(sizes, content, lines, strict=True):
        element.mass += size if is_content else 1e-6 * size
    for e in reversed(page.elements):
        if e.above is not None:
            e.above.mass += e.mass
    region = regions(page)
    for e in region:
        e.chosen = True
    for e in page.elements:
        e.chosen |= e.above is not None and e.above.chosen
    whole_page = region[0].tag in ("", "html", "body")
    linked = (links & ~content).tolist()
    out = []
    for i, (text, _, element, _) in enumerate(lines):
        beside = any(linked[j] for j in (i - 1, i + 1) if 0 <= j < len(lines))
        plain = not linked[i] or element.inside and not beside
        if element.hinted:
            stays = content[i] and not links[i]
        else:
            stays = content[i] or plain and not whole_page
        if element.chosen and stays:
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars.

    Null and empty pages, and pages without visible text, have an empty text. Null ids and
    urls stay null, repeated rows repeat, an empty table gives no row. Other columns are not
    read. All articles that stand in no other count, comments and teasers beside another apart.
    Lines of the region stay if they are content or hardly linked; in an article also a single
    line of links. Where a class name hints at something else, content alone stays.
    """

    def rows(batches):
        for batch in batches:
            html = batch.column(2)
            for a, b in blocks(html):
                texts = pa.array(
                    [main_text(x) for x in html.slice(a, b - a).to_pylist()], pa.string()
                )
                yield {
                    "page_id": batch.column(0).slice(a, b - a),
                    "url": batch.column(1).slice(a, b - a),
                    "text": texts,
                    "n_chars": pc.cast(pc.utf8_length(texts), pa.int64()),
                }

    return arrow_map(
        pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text_of("html")),
        TEXTS,
        rows,
    )
