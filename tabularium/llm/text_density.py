"""Main text of HTML pages by text-to-tag ratio.

Events of the standard library's streaming parser give the page as lines: runs of text between block tags. Menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are told by tag, role, or a
class or id made up of such words, and their lines have ratio 0. On a page with no article or main element outside them,
a class or id hides no element that holds most of the text, or an article or main and more text than stands outside. A
line's ratio is its characters over its tags, twice the median at most, so that one long line does not lift the threshold.
The ratios are smoothed with a Gaussian, and lines at or above the standard deviation of the smoothed ratios form the
content clusters.
A cluster selects its region: the outermost article or main element it lies in, with all lines there, however short; on a
page without such elements, the lines from its first to its last.

Pages are independent, so they are read where they lie, without a shuffle. A page is held whole, as a row.

Edge cases: a null or empty page, or one without content, has an empty text. Character references are decoded, unknown
or cut ones stay as they stand. White space, of any Unicode kind, inside a line becomes one space. Unclosed elements end
with their parent. Repeated rows are read alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RADIUS = 2  # lines on either side that smoothing reaches

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label link mark meta q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
NO_CONTENT = frozenset(
    "aside button datalist dialog footer form head header iframe menu nav noscript object option script select style "
    "svg template textarea title".split())
NO_CONTENT_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
REGIONS = frozenset(("article", "main"))
NO_CONTENT_WORDS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright discussion disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notification outbrain pager pagination popup promo promoted recommendations related replies respond share sharing "
    "sidebar signup social sponsor sponsored subscribe taboola toolbar widget".split())
COMMENT_WORDS = frozenset("comment comments discussion disqus replies respond".split())
PLACE_WORDS = frozenset("area bar bottom box container inner left list main primary right secondary section site slot top wrap wrapper".split())


class Lines(HTMLParser):
    """Collects [text, tags, region, content?, mark] per line. A mark is an element with a class or id that hides, by its
    place in `marks`; the first stands for none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, int]] = []
        self.open: list[tuple[str, bool, int, int]] = []  # tag, without content?, region, mark
        # where in `open` a tag stands, and where blocks and regions do, so that no end tag walks a deep page
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.outer: list[int] = []
        self.marks: list[list] = [[0, False]]  # the mark around it, holds an article or main?
        self.text: list[str] = []
        self.tags = self.regions = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, hidden, region, mark = self.open[-1] if self.open else ("", False, 0, 0)
            self.lines.append((text, self.tags, region, not hidden, mark))
        self.text, self.tags = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self._close("p")
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        _, hidden, region, mark = self.open[-1] if self.open else ("", False, 0, 0)
        found = dict(attrs)
        marked = marked_by_words(tag, found)
        if not hidden and (tag in REGIONS or ("role", "main") in attrs):
            if not region:
                self.regions += 1
                region = self.regions
            if not marked:
                self.marks[mark][1] = True
        if marked:
            self.marks.append([mark, False])
            mark = len(self.marks) - 1
        for at in (self.places[tag], *([self.blocks] if tag not in INLINE else []), *([self.outer] if tag in REGIONS else [])):
            at.append(len(self.open))
        self.open.append((tag, hidden or without_content(tag, found), region, mark))

    def handle_startendtag(self, tag, attrs):
        if tag not in INLINE:
            self._end_line()
        self.tags += 1

    def _close(self, tag: str) -> None:
        """End the last open element of this name and what stands in it; a block keeps an inline tag open, a region a p."""
        if not self.places[tag]:
            return
        place = self.places[tag][-1]
        if tag in INLINE and self.blocks and self.blocks[-1] > place or tag == "p" and self.outer and self.outer[-1] > place:
            return
        if self.blocks and self.blocks[-1] >= place:
            self._end_line()
        while len(self.open) > place:
            name = self.open.pop()[0]
            self.places[name].pop()
            for at in (self.blocks, self.outer):
                if at and at[-1] == len(self.open):
                    at.pop()

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._end_line()
        self._close(tag)
        self.tags += 1

    def handle_data(self, data):
        self.text.append(data)

    def close(self):
        super().close()
        self._end_line()


def without_content(tag: str, attrs: dict[str, str | None]) -> bool:
    return tag in NO_CONTENT or "hidden" in attrs or attrs.get("role") in NO_CONTENT_ROLES


def marked_by_words(tag: str, attrs: dict[str, str | None]) -> bool:
    """A class or the id is made up of such words: cookie-notice or sidebar-left, not has-sidebar or social-science."""
    if tag in ("html", "body", "main"):
        return False
    words = COMMENT_WORDS if tag == "article" else NO_CONTENT_WORDS
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split():
        parts = set(re.findall(r"[a-z]+", name))
        if parts & words and parts <= words | PLACE_WORDS:
            return True
    return False


def content(parser: Lines) -> list[bool]:
    """Whether each line is content."""
    lines, marks = parser.lines, parser.marks
    plain = [ok and not mark for _, _, _, ok, mark in lines]
    if any(ok and line[2] for ok, line in zip(plain, lines)):
        return plain
    chars, around = [0] * len(marks), [m for m, _ in marks]
    holds = [h for _, h in marks]
    for text, _, _, ok, mark in lines:
        chars[mark] += len(text) * ok
    outside, total = chars[0], sum(chars)
    for m in range(len(marks) - 1, 0, -1):  # a mark comes after those around it
        if around[m]:
            chars[around[m]] += chars[m]
            holds[around[m]] |= holds[m]
    hides = [False] * len(marks)
    for m in range(1, len(marks)):
        hides[m] = hides[around[m]] or not (2 * chars[m] > total or holds[m] and chars[m] > outside)
    return [ok and not hides[mark] for _, _, _, ok, mark in lines]


def smoothed(ratios: np.ndarray) -> np.ndarray:
    kernel = np.exp(-np.arange(-RADIUS, RADIUS + 1) ** 2 / (2.0 * (RADIUS / 2.0) ** 2))
    return np.convolve(np.pad(ratios, RADIUS, mode="edge"), kernel / kernel.sum(), mode="valid")


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    lines = parser.lines
    shown = content(parser)
    in_region = any(ok and line[2] for ok, line in zip(shown, lines))
    use = np.array([ok and bool(line[2] or not in_region) for ok, line in zip(shown, lines)], bool)
    if not use.any():
        return ""
    ratios = np.array([len(text) / max(1, tags) for text, tags, *_ in lines]) * use
    ratios = np.minimum(ratios, 2 * np.median(ratios[use]))
    even = smoothed(ratios)
    cluster = np.flatnonzero(use & (even >= even.std()) & (even > 0))
    if not len(cluster):
        cluster = np.flatnonzero(use & (even == even[use].max()))
    if in_region:
        chosen = {lines[i][2] for i in cluster}
        return " ".join(text for (text, _, region, *_), ok in zip(lines, use) if ok and region in chosen)
    return " ".join(lines[i][0] for i in range(cluster[0], cluster[-1] + 1) if use[i])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns named in `keep`, and text of every page."""
    rows = pages.select(id_col, *keep, F.col(html_col).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [id_col, *keep, "text"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, text string")
