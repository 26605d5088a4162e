"""Main text of web pages by text-to-tag ratios over the events of the standard parser.

The parser streams start tags, end tags and text; block tags end a line.  Of each line the text,
the tags in it and the elements round it are kept.  Lines inside elements that are never the
article (scripts, menus, footers, adverts, forms, comments, ...) are left out.  For the others the
ratio of characters to tags is smoothed along the page with a Gaussian, and lines over the
threshold, a part of the ratios' standard deviation, are selected.  Where article and main
elements hold most of the selected text, those with a selected line are the content, and headlines
beside them.  A header of an article, and a part of it whose name only holds such a word (as
``related-work``), stay if they have a headline or a line of prose.  Everywhere else it is the smallest container that holds all selected lines.  A region
is taken whole, so short lines in it are never lost.  A form that holds most of the text of a page
is the frame of the page.

Defined cases: a null or empty page has an empty text; unclosed and stray tags are tolerated;
repeated rows are read each by itself; an empty table gives an empty result; other columns stay,
and clashing result columns replace them.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.batches import text_slices

#: Deviation of the Gaussian in lines, and the part of the standard deviation a line must reach.
SMOOTHING, THRESHOLD = 1.0, 0.5
#: Characters by tag from which a line is prose in full, so that one long line doesn't outweigh others.
PROSE = 80.0
#: Part of the text that makes marked regions the content, or a form the frame of a page.
HOLDS_MOST = 0.5

# Elements of HTML.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
_CONTAINER = frozenset("article body div main section table td".split())
# An open element of the first kind ends when the second kind starts beside it.
_CLOSED_BY = {
    "p": _BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
}
# Elements, class names and roles of what isn't part of an article.
_NEVER = frozenset(
    "aside audio button canvas datalist dialog embed footer head header iframe input menu nav "
    "noscript object script search select style svg template textarea title video".split()
)
_NEVER_NAMED = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter "
    "notice notification popup promo promoted related share sharing sidebar social sponsor "
    "sponsored subscribe toolbar widget".split()
)
_NEVER_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
_NAME = re.compile("[a-z]+")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_KEPT_WHATEVER_NAMED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())


def is_foreign(tag: str, attributes: list[tuple[str, str | None]]) -> bool:
    """Whether an element is never part of an article."""
    if tag in _NEVER:
        return True
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and (value or "").strip().lower() in _NEVER_ROLES:
            return True
        if name in ("class", "id") and value:
            words = _NAME.findall(value.lower())
            if tag not in _KEPT_WHATEVER_NAMED and not _NEVER_NAMED.isdisjoint(words):
                return True
            if tag == "article" and not {"comment", "comments"}.isdisjoint(words):
                return True
    return False


def is_doubtful(tag: str, attributes: list[tuple[str, str | None]]) -> bool:
    """Whether only ``header``, or a name with more to it, makes a part of an article foreign."""
    others = [(name, value) for name, value in attributes if name not in ("class", "id")]
    if is_foreign("div" if tag == "header" else tag, others):
        return False
    for name in " ".join(value or "" for name, value in attributes if name in ("class", "id")).lower().split():
        words = _NAME.findall(name)
        if not _NEVER_NAMED.isdisjoint(words):
            of_header = words[-1] == "header" and _NEVER_NAMED.isdisjoint(words[:-1])
            of_other = words[0] in ("related", "notice") and _NEVER_NAMED.isdisjoint(words[1:])
            if len(words) == 1 or not (of_header or of_other):
                return False
    return True


class Lines(HTMLParser):
    """The lines of a page: text, number of tags, region, container, form, whether a headline, and
    the doubtful part."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []
        self.count: dict[str, int] = {}
        self.foreign = 0
        self.regions: list[tuple[str, int]] = []
        # The outermost open form by number, and the tags before it; 0 is none.
        self.form = self.forms = self.tags_before = 0
        # The outermost open doubtful part by number, and the tags before it; 0 is none.
        self.part = self.doubtful = self.open_doubtful = self.tags_outside = 0
        # Containers by number, each with the number of the one round it; 0 is the page.
        self.outer: list[int] = [0]
        self.container = 0
        self.elements = 0
        self.parts: list[str] = []
        self.tags = 0
        self.found: list[tuple[str, int, tuple[str, int] | None, int, int, bool, int, int]] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            # Tags without text count for the line that follows.
            region = self.regions[0] if self.regions else None
            headline = self.count.get("h1", 0) > 0
            self.found.append((text, self.tags, region, self.container, self.form, headline, self.part, self.tags_outside))
            self.tags = self.tags_outside = 0
        self.parts = []

    def push(self, tag: str, foreign: bool, doubtful: bool) -> None:
        self.elements += 1
        self.open.append((tag, foreign, doubtful))
        if doubtful:
            if not self.open_doubtful:
                self.doubtful += 1
                self.part, self.tags_outside = self.doubtful, self.tags - 1
            self.open_doubtful += 1
        self.count[tag] = self.count.get(tag, 0) + 1
        self.foreign += foreign
        if tag in _CONTAINER:
            self.outer.append(self.container)
            self.container = len(self.outer) - 1
        if tag in ("article", "main"):
            self.regions.append((tag, self.elements))
        if tag == "form" and self.count[tag] == 1:
            self.forms += 1
            self.form, self.tags_before = self.forms, self.tags

    def pop(self) -> str:
        tag, foreign, doubtful = self.open.pop()
        if doubtful:
            self.open_doubtful -= 1
            self.part = self.part if self.open_doubtful else 0
        self.count[tag] -= 1
        self.foreign -= foreign
        if tag in _CONTAINER:
            self.container = self.outer[self.container]
        if tag in ("article", "main"):
            self.regions.pop()
        if tag == "form" and not self.count[tag]:
            self.form, self.tags = 0, self.tags_before
        return tag

    def close_for(self, tag: str) -> None:
        """End open elements that can't hold the new one."""
        for at in range(len(self.open) - 1, max(len(self.open) - 16, -1), -1):
            name = self.open[at][0]
            if tag in _CLOSED_BY.get(name, ()):
                while len(self.open) > at:
                    self.pop()
                return
            if name in _BLOCK and name not in ("p",):
                return

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self.end_line()
            if tag != "br":
                self.close_for(tag)
        if not self.foreign:
            self.tags += 1
        if tag not in _VOID:
            foreign = is_foreign(tag, attrs)
            doubtful = foreign and bool(self.regions) and is_doubtful(tag, attrs)
            self.push(tag, foreign and not doubtful, doubtful)

    def handle_startendtag(self, tag, attrs):
        # A slash at the end of a start tag means nothing in HTML, but in drawings and formulas.
        if tag in _BLOCK or tag in _VOID or not self.count.get("svg", 0) + self.count.get("math", 0):
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self.end_line()
        if not self.foreign:
            self.tags += 1
        if tag not in _VOID and self.count.get(tag, 0):
            while self.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.foreign:
            self.parts.append(data)

    def close(self):
        super().close()
        self.end_line()


def smoothed(values: np.ndarray, deviation: float = SMOOTHING) -> np.ndarray:
    """Gaussian average along the lines; at the ends of what there is."""
    radius = max(1, math.ceil(2 * deviation))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / deviation) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[radius : radius + len(values)]
    return np.convolve(values, kernel)[radius : radius + len(values)] / weight


def main_text(html: str) -> str:
    """The text of the content regions of a page, lines joined by one space."""
    parser = Lines()
    # A tag that the end of the page cuts off is markup, which the parser would give as text.
    parser.feed(_CUT_TAG.sub("", html))
    parser.close()
    lines = without_forms(without_doubtful(parser.found))
    if not lines:
        return ""
    size = np.array([len(line[0]) for line in lines], float)
    plain = np.minimum(size / np.maximum([line[1] for line in lines], 1), PROSE)
    ratio = smoothed(plain)
    least = THRESHOLD * ratio.std()
    near = ratio >= least
    # A short line is not selected for its neighbours alone, unless it is a headline.
    headline = np.array([line[5] for line in lines]) & near
    selected = near & (plain >= least)
    marked = np.array([line[2] is not None for line in lines])
    if marked.any() and size[marked & selected].sum() >= HOLDS_MOST * size[selected].sum():
        chosen = {lines[i][2] for i in np.flatnonzero(marked & near)}
        keep = [line[2] in chosen or head for line, head in zip(lines, headline, strict=True)]
    else:
        keep = within_container([line[3] for line in lines], parser.outer, selected | headline)
    return " ".join(line[0] for line, kept in zip(lines, keep, strict=True) if kept)


def without_doubtful(lines: list[tuple]) -> list[tuple]:
    """The lines outside doubtful parts, and those of parts with a headline or a line of prose."""
    good = {line[6] for line in lines if line[5] or len(line[0]) >= PROSE * max(line[1] - line[7], 1)}
    kept, before = [], 0
    for line in lines:
        if line[6] and line[6] not in good:
            before += line[7]
        else:
            kept.append((line[0], line[1] + before, *line[2:]))
            before = 0
    return kept


def without_forms(lines: list[tuple]) -> list[tuple]:
    """The lines outside forms, and those of a form that is the frame of the page.

    A form is that if it holds most of the text, and not beside an article or main element.
    """
    total = sum(len(line[0]) for line in lines)
    dropped = set()
    for form in {line[4] for line in lines if line[4]}:
        inside = [line for line in lines if line[4] == form]
        beside = any(line[2] for line in lines if not line[4]) and not any(line[2] for line in inside)
        if beside or sum(len(line[0]) for line in inside) < HOLDS_MOST * total:
            dropped.add(form)
    return [line for line in lines if line[4] not in dropped]


def within_container(containers: list[int], outer: list[int], selected: np.ndarray) -> list[bool]:
    """Which lines are in the smallest container that holds all selected ones."""
    held = np.bincount(containers, selected, len(outer))
    for number in range(len(outer) - 1, 0, -1):  # outer containers have lower numbers
        held[outer[number]] += held[number]
    best = int(np.flatnonzero(held == held[0])[-1])  # such containers lie within each other
    inside = [False] * len(outer)
    for number in range(len(outer)):
        inside[number] = number == best or (number > 0 and inside[outer[number]])
    return [inside[c] for c in containers]


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns but the page, with ``text`` and ``n_chars``."""
    added = {"text": "string", "n_chars": "long"}
    kept = [c for c in pages.columns if c != html_col and c not in added]
    source = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").alias("_html"))

    def run(batches):
        for batch, pages_of in text_slices(batches, "_html"):
            texts = [main_text(html) for html in pages_of.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(kept))],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[*kept, *added],
            )

    schema = source.drop("_html").schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return source.mapInArrow(run, schema)
