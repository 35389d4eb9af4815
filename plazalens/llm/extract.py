"""The main text of web pages.

The standard library's parser streams a page's events. They make lines, one per block of text,
each with the number of its characters, links and tags, and a tree of the blocks around them. The
logarithms of the lines' text-to-tag ratios are smoothed with a Gaussian, and two-means clustering gives
the threshold above which lines are content; lines of 60 characters a tag always are. The content that a
block holds, against what lies around it, decides the rest:

- Blocks of three or more links and hardly anything else, whose ratio is under the threshold, are no content
  beside other content.
- A class, id or form makes a block side only if it lies beside an article or most content of its article,
  or of the page, lies outside; reader comments are side, however long, if any content lies outside.
- The region is every article or main element that holds content, a quarter of the fullest one's or
  more; on pages where none does, the smallest block that holds most of the content.

All other text of the region is kept, short lines too, except for elements that are no content by their
kind or role.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: kinds of elements ----------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p"
    " pre section summary table tbody td tfoot th thead title tr ul".split()
)
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video map".split())
SIDE = frozenset("nav footer aside button select textarea input menu dialog".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense alert alerts banner banners breadcrumb breadcrumbs"
    " consent cookie cookies cookiebar footer gdpr hidden login masthead menu modal nav navbar navigation"
    " newsletter notice notices notification overlay pager pagination popup promo promotion recommended related"
    " share sharing sidebar signup skip social sponsor sponsored subscribe subscription"
    " toolbar topbar widget widgets".split()
)
REMARKS = frozenset("comment comments disqus replies reply respond responses".split())
PLAIN = frozenset(
    "area articles bar block body bottom box boxes button buttons column container content danger div element frame"
    " group holder icons info inner item items layer left link links list main module outer page panel placeholder post"
    " posts region right row section slot stories success text thread title top unit warning wrap wrapper zone".split()
)
NEGATED = frozenset("has hide is no not with without".split())
"""A name like ``has-sidebar`` speaks of another element."""
CLOSED_BY = {
    "p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
}
ROOTS = frozenset(["article", "main"])
NEVER_MARKED = frozenset(["html", "body", "article", "main"])
"""Elements that no class, id or form makes side."""

LINKS = 3
"""Links of a block that is taken for a menu if hardly anything else is in it."""
PROSE = 60.0
"""Characters a tag from which a line is content on any page, as the clusters of a page that is prose throughout
would part long paragraphs from very long ones."""
SHARE = 4
"""Of several articles, those with a fourth of the fullest one's content belong to the region."""

_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Line:
    text: str
    chars: int
    link_chars: int
    links: int
    tags: int
    block: int
    """Number of the innermost block around it."""


@dataclass
class Block:
    parent: int
    side: bool
    """By its kind or role, or that of a block around it."""
    mark: str
    """``side`` or ``remarks`` by its class or id, or by being a form."""
    root: int
    """The outermost article or main around it or that it is; 0 if there is none."""
    whole: bool = False
    """Too large to be taken for a menu: the page or an article."""


@dataclass
class _Element:
    tag: str
    unseen: bool
    link: bool
    block: int
    own: bool
    """Whether it has a block of its own."""
    above: int
    """Place of the innermost block element in the stack, itself included."""


def _mark(names: str) -> str:
    """What classes and ids say: the last word that is not about layout tells what a name
    names, so ``ad-box`` is an advert and ``share-price`` is not for sharing."""
    found = ""
    for name in names.split():
        words = [word.lower() for word in _WORD.findall(name)]
        if NEGATED.intersection(words):
            continue
        while len(words) > 1 and words[-1] in PLAIN:
            words.pop()
        if words and words[-1] in REMARKS:
            return "remarks"
        if words and words[-1] in MARKS:
            found = "side"
    return found


class _Lines(HTMLParser):
    """Collects the lines and blocks of a page while its events go by."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.blocks = [Block(0, False, "", 0, True)]
        """A block comes after the one around it."""
        self._open = [_Element("", False, False, 0, True, 0)]
        self._number = Counter()
        self._text: list[str] = []
        self._tags = self._link_chars = self._links = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            linked = min(self._link_chars, len(text))
            self.lines.append(Line(text, len(text), linked, self._links, self._tags, self._open[-1].block))
            self._tags = 0
        self._text, self._link_chars, self._links = [], 0, 0

    def _close(self, at: int) -> None:
        self._number.subtract(element.tag for element in self._open[at:])
        del self._open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._end_line()
            above = self._open[-1].above
            if above and tag in CLOSED_BY.get(self._open[above].tag, ()):
                self._close(above)
        elif tag == "br":
            self._text.append("\n")
        self._tags += 1
        if tag in VOID:
            return
        self._start(tag, dict(attrs))
        self._links += tag == "a"

    def _start(self, tag: str, attrs: dict[str, str | None]) -> None:
        top = self._open[-1]
        around = self.blocks[top.block]
        role = (attrs.get("role") or "").lower()
        # A header within the article is its title; elsewhere it is the page's.
        by_kind = tag in SIDE or role in ROLES or (not around.root and tag == "header")
        mark = ""
        if tag not in NEVER_MARKED:
            names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
            mark = _mark(names) or ("side" if tag == "form" else "")
            if not mark and not around.root and "header" in map(str.lower, _WORD.findall(names)):
                mark = "side"
        side, root = around.side or by_kind, around.root
        is_root = tag in ROOTS or role in ("main", "article") or attrs.get("itemprop") == "articleBody"
        is_root = is_root and not side and not root
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_HIDDEN.search(attrs.get("style") or ""))
        own = tag in BLOCK or bool(mark) or by_kind or is_root
        block = top.block
        if own:
            if tag not in BLOCK:
                self._end_line()
            block = len(self.blocks)
            whole = is_root or tag in NEVER_MARKED
            self.blocks.append(Block(top.block, side, mark, block if is_root else root, whole))
        above = len(self._open) if tag in BLOCK else top.above
        self._open.append(_Element(tag, top.unseen or tag in UNSEEN or hidden, top.link or tag == "a", block, own, above))
        self._number[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as in HTML, a slash does not close an element

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        at = None
        if self._number[tag] > 0:
            at = next(i for i in range(len(self._open) - 1, 0, -1) if self._open[i].tag == tag)
        if tag in BLOCK or (at is not None and any(e.own for e in self._open[at:])):
            self._end_line()
        if at is not None:
            self._close(at)

    def handle_data(self, data: str) -> None:
        top = self._open[-1]
        if not top.unseen:
            self._text.append(data)
            self._link_chars += len(data) if top.link else 0

    def close(self) -> None:
        super().close()
        self._end_line()


def _parsed(html: str) -> _Lines:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    return parser


def lines_of(html: str) -> list[Line]:
    return _parsed(html).lines


def _within(blocks: list[Block], lines: list[Line], values: list[int]) -> list[int]:
    """For each block the sum of the values of the lines anywhere in it."""
    sums = [0] * len(blocks)
    for line, value in zip(lines, values):
        sums[line.block] += value
    for at in range(len(blocks) - 1, 0, -1):
        sums[blocks[at].parent] += sums[at]
    return sums


def _passed_down(blocks: list[Block], flags: list[bool]) -> None:
    """Sets the flag of all blocks within a flagged one."""
    for at in range(1, len(blocks)):
        flags[at] = flags[at] or flags[blocks[at].parent]


def _side_blocks(parser: _Lines, content: np.ndarray, cutoff: float) -> tuple[list[bool], list[int]]:
    """Which blocks are side, and the characters of content of each line that is not."""
    blocks, lines = parser.blocks, parser.lines
    side = [block.side for block in blocks]
    prose = [bool(content[i]) and 2 * line.link_chars < line.chars for i, line in enumerate(lines)]

    def weights() -> list[int]:
        return [line.chars if prose[i] and not side[line.block] else 0 for i, line in enumerate(lines)]

    def base(at: int) -> int:
        """The article around a block, or the page."""
        root = blocks[at].root
        return root if root != at else 0

    roots = [0] * len(blocks)
    for at in range(len(blocks) - 1, 0, -1):
        roots[at] += blocks[at].root == at
        roots[blocks[at].parent] += roots[at]
    wraps = [0 < n == roots[0] and not blocks[at].root for at, n in enumerate(roots)]
    """Blocks around all articles of the page."""

    held = _within(blocks, lines, weights())
    chars, linked, links, tags = (
        _within(blocks, lines, [getattr(line, name) for line in lines]) for name in ("chars", "link_chars", "links", "tags")
    )
    for at, block in enumerate(blocks):
        if links[at] >= LINKS and 10 * linked[at] >= 8 * chars[at] and not (block.whole or roots[at]):
            low = np.log(chars[at] / max(1, tags[at])) < cutoff
            side[at] = side[at] or bool(low and held[base(at)] > held[at])
        if block.mark == "side" and not wraps[at]:
            beside = not block.root and not roots[at] and roots[0] > 0
            side[at] = side[at] or beside or 2 * held[at] <= held[base(at)]
    _passed_down(blocks, side)
    held = _within(blocks, lines, weights())
    for at, block in enumerate(blocks):
        if block.mark == "remarks" and not wraps[at]:
            side[at] = side[at] or held[at] < held[base(at)] or not held[at]
    _passed_down(blocks, side)
    return side, weights()


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """The ratios under a Gaussian of three standard deviations; at the ends the weights that
    are left are scaled to 1."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    cut = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[cut] / np.convolve(np.ones(len(ratios)), kernel)[cut]


def threshold(values: np.ndarray) -> float:
    """The middle between the centres of two clusters of values."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        middle = (low + high) / 2
        upper = values > middle
        if not upper.any() or upper.all():
            break
        centres = float(values[~upper].mean()), float(values[upper].mean())
        if centres == (low, high):
            break
        low, high = centres
    return (low + high) / 2


def _container(parser: _Lines, own: list[int], weights: list[int]) -> list[int]:
    """All lines of the smallest block of two lines or more that holds most of the content
    lines and of their characters. Else all lines."""
    blocks, lines = parser.blocks, parser.lines
    kept = set(own)
    size = _within(blocks, lines, [int(i in kept) for i in range(len(lines))])
    found = _within(blocks, lines, [int(weight > 0) for weight in weights])
    chars = _within(blocks, lines, weights)
    most = [at for at in range(1, len(blocks)) if 2 * found[at] > found[0] and 2 * chars[at] > chars[0] and size[at] > 1]
    if not most:
        return own
    region = min(most, key=lambda at: (size[at], -at))
    inside = [at == region for at in range(len(blocks))]
    _passed_down(blocks, inside)
    return [i for i in own if inside[lines[i].block]]


def main_text(html: str | None) -> str:
    """The text of the content region, lines joined by a space; empty if there is none."""
    parser = _parsed(html or "")
    blocks = parser.blocks
    if not parser.lines:
        return ""
    ratios = np.log([line.chars / max(1, line.tags) for line in parser.lines])
    # Menus and the like show what is no content, but are not smoothed into the lines next to them.
    cutoff = min(threshold(smoothed(ratios)), float(np.log(PROSE)))
    seen = np.array([not blocks[line.block].side for line in parser.lines])
    lines = parser.lines = [line for line, is_seen in zip(parser.lines, seen) if is_seen]
    if not lines:
        return ""
    side, weights = _side_blocks(parser, smoothed(ratios[seen]) >= cutoff, cutoff)
    own = [i for i, line in enumerate(lines) if not side[line.block]]
    content, chars = Counter(), Counter()
    for i in own:
        root = blocks[lines[i].block].root
        if root:
            content[root] += weights[i]
            chars[root] += lines[i].chars
    fullest = max(content.values(), default=0)
    # Clusters overrule articles without content while other text has some.
    if fullest:
        regions = {root for root, held in content.items() if SHARE * held >= fullest}
    elif chars and not any(weights):
        regions = {max(chars, key=lambda root: (chars[root], -root))}
    else:
        return " ".join(lines[i].text for i in _container(parser, own, weights))
    return " ".join(lines[i].text for i in own if blocks[lines[i].block].root in regions)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html) for html in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``.

    NULL and empty html, and pages without content, have the empty text. Repeated rows give
    repeated rows, NULL ids and URLs stay, other columns are ignored. A page is read whole, and
    broken or cut markup is read as far as it goes. No row depends on another.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
