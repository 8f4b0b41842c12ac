"""HTML extraction by line-block distribution.

Method: markup is stripped to lines, one per block element. Text lengths (without link text)
are summed over sliding windows of lines. A region is a stretch between two dives of the sum
(to ``DIVE``) within which it surges (to ``SURGE``, or half the page's largest sum where that
is less), and the text between is kept. A stretch without a surge is kept if it shares its
box (a div, section or the like), or the one around, with a region. Boilerplate elements leave
no trace; the borders of the article element leave a gap of empty lines that no region crosses.

The article (or main) element is the final check: where it holds most of the text of the
regions, or the rest is too short to surge, it is the main text, whole and alone. Where it
does not, as with teasers beside a story, the regions stand.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

LINES = 3
#: Characters in a window: a region has one of ``SURGE`` and ends where there are ``DIVE``.
SURGE = 80
DIVE = 0

#: Elements and classes, ids or roles that mark boilerplate.
RAW = {"script", "style", "textarea", "xmp", "title"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = set(
    "head nav header footer aside form menu button select dialog iframe object svg canvas"
    " noscript template audio video".split()
)
BOILERPLATE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside"
    " complementary contentinfo cookie cookies consent notice notices alert gdpr popup modal"
    " overlay comment comments commentlist disqus respond replies share sharing social related"
    " recommended recommendations newsletter subscribe signup login search pagination pager"
    " toolbar widget hidden".split()
)
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus"}
#: Words beside a mark in a class or id, such as ad-box; any other makes it no mark.
BEARERS = set(
    "area bar block bottom box btn button buttons col container content element footer form frame"
    " global group head holder icons id inner item items left link links list main message outer"
    " page panel post posts right row section site slot top unit wrap wrapper".split()
)
#: A class that ends or begins like this is a mark, whatever else it says.
MARK_ENDINGS = {"comments", "commentlist", "replies"}
MARK_BEGINNINGS = {"related", "recommended"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements whose start ends an open one of these, if it is not beyond one of those.
_CELLS = {"td", "th"}
_LISTS = set("article main menu ol section table td th ul".split())
ENDS = {
    "li": ({"li"}, _LISTS),
    "dt": ({"dt", "dd"}, _LISTS | {"dl"}),
    "dd": ({"dt", "dd"}, _LISTS | {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": (_CELLS, {"table", "tr"}),
    "th": (_CELLS, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
#: Elements whose start ends an open paragraph.
ENDS_P = set(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search"
    " section summary table ul".split()
)
#: Elements that hold a part of a page, and those that end tags inside do not reach beyond.
BOXES = set("article blockquote center details div main section td th".split())
SCOPES = set("article caption main object table td template th".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr img".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(/?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Z]?[^\W\d_A-Z]+|[A-Z]+")


def _is_boilerplate(name: str, attributes: str, in_article: bool) -> bool:
    if name in BOILERPLATE:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    given: dict[str, str] = {}
    for found in _ATTRIBUTE.finditer(attributes):
        given.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
    own_id, classes = given.get("id", ""), given.get("class", "").split()
    if name == "article":
        return any(_means(x, COMMENT_WORDS) for x in [*classes, own_id])
    if any(_begins_or_ends(x) for x in classes):
        return True
    if (
        given.get("hidden", "until-found").lower() != "until-found"
        or given.get("aria-hidden", "").lower() == "true"
        or _NOT_SHOWN.search(given.get("style", ""))
        or any(x.lower() in BOILERPLATE_WORDS for x in given.get("role", "").split())
        or any(_means(x, BOILERPLATE_WORDS) for x in classes)
    ):
        return True
    # ids of headings and sections are made from their titles
    if name in HEADINGS:
        return False
    titled = in_article and (name == "section" or "section" in classes)
    return _means(own_id, COMMENT_WORDS if titled else BOILERPLATE_WORDS)


def _means(token: str, marks: set[str]) -> bool:
    """Whether a class or id as a whole is a mark: all its words are marks or say what bears one."""
    parts = [x.lower() for x in _PARTS.findall(token) if len(x) > 1]
    return not marks.isdisjoint(parts) and all(x in marks or x in BEARERS for x in parts)


def _begins_or_ends(token: str) -> bool:
    """Whether a class names reader comments (user-comments) or other texts (related-stories)."""
    parts = [x.lower() for x in _PARTS.findall(token) if len(x) > 1]
    return bool(parts) and (parts[-1] in MARK_ENDINGS or parts[0] in MARK_BEGINNINGS)


class Line(NamedTuple):
    """Text, its length (0 if mostly links), which of article and main hold it, and its boxes."""

    text: str
    length: int = 0
    inside: tuple[str, ...] = ()
    boxes: tuple[int, ...] = ()


class _Lines:
    """The lines of a page, and the block elements that are open."""

    def __init__(self) -> None:
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = False
        self.open: list[str] = []
        self.all_open: Counter[str] = Counter()
        self.counts: Counter[str] = Counter()  # of those outside dropped elements
        self.boxes = [0]  # numbers of the open boxes, the page itself being 0
        self.n_boxes = 0
        self.dropped = 0  # how many elements are open up to the boilerplate one we are in
        self.dropped_at = 0  # where that one began
        self.main_seen = False  # whether an article or main has begun outside
        self.closed: dict[int, bool] = {}  # whether dropped ones have an end tag, by where they began
        self.no_more: set[str] = set()  # names without an end tag ahead

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(raw.strip())

    def end(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                own = 0 if 2 * self.linked > len(text) else len(text)
                where = tuple(k for k in ("article", "main") if self.counts[k])
                self.lines.append(Line(text, own, where, tuple(self.boxes[-2:])))
        self.parts, self.linked = [], 0

    def gap(self) -> None:
        self.end()
        self.lines += [Line("")] * LINES

    def imply(self, name: str) -> None:
        """Close what the start of an element ends without an end tag."""
        if name in ENDS:
            self._end_open(*ENDS[name])
        if name in ENDS_P:
            self._end_open({"p"}, SCOPES | {"button"})

    def _end_open(self, names: set[str], bounds: set[str]) -> None:
        if not any(self.all_open[x] for x in names):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at] in names:
                self.pop(at)
                return
            if self.open[at] in bounds:
                return

    def push(self, name: str, drop: bool) -> None:
        if not self.dropped:
            self.end()
            if name in ("article", "main") and not drop:
                self.gap()
                self.main_seen = True
            if name in BOXES and not drop:
                self.n_boxes += 1
                self.boxes.append(self.n_boxes)
        self.open.append(name)
        self.all_open[name] += 1
        if drop and not self.dropped:
            self.dropped = len(self.open)
        elif not self.dropped:
            self.counts[name] += 1

    def pop(self, depth: int) -> None:
        """Close all open elements from ``depth`` on."""
        while len(self.open) > depth:
            if not self.dropped:
                self.gap() if self.open[-1] in ("article", "main") else self.end()
                self.counts[self.open[-1]] -= 1
                if self.open[-1] in BOXES:
                    self.boxes.pop()
            elif len(self.open) == self.dropped:
                self.dropped = 0
            self.all_open[self.open.pop()] -= 1

    def close(self, name: str) -> None:
        """An end tag; one that nothing in its cell or article opened closes nothing."""
        if self.all_open[name]:
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at] == name:
                    self.pop(at)
                    return
                if self.open[at] in SCOPES and name not in SCOPES and name not in ("body", "html"):
                    break
        if not self.dropped and name not in INLINE:
            self.end()


def _has_end(out: _Lines, page: str, name: str) -> bool:
    """Whether the dropped element has an end tag of its own; looked for once."""
    began = out.dropped_at
    if began not in out.closed:
        out.closed[began] = False
        depth = 1 if name not in out.no_more else 0
        ends = False
        for tag in re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])", re.I).finditer(page, began):
            if not depth:
                break
            ends = ends or bool(tag[1])
            depth += -1 if tag[1] else 1
            if not depth:
                out.closed[began] = True
        if not ends:
            out.no_more.add(name)
    return out.closed[began]


def _holds_no_main(out: _Lines, page: str, name: str) -> bool:
    """Whether the dropped element we are in stays dropped where ``name`` (article, main) starts.

    An aside, footer, navigation, header or form with an end tag holds teasers at best. Of
    others, marked by a class, an article is one if the story has begun before.
    """
    left = out.open[out.dropped - 1]
    if left == "head":
        return True
    if left in BOILERPLATE:
        return _has_end(out, page, left)
    return name == "article" and out.main_seen and _has_end(out, page, left)


def lines(page: str) -> list[Line]:
    """The lines of a page, without boilerplate elements."""
    out, at, size = _Lines(), 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if not token:
            if not out.dropped:
                out.text(page[at:])
            break
        if not out.dropped and token.start() > at:
            out.text(page[at : token.start()])
        at = max(token.end(), at + 1)
        if token[2] is None:
            continue
        closing, name, attributes = bool(token[1]), token[2].lower(), token[3]
        if closing:
            if name == "a" and not out.dropped:
                out.in_link = False
            out.close(name)
            continue
        if name in RAW:
            at = _after(page, at, name)
            continue
        out.imply(name)
        if out.dropped:
            # an element left open ends where the page's main part begins
            left = out.open[out.dropped - 1]
            begins = name in ("article", "main") and not _holds_no_main(out, page, name)
            if name == "body" or begins:
                out.pop(out.dropped - 1)
        if out.dropped:
            if name not in VOID and not token[4] and (name not in INLINE or name == left):
                out.push(name, False)
            continue
        if name not in VOID and not token[4] and _is_boilerplate(
            name, attributes, bool(out.counts["article"] or out.counts["main"])
        ):
            out.push(name, True)
            out.dropped_at = token.end()
        elif name == "a":
            out.in_link = True
        elif name == "br":
            out.text(" ")
        elif name not in INLINE:
            if name in VOID or token[4]:
                out.end()
            else:
                out.push(name, False)
    if not out.dropped:
        out.end()
    return out.lines


def _after(page: str, at: int, name: str) -> int:
    """Where the raw text of an element ends."""
    close = re.compile(rf"</{name}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
    return close.end() if close else len(page)


def regions(lengths: list[int], window: int = LINES) -> list[tuple[int, int, bool]]:
    """First line and end of every stretch between two dives, and whether it has a surge."""
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    surge = min(SURGE, max(sums, default=0) / 2)
    out, start = [], None
    for i, total in enumerate([*sums, 0]):
        if total > DIVE and start is None:
            start = i
        elif total <= DIVE and start is not None:
            # the window sees a line before it comes, and a line behind the dive has no text
            full = [k for k in range(start, i) if lengths[k]]
            out.append((full[0], full[-1] + 1, max(sums[start:i]) >= surge))
            start = None
    return out


def extract(page: str | None) -> str:
    """The main text of a page."""
    found = lines(page or "")
    parts = regions([x.length for x in found])
    boxes = {box for a, b, surges in parts if surges for x in found[a:b] for box in _own(x)}
    kept = [
        i
        for a, b, surges in parts
        if surges or any(not boxes.isdisjoint(_own(x)) for x in found[a:b])
        for i in range(a, b)
    ]
    chosen = sum(found[i].length for i in kept)
    for where in ("article", "main"):
        whole = [i for i, x in enumerate(found) if where in x.inside]
        held = sum(found[i].length for i in kept if where in found[i].inside)
        if any(found[i].text for i in whole) and (2 * held > chosen or chosen - held < SURGE):
            kept = whole
            break
    return " ".join(found[i].text for i in kept if found[i].text)


def _own(line: Line) -> tuple[int, ...]:
    """The box of a line and the one around it; the page counts only as the former."""
    return line.boxes[-1:] if line.boxes[:1] == (0,) else line.boxes


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in tx.pieces(batches, 2):
        texts = [extract(page) for page in piece.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [piece.column(0), piece.column(1), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row of ``pages`` (page_id, url, html).

    A null or empty page, or one without main text, has an empty text. Repeated rows, null
    ids and other columns do no harm; a page is always read whole.
    """
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        _extract, "page_id long, url string, text string"
    )
