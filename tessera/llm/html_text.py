"""Main text of HTML pages by line-block distribution.

Markup is stripped to one line per block element with text; a line break without text is an empty line.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are dropped
(a class, id or role names them; never one that holds the article or most of the text). Dropped menus,
headers and footers are empty lines, other dropped text leaves no gap. Text lengths are summed over windows
of ``WINDOW`` lines. A surge is where a window's sum rises from zero, a dive where it falls back to zero; the
text between a surge and its dive is kept if some window between them reaches ``PEAK`` characters, or if it lies
in the same article or container (the nearest element that holds several blocks) as such text; the largest
stretch stays if none reaches ``PEAK``. Lines that are mostly link text weigh nothing, so lists of links make
no surge; in an article only ``WINDOW`` or more of them in a row do (a linked title is text). Where
``article`` and ``main`` elements hold most of the text outside links, the lines outside them make stretches
of their own and weigh ``1 / FAR``; elsewhere all lines weigh alike.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_or_empty

WINDOW = 3
PEAK = 80
FAR = 4  # where an article holds most of the text, lines outside it weigh a quarter

#: Fixed lists: element names by role, and words of class, id and role attributes.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre script "
    "search section select style summary svg table tbody td template textarea tfoot th thead title tr ul video audio canvas object".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset(
    "head title script style noscript template nav header footer aside form menu dialog button select option textarea iframe svg "
    "object canvas audio video search".split()
)
MAIN = frozenset(("article", "main"))
LABELS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies footer "
    "gdpr header masthead menu modal nav navbar navigation newsletter notice notification pagination popup promo promotion related "
    "replies reply share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Names that begin with one of these count as well (commentlist, sidebarright).
STARTS = ("advert", "breadcrumb", "comment", "cookie", "footer", "navbar", "navigation", "newsletter", "popup", "sidebar", "sponsor")
#: A name with one of these tells how a page is laid out or what it lacks (has-comments, no-sidebar, menu-open).
LAYOUT = frozenset("has no non not with without hide show enable enabled disable disabled open closed collapsed expanded on off".split())
#: Dropped text of these sets apart what is before and after it; other dropped text leaves no gap.
BREAKS = frozenset("nav header footer menu".split())
#: Blocks that hold text rather than other blocks.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th tr caption figcaption summary address center".split())
#: An element of these ends an open one of the same name.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_RAW_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "textarea", "title", "template", "noscript", "iframe", "svg")}
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name, a bare one as an empty text; the first of equal names counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or "").strip())
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        attributes.get("hidden", "no").lower() in ("", "hidden", "true")
        or attributes.get("aria-hidden", "").lower() == "true"
        or bool(_NO_DISPLAY.search(attributes.get("style", "")))
    )


def _labelled(attributes: dict[str, str]) -> bool:
    """Whether a class, id or role is a label or begins or ends with one (cookie-notice, siteFooter)."""
    for name in " ".join(attributes.get(key, "") for key in ("class", "id", "role")).split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        if not LAYOUT.isdisjoint(parts):
            continue
        if any(p in LABELS or p.startswith(STARTS) for p in (*parts[:1], *parts[-1:])):
            return True
    return False


class _Label:
    """A labelled element: ``text`` counts its characters outside links, ``own`` those in article
    elements that it holds. ``up`` is the labelled element around it, ``article`` the article."""

    def __init__(self, up: _Label | None, article: int):
        self.up, self.article = up, article
        self.text = self.own = 0
        self.main = self.gone = False


def _judge(labels: list[_Label], total: int, articles: int) -> None:
    """Mark the labelled elements that drop out: not those with a main element, with half of the
    page's article text, or with most of the page's text when no article elsewhere has much."""
    for e in reversed(labels):  # inner ones come later
        if e.up:
            e.up.text += e.text
            e.up.own += e.own if e.article == e.up.article else e.text
            e.up.main |= e.main
    for e in labels:
        stays = e.main or 0 < articles <= 2 * e.own or (2 * e.text > total and 4 * (articles - e.own) < e.text)
        e.gone = not stays or bool(e.up and e.up.gone)


def lines(html: str) -> list[tuple[str, int, int, int]]:
    """The page's lines: text, characters of it that are link text, the number of the innermost
    article (0 for none), and the number of the line's container. Block boundaries without text
    make no line, nor does dropped text; line breaks and the text of ``BREAKS`` make empty ones."""
    out: list[tuple[str, int, int, int, _Label | None]] = []
    above, holds, boxes = [0], [0], [True]  # per element: the one around it, its lines, whether it groups blocks
    labels: list[_Label] = []
    text: list[str] = []
    linked = count = 0
    apart = False  # text of BREAKS since the last line
    # name, outside, number of the innermost article, in link, innermost labelled element, number, in BREAKS
    stack: list[tuple[str, bool, int, bool, _Label | None, int, bool]] = [("", False, 0, False, None, 0, False)]
    at, end = 0, len(html)

    def flush(tag: str = ""):
        nonlocal linked, apart
        _, outside, article, _, label, element, _ = stack[-1]
        line = " ".join("".join(text).split())
        if line or apart or (tag == "br" and not outside):
            out.append((line, min(linked, len(line)), article, element, label))
            holds[element] += bool(line)
        text.clear()
        linked, apart = 0, False

    def add(piece: str):
        nonlocal linked, apart
        _, outside, _, link, _, _, breaks = stack[-1]
        apart = apart or (breaks and bool(piece.strip()))
        if piece and not outside:
            piece = unescape(piece)
            text.append(piece)
            if link:
                linked += len(" ".join(piece.split()))

    while at < end:
        m = _TOKEN.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush(name)
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        if name in SELF_CLOSING and stack[-1][0] == name:
            stack.pop()
        _, outside, article, link, label, element, breaks = stack[-1]
        outside = outside or name in OUTSIDE
        if not outside and m[3] and name not in ("html", "body", "main"):
            attributes = _attributes(m[3])
            outside = _hidden(attributes)
            if not outside and name != "article" and _labelled(attributes):
                label = _Label(label, article)
                labels.append(label)
        if name in _RAW_END:  # their content is not markup
            close = _RAW_END[name].search(html, at)
            at = close.end() if close else end
            continue
        if name in MAIN and not outside:
            article = count = count + 1
            if label and name == "main":
                label.main = True
        above.append(element)
        holds.append(0)
        boxes.append(name in BLOCKS and name not in LEAVES)
        stack.append((name, outside, article, link or name == "a", label, len(above) - 1, breaks or name in BREAKS))
    flush()
    for e in range(len(above) - 1, 0, -1):  # inner ones come later
        holds[above[e]] += holds[e]
    box = [0]
    for e in range(1, len(above)):
        box.append(e if boxes[e] and holds[e] > 1 else box[above[e]])
    total = articles = 0
    for line, link, article, _, label in out:
        total += len(line) - link
        articles += len(line) - link if article else 0
        if label:
            label.text += len(line) - link
            label.own += len(line) - link if article != label.article else 0
    _judge(labels, total, articles)
    return [(line, link, article, box[element]) for line, link, article, element, label in out if not (label and label.gone)]


def _stretches(page: list[tuple[str, int, int, int]], weight: np.ndarray, largest: bool) -> list[int]:
    """Places of the lines between surge and dive points where a window reaches ``PEAK`` (or of the
    ``largest`` such stretch if none does), and of stretches in the same article or container."""
    if not weight.any():
        return []
    padded = np.concatenate([np.zeros(WINDOW - 1, np.int64), weight, np.zeros(WINDOW - 1, np.int64)])
    total = np.cumsum(np.concatenate([[0], padded]))
    windows = total[WINDOW:] - total[:-WINDOW]  # window w covers the lines w - WINDOW + 1 .. w
    live = np.concatenate([[False], windows > 0, [False]])
    surges, dives = np.flatnonzero(live[1:] & ~live[:-1]), np.flatnonzero(live[:-1] & ~live[1:])
    peaks = np.array([windows[s:d].max() for s, d in zip(surges, dives)])
    keep = peaks >= PEAK
    if largest and not keep.any():
        keep[int(peaks.argmax())] = True
    # from the first to the last line with weight
    stretches = [range(s, d - WINDOW + 1) for s, d in zip(surges.tolist(), dives.tolist())]
    boxes = [{-page[i][2] or page[i][3] for i in stretch if weight[i]} for stretch in stretches]
    held = set().union(*[b for b, k in zip(boxes, keep) if k])
    return [i for stretch, b, k in zip(stretches, boxes, keep) if k or b & held for i in stretch]


def main_text(html: str) -> str:
    """Text between surge and dive points, lines joined by one space."""
    page = lines(html)
    if not page:
        return ""
    size, linked, article, _ = (np.array(c) for c in zip(*[(len(p[0]), *p[1:]) for p in page]))
    inside, links = article > 0, 2 * linked > size
    cuts = np.flatnonzero(np.diff(links, prepend=not links[0], append=not links[-1]))
    lists = links & np.repeat(np.diff(cuts) >= WINDOW, np.diff(cuts))  # runs of lines that are mostly links
    weight = np.where(np.where(inside, lists, links), 0, size)
    if 2 * (size - linked)[inside].sum() > (size - linked).sum():
        parts = [(inside, weight, True), (~inside, weight // FAR, False)]
    else:
        parts = [(np.ones(len(page), bool), weight, True)]
    found: set[int] = set()
    for part, weights, largest in parts:
        found.update(i for i in _stretches(page, np.where(part, weights, 0), largest) if part[i])
    return " ".join(page[i][0] for i in sorted(found) if page[i][0])


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` plus ``out_col``, the main text of ``html_col``; rows and other columns stay as they are.

    A null or empty page, or one without content, has an empty text. Character references are
    decoded, white space inside a block becomes one space, blocks are joined by one space.
    """
    prepare(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(html: pd.Series) -> pd.Series:
        return html.map(main_text)

    return pages.withColumn(out_col, extract(text_or_empty(html_col)))
