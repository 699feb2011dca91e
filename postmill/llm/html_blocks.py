"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. A block is described by its word count and link density, by those of
its neighbours, and by where it stands; the tree is grown on the small labelled table below.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from postmill.llm.common import bounded_batches

# Element names of HTML.
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
_HIDDEN = frozenset("script style template noscript textarea select title svg math iframe object canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))
_FURNITURE = frozenset("nav aside footer form menu dialog button fieldset head".split())
#: Parts of class, id and role values that name furniture, and those that name the text itself.
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent copyright disclaimer footer menu modal nav navbar navigation newsletter notice notices pagination popup "
    "promo promoted recommended related search share sharing sidebar social sponsor sponsored subscribe toolbar "
    "widget complementary contentinfo alert".split()
)
_TEXT_WORDS = frozenset("article body content entry main post story text".split())
#: Reader comments and adverts stay furniture beside a word of the text, and however much of the page they fill.
_ALWAYS = frozenset("ad ads comment comments".split())
#: A class that begins or ends so tells the state or layout of a wrapper: has-sidebar, banner-on.
_STATE_FIRST = frozenset("has no not with without is js wp hide show".split())
_STATE_LAST = frozenset("on off open closed enabled disabled visible active layout page wrapper template".split())
_INLINE_ADS = frozenset("ad ads advert adverts advertisement advertising promo promoted sponsor sponsored".split())
#: Elements that hold all of a page but its head, whatever their class.
_WHOLE = frozenset(("html", "body"))

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript|textarea|svg|math|iframe|object|canvas|title)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+>"
    r".*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)|</[^>]*+>",
    re.I | re.S,
)
_NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int  # words inside links
    main: bool  # inside article or main
    furniture: bool  # inside navigation, a form, an advert and the like
    heading: bool


def _names(attributes: str) -> list[list[str]]:
    """The parts of each word of class, id and role, without words that tell a state."""
    tokens = [t for value in _NAMING.findall(attributes) for t in value.strip("\"'").lower().split()]
    parts = [[w for w in re.split(r"[^a-z]+", t) if w] for t in tokens]
    return [p for p in parts if p and (len(p) == 1 or not (p[0] in _STATE_FIRST or p[-1] in _STATE_LAST))]


def _is_furniture(name: str, attributes: str, in_main: bool) -> tuple[bool, bool, bool]:
    """Whether an element is furniture by its kind, or by its names alone, and whether those may yield to its content."""
    if name in _FURNITURE or (name == "header" and not in_main):
        return True, False, False
    if name in _WHOLE or "=" not in attributes and "hidden" not in attributes:
        return False, False, False
    if _UNSEEN.search(attributes):
        return True, False, False
    words = {w for parts in _names(attributes) for w in parts}
    named = words & _FURNITURE_WORDS
    by_name = bool(named) and not (words & _TEXT_WORDS and not named & _ALWAYS)
    return False, by_name, not named & _ALWAYS


def _muted(attributes: str) -> bool:
    """Whether an element inside a line is an advert or not shown."""
    if "=" not in attributes and "hidden" not in attributes:
        return False
    return bool(_UNSEEN.search(attributes)) or any(len(p) == 1 and p[0] in _INLINE_ADS for p in _names(attributes))


@dataclass
class _Open:
    name: str
    main: bool
    furniture: bool  # by an element's kind
    named: tuple[int, ...]  # elements around that are furniture by their names alone


def _wrappers(found: list[Block], named: list[tuple[int, ...]], yields: list[bool], parts: list[tuple[int, ...]]) -> set[int]:
    """Elements whose names don't count: those around the article or main parts that the fewest of them surround (so cards
    among related pages stay where an article stands apart), or around most words of a page without such a part."""
    if parts:
        open_parts = [p for p in parts if all(yields[e] for e in p)]
        least = min(map(len, open_parts), default=0)
        return {e for p in open_parts if len(p) == least for e in p}
    words = [0] * len(yields)
    total = 0
    for block, around in zip(found, named):
        if not block.furniture:
            total += block.words - block.linked
            for e in around:
                words[e] += block.words - block.linked
    return {e for e, n in enumerate(words) if yields[e] and n > 0 and 2 * n > total}


def blocks(page: str) -> list[Block]:
    """Text blocks in page order. Character references are decoded; white space becomes single spaces.

    An element is furniture by its kind (``nav``, ``form``), because it isn't shown, or by a word of its class, id or role. The last
    does not count for an element around an article or main part that lies in no other one, or, on a page that has none, around most
    of the words; nor ever for ``html`` and ``body``. Adverts inside a line are left out up to their end or that of their block.
    """
    found: list[Block] = []
    named: list[tuple[int, ...]] = []  # beside found
    yields: list[bool] = []  # per element named as furniture
    main_parts: list[tuple[int, ...]] = []  # the named elements around each
    open_tags: list[_Open] = []
    parts: list[str] = []
    linked, in_link, heading = 0, False, False
    mute, depth = "", 0
    outside = _Open("", False, False, ())

    def flush() -> None:
        nonlocal linked, heading
        words = html.unescape("".join(parts)).split() if parts else []
        if words:
            place = open_tags[-1] if open_tags else outside
            found.append(Block(" ".join(words), len(words), min(linked, len(words)), place.main, place.furniture, heading))
            named.append(place.named)
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not mute:
            parts.append(text)
            if in_link:
                linked += len(html.unescape(text).split())

    at = 0
    for m in _MARKUP.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if mute and name == mute:
            depth += -1 if m[2] else 1
            if depth == 0:
                mute = ""
        if name == "a":
            in_link = not m[2]
        elif name == "br":
            add(" ")
        if name not in _BLOCK:
            if not mute and not m[2] and name not in _VOID and m[4] and not m[4].endswith("/") and _muted(m[4]):
                mute, depth = name, 1
            continue
        mute = ""
        flush()
        if name in _HEADINGS:
            heading = not m[2]
        if m[2]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i].name == name:
                    del open_tags[i:]
                    break
            in_link = in_link and name in ("p", "li")
        elif name not in _VOID:
            if open_tags and (open_tags[-1].name == "p" or open_tags[-1].name == name in ("li", "option", "dd", "dt", "td", "tr")):
                open_tags.pop()
            around = open_tags[-1] if open_tags else outside
            main = around.main or name in _MAIN
            kind, by_name, may_yield = _is_furniture(name, m[4] or "", main)
            elements = around.named
            if name in _MAIN and not around.main and not around.furniture:
                main_parts.append(elements + (len(yields),) * by_name)
            if by_name:
                elements = (*elements, len(yields))
                yields.append(may_yield)
            open_tags.append(_Open(name, main, around.furniture or kind, elements))
    add(page[at:])
    flush()
    void = _wrappers(found, named, yields, main_parts) if yields else set()
    for block, elements in zip(found, named):
        block.furniture = block.furniture or any(e not in void for e in elements)
    return found


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """Word count and link density of each block and its neighbours; its place."""
    size = [float(b.words) for b in found]
    density = [b.linked / b.words for b in found]
    any_main = float(any(b.main for b in found))
    size_, density_ = [0.0, *size, 0.0], [0.0, *density, 0.0]
    return [
        (size_[i + 1], density_[i + 1], size_[i], density_[i], size_[i + 2], density_[i + 2],
         float(b.main), float(b.furniture), float(b.heading), any_main)
        for i, b in enumerate(found)
    ]


# Labelled table, our own: pages in short form with one sign per block, + main text, - furniture.
# Numbers are word counts; L, a block of links; a letter before a number, the place: m main, f furniture, M both,
# h heading, H heading in main, g heading in furniture.
_LABELLED = """
L1- L1- L1- f10- H8+ m30+ m25+ m2+ m40+ f8-
L1- L2- f12- H7+ m1+ m55+ m1+ m80+ f9-
fL1- fL1- f14- H9+ m60+ m45+ M12- M9- f6-
H5+ m3+ m2+ m1+ f11- fL4-
fL2- H6+ m12+ m9+ m15+ m7+ M20- M35- f10-
m90+ m4+ m1+ m33+ f5-
f40- f32- H4+ m18+ mL3+ m22+ m5+ f7-
fL1- fL1- H10+ m150+ m6+ m200+ mL2+ fL5- f12-
f9- f8- H8+ m1+ f8-
fL6- H3+ m2+ f13-
H8+ m14+ mL1+ mL1+ m26+ M50- f4-
fL1- f6- m11+ f9-
fL1- fL1- H2+ m1+
H1+ mL4+
m2+ fL1- fL1- m6+ M3-
fL3- m7+ mL2+ m3+ m1+
30- 12- H6+ m5+ m9+ 25- 4-
12- m3+ mL9+ 14- L2-
L1- 22- m2+ m2+ L3- 40-
9- H5+ mL1+ m8+
m70+ m3+ L1- L1- 6-
m1+ M4- M60- m1+
h3- L1- L1- H6+ m30+ m28+ g2- fL4-
h2- g1- fL1- H8+ m3+ m44+ h2- L5- L6-
g1- fL2- h7+ 40+ 52+ g3- f9-
g2- f3- h5+ 33+ 61+ h3+ 45+ f8-
h4- m25+ m31+ g2- f40- g1- f6-
g3- f20- m60+ h5- 33- 28-
fL1- f10- m60+ m50+ f9-
L1- f12- m40+ m3+ f11-
L2- 11- m70+ m45+ 8-
f9- m35+ f7-
14- m90+ m60+ 10-
fL2- f8- mL5+ m80+ 9-
L3- 7- m200+ f6-
f5- f13- m55+ 12-
25- m31+ m44+ 6- f40-
60- 45- m12+ m1+
H4+ M8- m20+ ML1- m3+
L1- L1- h8+ 60+ 42+ 75+ 3- L6-
L2- h6+ 35+ 28+ 31+ L3- 4-
L1- L1- L1- 55+ 48+ 21+ 66+ 5- L2-
h9+ 25+ 80+ 20+ 2- L1-
f30- h7+ 44+ 39+ 52+ f25- f60-
L4- 2- h5+ 29+ 33+ 1- L1- L1-
3- L1- 2- L2- 4- L1-
L1- 70+ 65+ L1- L2- 3-
40+
18+ 33+
h6+ 24+ 5+ 31+
50+ 4+ 60+ 2- L2-
f12- 50+ 38+ f9-
fL1- f10- 64+ 5+ 47+ f8-
f9- 5+ 70+ 41+ f30-
L30- L30- 60+ 55+ 40+ L30- L25-
L12- 70+ 44+ L40- L35- L30- 3-
h5+ 38+ L26- 41+ 36+ L22-
L24- L28- L30-
h6+ 9+ 12+ 10+
11+ 9+ 13+ 12+
L3- h4+ 10+ 8+ 14+ 11+ f6-
L1- L1- 12+ 9+ 11+ L2- L2-
9+ 10+ 12+ 9+ L4-
60+ 55+ 48+ 7- L3-
70+ 65+ 7-
L2- 8- 70+ 52+ 9- L2-
9+ 8+ 9+
h4+ 7+ 9+ 8+
"""


def _labelled() -> list[tuple[tuple[float, ...], bool]]:
    rows = []
    for line in _LABELLED.split("\n"):
        found, labels = [], []
        for cell in line.split():
            place, link, count, sign = re.fullmatch(r"([mfMhHg]?)(L?)(\d+)([+-])", cell).groups()
            n = int(count)
            found.append(Block("", n, n if link else 0, place in "mMH" and place != "", place in "fMg" and place != "",
                               place in "hHg" and place != ""))
            labels.append(sign == "+")
        rows += zip(features(found), labels)
    return rows


def grow(rows: list[tuple[tuple[float, ...], bool]], depth: int = 10):
    """A decision tree by Gini impurity: a leaf is a bool, a node (feature, threshold, below, above)."""
    good = sum(y for _, y in rows)
    if depth == 0 or good in (0, len(rows)):
        return 2 * good > len(rows)
    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left = [y for x, y in rows if x[f] <= cut]
            right_good, right = good - sum(left), len(rows) - len(left)
            impurity = sum(left) * (len(left) - sum(left)) / len(left) + right_good * (right - right_good) / right
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut)
    if best is None:
        return 2 * good > len(rows)
    _, f, cut = best
    return (f, cut, grow([r for r in rows if r[0][f] <= cut], depth - 1), grow([r for r in rows if r[0][f] > cut], depth - 1))


@cache
def tree():
    return grow(_labelled())


def _decide(node, x: tuple[float, ...]) -> bool:
    while not isinstance(node, bool):
        f, cut, below, above = node
        node = below if x[f] <= cut else above
    return node


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    grown = tree()
    return "\n".join(b.text for b, x in zip(found, features(found)) if _decide(grown, x))


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per input row; text is never null and n_chars its code points.

    Null and empty pages, and pages without main text, give an empty text. Whole pages are read, whatever their
    length; unclosed tags, comments and scripts end with the page. Repeated rows are extracted each; null ids and
    urls are passed on, other columns ignored.
    """
    bounded_batches(pages.sparkSession)
    source = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    ids = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {ids}, url string, text string, n_chars bigint")
