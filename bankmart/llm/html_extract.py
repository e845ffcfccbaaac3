"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element.  A line's weight is the
length of its text.  What stands in elements that the language has for menus,
headers, footers, sidebars, adverts and forms (by tag or role) weighs nothing.
Class names and ids only hint at such parts: a container with such a name
weighs nothing unless it holds more than half of the page's text or of its
articles, as wrappers of a page do (comments may be longer than what they
comment on: their names count at any size); paragraphs and headings go by their names only
where those say advert.  Lines outside a marked article (``<article>``,
``<main>``) weigh nothing if they are mostly links, and ``OUTSIDE`` of their
length if the page has one.
Weights are summed over sliding windows of ``WINDOW`` lines, apart inside and
outside of articles; what is set aside inside an article does not part it.
Text surges where a window rises from nothing and dives where it falls back
to nothing.  On every page the weighted lines between a surge and its dive
are kept if their fullest window reaches the page's level: ``SHARE`` of the
window in which the page's median character stands, ``ENOUGH`` at most, so
that one long paragraph does not raise it.  So a single short paragraph between
lists of links goes, as the method has it.

Defined results: null or empty html gives an empty text; unclosed and cut off
tags end with the page, and a quote opens a value only where a value may begin;
windows of equal sums are treated alike; very long and deeply nested pages take
time in proportion; ids and urls pass through, null or repeated; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import ship

WINDOW = 3
SHARE = 0.3
ENOUGH = 80
LINKS = 0.6
OUTSIDE = 0.5

_VALUE = r"""\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|={_VALUE})*+)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s/>=]+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "title", "head", "object",
        "canvas", "audio", "video"}
_ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "header"}
_VOID = {"br", "img", "hr", "meta", "link", "input", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
           "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
           "u", "var", "wbr", "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot",
           "mover", "munder", "munderover", "mspace", "mstyle", "semantics"}
_MAIN = {"article", "main"}
#: Elements of text alone: their names say little about the page's parts.
_LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "dt", "dd", "td", "th", "caption"}
_ADVERT = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "sponsors", "promo", "promotion"}
_PARTS = _ADVERT | {
    "banner", "sidebar", "aside", "comment", "comments", "respond", "reply", "replies", "disqus", "cookie", "cookies", "consent", "notice",
    "notices", "alert", "alerts", "notification", "notifications", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "breadcrumb", "breadcrumbs", "menu", "nav",
    "navbar", "navigation", "topbar", "toolbar", "masthead", "footer", "header", "pagination", "pager", "widget", "widgets", "skip"}
_COMMENTS = {"comment", "comments", "respond", "reply", "replies", "disqus"}
#: What may stand beside them in a name that means the part alone.
_BESIDE = {
    "area", "article", "articles", "bar", "block", "bottom", "box", "button", "buttons", "col", "column", "container", "content", "desktop",
    "entry", "form", "global", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "outer", "page", "panel",
    "post", "posts", "primary", "reader", "right", "row", "secondary", "section", "site", "slot", "stories", "story", "text", "thread", "top",
    "user", "wrap", "wrapper"}
#: Headers of the text itself.
_OWN_HEADER = {"article", "content", "entry", "post", "story", "text"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def _parts_named(value: str, parts: set[str]) -> set[str]:
    """The parts of a page that a class or id is the name of, and of nothing else."""
    found: set[str] = set()
    for token in value.split():
        words = [w.lower() for w in _WORDS.findall(token) if not w.isdigit()]
        named = [w for w in words if w in parts]
        if named and all(w in parts or w in _BESIDE for w in words) and not (named == ["header"] and _OWN_HEADER & set(words)):
            found.update(named)
    return found


def _hints(name: str, attrs: str) -> tuple[bool, bool | None]:
    """Whether an element's attributes set it aside for sure; whether its names do at
    any size, or if it is no wrapper (False), or not at all (None)."""
    named: set[str] = set()
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in _ROLES:
            return True, None
        if key in ("class", "id"):
            named |= _parts_named(value, _ADVERT if name in _LEAF else _PARTS)
    return False, bool(named & _COMMENTS) if named else None


def lines_of(page: str) -> list[tuple[str, bool, bool, float]]:
    """Lines of a page: text, set aside, inside a marked article, share of links."""
    lines: list[list] = []
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool, tuple | None]] = []  # open blocks: name, set aside, article, first line and share if only named so
    opened: dict[str, int] = {}  # how many of each are open
    out_n = main_n = in_link = 0
    named: list[tuple[int, int, bool]] = []  # lines of containers that only their names set aside; whether at any size

    def end_line() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                lines.append([text, out_n > 0, main_n > 0, min(1.0, linked / len(text))])
            parts.clear()
        linked = 0

    def close() -> str:
        nonlocal out_n, main_n
        name, out, main, hint = stack.pop()
        opened[name] -= 1
        out_n, main_n = out_n - out, main_n - main
        if hint is not None and hint[0] < len(lines):
            named.append((hint[0], len(lines), hint[1]))
        return name

    at = 0
    while True:
        m = _TAG.search(page, at)
        if (text := page[at:m.start() if m else len(page)]):
            parts.append(text)
            if in_link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in _RAW and not closing and not m[3].endswith("/"):
            end_line()
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if name == "head":  # a page may leave its end out
                end = re.compile(r"</head\b[^>]*>|(?=<body\b)", re.I).search(page, at)
                at = end.end() if end else at
            else:
                at = end.end() if end else len(page)
            continue
        if name == "a":
            in_link = 0 if closing else 1
        if name in ("br", "hr"):
            parts.append(" ")
        is_open = opened.get(name, 0) > 0
        sure, by_name = (False, None) if closing else _hints(name, m[3])
        if name in _VOID or name in _INLINE and not (is_open if closing else sure or by_name is not None):
            continue
        end_line()
        if closing:
            if is_open:
                while close() != name:
                    pass
        elif not m[3].endswith("/"):
            main = name in _MAIN
            out = sure or name in _ASIDE and not (name == "header" and main_n)
            if name == "p":  # a paragraph ends the one before it
                while stack and stack[-1][0] == "p":
                    close()
            hint = None if by_name is None or out or main or name in ("html", "body") else (len(lines), by_name or main_n > 0)
            stack.append((name, out, main, hint))
            opened[name] = opened.get(name, 0) + 1
            out_n, main_n = out_n + out, main_n + main
    end_line()
    while stack:
        close()
    return [tuple(x) for x in _named_aside(lines, named)]


def _named_aside(lines: list[list], named: list[tuple[int, int, bool]]) -> list[list]:
    """Sets lines aside by the names of their containers, but for wrappers."""
    size = [0, *accumulate(0 if aside else len(text) for text, aside, _, _ in lines)]
    main = [0, *accumulate(len(text) if inside and not aside else 0 for text, aside, inside, _ in lines)]
    edge = [0] * (len(lines) + 1)
    for first, end, always in named:
        if always or 2 * (size[end] - size[first]) <= size[-1] and (not main[-1] or 2 * (main[end] - main[first]) <= main[-1]):
            edge[first] += 1
            edge[end] -= 1
    for line, depth in zip(lines, accumulate(edge), strict=False):
        line[1] = line[1] or depth > 0
    return lines


def level(weights: list[float], sums: list[float]) -> float:
    """Least of the fullest windows that are kept."""
    half, seen = sum(weights) / 2, 0.0
    for total, weight in sorted(zip(sums, weights, strict=True)):
        seen += weight
        if seen >= half:
            return min(SHARE * total, ENOUGH)
    return 0.0


def main_text(page: str | None) -> str:
    lines = [x for x in lines_of(page or "") if not (x[1] and x[2])]
    marked = any(inside for _, _, inside, _ in lines)
    weights = [0 if aside or not inside and links > LINKS else len(text) * (OUTSIDE if marked and not inside else 1)
               for text, aside, inside, links in lines]
    sums: list[float] = []
    edges: set[int] = set()  # where an article begins or ends
    for _, part in groupby(range(len(lines)), lambda i: lines[i][2]):
        at = list(part)
        edges.add(at[0])
        sums += [sum(weights[max(at[0], i - WINDOW // 2):min(at[-1], i + WINDOW // 2) + 1]) for i in at]
    least = level(weights, sums)
    kept: list[str] = []
    surge = None
    for i, total in enumerate([*sums, 0]):
        if surge is not None and (not total or i in edges):  # the dive
            if max(sums[surge:i]) >= least:
                kept += [lines[j][0] for j in range(surge, i) if weights[j]]
            surge = None
        if total and surge is None:
            surge = i
    return "\n\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        text = pa.array([main_text(x.as_py()) for x in got.column(2)], pa.string())
        yield pa.RecordBatch.from_arrays([got.column(0), got.column(1), text], names=["page_id", "url", "text"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and main text of every page; local to the scan's partitions."""
    ship(pages.sparkSession)
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return slim.mapInArrow(_extract, "page_id long, url string, text string")
