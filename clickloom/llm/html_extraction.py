"""Main text of web pages by line-block distribution.

Markup becomes lines: every block element's text is a line. Lines of page furniture (menus, headers, footers, side columns,
notices, adverts, forms, scripts, comments of readers) weigh nothing. The lengths of the others are summed over sliding windows of
``WINDOW`` lines; the first window that rises over a share of the highest is the surge point, the last one the dive point, and
both reach out over adjoining windows with text. The lines between them that are no furniture are the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.common import ship_code, table

WINDOW = 3
RISE = 0.1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<]*?(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")  # values are units, so that none is read as a name
_PART = re.compile(r"[a-z0-9]+")

RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")
_RAW_END = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
#: Blocks that are no lists of links, however much of them is linked.
PROSE = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "p", "blockquote", "pre", "figcaption"))
FURNITURE_TAGS = frozenset(("head", "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "object", "canvas"))
FURNITURE_NAMES = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "disqus", "footer", "gdpr", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "responses", "share", "sharing",
    "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"))
#: Words that say of a piece of furniture which part of it this is.
LAYOUT = frozenset((
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "container", "content", "count", "counter",
    "form", "group", "header", "heading", "icon", "icons", "inner", "item", "items", "label", "left", "link", "links", "list", "main", "message",
    "outer", "page", "post", "posts", "right", "section", "site", "slot", "text", "title", "top", "unit", "wrap", "wrapper"))
FURNITURE_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"))
HEADERS = frozenset(("header", "masthead", "topbar"))
ROOTS = frozenset(("article", "main"))


def _whole_names(value: str) -> set[str]:
    """The listed words of names that consist of nothing else but words of layout: share-button, and not notice-period."""
    names: set[str] = set()
    for name in value.split():
        parts = {x for x in _PART.findall(name) if not x.isdigit()}
        if name in HEADERS:
            names.add(name)
        elif parts <= FURNITURE_NAMES | LAYOUT:
            names |= parts & FURNITURE_NAMES
    return names


def _is_furniture(tag: str, rest: str, inside_root: bool) -> bool:
    """Whether an element is no part of an article. Headers are, inside one; the page and the article itself are never."""
    if tag in ("html", "body"):
        return False
    if tag in FURNITURE_TAGS or (tag == "header" and not inside_root):
        return True
    if not rest:
        return False
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            whole = tag not in BLOCKS or tag in PROSE or tag == "section" and name == "id"
            parts = _whole_names(value) if whole else set(_PART.findall(value))
            if parts & FURNITURE_NAMES and not (tag in ROOTS and not parts & {"comment", "comments", "replies", "responses"}):
                return True
            if parts & HEADERS and not inside_root and tag not in ROOTS:
                return True
        elif name == "role" and value in FURNITURE_ROLES or name == "hidden" and "=" not in rest or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def page_lines(page: str) -> list[tuple[str, bool, bool, int]]:
    """(text, furniture, inside an article or main element, characters in links that are no prose) for every line with text, in page order."""
    lines: list[tuple[str, bool, bool, int]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, furniture, inside root
    words: list[str] = []
    state = {"linked": 0, "link": 0}

    def take(text: str) -> None:
        if text:
            text = html.unescape(text)
            words.append(text)
            if state["link"]:
                state["linked"] += len(text.strip())

    def end_line() -> None:
        text = " ".join("".join(words).split())
        if text:
            top = stack[-1] if stack else ("", False, False)
            lines.append((text, top[1], top[2], 0 if top[0] in PROSE else state["linked"]))
        words.clear()
        state["linked"] = 0

    at = 0
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            take(page[at:])
            break
        take(page[at:found.start()])
        at = found.end()
        if found["tag"] is None:
            continue
        tag = found["tag"].lower()
        if tag == "br":
            words.append(" ")
            continue
        if tag == "a":
            state["link"] = 0 if found["close"] else 1
        if tag in RAW and not found["close"]:
            stop = _RAW_END[tag].search(page, at)  # on the page itself: lower case may be longer
            at = stop.start() if stop else len(page)
            words.append(" ")
            continue
        block = tag in BLOCKS
        if found["close"]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if block or depth is not None and stack[depth][1]:
                end_line()
            if depth is not None:
                del stack[depth:]
            continue
        if tag in VOID or found["rest"].endswith("/"):
            if block:
                end_line()
            continue
        outer = stack[-1] if stack else ("", False, False)
        if block:
            end_line()
            if outer[0] == "p" or outer[0] == tag == "li":  # closed by what follows
                stack.pop()
                outer = stack[-1] if stack else ("", False, False)
        furniture = outer[1] or _is_furniture(tag, found["rest"], outer[2])
        if block or furniture and not outer[1]:
            if not block:
                end_line()
            stack.append((tag, furniture, outer[2] or tag in ROOTS))
    end_line()
    return lines


def main_text(page: str | None) -> str:
    """The article's blocks, one per line. Empty if the page is null or has none."""
    if not page:
        return ""
    lines = page_lines(page)
    rooted = any(root and not furniture for _, furniture, root, _ in lines)
    # known furniture leaves no gap: windows decide only about lines of unknown kind
    shown = [(text, rooted or 2 * linked <= len(text)) for text, furniture, root, linked in lines if not furniture and (root or not rooted)]
    lengths = np.array([len(text) if weighs else 0 for text, weighs in shown])
    if not lengths.any():
        return ""
    sums = np.convolve(lengths, np.ones(WINDOW, int))  # window k covers the lines k - WINDOW + 1 to k
    high = np.flatnonzero(sums >= RISE * sums.max())
    surge, dive = int(high[0]), int(high[-1])
    while surge > 0 and sums[surge - 1]:
        surge -= 1
    while dive + 1 < len(sums) and sums[dive + 1]:
        dive += 1
    between = np.flatnonzero(lengths)
    between = between[(between >= surge - WINDOW + 1) & (between <= dive)]
    return "\n".join(text for text, _ in shown[between[0]:between[-1] + 1])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page. Each page is read alone: copies, ties, null ids and other columns do not matter."""
    ship_code(pages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
            ], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(read, "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark, sf_dir) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
