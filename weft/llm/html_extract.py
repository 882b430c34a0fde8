"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines (one per block element); each line's weight is the length of its text.
Weights are summed over sliding windows of lines; text starts where the sum surges and ends where it
dives, and all lines between the two are kept, short ones too. Markup is a prior: elements and class
words of boilerplate (menus, headers, footers, asides, forms, adverts, notices, comments, link lists)
take a line's weight, unless nearly all text of the page is in boxes of such classes; lines of an
article weigh more, and those outside one nothing, unless most text is outside.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import text_or_empty

# HTML element names.
RAW = {"script", "style", "template", "noscript", "iframe", "textarea", "title", "svg", "canvas", "object", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILER = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# Words in class, id or role that mark boilerplate.
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "contentinfo", "complementary", "alert", "alertdialog"}
# Words that say no more than that something is a part of a page.
PLAIN = {"area", "bar", "block", "bottom", "box", "button", "buttons", "column", "container", "content", "form", "group", "head", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "module", "outer", "page", "panel", "post", "posts", "right", "row", "section", "site", "slot", "title", "top", "unit", "wrap", "wrapper"}
#: Elements that a missing end tag doesn't keep open past the start of another.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: Elements of running text, and those that don't make a box of their own for it.
PROSE = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dt", "dd"}
LISTS = {"ul", "ol", "dl", "li", "dd", "blockquote"}
#: Characters in a window of lines from which text starts and below which it ends, on a page with so many.
SURGE, DIVE = 86, 43
#: Weight that a line of an article has beyond its length, so that its lists and headings are no dive.
BONUS = 43
#: An article rules out the text outside it if that is at most so many times as long; classes mark
#: boilerplate unless they mark more than so many times the other text.
OUTSIDE, MARKED = 2, 16

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORDS = re.compile(r"[^a-z0-9]+")
SPACE = re.compile(r"\s+")


def marked(attrs: str) -> bool:
    """Whether a name in class, id or role says boilerplate: it has a word that marks it, and no word of another meaning."""
    if not attrs or attrs.isspace():
        return False
    for m in ATTR.finditer(attrs):
        value = next(x for x in m.groups() if x is not None)
        for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
            words = [w for w in WORDS.split(name) if w]
            if any(w in MARKS for w in words) and all(w in MARKS or w in PLAIN or w.isdigit() for w in words):
                return True
    return False


class Line(NamedTuple):
    text: str
    hard: bool  # boilerplate by element, or hidden
    soft: bool  # boilerplate by class words, or links only outside an article
    article: bool
    name: str  # element
    box: int  # what holds the element, lists aside


def lines_of(page: str) -> list[Line]:
    out: list[Line] = []
    stack: list[tuple[str, bool, bool, bool, int]] = []  # name, boilerplate by element, by class, article, number
    parts: list[str] = []
    state = [False, False, False]
    plain = in_link = False  # whether the line has text outside links; whether a link is open
    opened = 0

    def end_line():
        nonlocal plain
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                held = [x for x in stack if x[0] in BLOCK]
                name = held.pop()[0] if held else ""
                while held and held[-1][0] in LISTS:
                    held.pop()
                out.append(Line(text, state[0], state[1] or not (plain or state[2]), state[2], name, held[-1][4] if held else 0))
            parts.clear()
        plain = False

    def text_part(part):
        nonlocal plain
        parts.append(part)
        plain = plain or not in_link and not part.isspace()

    def settle():
        for k in range(3):
            state[k] = any(x[k + 1] for x in stack)

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            text_part(page[at:])
            break
        if m.start() > at:
            text_part(page[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            in_link = not m.group(1)
        if m.group(1):
            if name in BLOCK:
                end_line()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    settle()
                    break
                # An end tag of something outside doesn't close an article or boilerplate box.
                if name not in BLOCK and stack[k][0] in BLOCK:
                    break
            continue
        if name in RAW and not m.group(3).rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else n
            parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            end_line()
            if name in CLOSES and stack and stack[-1][0] in CLOSES[name]:
                stack.pop()
                settle()
        if name in VOID or m.group(3).rstrip().endswith("/") and name not in BLOCK:
            continue
        article = name in ("article", "main")
        # An article's own header holds its title; the boxes of comments and adverts in it are boilerplate.
        hard = name in BOILER and not (name == "header" and state[2])
        soft = False
        if name not in ("html", "body", "article", "main"):
            soft = marked(m.group(3))
            hard = hard or bool(HIDDEN.search(m.group(3)))
        if hard or soft or article or name in BLOCK:
            if name == "p" and any(x[0] == "p" for x in stack):
                while stack and stack[-1][0] == "p":
                    stack.pop()
            opened += 1
            stack.append((name, hard, soft, article, opened))
            settle()
    end_line()
    return out


def surges(weights: list[int], window: int, least: int, dive: int = 1) -> list[tuple[int, int]]:
    """Stretches [a, b) of lines between a surge and a dive of the windowed sums of weights.

    A sum covers a line and the ``window - 1`` lines after it. A stretch holds a sum of ``least`` or
    more, and reaches both ways as far as sums are ``dive`` or more; lines without weight at either
    end of it are cut off.
    """
    n = len(weights)
    sums, run = [0] * n, 0
    for i in range(n - 1, -1, -1):
        run += weights[i] - (weights[i + window] if i + window < n else 0)
        sums[i] = run
    out, i = [], 0
    while i < n:
        if sums[i] < least:
            i += 1
            continue
        a = b = i
        while b < n and sums[b] >= dive:
            b += 1
        i = b + 1
        while a > 0 and sums[a - 1] >= dive:
            a -= 1
        while a < b and weights[a] == 0:
            a += 1
        while b > a and weights[b - 1] == 0:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def weigh(lines: list[Line]) -> list[int]:
    """Each line's weight: its length, by the priors that markup gives."""
    sure = sum(len(x.text) for x in lines if not (x.hard or x.soft))
    doubtful = sum(len(x.text) for x in lines if x.soft and not x.hard)
    by_class = doubtful <= MARKED * sure
    weights = [0 if x.hard or x.soft and by_class else len(x.text) for x in lines]
    inside = sum(w for w, x in zip(weights, lines, strict=True) if x.article)
    if inside and sum(weights) - inside <= OUTSIDE * inside:
        return [w + BONUS if w and x.article else 0 for w, x in zip(weights, lines, strict=True)]
    return weights


def settled(lines: list[Line], weights: list[int], a: int, b: int, window: int, dive: int) -> tuple[int, int]:
    """A stretch with exact ends.

    Windows blur them by ``window - 1`` lines: short lines there belong to the text if they are
    running text in the box of its first or last long line, or its title.
    """
    long = [i for i in range(a, b) if weights[i] >= dive]
    if not long:
        return a, b

    def belongs(i, to):
        return lines[i].name in PROSE and lines[i].box == lines[to].box

    while a < long[0] and not (weights[a] and (belongs(a, long[0]) or lines[a].name == "h1")):
        a += 1
    b = max(long[-1] + 1, next((i + 1 for i in range(b - 1, long[-1], -1) if weights[i] and belongs(i, long[-1])), 0))
    end = min(len(lines), b + window - 1)
    while b < end and weights[b] and belongs(b, long[-1]):
        b += 1
    return a, b


def main_text(page: str | None, window: int = 3, least: int = SURGE, dive: int = DIVE) -> str:
    """The main text: lines joined by one newline; empty for a null or empty page.

    On a page with no window of twice ``least`` characters the surge is half of its fullest window,
    and the dive falls with it.
    """
    if not page:
        return ""
    lines = lines_of(page)
    weights = weigh(lines)
    fullest = max((sum(weights[i : i + window]) for i in range(len(weights))), default=0)
    surge = max(1, min(least, fullest // 2))
    dive = max(1, min(dive, dive * surge // max(1, least)))
    kept: list[tuple[int, int]] = []
    for a, b in surges(weights, window, surge, dive):
        a, b = settled(lines, weights, a, b, window, dive)
        # Short running text in the box of the text before and after it is no end of either.
        if kept and all(not weights[i] or lines[i].name in PROSE and lines[i].box == lines[a].box for i in range(kept[-1][1] - 1, a)):
            a = kept.pop()[0]
        kept.append((a, b))
    return "\n".join(lines[i].text for a, b in kept for i in range(a, b) if weights[i])


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = 3, least: int = SURGE, dive: int = DIVE) -> DataFrame:
    """Main text of every row: id, url, text (empty if none), n_chars (code points).

    A null or empty page has an empty text; null ids and URLs pass through; repeated rows give
    repeated results; an empty table an empty one. Only the three named columns are read. Whole pages
    are processed, a row at a time; memory is bound by a batch of rows.
    """
    src = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))

    def run(batches):
        for b in batches:
            texts = [main_text(x, window, least, dive) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
