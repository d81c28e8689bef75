"""Main text of HTML pages by the distribution of text over lines.

Markup is stripped to a list of lines, one for each block of the page. A line's weight is its text outside links; lines
of menus, forms, notices and the like weigh nothing. Weights are summed over sliding windows of lines: a region surges
where a window's sum rises above a threshold and dives where no weight follows within a window; the text between is
kept. This decides on every page. Where the page marks its article and the marked lines hold at least half of its text
outside links, the mark moves weights by one threshold: up for marked lines, down for all others.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW_LINES = 3
SURGE_CHARS = 86

# Elements of HTML by what they do to text.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "noembed", "noframes", "xmp"}
HIDDEN = {"head", "nav", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "object", "audio", "video", "canvas", "map", "label", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_PARAGRAPH = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
# Words in class, id, role and label names that mark what is not the article, and what is.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|banner\w*|breadcrumbs?|captcha|combx|comments?|comment(?:list|section|area|form)?|contentinfo|cookies?|consent|disqus|disclaimer|footer|foot|gdpr|header|masthead|login|menu\w*|modal|nav|navbar|navigation|newsletter|notice|notification|outbrain|pager|pagination|popup|promo\w*|related|recommend\w*|replies|reply|respond|search|share|sharing|shoutbox|sidebar|side-bar|signup|skip|social|sponsor\w*|subscribe|taboola|tags|toolbar|topbar|widget|alert|complementary)(?:$|[\s_-])",
    re.I,
)
# Inside an article a compound name marks noise only if all its words do, but for words that say nothing of the content.
FIRM_NOISE = re.compile(r"ads?|advert\w*|adsense|adslot|comments?|comment(?:list|section|area|form)|disqus|outbrain|replies|shoutbox|sponsor\w*|taboola", re.I)
NEUTRAL = re.compile(r"area|article|articles|bar|block|bottom|box|button|buttons|center|container|entry|group|icons|inline|inner|item|items|left|links?|list|main|outer|page|panel|post|posts|right|row|section|side|signup|site|slot|stories|the|this|tools|top|unit|wrap|wrapper|\d*", re.I)
ARTICLE = re.compile(r"(?:^|[\s_-])(?:article(?:-?body|-?content|-?text)?|post-?(?:body|content|text)|entry-?content|story-?(?:body|content)|main-?(?:content|text))(?:$|[\s_])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|aria-label|itemprop|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Line:
    text: str
    weight: int
    inside: bool
    noise: bool


@dataclass
class Element:
    name: str
    noise: bool
    inside: bool
    link: bool


def _names_noise(value: str, inside: bool, whole: bool) -> bool:
    """Whether a class, id or role (each of its names by itself) or a label (as a whole) tells what is not the article."""
    if not inside or not NOISE.search(value):
        return bool(NOISE.search(value))
    for name in [value] if whole else value.split():
        words = re.split(r"[\s_-]+", name)
        noisy = [w for w in words if NOISE.search(w) and w.lower() != "header"] or (["header"] if len(words) > 1 and words[0].lower() in ("site", "page", "top") else [])
        if NOISE.fullmatch(name) and noisy or any(map(FIRM_NOISE.fullmatch, words)):
            return True
        if noisy and all(w in noisy or w.lower() == "header" or NEUTRAL.fullmatch(w) for w in words):
            return True
    return False


def _marks(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """(is not the article, is the article) for an element's own name and attributes."""
    noise, article = name in HIDDEN or (name == "header" and not inside), name in ("article", "main")
    if attributes:
        for found in ATTRIBUTE.finditer(attributes):
            key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and UNSEEN.search(value)):
                noise = True
            elif key == "itemprop":
                article |= value.lower() == "articlebody"
            elif key in ("class", "id", "role", "aria-label"):
                article |= key != "aria-label" and bool(ARTICLE.search(value)) or (key == "role" and value.lower() in ("main", "article"))
                noise |= name not in ("html", "body", "article", "main") and _names_noise(value, inside, key == "aria-label")
    return noise, article and not noise


def page_lines(page: str) -> list[Line]:
    """The page's blocks in order, with the length of their text outside links and where they stand."""
    lines: list[Line] = []
    stack: list[Element] = [Element("", False, False, False)]
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            top = stack[-1]
            lines.append(Line(text, 0 if top.noise else max(0, len(text) - linked), top.inside, top.noise))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    def close(name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name == name:
                del stack[k:]
                return

    at = 0
    while found := TOKEN.search(page, at):
        add(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if found[1]:
            if name not in INLINE or name == "a":
                if name not in INLINE:
                    flush()
                close(name)
            continue
        if name in RAW:
            flush() if name not in INLINE else None
            end = re.compile(f"</{name}\\b[^>]*>|$", re.I).search(page, at) if not found[3].endswith("/") else None
            at = end.end() if end else at
            continue
        if name == "br":
            add(" ")
            continue
        if name in INLINE and name != "a" and not found[3]:
            continue
        if name not in INLINE:
            flush()
            if name in ENDS_PARAGRAPH and any(e.name == "p" for e in stack):
                close("p")
            for other in CLOSES_ITSELF.get(name, ()):
                if stack[-1].name == other:
                    stack.pop()
        if name in VOID or found[3].endswith("/"):
            continue
        top = stack[-1]
        noise, article = _marks(name, found[3], top.inside)
        if name == "a" or name not in INLINE or noise:
            if name in INLINE and noise and not top.noise:
                flush()
            stack.append(Element(name, top.noise or noise, (top.inside or article) and not noise, top.link or name == "a"))
    add(page[at:].partition("<")[0] if re.match(r"[^<]*<[a-zA-Z/!][^>]*$", page[at:], re.S) else page[at:])
    flush()
    return lines


def regions(weights: list[int], window: int = WINDOW_LINES, surge: int = SURGE_CHARS) -> list[tuple[int, int]]:
    """(first, last) of each run of lines from a surge to the dive after it."""
    n = len(weights)
    sums = [sum(weights[i : i + window]) for i in range(n)]
    found, i = [], 0
    while i < n:
        if sums[i] < surge or not weights[i]:
            i += 1
            continue
        last = i
        while (ahead := next((j for j in range(last + 1, min(n, last + window + 1)) if weights[j]), None)) is not None:
            last = ahead
        found.append((i, last))
        i = last + 1
    return found


def line_weights(lines: list[Line], surge: int = SURGE_CHARS) -> list[int]:
    """The lines' weights, moved by a mark that can be trusted.

    A page's marks are trusted together if their lines hold at least half of the text outside links: teasers do not.
    Then a marked line weighs surge more, so that no line of the article is too short to count, and any other line surge
    less, so that only text as long as a surge counts there.
    """
    marked = sum(x.weight for x in lines if x.inside)
    if not any(x.inside and not x.noise for x in lines) or 2 * marked < sum(x.weight for x in lines):
        return [x.weight for x in lines]
    return [0 if x.noise else x.weight + surge if x.inside else max(0, x.weight - surge) for x in lines]


def main_text(page: str | None) -> str:
    """The article's blocks, one a line; empty for null, empty and textless pages.

    The surging regions without their noise; if no window surges, all lines that are not noise.
    """
    lines = page_lines(page) if page else []
    found = regions(line_weights(lines)) or [(0, len(lines) - 1)]
    return "\n".join(x.text for a, b in found for x in lines[a : b + 1] if not x.noise)


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every row, from the whole page. Repeated rows stay; an empty table gives none."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return source.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
