"""Main text of web pages by the line-block distribution.

Markup is stripped into lines, one per block element. Lines of menus, forms,
adverts and the like keep their place with length 0. Text lengths are summed
over a sliding window of lines; where the sum leaves 0 the text surges, where
it falls back to 0 it dives, and what lies between a surge and the next dive
is a candidate. On a page that marks its article (or main part) lines
elsewhere have length 0 and every candidate is article text; on others a
candidate needs a window of ``SURGE`` characters.
"""
from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Lines of a window, characters a window needs where no article is marked, share of link text of a menu line.
WINDOW, SURGE, LINKS = 3, 80, 0.6

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
                  r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>][^\s>]*)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_ARTICLE = re.compile(r"<(?:article|main)[\s/>]", re.I)

#: Elements whose content is raw text and no page text.
RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "object", "xmp"}
#: Elements that are never article text.
STRUCK = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "audio", "video", "canvas",
          "header"}
#: Words in class, id or role that mark such parts.
STRUCK_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "alert", "alertdialog", "author-box",
    "banner", "breadcrumb", "breadcrumbs", "byline-share", "comment", "comments", "commentlist", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "outbrain",
    "pagination", "paywall", "popup", "promo", "promotion", "reader-comments", "recommended", "related", "replies",
    "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "taboola", "tags", "toolbar", "topbar", "widget",
    # compounds, for articles, where a first or last part does not count
    "ad-container", "ad-slot", "ad-unit", "ad-wrapper", "comment-list", "comments-area", "comments-section",
    "cookie-banner", "cookie-notice", "newsletter-form", "newsletter-signup", "related-articles", "related-content",
    "related-links", "related-posts", "share-bar", "share-buttons", "share-links", "social-buttons", "social-links",
    "social-media", "social-share",
}
#: Elements that do not end a line.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_WORD = re.compile(r"[\s_]+|-+")


def _marked(rest: str) -> int:
    """Whether attributes mark a part that is no article text: 1 if it is not
    shown or a whole token of class, id or role is listed, 2 if only the first
    or last part of a token is, else 0."""
    attributes: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(rest):
        attributes.setdefault(name.lower(), a or b or c)
    if not attributes.get("hidden", "false").strip().lower().startswith(("false", "until")) \
            or attributes.get("aria-hidden", "").strip().lower() == "true" \
            or _NO_DISPLAY.search(attributes.get("style", "")):
        return 1
    grade = 0
    for name in ("class", "id", "role"):
        for value in attributes.get(name, "").lower().split():
            if value in STRUCK_WORDS:
                return 1
            words = _WORD.split(value)
            if words[0] in STRUCK_WORDS or words[-1] in STRUCK_WORDS:
                grade = 2
    return grade


def lines_of(page: str, whole: bool = False) -> tuple[list[list], bool]:
    """Lines of a page as [text, length for the distribution, in article,
    length of link text], and whether an article with text is marked. In
    articles, and everywhere if ``whole``, only whole tokens of class, id and
    role strike a part."""
    lines: list[list] = []
    text: list[str] = []
    linked = struck_depth = articles = links = 0
    struck_name, loose = "", False
    at, n = 0, len(page)

    def end() -> None:
        nonlocal linked
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                lines.append([line, 0 if struck_depth else len(line), articles > 0, linked])
        text.clear()
        linked = 0

    while at < n:
        m = _TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            text.append(page[at:stop])
            if links:
                linked += stop - at
        if not m:
            break
        at = m.end()
        if m["name"] is None:
            continue
        name, closing = m["name"].lower(), bool(m["close"])
        if name in RAW:
            if not closing and not m["rest"].endswith("/"):
                gone = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = gone.end() if gone else n
            if name not in INLINE:
                end()
            continue
        if name in INLINE:
            if name == "br":
                text.append(" ")
            elif name == "a":
                links = 0 if closing else 1
            if name not in ("span", "a", "label") or not (
                    struck_depth or _struck(name, m["rest"], closing, articles, whole)):
                if not (struck_depth and name == struck_name):
                    continue
        end()
        if struck_depth:
            if name in ("article", "main") and not closing and (
                    struck_name not in ("article", "main", "div", "section") or loose and name == "main"):
                struck_depth, struck_name = 0, ""      # an open menu cannot hold the article
            elif name == struck_name:
                struck_depth += -1 if closing else 1
                if not struck_depth:
                    struck_name = ""
                continue
            else:
                if name == "body" and struck_name == "head":
                    struck_depth, struck_name = 0, ""
                continue
        if name in ("article", "main"):
            articles = max(0, articles + (-1 if closing else 1))
        elif not closing and name not in VOID and not m["rest"].endswith("/") \
                and (grade := _struck(name, m["rest"], closing, articles, whole)):
            struck_depth, struck_name, loose = 1, name, grade == 2
    end()
    return lines, any(x[1] and x[2] for x in lines)


def _struck(name: str, rest: str, closing: bool, articles: int, whole: bool) -> int:
    """0, or 1 or 2 as ``_marked`` says."""
    if closing or name == "header" and articles:
        return 0
    if name in STRUCK:
        return 1
    grade = _marked(rest) if rest and name not in ("body", "html", "h1") else 0
    return 0 if grade == 2 and (articles or whole) else grade


def _candidates(lines: list[list], marked: bool) -> tuple[list[str], list[str]]:
    """Lines of all candidates, and of the longest that is no candidate for its length only."""
    length = [(x[1] if x[2] or not marked else 0) if marked or x[3] < LINKS * len(x[0]) else 0 for x in lines]
    n, need = len(length), 1 if marked else SURGE
    window = [sum(length[max(0, i - WINDOW + 1):i + 1]) for i in range(n)]
    out: list[str] = []
    best: list[str] = []
    i = 0
    while i < n:
        if not window[i]:
            i += 1
            continue
        surge = i                                    # the sum leaves 0
        while i < n and window[i]:
            i += 1                                   # until it dives
        part = [lines[k][0] for k in range(surge, i) if length[k]]
        if max(window[surge:i]) >= need:
            out += part
        elif sum(map(len, part)) > sum(map(len, best)):
            best = part
    return out, best


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by an empty line."""
    page = page or ""
    out, best = _candidates(*lines_of(page))
    if not out and _ARTICLE.search(page):            # its article may lie in a part struck for half a class name
        lines, marked = lines_of(page, whole=True)
        if marked:
            out, _ = _candidates(lines, marked)
    return "\n\n".join(out or best)


def _run(batches):
    for batch in batches:
        pages = batch.column("_llm_html")
        found = [main_text(x.as_py()) for x in pages]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_llm_id"), batch.column("_llm_url"), pa.array(found, pa.string()),
             pa.array([len(x) for x in found], pa.int64())], names=["_llm_id", "_llm_url", "text", "n_chars"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """id, url, ``text`` (empty if there is none) and ``n_chars`` of every row.

    Null or empty html gives an empty text; null ids and urls stay null; every
    row gives one row, repeated ones too; an empty table gives an empty table.
    Other columns are not read."""
    slim = pages.select(F.col(id_col).alias("_llm_id"), F.col(url_col).alias("_llm_url"),
                        F.col(html_col).alias("_llm_html"))
    schema = StructType([slim.schema["_llm_id"], slim.schema["_llm_url"], StructField("text", StringType()),
                         StructField("n_chars", LongType())])
    return slim.mapInArrow(_run, schema).withColumnsRenamed({"_llm_id": id_col, "_llm_url": url_col})
