"""Main text of web pages by the line-block distribution.

Markup is stripped block by block: each block of text is a line with its length, the part of it in links, and
whether it stands in an article. Lengths are summed over a sliding window of lines. Where the sum surges the
main text begins, where it dives it ends; everything between is kept.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillcast.llm.common import add_columns

#: Lines of a window; a window's length that counts as a surge.
WINDOW = 3
SURGE_CHARS = 80
#: What a character inside article or main weighs: each such line surges by itself.
ARTICLE_WEIGHT = SURGE_CHARS

# Elements by their role in a page, and words in class, id or role that mark what is no article.
SILENT = "script style template noscript iframe object svg math textarea select head title canvas audio video"
FRAME = "nav footer aside form button menu dialog header"
BLOCKS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
)
VOID = "area base br col embed hr img input link meta param source track wbr"
MARKS = (
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs byline-share comment comments commentlist consent "
    "contentinfo cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices overlay pager pagination paywall popup promo promoted promotion recommended related replies reply search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget complementary alert"
)
ARTICLE_MARKS = "ad ads advert comment comments promo promoted related recommended reply replies sponsor sponsored teaser widget"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(" + "|".join(("script", "style", "textarea", "title")) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)>|[^<]+|<",
    re.S | re.I,
)
_MARKED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+")

_SILENT, _FRAME, _BLOCKS, _VOID = set(SILENT.split()), set(FRAME.split()), set(BLOCKS.split()), set(VOID.split())
_MARKS, _ARTICLE_MARKS = set(MARKS.split()), set(ARTICLE_MARKS.split())


def _left_out(name: str, attributes: str, in_article: int, by_marks: bool) -> bool:
    if name in _SILENT:
        return True
    if name in _FRAME and not (name == "header" and in_article):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    if not by_marks:
        return False
    marks = _ARTICLE_MARKS if name == "article" or in_article else _MARKS
    return any(
        not marks.isdisjoint(_PARTS.findall((m[2] or m[3] or m[4] or "").lower())) for m in _MARKED.finditer(attributes)
    )


def page_lines(page: str, by_marks: bool = True) -> list[tuple[str, int, bool]]:
    """(text, characters in links, inside an article) of each block, in page order."""
    lines: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked: list[str] = []
    in_link = in_article = depth = 0
    gone = ""

    def close() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                lines.append((line, len(" ".join("".join(linked).split())), in_article > 0))
            text.clear()
            linked.clear()

    for m in _TOKEN.finditer(page):
        token = m[0]
        name = m[3] or m[6]
        if not name:
            if not gone and (token[0] != "<" or token == "<"):
                part = unescape(token) if "&" in token else token
                text.append(part)
                if in_link:
                    linked.append(part)
            elif token[0] == "<" and not gone:
                text.append(" ")
            continue
        name, ends = name.lower(), bool(m[2] or m[5])
        attributes = m[4] or m[7] or ""
        if gone:
            if name == gone:
                depth += -1 if ends else not attributes.endswith("/")
            if depth == 0 or name in ("article", "main") and not ends and gone not in ("article", "main") or name in ("body", "html"):
                unclosed, gone = depth > 0, ""
                if not unclosed:
                    continue
            else:
                continue
        if name in _BLOCKS:
            close()
        elif name == "br":
            text.append(" ")
        if ends:
            if name == "a":
                in_link = 0
            elif name in ("article", "main"):
                in_article = max(0, in_article - 1)
            continue
        if name in _VOID or attributes.endswith("/"):
            continue
        if _left_out(name, attributes, in_article, by_marks):
            if name in _BLOCKS:
                close()
            gone, depth = name, 1
            continue
        if name == "a":
            in_link = 1
        elif name in ("article", "main"):
            in_article += 1
    close()
    return lines


def main_text(page: str | None) -> str:
    """The kept blocks, one a line; empty if there is none."""
    if not page:
        return ""
    lines = page_lines(page) or page_lines(page, by_marks=False)
    if not lines:
        return ""
    # links weigh against a line outside an article: a menu is all links
    kept = _surge_to_dive(np.array([ARTICLE_WEIGHT * len(x[0]) if x[2] else max(0, len(x[0]) - 2 * x[1]) for x in lines]))
    return "\n".join(x[0] for x, own in zip(lines, kept) if own)


def _window_sums(size: np.ndarray) -> np.ndarray:
    """Total length of the window around each line."""
    half = WINDOW // 2
    total = np.concatenate((np.zeros(half + 1, int), size, np.zeros(half, int))).cumsum()
    return total[WINDOW:] - total[:-WINDOW]


def _surge_to_dive(size: np.ndarray) -> np.ndarray:
    """Whether each line is kept: those of every stretch whose window sums stay high, and what has text between them.

    A window sum belongs to its middle line; lines without own text are trimmed from both ends of a stretch. The
    limit does not depend on the longest lines; a page whose sums are all below it has its highest sum as limit.
    """
    sums = _window_sums(size)
    kept = np.zeros(len(size), bool)
    high = sums >= max(1, min(SURGE_CHARS, int(sums.max())))
    for first, last in np.flatnonzero(np.diff(np.concatenate(([0], high.astype(np.int8), [0])))).reshape(-1, 2).tolist():
        full = np.flatnonzero(size[first:last])
        if len(full):
            kept[first + full[0]:first + full[-1] + 1] = True
    ends = np.flatnonzero(kept)
    if len(ends):
        kept[ends[0]:ends[-1]] |= size[ends[0]:ends[-1]] > 0
    return kept


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with text (empty if there is none) and n_chars (its code points).

    A null or empty page has an empty text. New columns replace clashing ones.
    """

    def run(htmls):
        texts = [main_text(h) for h in htmls]
        return texts, list(map(len, texts))

    return add_columns(pages, column, lambda: run, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
