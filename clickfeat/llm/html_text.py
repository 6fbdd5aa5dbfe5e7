"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped so that every block element is a line. Elements that are never article text by
their name, role or class (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
comments) leave their lines without weight. Where a page marks its article, and that holds the main
share of the text, the article's lines are the main text. On other pages text lengths without links
are summed over a sliding window of lines: where the sum first surges the main text begins, where it
dives after its last surge it ends, and all weighted lines between are kept, except lines of links
at the ends. A surge is relative to the page: a share of the window sum around its median character,
so that short pages stay whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import query, table

#: Lines in a window; the share of a page's typical window that makes a surge, and the most it asks for.
WINDOW = 3
SURGE = 0.1
SURGE_CHARS = 80

#: Content that is not markup: it ends at its own end tag only.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math",
       "object", "xmp", "noembed", "noframes")
#: Elements without article text.
ASIDE = frozenset(
    "nav header footer aside form button select option menu dialog fieldset label head".split()
)
#: Elements that may stand in a head; any other ends one that is still open.
METADATA = frozenset("base basefont bgsound head link meta".split()) | set(RAW[:4]) | {"title", "noframes"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr img input embed".split()
)
#: Words of a class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments commentlist cookie cookies consent disqus footer gdpr header masthead menu nav navbar"
    " navigation newsletter notice popup promo promoted promotion related respond responses replies"
    " share sharing sidebar signup social sponsor sponsored subscribe toolbar widget contentinfo"
    " complementary search modal overlay skyscraper pagination pager".split()
)

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    # A tag with a quote that is never closed ends at the next bracket.
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.S | re.I,
)
#: An attribute: its name and, with a value, the value in one of three forms.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
_WORD = re.compile(r"[^\W_]")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARTS = re.compile(r"[^a-z0-9]+")
#: A class of these says what else is on the page, not what the element is.
_WITH = re.compile(r"(?:has|with|no|without|is|wp)[-_]")
#: An article element of these words is a reader's comment.
_REPLIES = frozenset("comment comments response responses reply replies disqus".split())
#: Elements whose start ends an open paragraph; an end tag without its start does nothing.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)


def _is_aside(name: str, rest: str, in_article: bool) -> bool:
    if name in ASIDE and not (in_article and name == "header"):  # an article's own headline
        return True
    if not rest or name in ("html", "body", "main"):
        return False
    marks = _REPLIES if name == "article" else MARKS
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if (
            key == "hidden"
            or (key == "aria-hidden" and value.strip().lower() == "true")
            or (key == "style" and _NO_DISPLAY.search(value))
        ):
            return True
        if key not in ("class", "id", "role"):
            continue
        for word in value.lower().split():
            parts = set(_PARTS.split(word)) - ({"header"} if in_article else set())
            if not _WITH.match(word) and not marks.isdisjoint(parts):
                return True
    return False


def lines(html: str) -> list[tuple[str, bool, bool, int, bool]]:
    """Lines of a page in order: text, whether inside an article or main element, whether aside,
    the characters outside links (none if those have no word; a heading's links count as text), and
    whether a heading."""
    found: list[tuple[str, bool, bool, int, bool]] = []
    text: list[str] = []
    #: Text outside links; a link ends with its line at the latest.
    plain: list[str] = []
    link = linked = False
    #: Open elements: name, whether aside, whether article.
    stack: list[tuple[str, bool, bool]] = []
    aside = article = 0

    def add(part: str) -> None:
        nonlocal linked
        text.append(part)
        if link:
            linked = True
        else:
            plain.append(part)

    def flush() -> None:
        nonlocal link, linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                own = len(joined)
                heading = any(s[0] in _HEADINGS for s in stack[-4:])
                if linked and not heading:
                    outside = " ".join(unescape("".join(plain)).split())
                    own = len(outside) if _WORD.search(outside) else 0
                found.append((joined, article > 0, aside > 0, own, heading))
            text.clear()
            plain.clear()
        link = linked = False

    def close(until: int) -> None:
        nonlocal aside, article
        while len(stack) > until:
            _, was_aside, was_article = stack.pop()
            aside -= was_aside
            article -= was_article

    def close_head() -> None:
        if stack and stack[-1][0] == "head":
            flush()
            close(len(stack) - 1)

    at = 0
    for match in _TOKEN.finditer(html):
        if match.start() > at:
            if html[at : match.start()].strip():
                close_head()
            add(html[at : match.start()])
        at = match.end()
        name = match["name"] or match["name2"]
        if name is None:
            continue
        name = name.lower()
        if match["end"] or match["end2"]:
            if name not in INLINE:
                flush()
            elif name == "a":
                link = False
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break  # an inline end tag ends nothing outside its block
            continue
        if name not in INLINE:
            flush()
        if name in _ENDS_P and stack and any(s[0] == "p" for s in stack[-8:]):
            for depth in range(len(stack) - 1, max(-1, len(stack) - 9), -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
        if name not in METADATA:
            close_head()
        if name in VOID:
            continue
        rest = match["rest"] if match["name"] else match["rest2"]
        if name == "a":
            link = _HREF.search(rest) is not None
        marked = _is_aside(name, rest, article > 0)
        is_article = name in ("article", "main")
        stack.append((name, marked, is_article))
        aside += marked
        article += is_article
    if html[at:].strip():
        close_head()
    add(html[at:])
    flush()
    return found


def _settled(found: list[tuple[str, bool, bool, int, bool]]) -> bool:
    """Whether article and main elements hold the main share of the text that is not aside."""
    inside = sum(len(text) for text, article, aside, *_ in found if article and not aside)
    return inside > 0 and 2 * inside >= sum(len(text) for text, _, aside, *_ in found if not aside)


def _between(size: np.ndarray, window: int, surge: float) -> tuple[int, int]:
    """The first line of the first surge and the line after the last dive, for lines of some text."""
    sums = np.concatenate([[0], np.cumsum(np.concatenate([size, np.zeros(window - 1, int)]))])
    blocks = sums[window:] - sums[:-window]
    # The window sum in which the page's median character lies.
    order = np.argsort(blocks, kind="stable")
    total = np.cumsum(size[order])
    typical = blocks[order[np.searchsorted(total, total[-1] / 2)]]
    high = np.flatnonzero(blocks >= max(1, min(surge * typical, SURGE_CHARS)))
    first, last = int(high[0]), min(int(high[-1]) + window, len(size))
    while not size[first]:
        first += 1
    while not size[last - 1]:
        last -= 1
    return first, last


def main_lines(html: str | None, window: int = WINDOW, surge: float = SURGE) -> list[str]:
    """The lines of the marked article, or those between the first surge and the last dive."""
    found = [line for line in lines(html or "") if not line[2]]
    if _settled(found):
        return [text for text, inside, *_ in found if inside]
    size = np.array([own for *_, own, _ in found], int)
    if not size.any():  # nothing but links
        return [text for text, *_ in found]
    first, last = _between(size, window, surge)
    # A title above a few short lines, such as author and date, belongs to the text.
    first = next((i for i in range(max(0, first - window), first) if found[i][4]), first)
    return [text for text, *_ in found[first:last]]


def _extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([" ".join(main_lines(html)) for html in pages], dtype=object)


def main_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the column ``name``: the main text, its blocks joined by one space.

    Character references are decoded, white space in a block becomes one space, blocks are trimmed.
    Pages that are null, empty or without main text give the empty string. Each row is read whole and on
    its own; other columns pass unchanged, unless one is called ``name``.
    """
    extracted = F.pandas_udf(_extracted, "string").asNondeterministic()
    return pages.withColumn(name, extracted(F.col(html_col)))


@query()
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )
