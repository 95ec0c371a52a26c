"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element. A line's weight is the length of its text outside links; lines inside
elements that never hold an article (menus, forms, footers, adverts, comments and so on) weigh nothing. An element is one of
these by its tag, or where a whole name of its class, id or role says so, or if its attributes hide it; neither counts for
an element that holds all articles of the page or most of its text outside links, and names say nothing about headings. Sums over sliding
windows of lines surge where text begins and dive to nothing where it ends; the text between a surge and its dive is a
region. Regions inside an article or main element are the page's text, if they hold more than a small share of its text
outside links; else every region is that is not mostly links.

A page is scanned once from left to right, in time proportional to its length however odd its markup is.

Defined results: a null, empty or textless page has empty text and n_chars 0. Unclosed elements end with what encloses
them; an unclosed comment or script ends with the page; a `<` whose tag never ends is text. Every row of the table is one row of the result, repeated rows
too. Other columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.session import apply_settings

#: Lines that a window spans.
WINDOW = 3
#: Share of a region's text that may be links, on pages that mark no article.
LINK_SHARE = 0.5
#: Share of the page's text outside links that marked articles need, to be taken for all of it.
MARKED_SHARE = 0.2
#: Share of the page's text outside links above which an element is not judged by its names.
MOST_SHARE = 0.5

#: Fixed values of HTML: elements that begin a new line.
BLOCKS = frozenset(
    (
        "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
        "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend",
        "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
    )
)
#: Elements without an end tag.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
#: Elements whose end tag may be left out: a sibling or any block ends them.
OPEN_ENDED = frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option"))
#: Elements that hold no article text.
APART = frozenset(
    (
        "aside", "audio", "button", "canvas", "datalist", "dialog", "embed", "fieldset", "footer", "form", "frameset", "head", "header",
        "iframe", "input", "label", "map", "menu", "nav", "noscript", "object", "option", "select", "svg", "template", "video",
    )
)
#: Words of class, id and role names that mark the same.
APART_NAMES = frozenset(
    (
        "ad", "ads", "adv", "advert", "advertisement", "advertisements", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "form", "gdpr",
        "header", "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
        "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "respond",
        "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
        "toc", "toolbar", "topbar", "widget", "widgets",
    )
)

#: Words that only say where such an element stands or what shape it has, so that `ad-slot` or `site-footer` mark the same.
PLACE_NAMES = frozenset(
    (
        "area", "article", "articles", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "global", "inner", "item",
        "left", "link", "links", "list", "main", "more", "news", "outer", "page", "panel", "post", "posts", "primary", "reader", "readers",
        "right", "secondary", "section", "site", "slot", "stories", "story", "thread", "top", "unit", "user", "users", "visitor", "wrap", "wrapper",
    )
)
#: Elements that names say nothing about, and names that count for a paragraph.
NOT_BY_NAME = frozenset(("html", "body", "main", "a", "b", "i", "em", "strong", "h1", "h2", "h3", "h4", "h5", "h6"))
PARAGRAPH_NAMES = frozenset(("ad", "ads", "adv", "advert", "advertisement", "advertisements", "adverts", "promo", "promoted", "sponsor", "sponsored"))
#: Elements that are never hidden.
SHOWN = frozenset(("html", "body", "main"))

#: Elements whose content is no markup; only `xmp` and such would be shown, and hold no article.
RAW = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in ("script", "style", "textarea", "title", "xmp", "noembed")}
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_SPECIAL = re.compile("['\">]")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+(?![a-z0-9])|\d+x\d+|\d+|[^_-]+")
_SIZE = re.compile(r"\d+(?:x\d+)?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class _Scanner:
    """Tags of a page from left to right, each character looked at a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page = page
        self._gt = 0  # the first > at or after some place looked at, -1 if there is none from there on
        self._run = (0, -1)  # the last stretch without quote or >, from its start to the character that ends it
        self._dead: set[int] = set()  # quotes and ends that no tag can be ended from

    def _next_gt(self, at: int) -> int:
        if 0 <= self._gt < at:
            self._gt = self.page.find(">", at)
        return self._gt

    def _tag_end(self, at: int) -> int:
        """Place of the > that ends the tag whose name ends at `at`, outside quoted values; -1 if there is none."""
        if self._next_gt(at) < 0:
            return -1
        passed: list[int] = []
        low, place = self._run
        if not low <= at <= place:
            found = _SPECIAL.search(self.page, at)
            place = found.start() if found else -1
            self._run = (at, place)
        while place >= 0 and place not in self._dead:
            passed.append(place)
            quote = self.page[place]
            if quote == ">":
                return place
            closing = self.page.find(quote, place + 1)
            found = _SPECIAL.search(self.page, closing + 1) if closing >= 0 else None
            place = found.start() if found else -1
        self._dead.update(passed)
        return -1

    def tokens(self) -> Iterator[tuple[int, int, bool, str | None, str]]:
        """start, end, whether it closes, name (None for what is not shown) and attributes of each tag."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            after = page[at : at + 1]
            if after in ("!", "?"):
                if page.startswith("<!--", start):
                    end = page.find("-->", start + 4)
                    at = end + 3 if end >= 0 else len(page)
                    yield start, at, False, None, ""
                elif (end := self._next_gt(at)) >= 0:
                    at = end + 1
                    yield start, at, False, None, ""
                continue
            closes = after == "/"
            name = _NAME.match(page, at + closes)
            if name is None:
                continue
            tag = name[0].lower()
            end = self._next_gt(name.end()) if tag in RAW and not closes else self._tag_end(name.end())
            if end < 0:
                continue
            at = end + 1
            if tag in RAW and not closes:
                found = RAW[tag].search(page, at)
                at = found.end() if found else len(page)
                yield start, at, False, None, ""
            else:
                yield start, at, closes, tag, page[name.end() : end]


def _is_apart(tag: str, in_article: bool) -> bool:
    """Whether the element holds no article text by its tag."""
    return tag in APART and not (tag == "header" and in_article)  # an article's own header holds its title


def _is_marked_apart(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the element is hidden, or a whole name of it is one of `APART_NAMES`, or made of them and of `PLACE_NAMES` alone."""
    if not attributes or attributes.isspace():
        return False
    # Sites repeat their markup: short attributes are judged once.
    return (_judged if len(attributes) <= 200 else _judged.__wrapped__)(tag, attributes, in_article)


@lru_cache(maxsize=1 << 14)
def _judged(tag: str, attributes: str, in_article: bool) -> bool:
    names: list[str] = []
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if tag not in SHOWN:
            if name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true":
                return True
            if name == "style" and _NO_DISPLAY.search(value):
                return True
        if name in ("class", "id", "role"):
            names += value.split()
    if not names or tag in NOT_BY_NAME:
        return False
    own = PARAGRAPH_NAMES if tag == "p" else APART_NAMES - {"header", "masthead"} if in_article else APART_NAMES
    for name in names:
        words = _WORD.findall(_CAMEL.sub("-", name).lower())
        if any(word in own for word in words) and all(word in own or word in PLACE_NAMES or _SIZE.fullmatch(word) for word in words):
            return True
    return False


@dataclass
class _Named:
    """What a marked element holds: text outside links, and articles."""

    text: int = 0
    articles: int = 0
    #: While it is open: what the page held when it began.
    text_before: int = 0
    articles_before: int = 0


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """Text, weight, and whether an article or main element holds it, for each line of the page."""
    named: dict[int, _Named] = {}
    lines, whole = _lines(page, named, frozenset())
    spared = frozenset(
        at for at, own in named.items() if own.text > MOST_SHARE * whole.text or own.articles and own.articles == whole.articles
    )
    # The first pass leaves no marked element out.
    return _lines(page, None, spared)[0] if len(spared) < len(named) else lines


def _lines(page: str, named: dict[int, _Named] | None, spared: frozenset[int]) -> tuple[list[tuple[str, int, bool]], _Named]:
    """Lines of the page, and what it holds in all.

    With `named`, marked elements are entered there by their place; else they are left out, but for those in `spared`.
    """
    lines: list[tuple[str, int, bool]] = []
    whole = _Named()
    inside: list[tuple[int, _Named]] = []  # depth and contents of the marked elements that are open
    pieces: list[str] = []
    linked = apart = article = 0
    stack: list[tuple[str, bool, bool]] = []  # tag, holds no article text, is an article
    open_: Counter[str] = Counter()

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text or pieces:
            lines.append((text, max(0, len(text) - linked) if article == 0 else len(text), article > 0))
        pieces.clear()
        linked = 0

    def leave(depth: int) -> None:
        nonlocal apart, article
        while inside and inside[-1][0] >= depth:
            own = inside.pop()[1]
            own.text, own.articles = whole.text - own.text_before, whole.articles - own.articles_before
        while len(stack) > depth:
            tag, no_text, is_article = stack.pop()
            open_[tag] -= 1
            apart -= no_text
            article -= is_article

    def say(raw: str) -> None:
        nonlocal linked
        if not raw:
            return
        if apart:
            if not raw.isspace() and (not lines or lines[-1] != ("", 0, False)):
                flush()
                lines.append(("", 0, False))
            return
        text = html.unescape(raw)
        pieces.append(text)
        size = len(" ".join(text.split()))
        if open_["a"]:
            linked += size
        else:
            whole.text += size

    at = 0
    for start, end, closes, tag, attributes in _Scanner(page).tokens():
        say(page[at:start])
        at = end
        if tag is None:  # a comment, a declaration, or text that is not shown
            continue
        if tag in BLOCKS:
            flush()
        elif tag in ("br", "td", "th"):
            pieces.append(" ") if not apart else None
        if closes:
            if open_[tag]:
                leave(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            continue
        while stack and stack[-1][0] in OPEN_ENDED and (tag == stack[-1][0] or stack[-1][0] == "p" and tag in BLOCKS):
            leave(len(stack) - 1)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        if tag == "body" and open_["head"]:
            leave(next(k for k, (name, _, _) in enumerate(stack) if name == "head"))
        no_text = _is_apart(tag, article > 0)
        if not no_text and _is_marked_apart(tag, attributes, article > 0):
            if named is None:
                no_text = start not in spared
            elif not apart:
                named[start] = _Named(text_before=whole.text, articles_before=whole.articles)
                inside.append((len(stack), named[start]))
        is_article = tag in ("article", "main") and not apart and not no_text
        whole.articles += is_article
        open_[tag] += 1
        stack.append((tag, no_text, is_article))
        apart += no_text
        article += is_article
    say(page[at:])
    flush()
    leave(0)
    return lines, whole


def regions(weights: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """Line ranges between each surge of the window sums and the dive that follows."""
    if not len(weights):
        return []
    sums = np.convolve(weights, np.ones(window, dtype=np.int64))[window - 1 :]  # of a line and those after it
    filled = np.concatenate([[False], sums > 0, [False]])
    surges, dives = np.flatnonzero(filled[1:] & ~filled[:-1]), np.flatnonzero(~filled[1:] & filled[:-1])
    # A window reaches ahead, so the text begins at the first line with weight; it ends before the first empty window.
    return [(int(a + np.argmax(weights[a:b] > 0)), int(b)) for a, b in zip(surges, dives)]


def main_text(page: str | None) -> str:
    """Lines of the page's article, joined by line breaks."""
    lines = lines_of(page or "")
    own = sum(weight for _, weight, inside in lines if inside)
    marked = own > 0 and own >= MARKED_SHARE * sum(weight for _, weight, _ in lines)
    weights = np.array([weight if inside or not marked else 0 for _, weight, inside in lines], dtype=np.int64)
    chars = np.array([len(text) for text, _, _ in lines], dtype=np.int64)
    chosen = [(a, b) for a, b in regions(weights) if marked or weights[a:b].sum() >= (1 - LINK_SHARE) * chars[a:b].sum()]
    return "\n".join(lines[k][0] for a, b in chosen for k in range(a, b) if lines[k][0] and (lines[k][2] or not marked))


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of `pages` (page_id, url, html)."""
    apply_settings(pages.sparkSession)
    return pages.select("page_id", "url", pages["html"].cast("string").alias("html")).mapInArrow(
        _extract, f"page_id {dict(pages.dtypes)['page_id']}, url {dict(pages.dtypes)['url']}, text string, n_chars bigint"
    )
