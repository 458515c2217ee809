"""Main text of web pages: the contiguous region whose words and tags score highest."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import python_columns

# Kinds of elements, and words in class or id names of what is not the article.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg math object select xmp noembed noframes".split())
INLINE = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
BOILERPLATE = set("nav header footer aside form menu dialog button fieldset".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
HINTS = set(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar menu nav "
    "navbar navigation topnav breadcrumb breadcrumbs masthead footer header comment comments commentlist disqus respond reply "
    "replies related recommended share sharing social widget toolbar pagination pager skip".split())
# Parts of names that say nothing of the content, and elements that only mark areas.
GENERIC = set(
    "area bar block bottom box col column container content element form group holder inner item items left link links list "
    "main middle outer panel pane right row section slot text top unit wrap wrapper".split())
ARTICLE = ("article", "main")
MARKS = {*ARTICLE, "nav", "header", "footer", "aside", "form", "menu", "section"}

DEFAULTS = {"word": 1.0, "link": 0.2, "other": -1.0, "unknown": -0.25}

_NAME_OF_TAG = re.compile(r"[A-Za-z][^\s/>]*")
_REST_OF_TAG = re.compile(r"(?:[^'\">]++|\"[^\"]*\"|'[^']*')*+>")
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WHITE = re.compile(r"[ \t\n\x0b\x0c\r\xa0 -     　]+")
_NAME = re.compile(r"[a-z]+")


def _is_hint(name: str) -> bool:
    """Whether a class or id speaks of something beside the article: by its last word, or by its first
    one if the others say nothing."""
    parts = _NAME.findall(name)
    return bool(parts) and (parts[-1] in HINTS or parts[0] in HINTS and GENERIC.issuperset(parts[1:]))


def _is_aside(name: str, attributes: str, in_article: bool) -> bool:
    if name in BOILERPLATE and not (name == "header" and in_article):
        return True
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
            return True
        if key in ("class", "id") and any(map(_is_hint, value.split())):
            return True
    return False


def tags_of(source: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(begin, end, closing, name, attributes) of the tags and comments of a page, in order.

    The name is empty for comments and declarations. Every character is looked at a fixed number
    of times: where quotes leave a tag without an end, quotes count no more in the rest of the page.
    """
    at, quotes, size = 0, True, len(source)
    while (at := source.find("<", at)) >= 0:
        begin, follow = at, source[at + 1:at + 2]
        closing = follow == "/"
        name = _NAME_OF_TAG.match(source, at + 1 + closing)
        if not name:
            if follow not in ("!", "?", "/") or not follow:
                at += 1
                continue
            mark = "-->" if source.startswith("<!--", at) else ">"
            end = source.find(mark, at + 2)
            at = size if end < 0 else end + len(mark)
            yield begin, at, False, "", ""
            continue
        rest = _REST_OF_TAG.match(source, name.end()) if quotes else None
        if rest:
            end, at = rest.end() - 1, rest.end()
        else:
            quotes = False
            end = source.find(">", name.end())
            end, at = (size, size) if end < 0 else (end, end + 1)
        word = name.group().lower()
        yield begin, at, closing, word, source[name.end():end]
        if word in RAW and not closing:
            raw = re.compile(rf"</{re.escape(word)}(?=[\s/>])", re.I).search(source, at)
            at = raw.start() if raw else size


class Page:
    """Tokens of a page in order: tags, and runs of words in their blocks.

    `names`, `counts` and `places` are the tokens' score names, numbers of words (1 for tags) and
    blocks (-1 for tags). Words are of kind "word", "link", or "other" where names and roles speak
    of something beside the article. An element that holds the article mark, nine tenths of the words
    or half of them and the title, is a wrapper and not beside it, whatever it is called, but for
    marked menus, footers and the like. Marks of teasers and comments in such elements count only
    where there are no others. `inside` says which tokens the page itself marks as its article.

    A `blind` page is read as if all elements that mark areas were plain ones without attributes;
    its `inside` is still true to the marks.
    """

    def __init__(self, source: str, blind: bool = False):
        self.names: list[str] = []
        self.counts: list[int] = []
        self.places: list[int] = []
        self.inside: list[bool] = []
        self.blocks: list[list[tuple[str, int]]] = [[]]
        self.blind, self.has_article = blind, False
        self._links = self._articles = self._raw = 0
        self._open: list[tuple[str, int, bool]] = []
        self._where: dict[str, list[int]] = {}
        self._asides: list[tuple[int, int, bool]] = []
        self._marked: list[int] = []
        at = 0
        for begin, end, closing, name, attributes in tags_of(source):
            self._text(source[at:begin])
            at = end
            if name:
                self._tag(name, closing, attributes)
        self._text(source[at:])
        self._leave(0)
        self._settle()

    def _tag(self, name: str, closing: bool, attributes: str) -> None:
        if name == "br":
            self.blocks[-1].append((" ", -1))
        elif name in BLOCKS and self.blocks[-1]:
            self.blocks.append([])
        if closing and self._where.get(name):
            self._leave(self._where[name][-1])
        shown = "div" if self.blind and name in MARKS or name in ARTICLE else name
        if not self._raw and name not in RAW:
            self._token(shown if shown in BLOCKS or shown in INLINE or shown in VOID else "unknown", 1, -1)
        if closing or name in VOID or attributes.endswith("/") and name not in BLOCKS and name not in RAW:
            return
        if name in BLOCKS:
            self._end_implied("li" if name == "li" else "p")
        aside = not self.blind and _is_aside(name, attributes, self._articles > 0)
        self._where.setdefault(name, []).append(len(self._open))
        self._open.append((name, len(self.names), aside))
        self._links += name == "a"
        self._raw += name in RAW
        if name in ARTICLE:
            self._articles += 1
            self._marked.append(len(self.names))
            self.has_article = True

    def _end_implied(self, ends: str) -> None:
        """A block ends an open paragraph, a list item the one before it."""
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == ends:
                self._leave(i)
                return
            if self._open[i][0] in BLOCKS:
                return

    def _leave(self, depth: int) -> None:
        while len(self._open) > depth:
            name, begin, aside = self._open.pop()
            self._where[name].pop()
            if aside:
                self._asides.append((begin, len(self.names), name in BOILERPLATE and name not in ("form", "fieldset")))
            self._links -= name == "a"
            self._raw -= name in RAW
            self._articles -= name in ARTICLE

    def _token(self, name: str, count: int, block: int) -> None:
        self.names.append(name)
        self.counts.append(count)
        self.places.append(block)
        self.inside.append(self._articles > 0)

    def _text(self, text: str) -> None:
        if not text or self._raw:
            return
        words = len(text.split())
        self.blocks[-1].append((text, len(self.names) if words else -1))
        if words:
            self._token("link" if self._links else "word", words, len(self.blocks) - 1)

    def _settle(self) -> None:
        """Words in elements beside the article are "other"; their text is taken out of the blocks."""
        covered = self._depths(self._asides)
        # Marks in asides count only where there are no others.
        plain = any(not covered[m] for m in self._marked)
        marks = [] if plain else sorted(self._marked)
        words = [count if place >= 0 and (own or not plain) else 0 for count, place, own in zip(self.counts, self.places, self.inside)]
        before = list(accumulate(words, initial=0))
        titles = [i for i, name in enumerate(self.names) if name == "h1"]

        def holds(places: list[int], begin: int, end: int) -> bool:
            at = bisect_left(places, begin)
            return at < len(places) and places[at] < end

        asides = []
        for begin, end, certain in self._asides:
            own = before[end] - before[begin]
            most = 10 * own >= 9 * before[-1] or 2 * own >= before[-1] and holds(titles, begin, end)
            if not (holds(marks, begin, end) or most and own and not certain):
                asides.append((begin, end, certain))
        self.aside = [depth > 0 for depth in self._depths(asides)]
        for i, place in enumerate(self.places):
            if self.aside[i] and place >= 0:
                self.names[i] = "other"

    def _depths(self, spans: list[tuple[int, int, bool]]) -> list[int]:
        """How many of the spans each token lies in, and one more place behind the last token."""
        edges = [0] * (len(self.names) + 2)
        for begin, end, _ in spans:
            edges[begin] += 1
            edges[end] -= 1
        return list(accumulate(edges))[:-1]

    def region(self, weights: dict[str, float]) -> tuple[int, int]:
        """First and last block of the best contiguous run of tokens; (0, -1) if none scores above 0."""
        first, last = best_run(self.scores(weights))
        held = [b for b in self.places[first:last + 1] if b >= 0]
        return (held[0], held[-1]) if held else (0, -1)

    def scores(self, weights: dict[str, float]) -> list[float]:
        """Score of each token. Where a page marks its article, everything outside counts against it."""
        found = [weights.get(name, weights["unknown"]) * count for name, count in zip(self.names, self.counts)]
        if self.has_article and not self.blind:
            found = [x if own else -abs(x) - 1.0 for x, own in zip(found, self.inside)]
        return found

    def text(self, weights: dict[str, float]) -> str:
        first, last = self.region(weights)
        blocks = []
        for block in self.blocks[first:last + 1]:
            # White space stands beside what it separates.
            text = "".join(t for t, i in block if i < 0 or not self.aside[i])
            blocks.append(_WHITE.sub(" ", html.unescape(text)).strip(" "))
        return "\n".join(b for b in blocks if b)


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the largest sum, the first and shortest of equals; (0, -1) if none is above 0."""
    best, first, last, total, begin = 0.0, 0, -1, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, first, last = total, begin, i
    return first, last


@dataclass(frozen=True)
class LearnParams:
    """The weights are learned from at most `pages` labelled pages of at most `longest` characters,
    those with the smallest hashes, in `rounds` passes."""

    pages: int = 300
    longest: int = 100_000
    rounds: int = 8


def learned_weights(
    pages: DataFrame, html_col: str = "html", id_col: str = "page_id", params: LearnParams = LearnParams(),
) -> dict[str, float]:
    """Weights of words by kind and of tags by name, from pages that mark their article themselves.

    Without labelled pages the defaults hold. Only pages below a hash bound are looked at; the bound
    rises until there are enough, so what reaches the driver does not grow with the table.
    """
    text = F.col(html_col)
    h = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text), 32)
    hashed = pages.select(text.alias("html"), h.alias("h"))
    total, share = pages.count(), 0.0
    while share < 1.0:
        share = min(1.0, 8 * (share or params.pages / max(total, 1)))
        few = hashed.where(F.col("h") < int(share * 2**32))
        labelled = few.where(F.rlike("html", F.lit(r"(?i)<(?:article|main)[\s>]")) & (F.length("html") <= params.longest))
        # Copies of a page count once.
        rows = labelled.groupBy("h").agg(F.min("html").alias("html")).orderBy("h").limit(params.pages).collect()
        if len(rows) == params.pages:
            break
    return weights_from([r["html"] for r in rows], params.rounds)


def weights_from(sources: list[str], rounds: int = LearnParams.rounds) -> dict[str, float]:
    """Weights under which the best run of each labelled page is its article, as far as there are such.

    Each page is learned twice: as it is, and blind, without the marks and names that other pages
    lack. Whenever another run than the article's scores best, the weights move by the smallest step
    that puts the article ahead of it by the number of words that they differ in. Words never score
    below 0, tags and words beside the article never above. The average over all steps is returned.
    """
    examples = []
    for source in sources:
        for blind in (False, True):
            page = Page(source, blind)
            own = [i for i, place in enumerate(page.places) if page.inside[i] and place >= 0 and not page.aside[i]]
            if page.has_article and own:
                examples.append((page, own[0], own[-1]))
    weights = dict(DEFAULTS)
    total, steps = dict.fromkeys(weights, 0.0), 0
    for _ in range(rounds):
        for page, first, last in examples:
            # The marks of the page are its label, not a feature.
            scores = [weights.get(n, weights["unknown"]) * c for n, c in zip(page.names, page.counts)]
            begin, end = best_run(scores)
            if (begin, end) != (first, last):
                change: dict[str, float] = {}
                missed = 0
                for (a, b), sign in (((first, last), 1), ((begin, end), -1)):
                    for i in range(a, b + 1):
                        if not (first <= i <= last and begin <= i <= end):
                            change[page.names[i]] = change.get(page.names[i], 0.0) + sign * page.counts[i]
                            missed += page.counts[i] if page.places[i] >= 0 else 0
                behind = missed - sum(weights.get(n, weights["unknown"]) * x for n, x in change.items())
                size = sum(x * x for x in change.values())
                if behind > 0 and size:
                    for name, x in change.items():
                        moved = weights.get(name, weights["unknown"]) + behind / size * x
                        weights[name] = max(moved, 0.0) if name in ("word", "link") else min(moved, 0.0)
            steps += 1
            for name, value in weights.items():
                total[name] = total.get(name, value * (steps - 1)) + value
    return {name: value / steps for name, value in total.items()} if steps else weights


def main_text(
    pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    The region is the run of words and tags with the largest sum of weights, extended to whole
    blocks; of equal runs the first. Text inside it that belongs to menus, adverts, forms, notices
    or comments is left out. A line break inside a block is white space. Pages that mark an article
    are searched only there. Null and empty pages, and pages without any run above 0, have an empty
    text. Rows that repeat an id are read one by one. A very long page takes time in proportion to
    its length. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    held = pages.sparkSession.sparkContext.broadcast(weights or learned_weights(pages, html_col, id_col))
    found = python_columns(
        pages, _reader(held), "text string", {"html": F.col(html_col)}, [id_col, url_col])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def _reader(held) -> Callable:
    def make():
        weights = held.value
        return lambda batch: {"text": pa.array([Page(s or "").text(weights) for s in batch["html"].to_pylist()], pa.string())}

    return make
