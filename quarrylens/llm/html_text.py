"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once, tag by tag, into text blocks: the text between two block-level tags, without comments,
scripts, styles and other raw or hidden elements. For every block the words, the share of them in links, the same
of the blocks before and after it (of a list's items: before and after the list; none where these are besides the
main text), the words outside links of the longest other block under the same element (its ``kin``), and what encloses it (an article; a
navigation, form, advert or the like, by element, role, class or id) are measured. An element that only has part of such
a name, or is a form, may be a wrapper: an article in it counts, and other blocks in it by their neighbours. How many words outside links the longest block has that stands ``beside`` such elements
says whether there is a main text besides: where there is none, an element that has other names too, or is a form, holds the page, and its blocks count as any others; elements such as
navigation, footers and those named as nothing else never do. A decision tree decides which blocks are main text. It is grown by Gini impurity on the
small labelled table ``LABELLED`` when the operator is called, so a call with another table gives another tree. Where it keeps nothing of a page, the sentences
outside links and such elements are kept (blocks of three words or more that end as sentences do), with the headings under the same element.

Character references are decoded, white space inside a block becomes one space, and blocks are joined by two line feeds.

Defined results: a null or empty page has an empty text; markup that isn't closed, or is cut off, is read as far as it goes; a
less-than sign that begins no tag is text; repeated rows give repeated rows; texts of any length are read as a whole, in time linear in
the page; an empty table gives an empty table; other columns of ``pages``, whatever their names, are not looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "aside", "heading", "beside", "kin", "prose")
#: Labelled blocks: the features in order but the last (links in hundredths of the words; aside 2, or 1 where only part of
#: a name says so), then 1 for main text (fixed values). The last feature follows from those of the neighbours.
#: Words beside are those of the longest block outside elements besides the main text, for blocks in such; 999 where there is an article, and in navigation and the like.
LABELLED = """
9 0 0 0 80 0 1 0 1 0 80 1
62 0 9 0 44 0 1 0 0 0 44 1
1 0 62 0 71 0 1 0 0 0 71 1
3 0 1 0 1 0 1 0 0 0 1 1
1 0 3 0 12 0 1 0 0 0 12 1
12 8 40 0 55 3 1 0 0 0 53 1
2 100 30 0 45 0 1 0 0 0 45 1
18 50 33 2 41 0 1 0 0 0 41 1
140 2 66 0 12 0 1 0 0 0 66 1
4 0 2 0 90 0 1 0 1 0 90 1
5 0 44 0 0 0 1 0 0 0 44 1
2 0 0 0 2 0 1 0 1 0 2 1
5 0 2 100 9 0 1 0 0 0 9 1
3 0 20 0 2 100 1 0 0 0 20 1
1 100 3 100 2 100 1 0 0 0 0 1
7 30 2 100 4 100 1 0 1 0 0 1
4 0 1 100 1 100 1 0 0 0 0 1
35 0 28 0 8 100 1 0 0 0 28 1
6 0 50 0 9 0 1 0 0 0 50 1
80 0 7 0 64 5 0 0 0 0 60 1
45 4 80 0 33 0 0 0 0 0 80 1
28 0 45 4 52 0 0 0 0 0 52 1
11 0 40 0 60 0 0 0 1 0 60 1
60 10 12 0 30 0 0 0 0 0 30 1
25 0 31 0 2 100 0 0 0 0 31 1
19 5 70 0 38 0 0 0 0 0 70 1
33 0 3 100 41 0 0 0 0 0 41 1
1 100 0 0 1 100 0 2 0 999 4 0
1 100 1 100 1 100 0 2 0 22 0 0
2 100 1 100 8 0 0 2 0 35 8 0
8 0 1 100 9 0 0 2 0 999 0 0
30 0 1 100 7 0 0 2 0 12 4 0
15 0 60 0 0 0 0 2 0 61 0 0
70 3 44 0 0 0 0 2 0 999 44 0
12 40 70 0 3 100 0 2 0 15 0 0
6 0 20 0 25 0 1 2 0 22 4 0
22 0 70 0 31 0 1 2 0 999 0 0
3 100 90 0 4 100 1 2 0 48 90 0
40 5 22 0 12 0 1 2 0 12 0 0
2 0 12 0 40 0 1 2 1 999 4 0
4 0 0 0 1 100 0 2 1 80 0 0
5 100 4 100 3 100 0 0 0 0 30 0
2 100 0 0 3 100 0 0 0 0 0 0
3 66 2 100 5 100 0 0 0 0 30 0
10 80 6 100 4 100 0 0 0 0 0 0
2 0 3 100 2 100 0 0 0 0 2 0
4 0 4 100 0 0 0 0 0 0 0 0
7 0 2 100 1 100 0 0 0 0 5 0
6 50 80 0 2 100 0 0 0 0 80 0
20 90 60 0 9 100 0 0 0 0 60 0
3 0 0 0 2 100 0 0 1 0 0 0
6 0 45 0 52 0 0 0 0 0 52 1
3 0 60 4 38 0 0 0 0 0 57 1
9 0 30 2 24 0 0 0 0 0 29 1
1 0 41 0 33 0 0 0 0 0 41 1
8 12 28 0 70 5 0 0 0 0 66 1
4 0 0 0 45 0 0 0 1 0 45 1
7 0 2 100 60 3 0 0 1 0 58 1
2 0 55 0 40 0 0 0 1 0 55 1
5 0 3 0 31 0 0 0 1 0 31 1
3 0 1 100 35 0 0 0 1 0 35 1
6 0 1 100 16 0 0 0 0 0 16 1
9 0 4 0 27 0 0 0 0 0 27 1
4 40 7 0 50 0 0 0 0 0 50 1
7 0 45 0 2 100 0 0 0 0 45 1
5 0 17 0 0 0 0 0 0 0 17 1
8 0 52 3 3 0 0 0 0 0 50 1
10 45 33 0 20 0 0 0 0 0 33 1
2 0 19 5 2 0 0 0 0 0 18 1
3 0 2 100 4 0 0 0 0 0 2 0
5 0 4 0 13 0 0 0 0 0 0 0
6 0 12 0 1 100 0 0 0 0 5 0
9 0 3 0 8 0 0 0 0 0 0 0
10 0 0 0 2 100 0 0 0 0 2 0
8 0 5 0 0 0 0 0 1 0 0 0
4 0 3 100 5 100 0 0 1 0 5 0
3 0 0 0 0 0 0 0 0 0 0 0
4 0 40 90 30 95 0 0 0 0 2 0
3 0 2 0 22 88 0 0 1 0 0 0
5 0 60 80 2 0 0 0 0 0 5 0
2 100 45 0 50 0 0 0 0 0 50 0
3 100 60 0 2 100 0 0 0 0 60 0
4 75 2 0 48 0 0 0 0 0 48 0
1 100 38 0 70 0 0 0 0 0 70 0
9 55 22 0 31 0 0 0 0 0 31 0
13 0 2 0 3 0 0 0 0 0 3 1
90 0 2 100 1 100 0 0 0 0 0 1
16 45 3 100 4 0 0 0 0 0 3 1
40 0 0 0 0 0 0 0 0 0 0 1
120 3 0 0 5 100 0 0 0 0 3 1
30 60 45 0 50 0 0 0 0 0 50 0
14 100 3 100 60 0 0 0 0 0 60 0
60 0 45 0 52 0 0 1 0 35 0 1
34 3 28 0 70 4 0 1 0 48 67 1
48 0 5 0 36 0 0 1 0 12 0 1
29 0 33 2 7 0 0 1 0 61 4 1
75 2 0 0 41 0 0 1 0 80 0 1
12 0 64 0 2 100 0 1 0 15 64 1
6 0 45 0 52 0 0 1 0 22 0 1
5 0 2 100 60 0 0 1 1 35 4 1
3 0 38 0 44 0 0 1 1 48 0 1
13 0 2 0 3 0 0 1 0 12 3 0
14 0 12 0 2 0 0 1 0 61 0 0
16 5 1 100 1 100 0 1 0 80 4 0
45 0 3 0 4 0 0 1 0 15 0 0
28 0 30 90 2 0 0 1 0 22 3 0
3 0 2 0 4 0 0 1 0 35 0 0
2 100 1 100 1 100 0 1 0 48 4 0
20 90 3 100 4 100 0 1 0 12 0 0
2 100 45 0 50 0 0 1 0 61 50 0
5 0 9 0 2 0 0 1 0 80 0 0
3 0 4 0 2 100 1 1 0 15 4 0
2 100 45 0 50 0 1 1 0 22 0 0
4 0 2 100 3 100 1 1 0 35 0 0
32 0 40 0 55 0 1 1 0 48 0 1
5 0 48 0 36 0 1 1 0 12 4 1
1 100 45 0 60 0 1 0 0 0 60 1
30 80 50 0 41 0 1 0 0 0 50 1
12 0 2 0 3 100 1 0 0 0 2 1
8 0 62 0 47 0 0 2 0 22 4 0
45 0 62 0 47 0 0 2 0 999 0 0
31 2 18 0 24 0 0 2 0 48 24 0
9 0 0 0 55 0 0 2 1 12 0 0
26 0 40 0 70 0 1 2 0 999 4 0
5 0 80 0 66 0 1 2 0 80 0 0
52 0 33 0 2 100 0 2 0 15 33 0
17 0 29 0 21 0 0 2 0 999 0 0
3 0 35 0 58 0 0 2 1 35 4 0
64 4 3 0 90 0 0 2 0 48 0 0
38 0 51 0 1 100 1 2 0 999 51 0
22 0 36 0 44 0 0 2 0 61 0 0
11 0 2 100 3 0 0 0 0 0 3 1
18 4 60 100 12 0 0 0 0 0 0 1
70 48 7 0 25 90 0 0 1 0 3 1
25 0 11 0 0 0 0 0 0 0 0 1
36 20 3 100 24 95 0 0 0 0 3 1
52 0 40 88 2 0 0 0 0 0 0 1
12 80 2 100 3 100 0 0 0 0 30 0
22 100 0 0 2 0 0 0 0 0 0 0
41 66 4 0 3 100 0 0 0 0 30 0
65 95 5 100 6 100 0 0 0 0 0 0
35 53 9 0 12 0 0 0 0 0 2 0
90 75 0 0 1 100 0 0 0 0 0 0
39 0 0 0 8 0 0 1 0 12 4 0
80 6 2 0 4 0 0 1 0 61 0 0
55 0 9 0 0 0 0 1 0 80 9 0
24 0 50 100 2 100 0 1 0 15 0 0
11 12 0 0 3 0 0 1 0 22 4 0
33 52 45 0 30 0 0 0 0 0 45 0
15 48 40 0 22 0 0 0 0 0 40 1
50 0 2 0 3 100 1 1 0 12 0 0
30 0 2 0 3 0 0 1 0 0 4 1
45 2 4 0 0 0 0 1 0 2 0 1
12 0 1 100 2 100 0 1 0 5 0 1
60 0 30 0 5 0 0 1 0 0 0 1
4 0 0 0 45 0 0 1 1 0 4 1
6 0 30 0 42 0 0 1 0 3 0 1
3 0 2 100 4 0 0 1 0 0 4 0
5 0 3 0 2 100 0 1 0 4 0 0
2 100 1 100 8 0 0 1 0 0 4 0
25 80 4 0 3 100 0 1 0 0 0 0
30 0 0 0 38 0 0 2 0 0 38 1
38 0 30 0 0 0 0 2 0 0 0 1
52 3 2 100 4 0 0 2 0 6 4 1
15 0 0 0 0 0 0 2 0 8 0 1
3 0 1 100 33 0 0 2 1 0 33 1
7 0 40 0 26 0 0 2 0 2 0 1
3 0 2 0 3 100 0 2 0 0 4 0
2 100 3 100 1 100 0 2 0 0 0 0
18 90 2 100 3 100 0 2 0 4 0 0
30 0 0 0 38 0 0 2 0 999 0 0
38 0 30 0 0 0 0 2 0 999 4 0
20 0 0 0 0 0 0 2 0 999 0 0
14 5 0 0 3 100 0 2 0 999 0 0
33 0 18 0 40 0 0 2 0 14 0 0
41 0 0 0 27 0 0 2 0 11 4 0
26 0 12 0 0 0 0 2 0 19 0 0
2 0 45 0 50 0 0 1 1 22 50 1
20 0 16 0 3 0 0 1 0 31 0 1
3 100 50 0 44 0 0 1 0 40 4 0
5 0 17 3 2 0 0 1 0 26 0 1
9 0 4 0 0 0 0 0 0 0 43 1
4 0 3 0 5 0 0 0 0 0 60 1
7 0 0 0 9 0 0 0 0 0 38 1
3 0 2 0 2 100 0 0 1 0 75 1
8 20 1 100 3 0 0 0 0 0 28 1
2 0 6 0 4 0 0 0 0 0 123 1
10 0 9 0 8 0 0 0 0 0 17 1
1 0 3 0 7 0 0 0 0 0 90 1
5 0 8 0 10 0 0 0 0 0 22 1
2 100 4 0 3 0 0 0 0 0 52 0
4 75 1 100 6 0 0 0 0 0 40 0
6 0 4 0 3 0 0 0 0 0 9 0
9 0 5 0 10 0 0 0 0 0 10 0
8 0 10 0 2 100 0 0 0 0 12 0
"""
#: Elements whose content isn't text of the page. Those of ``TEXT_ONLY`` hold no tags: the first end tag closes them.
TEXT_ONLY = frozenset("script style title textarea iframe".split())
RAW = TEXT_ONLY | frozenset("noscript template select svg math object canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form menu dialog button fieldset".split())
#: Lists; the neighbours of an item are the blocks around the outermost list.
LISTS = frozenset("ul ol dl".split())
#: Elements that may be left open; they are closed by an outer end tag.
PLAIN = frozenset("p li dt dd tr td th thead tbody tfoot option".split())
#: Words of class, id or role attributes that name something besides the main text (fixed values).
ASIDE_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies "
    "disqus footer form gdpr header login masthead menu menubar nav navbar navigation newsletter notice notification outbrain pager pagination "
    "popup promo promoted related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar widget".split()
)
#: A slash that closes an element at its start tag, and isn't the end of a bare value.
_CLOSED = re.compile(r"(?:\A[^=]*|[\s\"'])/\Z")
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in TEXT_ONLY}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
#: A tag without angle brackets in its attributes. Each try ends at the next of these.
_SIMPLE = re.compile(r"<(/?)([A-Za-z][^\s/<>\"']*+)(?=[\s/>])((?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*+)>")
_NAME_PART = re.compile(r"[A-Za-z]+")
#: The end of a sentence, with quotes and brackets after it.
_SENTENCE = re.compile("[.!?\u2026\u3002\uff01\uff1f][\"'\u2019\u201d\u00bb)\\]]*\\Z")
SCHEMA = "page_id long, url string, text string"
BATCH_ROWS = 500


@dataclass
class Block:
    article: bool
    aside: int
    heading: bool
    within: int = 0
    element: int = -1  # the innermost element besides the main text
    parent: int = 0  # the element under which it stands, paragraphs and the like apart
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


#: Of those names, the ones that count for an article element too (a reader's comment, a teaser).
NOT_ARTICLE = frozenset("ad ads advert advertisement comment comments promo promoted related sponsor sponsored".split())


#: Words after which a name says what an element has or lacks, not what it is (fixed values).
HAVING = frozenset("with without has have having no non not".split())


def _aside_names(attributes: str, names: frozenset = ASIDE_NAMES) -> list[int]:
    """For each class, id and role 2 if it names something besides the main text; 1 if such a name is only a part of it; else 0."""
    found = []
    for m in _NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = list(takewhile(lambda p: p not in HAVING, (p.lower() for p in _NAME_PART.findall(name))))
            found.append(0 if names.isdisjoint(parts) else 2 if names.issuperset(parts) or not NOT_ARTICLE.isdisjoint(parts) else 1)
    return found


def _aside_name(attributes: str, names: frozenset = ASIDE_NAMES) -> int:
    return max(_aside_names(attributes, names), default=0)


@dataclass
class Tag:
    """What stands at a less-than sign: a tag, or (without a name) a comment or other markup."""

    start: int
    stop: int
    name: str = ""
    end: bool = False
    attributes: str = ""


class Scanner:
    """Markup of a page, one piece after the other, in time linear in the page: what is known of the place where something
    comes next, or that a tag isn't closed, is kept for the tries that follow."""

    def __init__(self, page: str):
        self.page = page
        self.last_close = page.rfind(">")
        self._known = {kind: (0, -1) for kind in self._NEXT}
        self._open_from: set[int] = set()  # quotes that, met outside of quotes, lead to no end of the tag

    _NEXT = {"name": re.compile(r"[\s/>]"), "special": re.compile(r"[>\"']"), "angle": re.compile(r"[<>]")}

    def _next(self, kind: str, at: int) -> int:
        """The next place from ``at`` on with a character of this kind, or the page's length."""
        low, found = self._known[kind]
        if not low <= at <= found:
            m = self._NEXT[kind].search(self.page, at)
            found = m.start() if m else len(self.page)
            self._known[kind] = at, found
        return found

    def _tag_stop(self, at: int) -> int:
        """The place after the ``>`` that ends a tag whose attributes begin at ``at``; -1 if it has no end. A ``>`` in quotes is no end."""
        page, tried = self.page, []
        while (q := self._next("special", at)) < len(page):
            if page[q] == ">":
                return q + 1
            if q in self._open_from:
                break
            tried.append(q)
            if (closing := page.find(page[q], q + 1)) < 0:
                break
            at = closing + 1
        self._open_from.update(tried)
        return -1

    def tag(self, at: int) -> Tag | None:
        """The next markup from ``at`` on."""
        page = self.page
        while (p := page.find("<", at)) >= 0:
            if m := _SIMPLE.match(page, p):
                return Tag(p, m.end(), m[2].lower(), bool(m[1]), m[3])
            if page.startswith("<!--", p):
                stop = page.find("-->", p + 4)
                return Tag(p, len(page) if stop < 0 else stop + 3)
            end = page.startswith("/", p + 1)
            letter = page[p + 1 + end : p + 2 + end]
            if letter.isascii() and letter.isalpha():
                name = self._next("name", p + 2 + end)
                stop = self._tag_stop(name)
                if stop >= 0:
                    return Tag(p, stop, page[p + 1 + end : name].lower(), end, page[name : stop - 1])
            if page[p + 1 : p + 2] in ("!", "?", "/"):
                stop = page.find(">", p + 2)
                return Tag(p, len(page) if stop < 0 else stop + 1)
            if letter.isascii() and letter.isalpha():
                stop = self._next("angle", p + 1)
                if stop == len(page) or page[stop] == ">":
                    return Tag(p, min(stop + 1, len(page)))
            at = p + 1
        return None

    def text_end(self, name: str, at: int) -> int:
        """The place after the next end tag ``name``, or -1."""
        m = _END[name].search(self.page, at, self.last_close + 1)
        return m.end() if m else -1


def _ends(scanner: Scanner, name: str, at: int) -> dict[int, int]:
    """Where the elements ``name`` that start from ``at`` on end, by their start; those without an end tag are absent."""
    found, open_at = {}, []
    while (m := scanner.tag(at)) is not None:
        at = m.stop
        if m.name in ("script", "style") and not m.end:
            stop = scanner.text_end(m.name, at)
            at = stop if stop >= 0 else len(scanner.page)
        elif m.name != name:
            continue
        elif m.end:
            if open_at:
                found[open_at.pop()] = m.stop
        elif not _CLOSED.search(m.attributes):
            open_at.append(m.start)
    return found


def _after_raw(scanner: Scanner, m: Tag, ends: dict[str, dict[int, int] | None]) -> int:
    """Where to read on after the start tag ``m`` of a raw element: after its end tag, or after the start tag if there is none.

    Only scripts and styles without an end tag reach to the end of the page. ``ends`` keeps what is known of the page."""
    if m.name in ("script", "style"):
        stop = scanner.text_end(m.name, m.stop)
        return stop if stop >= 0 else len(scanner.page)
    if _CLOSED.search(m.attributes):
        return m.stop
    if m.name in TEXT_ONLY:
        stop = scanner.text_end(m.name, m.stop) if m.name not in ends else -1
        if stop < 0:
            ends[m.name] = None
        return stop if stop >= 0 else m.stop
    if m.name not in ends:
        ends[m.name] = _ends(scanner, m.name, m.start)
    return ends[m.name].get(m.start, m.stop)


#: What holds outside all elements.
TOP = False, 0, 0, -1, 0


def text_blocks(page: str) -> tuple[list[tuple[Block, str]], list[tuple[int, bool]]]:
    """The blocks of a page that hold text, each with that text, and the elements besides the main text: the one around each, and whether it never holds the main text (an element
    or role of that kind, or one that has no other name)."""
    found: list[Block] = []
    # element, within an article, within something besides it (0 to 2), outermost list, innermost such element, parent of blocks
    stack: list[tuple[str, bool, int, int, int, int]] = []
    besides_at: list[tuple[int, bool]] = []
    block = Block(False, 0, False)
    link, at, lists, parents = 0, 0, 0, 0

    def close(heading: bool = False) -> None:
        nonlocal block
        if block.parts:
            found.append(block)
        article, aside, within, element, parent = stack[-1][1:] if stack else TOP
        block = Block(article, aside, heading, within, element, parent)

    def add(text: str) -> None:
        if text:
            block.parts.append(text)
            if link:
                block.linked.append(text)

    ends: dict[str, dict[int, int] | None] = {}
    opened: dict[str, int] = {}  # open elements by name

    def pop() -> str:
        gone = stack.pop()[0]
        opened[gone] -= 1
        return gone

    def push(name: str, *place) -> None:
        stack.append((name, *place))
        opened[name] = opened.get(name, 0) + 1

    scanner = Scanner(page)
    while m := scanner.tag(at):
        add(page[at : m.start])
        at = m.stop
        if not (name := m.name):
            continue
        if name in RAW:
            if not m.end:
                at = _after_raw(scanner, m, ends)
            if name in ("title", "noscript", "textarea", "select"):
                close()
            continue
        if name == "a":
            link = 0 if m.end else 1
            continue
        if name in INLINE:
            if name in ("br", "img", "wbr"):
                add(" ")
            elif not m.end and name == "span" and "=" in m.attributes and (besides := _aside_name(m.attributes)):
                article, aside, within, element, parent = stack[-1][1:] if stack else TOP
                besides_at.append((element, True))
                push(name, article, max(aside, besides), within, len(besides_at) - 1, parent)
                close()
            elif m.end and stack and stack[-1][0] == name:
                pop()
                close()
            continue
        link = 0
        if m.end:
            if opened.get(name):
                while pop() != name:
                    pass
            close()
        elif name in VOID:
            close()
        else:
            if name in PLAIN:
                # an element that may be left open ends one of its kind that has no other element inside
                while stack and stack[-1][0] in PLAIN and (stack[-1][0] == name or name in ("p", "li")):
                    pop()
            elif name not in ("body", "html") and stack and stack[-1][0] == "p":
                pop()
            article, aside, within, element, parent = stack[-1][1:] if stack else TOP
            named = "=" in m.attributes
            if name in ARTICLE:
                # an article in an element with part of such a name, or in a form, shows that this is a wrapper; <main> does so in any
                besides = _aside_name(m.attributes, NOT_ARTICLE) if named else 0
                aside = max(aside if aside == 2 and name != "main" else 0, besides)
                article = article or not aside
                if besides:
                    besides_at.append((element, True))
                    element = len(besides_at) - 1
                elif not aside:
                    element = -1
            elif name in ASIDE or (named and name not in ("body", "html")):
                # the header of an article is part of it
                names = ASIDE_NAMES - {"header"} if article else ASIDE_NAMES
                of_element = 0 if name not in ASIDE or (name == "header" and article) else 1 if name == "form" else 2
                of_names = _aside_names(m.attributes, names) if named else []
                if besides := max(of_element, *of_names, 0):
                    aside = max(aside, besides)
                    besides_at.append((element, of_element == 2 or (besides == 2 and min(of_names) > 0)))
                    element = len(besides_at) - 1
            if name in LISTS and not within:
                lists = within = lists + 1
            heading = len(name) == 2 and name[0] == "h" and name[1] in "123456"
            if not heading and name not in PLAIN and name not in LISTS:
                parents += 1
                parent = parents
            push(name, article, aside, within, element, parent)
            close(heading)
    add(page[at:])
    close()
    return [(b, text) for b in found if (text := b.text())], besides_at


#: Words beside a block of navigation and the like, and words that are no main text yet.
NO_MAIN_TEXT, LITTLE = 999.0, 10.0


def with_prose(x: np.ndarray) -> np.ndarray:
    """Features with one more: the words outside links of that neighbour which has more of them."""
    return np.column_stack([x, np.maximum(x[:, 2] * (100 - x[:, 3]), x[:, 4] * (100 - x[:, 5])) / 100])


def words_beside(blocks: list[tuple[Block, str]], elements: list[tuple[int, bool]], plain: list[float]) -> list[float]:
    """For each block in an element besides the main text the words outside links of the longest block that stands beside that and outside other such elements."""
    longest = [0.0] * (len(elements) + 1)  # of the blocks of which this is the innermost such element; the last: of those in none
    for (b, _), n in zip(blocks, plain, strict=True):
        longest[b.element] = max(longest[b.element], NO_MAIN_TEXT if b.article and b.aside < 2 else n)  # an article is main text, however short
    beside: list[float] = []
    for outer, never in elements:  # an element comes after the one around it
        beside.append(NO_MAIN_TEXT if never else max(beside[outer] if outer >= 0 else 0.0, longest[outer]))
    return [beside[b.element] if b.element >= 0 else 0.0 for b, _ in blocks]


def words_of_kin(blocks: list[tuple[Block, str]], plain: list[float]) -> list[float]:
    """For each block the words outside links of the longest other block under the same element."""
    two: dict[tuple, list[float]] = {}
    for (b, _), n in zip(blocks, plain, strict=True):
        best = two.setdefault((b.parent, b.element), [0.0, 0.0])
        best[:] = sorted([*best, n])[1:]
    longest = [two[b.parent, b.element] for b, _ in blocks]
    return [second if n == first else first for (second, first), n in zip(longest, plain, strict=True)]


def features(blocks: list[tuple[Block, str]], elements: list[tuple[int, bool]]) -> np.ndarray:
    words = [len(t.split()) for _, t in blocks]
    linked = [len(html.unescape("".join(b.linked)).split()) if b.linked else 0 for b, _ in blocks]
    share = np.array([min(100.0, 100 * m / n) for m, n in zip(linked, words, strict=True)])
    n, first, last = len(blocks), [], []
    for k, (b, _) in enumerate(blocks):
        first.append(first[-1] if k and b.within and b.within == blocks[k - 1][0].within else k)
    for k in range(n - 1, -1, -1):
        last.append(last[-1] if last and first[last[-1]] == first[k] else k)
    plain = [max(0, a - m) for a, m in zip(words, linked, strict=True)]
    beside, kin = words_beside(blocks, elements, plain), words_of_kin(blocks, plain)
    # the blocks around every block, or around its list; places 0 and n + 1 are beside the page. As neighbours, blocks besides the main text have no words
    before, after = np.array(first), np.array(last[::-1]) + 2
    seen = np.array([b.aside < 2 or w < LITTLE for (b, _), w in zip(blocks, beside, strict=True)], float)
    words_at, share_at = np.concatenate([[0], words * seen, [0]]), np.concatenate([[0], share * seen, [0]])
    flags = np.array([(b.article, b.aside, b.heading, w, k) for (b, _), w, k in zip(blocks, beside, kin, strict=True)], float)
    return with_prose(np.column_stack([words, share, words_at[before], share_at[before], words_at[after], share_at[after], flags]))


def labelled(table: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    rows = np.array([line.split() for line in table.strip().splitlines()], float)
    return with_prose(rows[:, :-1]), rows[:, -1].astype(int)


def grown(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1):
    """A decision tree: ``(feature, threshold, tree up to it, tree above it)`` or the share of main text."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return share
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for threshold in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= threshold
            n, m = int(low.sum()), int((~low).sum())
            if min(n, m) < least:
                continue
            p, q = y[low].mean(), y[~low].mean()
            impurity = n * p * (1 - p) + m * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, float(threshold)
    if best is None:
        return share
    _, f, threshold = best
    low = x[:, f] <= threshold
    return f, threshold, grown(x[low], y[low], depth - 1, least), grown(x[~low], y[~low], depth - 1, least)


def main_text_share(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str, tree) -> str:
    blocks, elements = text_blocks(page)
    if not blocks:
        return ""
    rows = features(blocks, elements).tolist()
    kept = [text for (_, text), row in zip(blocks, rows, strict=True) if main_text_share(tree, row) >= 0.5]
    if not kept:
        free = [not b.aside or row[9] < LITTLE for (b, _), row in zip(blocks, rows, strict=True)]
        parents = {b.parent for (b, text), row, f in zip(blocks, rows, free, strict=True) if f and row[0] >= 3 and row[1] < 50 and not b.heading and _SENTENCE.search(text)}
        kept = [text for (b, text), row, f in zip(blocks, rows, free, strict=True) if f and row[1] < 50 and b.parent in parents and (b.heading or (row[0] >= 3 and _SENTENCE.search(text)))]
    return "\n\n".join(kept)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", table: str = LABELLED) -> DataFrame:
    """``page_id, url, text`` for every row."""
    tree = grown(*labelled(table))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = pa.array([main_text(x.as_py(), tree) for x in part.column(2)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], names=["page_id", "url", "text"])

    return rows.mapInArrow(run, SCHEMA)
