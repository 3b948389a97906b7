"""Main text of web pages by tree scoring.

The page is read into a tree of elements. Every paragraph with text gives points for its length and its
commas to its ancestors, fewer with each level and fewer the more of it is link text. The container with
most points is kept, or the article or main element around it as a whole, or else those siblings too that
score like it or read like prose; elements that by their
tag, role, class or state are page furniture are left out before. A class or id that names furniture only
in part doesn't remove what stands around the article, and none counts if nothing would be left. A form
goes, unless an article or main element stands in it or its prose has most points of the page (a page
wrapped in one form). An article element that its names or its schema call a reader comment goes too.

Character references are decoded, white space inside a block becomes one blank, and the blocks are joined
in page order by one blank. Nothing is cut: long pages are read whole. Defined results: null and empty
pages, and pages without text, give an empty text; unclosed tags end where their parent ends; a svg or math
element that closes itself holds nothing; time grows with the length of the page, also where elements are
nested thousands of levels deep; equal rows give equal results; other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

RAW = "script|style|noscript|template|textarea|iframe|title|object|select"
FOREIGN = "svg|math"  # only here a slash at the end of the tag closes the element
ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b{ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<({FOREIGN})\b{ATTRIBUTES}(?<!/)>.*?(?:</\2\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-z!?/][^>]*>?", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([a-z-]+)", re.I)
WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
FURNITURE = frozenset("nav header footer aside button menu dialog fieldset input canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# Names that public reader-view tools (Arc90's Readability and its successors) take for furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs combx comment comments community cookie "
    "consent disqus footer footnav gdpr header hidden login masthead menu menus meta modal nav navbar navigation newsletter "
    "notice notices outbrain overlay pager pagination paywall popup promo promotion promotions recommended related remark reply "
    "replies respond rss share sharing shoutbox sidebar signup skip social sponsor sponsored sponsors subscribe subscription "
    "tags taboola teaser toolbar topbar widget widgets".split())
COMMENT = frozenset("comment comments reply replies".split())
COMMENT_PARTS = COMMENT | frozenset("body box card container content div entry inner item list node single thread user wrapper".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
                   "ol p pre section table ul".split())
SCOPES = frozenset("article aside blockquote body div footer form header main nav ol section table td th ul dl li".split())
CONTAINERS = {"article": 30.0, "main": 25.0, "section": 3.0, "div": 5.0, "blockquote": 3.0, "td": 3.0, "pre": 3.0}
KEEP_SHARE, PROSE = 0.2, 80


def _is_comment(name: str, value: str) -> bool:
    """Whether an attribute of an article element says that it holds a reader comment (``comment-body``, not ``comments-open``)."""
    if name in ("class", "id"):
        return any(not COMMENT.isdisjoint(words) and COMMENT_PARTS.issuperset(words) for words in map(WORD.findall, value.split()))
    return name == "itemprop" and value == "comment" or name == "itemtype" and value.rstrip("/").endswith("schema.org/comment")


def _furniture(tag: str, attributes: str, marks: bool) -> tuple[bool, int]:
    """Whether tag, role or state say furniture, and how far class and id do: 2 by a whole name, 1 by a part of one."""
    if tag in FURNITURE:
        return True, 0
    mark = 0
    for name, *values, bare in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = (name or bare).lower(), "".join(values).lower()
        if tag == "article" and marks and _is_comment(name, value):
            mark = 2
        elif name in ("class", "id"):
            if marks and tag not in ("body", "html", "article", "main") and not MARKS.isdisjoint(WORD.findall(value)):
                mark = max(mark, 2 if any(MARKS.issuperset(words) for words in map(WORD.findall, value.split()) if words) else 1)
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True, mark
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return True, mark
    # inline elements have no blocks of their own, so they go at once
    return mark > 0 and tag in INLINE, mark


class Page:
    """The tree: for every element its parent and tag; for every block its element, text and link length."""

    def __init__(self, html: str, marks: bool = True):
        self.parent, self.tags, self.dropped, self.marks, self.by_marks = [-1], ["#root"], [False], [0], marks
        self.blocks: list[tuple[int, str, int]] = []
        self.texts: list[str] = []
        self.linked, self.links, self.block_of = 0, 0, 0
        self.outer = [0]  # for every element itself, or the nearest one around it that isn't inline
        self.open: Counter[str] = Counter()  # open elements by tag
        stack, at = [0], 0
        for token in TOKEN.finditer(html):
            if token.start() > at:
                self._text(stack, html[at:token.start()])
            at = token.end()
            tag = token[4]
            if tag is None:
                continue
            tag = tag.lower()
            if token[3]:
                self._close(stack, tag)
            elif tag not in ("svg", "math"):
                self._open(stack, tag, token[5])
        if at < len(html):
            self._text(stack, html[at:])
        self._flush()
        if "form" in self.tags:
            self._leave_forms()
        if any(self.marks):
            self._leave_out()

    def _leave_forms(self) -> None:
        """Drop forms and their blocks, but for one around an article or main element, or around most of the page's prose."""
        prose, total = [0.0] * len(self.parent), 0.0
        for node, text, linked in self.blocks:
            worth = _worth(text, linked)
            total += worth
            if len(text) >= PROSE:
                prose[node] += worth
        holds = [tag in ("article", "main") and not out for tag, out in zip(self.tags, self.dropped)]
        for node in range(len(prose) - 1, 0, -1):
            prose[self.parent[node]] += prose[node]
            holds[self.parent[node]] |= holds[node]
        within = [False]
        for node in range(1, len(self.parent)):
            above, tag = self.parent[node], self.tags[node]
            within.append(within[above] or self.tags[above] in ("article", "main"))
            if self.dropped[above] or tag == "form" and not (holds[node] or not within[node] and prose[node] * 2 > total):
                self.dropped[node] = True
        self.blocks = [b for b in self.blocks if not self.dropped[b[0]]]

    def _leave_out(self) -> None:
        """Drop the blocks of elements with a furniture class or id.

        A part of a name (``has-sidebar``) doesn't drop what stands around an article or main element, or
        holds most of the points of a page without another one.
        """
        whole, within = [False], [False]  # below an element marked by a whole name; below an article or main element
        for node in range(1, len(self.parent)):
            above = self.parent[node]
            whole.append(whole[above] or self.marks[node] == 2 or self.dropped[node])
            within.append(within[above] or self.tags[above] in ("article", "main"))
        around: set[int] = set()
        for node, tag in enumerate(self.tags):
            if tag in ("article", "main") and not whole[node]:
                while node >= 0 and node not in around:
                    around.add(node)
                    node = self.parent[node]
        held = [0.0] * len(self.parent)
        for node, text, linked in self.blocks:
            if not whole[node]:
                held[node] += _worth(text, linked)
        for node in range(len(held) - 1, 0, -1):
            held[self.parent[node]] += held[node]
        out = [False]
        for node in range(1, len(self.parent)):
            mark = self.marks[node]
            spared = mark == 1 and (node in around and not within[node] or held[node] * 2 > held[0] and (within[node] or not around))
            out.append(out[self.parent[node]] or mark > 0 and not spared)
        self.blocks = [b for b in self.blocks if not out[b[0]]]

    def _text(self, stack: list[int], text: str) -> None:
        if self.dropped[stack[-1]]:
            return
        if "&" in text:
            text = unescape(text)
        self.texts.append(text)
        if self.links:
            self.linked += len(text)

    def _flush(self) -> None:
        if self.texts:
            text = " ".join("".join(self.texts).split())
            if text:
                self.blocks.append((self.block_of, text, min(self.linked, len(text))))
            self.texts, self.linked = [], 0

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag == "br":
            self.texts.append(" ")
            return
        if tag in INLINE:
            if tag in VOID:
                return
            if tag == "a":
                self.links += 1
        else:
            self._flush()
            if tag in ENDS_P:
                self._end(stack, {"p"})
            if tag in CLOSES and tag != "p":
                self._end(stack, CLOSES[tag])
            if tag in VOID:
                return
        node = len(self.parent)
        self.parent.append(stack[-1])
        self.tags.append(tag)
        self.outer.append(self.outer[stack[-1]] if tag in INLINE else node)
        self.open[tag] += 1
        furniture, mark = _furniture(tag, attributes, self.by_marks)
        self.dropped.append(self.dropped[stack[-1]] or furniture)
        self.marks.append(mark)
        stack.append(node)
        if tag not in INLINE:
            self.block_of = node
            self.links = 0

    def _end(self, stack: list[int], tags: set[str]) -> None:
        """Close an open element of these tags, unless a scope stands between."""
        if not any(self.open[tag] for tag in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[depth]]
            if tag in tags:
                self._leave(stack, depth)
                self._moved(stack)
                return
            if tag in SCOPES:
                return

    def _close(self, stack: list[int], tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        elif tag == "a":
            self.links = max(0, self.links - 1)
        if not self.open[tag]:
            return
        for depth in range(len(stack) - 1, 0, -1):
            found = self.tags[stack[depth]]
            if found == tag:
                self._leave(stack, depth)
                if tag not in INLINE:
                    self._moved(stack)
                return
            if tag in INLINE and found in SCOPES:
                return

    def _leave(self, stack: list[int], depth: int) -> None:
        for node in stack[depth:]:
            self.open[self.tags[node]] -= 1
        del stack[depth:]

    def _moved(self, stack: list[int]) -> None:
        self.block_of = self.outer[stack[-1]]
        self.links = 0


def _worth(text: str, linked: int) -> float:
    return (1.0 + text.count(",") + min(len(text) / 100.0, 3.0)) * (1.0 - linked / len(text))


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = Page(html)
    if not page.blocks and any(page.marks):
        page = Page(html, marks=False)
    if not page.blocks:
        return ""
    found: dict[int, float] = {}
    for node, text, linked in page.blocks:
        node = page.parent[node] if page.tags[node] in ("p", "pre", "h1", "h2", "h3", "h4", "h5", "h6") else node
        found[node] = found.get(node, 0.0) + _worth(text, linked)
    for node in range(len(page.parent) - 1, 0, -1):  # children stand after their parents
        if node in found:
            found[page.parent[node]] = found.get(page.parent[node], 0.0) + found[node] / 2.0
    points = {node: worth + CONTAINERS.get(page.tags[node], 0.0) for node, worth in found.items()}
    best = max(points, key=lambda n: (points[n], -n))
    # an article is kept whole, however its text is wrapped and however long it is
    above = best
    while above > 0 and page.tags[above] not in ("article", "main"):
        above = page.parent[above]
    best = above if above > 0 else best
    kept = {best}
    if page.tags[best] not in ("article", "main"):
        enough = KEEP_SHARE * points[best]
        beside = page.parent[best]
        for node, score in points.items():
            if page.parent[node] == beside and score >= enough:
                kept.add(node)
        for node, text, linked in page.blocks:
            if page.parent[node] == beside and len(text) >= PROSE and linked * 4 < len(text):
                kept.add(node)
    else:
        # several articles in one page: those that score like the best are kept
        same = page.parent[best]
        kept |= {n for n, s in points.items() if page.parent[n] == same and page.tags[n] == page.tags[best] and s >= KEEP_SHARE * points[best]}
    inside: dict[int, bool] = {-1: False}

    def within(node: int) -> bool:
        path = []
        while node not in inside and node not in kept:
            path.append(node)
            node = page.parent[node]
        found = node in kept or inside[node]
        for n in path:
            inside[n] = found
        return found

    return " ".join(text for node, text, _ in page.blocks if within(node))


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Replace the html column by the main text."""
    kept = [c for c in pages.columns if c not in (html_col, out)]
    source = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").cast("string").alias(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = pa.array([main_text(h) for h in part.column(out).to_pylist()], part.schema.field(out).type)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], texts], [*kept, out])

    return source.mapInArrow(run, source.schema)


def of_pages(pages: DataFrame) -> DataFrame:
    """Main text and its length for every page."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
