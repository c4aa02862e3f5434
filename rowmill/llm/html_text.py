"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import log1p

import pyarrow as pa
from pyspark.sql import Column, functions as F

from rowmill.llm.common import utf8

# a tag with quoted attributes, a comment, or a declaration; the possessive repeats never go back
_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")

#: Elements of HTML by what they do to text.
RAW_TEXT = frozenset("script style noscript template iframe noembed noframes xmp textarea title svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
BOILERPLATE = frozenset(
    "head nav footer aside form select button option optgroup datalist fieldset legend dialog menu object canvas audio "
    "video map progress meter output".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FLOW = HEADINGS | frozenset("p ul ol dl blockquote pre table figure".split())
#: An element closes open ones of these names, up to the nearest of the names after the bar.
IMPLIED_ENDS = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("thead tbody tfoot tr td th", "table"),
    "thead": ("thead tbody tfoot tr td th", "table"),
    "tfoot": ("thead tbody tfoot tr td th", "table"),
    "body": ("head", "html"),
}
#: Words in an element's class, id or role that mark what is not the article.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo "
    "promoted promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations comment comments commentlist disqus reply replies respond "
    "widget widgets toolbar pagination pager copyright complementary contentinfo search form dialog alertdialog".split()
)
#: First words of names that tell of the layout, and words that make a header the article's own.
LAYOUT = frozenset("has with without no not is hide show".split())
ARTICLE_PARTS = frozenset("article post entry story content section table t".split())
#: A path is content from this share of the best path's score; outside an article, one with more links is not.
LEAST_SCORE, MOST_LINKS = 0.5, 0.5


def _marks(name: str) -> set[str]:
    """The words of a class name that mark boilerplate; names such as has-sidebar tell of the layout only."""
    words = re.split(r"[^a-z0-9]+", name)
    if words[0] in LAYOUT:
        return set()
    return {w for w in words if w in MARKED or w in ("header", "head") and not ARTICLE_PARTS & set(words)}


class _Element:
    __slots__ = ("name", "path", "dropped", "marked", "articles", "header", "whole")

    def __init__(self, name: str, above: _Element | None, attributes: str):
        self.name = name
        self.path = above.path if above and name in INLINE else ((*above.path, name) if above else ())
        self.dropped = bool(above and above.dropped) or name in BOILERPLATE
        self.articles = (above.articles if above else ()) + ((self,) if name in ("article", "main") else ())
        self.header = (above.header if above else False) or name == "header"
        if self.header and name in HEADINGS and self.articles:
            self.header = False  # an article's own heading
        self.marked = above.marked if above else ()
        self.whole = False  # whether an article lies in it, which no mark can take away
        if attributes and name not in ("html", "body", "main", "article"):
            words: set[str] = set()
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), "".join(values).lower()
                if key in ("class", "id", "role"):
                    words.update(word for name in value.split() for word in _marks(name))
                elif key == "hidden" or key == "aria-hidden" and value == "true":
                    self.dropped = True
                elif key == "style" and "display:none" in value.replace(" ", ""):
                    self.dropped = True
            if words:
                self.marked = (*self.marked, self)


class _Block:
    __slots__ = ("element", "text", "links")

    def __init__(self, element: _Element, text: str, links: int):
        self.element, self.text, self.links = element, text, links


def blocks_of(page: str) -> Iterator[_Block]:
    """Runs of text between block elements, in page order, with the element that they stand in."""
    root = _Element("", None, "")
    stack, pieces, links, linked = [root], [], 0, 0

    def top_block() -> _Element:
        return next(e for e in reversed(stack) if e.name not in INLINE)

    def ended() -> _Block | None:
        nonlocal links
        text = " ".join("".join(pieces).split())
        block = _Block(stack[-1], text, links) if text else None
        pieces.clear()
        links = 0
        return block

    def add(raw: str) -> None:
        nonlocal links
        if raw:
            text = html.unescape(raw)
            pieces.append(text)
            if linked:
                links += len("".join(text.split()))

    def close(names: frozenset | set, until: frozenset | set) -> None:
        """Close the innermost open element of ``names`` and all in it, unless one of ``until`` lies before it."""
        nonlocal linked
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                linked -= sum(e.name == "a" for e in stack[k:])
                del stack[k:]
                return
            if stack[k].name in until:
                return

    at = 0
    while True:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        add(page[at:start])
        found = _MARKUP.match(page, start) or _LOOSE_TAG.match(page, start)
        if not found:
            if page.startswith("</", start) and len(page) > start + 2:
                at = (page.find(">", start) + 1) or len(page)
            else:
                add("<")
                at = start + 1
            continue
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name or found.group(0)[-1] != ">":
            continue  # a comment, a declaration, or a tag that the page's end cuts off
        if name == "br":
            pieces.append(" ")
            continue
        if found.group(1):
            inline = name in INLINE
            if not inline and any(e.name == name for e in stack):
                if block := ended():
                    yield block
                close({name}, set())
            elif inline:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        linked -= name == "a"
                        del stack[k]
                        break
                    if stack[k].name not in INLINE:
                        break
            continue
        if name in RAW_TEXT:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            if not found.group(3).endswith("/") or name not in ("svg", "math"):
                at = end.end() if end else len(page)
            continue
        if name not in INLINE:
            if block := ended():
                yield block
            if name in VOID:
                continue
            if name in CLOSES_PARAGRAPH:
                close({"p"}, {"button", "td", "th", "table", "object"})
            if name in HEADINGS and top_block().name in HEADINGS:
                close({top_block().name}, set())
            if name in IMPLIED_ENDS:
                inner, outer = (frozenset(x.split()) for x in IMPLIED_ENDS[name])
                while any(e.name in inner for e in stack[_last(stack, outer) + 1 :]):
                    close(inner, outer)
        elif name in VOID:
            continue
        element = _Element(name, stack[-1], found.group(3))
        if name in ("article", "main"):
            for e in stack:
                e.whole = True
        stack.append(element)
        linked += name == "a"
    if block := ended():
        yield block


def _last(stack: list[_Element], names: frozenset) -> int:
    return max((k for k, e in enumerate(stack) if e.name in names), default=0)


def main_text(page: str) -> str:
    """The article's blocks, joined by newlines."""
    blocks = [b for b in blocks_of(page) if not b.element.dropped]
    unmarked = [b for b in blocks if all(m.whole for m in b.element.marked) and not b.element.header]
    blocks = unmarked or blocks
    articles = {id(e): e for b in blocks for e in b.element.articles if e.name == "article"}
    outer = [e for e in articles.values() if not any(id(x) in articles for x in e.articles[:-1])]
    mains = {id(e): e for b in blocks for e in b.element.articles if e.name == "main"}
    scope = outer[0] if len(outer) == 1 else next(iter(mains.values())) if len(mains) == 1 else None
    if scope:  # all that nothing marks belongs to it, wherever its longest texts stand
        return "\n".join(b.text for b in blocks if scope in b.element.articles)
    chosen = content_paths(blocks)
    return "\n".join(b.text for b in blocks if b.element.path in chosen)


def content_paths(blocks: list[_Block]) -> set[tuple[str, ...]]:
    """The tag paths that hold content on a page without an article of its own.

    Per path the text outside links and the punctuation are counted and divided by its blocks. Both ratios are smoothed
    with those of the paths beside it (the same parent) and fused into one score; paths with at least ``LEAST_SCORE`` of
    the best score are content. So is what lies in the same container as a content path and is no list of links.
    """
    texts: dict[tuple, list[int]] = {}
    for b in blocks:
        counts = texts.setdefault(b.element.path, [0, 0, 0, 0])
        for k, n in enumerate((1, max(0, len(b.text) - b.links), len(_PUNCTUATION.findall(b.text)), min(b.links, len(b.text)))):
            counts[k] += n
    beside: dict[tuple, list[int]] = {}
    for path, counts in texts.items():
        around = beside.setdefault(path[:-1], [0, 0, 0, 0])
        for k in range(4):
            around[k] += counts[k]

    def score(path: tuple) -> float:
        (n, chars, marks, _), (m, more, signs, _) = texts[path], beside[path[:-1]]
        return log1p((chars / n + more / m) / 2) * (1 + log1p((marks / n + signs / m) / 2))

    def linked(path: tuple) -> bool:
        _, chars, _, links = texts[path]
        return links > MOST_LINKS * (chars + links)

    scores = {path: score(path) for path in texts if not linked(path)}
    if not scores:
        return set()
    best = max(scores.values())
    content = {path for path, value in scores.items() if value >= LEAST_SCORE * best}
    containers = {path[:-1] for path in content}
    for path in texts:
        if path not in content and not linked(path):
            for depth in range(len(path)):
                inside = path[depth] if depth < len(path) else ""
                if path[:depth] in containers and (path[:depth] not in ((), ("html",), ("html", "body"), ("body",)) or inside in FLOW):
                    content.add(path)
                    break
    return content


def extracted(page: Column) -> Column:
    """The main text of an HTML page: what is in the article, without markup, boilerplate and reader comments.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by newlines in page
    order, and nothing is cut off. Broken pages are read like browsers read them: open elements are closed where HTML
    says so, a tag that the end of the page cuts off is dropped. Null and empty pages have an empty text, a page without
    tags is one block.
    """

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text((p.as_py() or b"").decode("utf-8", "replace")) for p in pages], pa.string())

    return extract(utf8(page))
