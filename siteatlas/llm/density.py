"""Main text of a page by composite text density.

For every element of the page's tree: characters per tag, scaled down by the share of its characters and tags that are links. Elements that only
format a few words of a line are no tags of this count. An element's density sum adds the densities of its children and of its own text. The
element with the largest sum is the article. The least density and the least sum on the way from it to the body are thresholds:
in every other subtree that reaches the density, the element with the largest sum is content too if it reaches the sum, so an article in
several parts is whole, and a line of text that stands alone, however dense, is not part of it.

Scripts, menus and the like leave the tree first. Names of classes and ids are only asked about what density cannot tell: text that is not the
article's although it is laid out like it, such as a comment inside it. Forms, and elements so named, leave the tree unless they
hold the article or most of the page's text (``_leave_out``); and of two elements on one path that hold the same text within an article or main
element, this one is taken.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without an end tag, elements whose content is not markup, and elements that begin a block.
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"})
RAW = frozenset({"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"})
BLOCK = frozenset(
    {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption"}
    | {"figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p"}
    | {"pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
)
# A start tag ends these open elements, looked for up to the named limits.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements that format words inside a line.
FORMAT = frozenset(
    {"abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span"}
    | {"strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
)
ENDS_P = BLOCK - {"body", "html", "caption", "tbody", "thead", "tfoot", "tr", "td", "th", "option", "legend"}
# Elements, roles and words of class or id that mark what is not the article.
NOT_ARTICLE = frozenset(
    {"aside", "button", "dialog", "footer", "head", "header", "iframe", "input", "menu", "nav", "noembed", "noframes", "noscript", "script", "select"}
    | {"style", "svg", "template", "textarea", "title", "xmp"}
)
NOT_ARTICLE_ROLES = frozenset({"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "menu", "menubar", "navigation", "search"})
NOT_ARTICLE_WORDS = frozenset(
    {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie"}
    | {"cookies", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo"}
    | {"promoted", "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar"}
)
ARTICLE = frozenset({"article", "main"})

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=$|[\s/])""", re.I)
_COMMENT_END = re.compile("-?>")
_COMMENT_END_LATER = re.compile("--!?>")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


class _Node:
    __slots__ = ("tag", "parent", "children", "skip", "names", "chars", "tags", "link_chars", "links", "own", "density", "total", "content")

    def __init__(self, tag: str, parent, skip: bool, names: frozenset = frozenset()):
        self.tag, self.parent, self.skip, self.names = tag, parent, skip, names
        self.children = []  # nodes and strings, in page order
        self.chars = self.tags = self.link_chars = self.links = self.own = 0
        self.density = self.total = 0.0
        self.content = False


def _not_article(tag: str, attributes: str) -> tuple[bool, frozenset]:
    """Whether the element is never article text; and what in its tag, role, class and id says that it may not be, plurals as singulars."""
    if tag in NOT_ARTICLE:
        return True, frozenset()
    found = {"form"} if tag == "form" else set()
    if not attributes or tag in ("html", "body"):
        return False, frozenset(found)
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if tag not in ARTICLE and (name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in NOT_ARTICLE_ROLES):
            return True, frozenset()
        if name == "role" and value == "form":
            found.add("form")
        if name in ("class", "id"):
            found.update(word.removesuffix("s") for word in NOT_ARTICLE_WORDS.intersection(_WORD.findall(value)))
    return False, frozenset(found)


def parse(html: str) -> _Node:
    """The page's tree. Broken markup is read on: unknown end tags are dropped, open elements end where an outer one ends."""
    root = _Node("html", None, False)
    open_, at, size = [root], 0, len(html)
    places = {}  # of every tag the places of its open elements

    def text(raw: str) -> None:
        if raw and not open_[-1].skip:
            open_[-1].children.append(raw)

    def last(tags) -> int:
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def close(tags, limits=frozenset()) -> None:
        at = last(tags)
        if at > last(limits):
            while len(open_) > at:
                places[open_.pop().tag].pop()

    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            text(html[at:])
            break
        text(html[at:mark])
        if html.startswith("<!--", mark):
            end = _COMMENT_END.match(html, mark + 4) or _COMMENT_END_LATER.search(html, mark + 4)
            at = end.end() if end else size
            continue
        if mark + 1 < size and html[mark + 1] in "!?" or html.startswith("</", mark) and not html[mark + 2 : mark + 3].isalpha():
            end = html.find(">", mark)
            at = end + 1 if end >= 0 else size
            continue
        found = _TAG.match(html, mark)
        if not found:
            if html[mark + 1 : mark + 2].isalpha() or html.startswith("</", mark):
                break  # the page ends inside a tag
            text("<")
            at = mark + 1
            continue
        at = found.end()
        slash, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        tag = name.lower()
        if slash:
            close({tag})
            continue
        if tag == "html" or tag == "body" and places.get(tag):
            continue
        if tag in ENDS_P:
            close({"p"}, {"table", "td", "th", "button", "object"})
        if tag in ENDS:
            close(*ENDS[tag])
        parent = open_[-1]
        never, names = _not_article(tag, attributes)
        node = _Node(tag, parent, parent.skip or never, names)
        parent.children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else size
        places.setdefault(tag, []).append(len(open_))
        open_.append(node)
    return root


def _in_order(root: _Node) -> list[_Node]:
    """The elements that are not left out, in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.skip:
            order.append(node)
            stack.extend(c for c in reversed(node.children) if isinstance(c, _Node))
    return order


def _leave_out(root: _Node) -> None:
    """Decode and count the text, and leave out the elements whose names say that they are not the article.

    One that encloses an article or main element with text stays: it is a wrapper, whatever its name says. An article that bears the same
    name, a comment among comments, does not count; nor does one in an element that is itself left out. One with more than half of the
    characters outside links of the article or main around it, or else of the page, stays too, but beside an article or main that no such
    element encloses it is an advertisement or the like, however long. If nothing but links would remain, all stay.
    """
    order = _in_order(root)
    plain, holds = {}, {}  # of every subtree: characters outside links, the names of each of its articles
    for node in reversed(order):
        node.children = [c if isinstance(c, _Node) else unescape(c) for c in node.children]
        node.own = sum(len(_SPACE.sub("", c)) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if isinstance(c, _Node) and not c.skip]
        plain[node] = 0 if node.tag == "a" else node.own + sum(plain[c] for c in inner)
    named = [n for n in order if n.names and n.tag not in ARTICLE]
    if not named:
        return
    scope, clear = {}, {}  # the innermost article or main around an element; whether no name is on the way to it
    for node in order:
        up = node.parent
        scope[node] = up if up is not None and up.tag in ARTICLE else scope.get(up)
        clear[node] = not node.names and clear.get(up, True)
    page = None if any(clear[n] and n.tag in ARTICLE and plain[n] for n in order) else root
    gone = set()
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, _Node) and not c.skip and c not in gone]
        holds[node] = frozenset().union(*(holds[c] for c in inner))
        if node.tag in ARTICLE:
            if plain[node]:
                holds[node] |= {node.names if node.tag == "article" else frozenset()}
        elif node.names and all(names & node.names for names in holds[node]):
            around = scope[node] or page
            if around is None or 2 * plain[node] <= plain[around]:
                gone.add(node)
    left = {}
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, _Node) and not c.skip and c not in gone]
        left[node] = 0 if node.tag == "a" else node.own + sum(left[c] for c in inner)
    if left[root] or not plain[root]:
        for node in gone:
            node.skip = True


def _density(chars: int, tags: int, link_chars: int, links: int, share: float) -> float:
    """Characters per tag, less where many of them are links; ``share`` is the page's share of characters in links."""
    if not chars:
        return 0.0
    tags, links, linked = max(tags, 1), max(links, 1), max(link_chars, 1)
    base = math.log(chars / max(chars - link_chars, 1) * linked + share * chars + math.e)
    return chars / tags * max(0.0, math.log(chars / linked * tags / links, base))


def _measure(root: _Node) -> list[_Node]:
    """Sums over subtrees, children first; returns the elements in page order."""
    _leave_out(root)
    order = _in_order(root)
    for node in reversed(order):
        node.chars += node.own
        if node.tag == "a":
            node.link_chars = node.chars
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + (node.tag not in FORMAT)
            up.links += node.links + (node.tag == "a")
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        node.density = _density(node.chars, node.tags, node.link_chars, node.links, share)
    for node in order:
        node.total = _density(node.own, 0, 0, 0, share) + sum(c.density for c in node.children if isinstance(c, _Node) and not c.skip)
    return order


def _choose(root: _Node, order: list[_Node]) -> None:
    """Mark the content: the subtree of the largest sum, and others by the thresholds of its way to the body."""
    best = max(order, key=lambda n: n.total)  # the first of equal ones, so the outer
    density, total, way, node = best.density, best.total, set(), best
    while node is not None:
        if node.parent is not None or node is best or not any(c.tag == "body" for c in way):  # html adds nothing to its body
            density, total = min(density, node.density), min(total, node.total)
        way.add(node)
        node = node.parent
    top, bottom = {}, {}  # of every subtree the element with the largest sum; whether the subtree holds the best element or is inside it
    for node in reversed(order):
        top[node] = max([node, *(top[c] for c in node.children if isinstance(c, _Node) and not c.skip)], key=lambda n: n.total)
    for node in order:
        bottom[node] = node is best or bottom.get(node.parent, False)
        if node not in way and not bottom[node] and node.chars and node.density >= density and top[node].total >= total:
            top[node].content = True
    best.content = True
    while best.parent is not None:  # a tie: an article or main element that holds little else beside it
        best = best.parent
        if best.tag in ARTICLE:
            best.content = True


def extract(html: str | None) -> str:
    """The blocks of the chosen subtrees in page order, one a line."""
    if not html:
        return ""
    root = parse(html)
    order = _measure(root)
    _choose(root, order)
    blocks, now = [], []

    def end_block() -> None:
        block = _SPACE.sub(" ", "".join(now)).strip()
        now.clear()
        if block:
            blocks.append(block)

    stack = [(root, False, False)]
    while stack:
        item, inside, leaving = stack.pop()
        if leaving:
            end_block()
        elif isinstance(item, str):
            if inside:
                now.append(item)
        elif not item.skip:
            inside = inside or item.content
            if item.tag == "br":
                now.append(" ")
            elif item.tag in BLOCK:
                end_block()
                stack.append((item, inside, True))
            stack.extend((c, inside, False) for c in reversed(item.children))
        elif item.tag in BLOCK:
            end_block()
    end_block()
    return "\n".join(blocks)


def main_text(html: Column) -> Column:
    """The main text of a page as a column; empty for null."""

    @F.arrow_udf("string")
    def extracted(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for page in pages:
            yield pa.array([extract(p) for p in page.to_pylist()], pa.string())

    return extracted(html.cast("string"))


def pages_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars), one row per row of ``pages``. A null or empty page, or one without article text, has an empty text;
    repeated rows and null ids stay as they are; other columns are not read."""
    out = pages.select(id_col, url_col, main_text(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
