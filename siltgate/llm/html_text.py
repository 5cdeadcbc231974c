"""Main text of web pages by scoring the tree of elements.

Every paragraph-like block earns points for its length and its commas and passes them to its
ancestors, half as much each step up. A container's points are discounted by the share of its
text inside links. The best container and those of its siblings that score well beside it are
the article; boilerplate inside is left out and its blocks are joined in page order. A class or id
that names boilerplate is a doubt only, settled by what the element holds.

Pages are independent, so this is one map over them; only the tags are parsed by hand, as pages
need not be well-formed.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements of the language by what they do to text.
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
SKIPPED = {"svg", "noscript", "template", "annotation", "annotation-xml"}
FOREIGN = {"svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
    "tr", "ul",
}
# What a start tag closes if it is open within the given limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = {"nav", "aside", "footer", "form", "button", "select", "dialog", "menu", "head"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar"}
NOISE = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advertisements?|advertising|banners?|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr"
    r"|header|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promos?|related|replies|respond"
    r"|share|sharing|sidebars?|social|sponsor(?:ed|s)?|subscribe|toolbar|widgets?)(?![a-z])"
)
# One forward pass: what follows a tag's name always matches up to the next < or > outside a quoted
# value, and quotes count only where a value starts. Nothing is given back, so nothing is read twice.
_REST = r"(?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s<>]*+|[\"']))*+"
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/<>]*+)({_REST})(>|(?=<)|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s]*+)))?")
_MAY_READ = re.compile(r"class|id|role|style|hidden", re.I)
_HIDES = re.compile(r"display\s*:\s*none")
_READ = {"class", "id", "role", "hidden", "aria-hidden", "style"}
_EMPTY = re.compile(r"(?:\A|[\s\"'])/\Z")  # but not the slash that ends an unquoted value
_SPACE = re.compile(r"\s+")
CHROME = {"header", "nav", "footer", "aside"}  # they tell the level of a page
# Siblings that are text by their kind, however short.
PROSE = {"p", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "ul", "ol", "dl", "table", "figure", "section", "details", "hgroup", "address"}
DOUBT = 0.3  # what points count for above an element whose name is noise
SIBLING = 0.2  # of the best score that a sibling needs


class Node:
    __slots__ = ("tag", "parent", "items", "noise", "doubt", "score", "length", "linked", "points", "holds")

    def __init__(self, tag: str, parent: Node | None, noise: bool, doubt: int = 0):
        self.tag, self.parent, self.noise, self.doubt = tag, parent, noise, doubt
        self.points, self.holds = 0.0, False
        self.items: list[Node | str] = []
        self.score, self.length, self.linked = 0.0, 0, 0


def _attributes(text: str) -> dict[str, str]:
    """The attributes that say what an element is for; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        if name.lower() in _READ:
            found.setdefault(name.lower(), next((v for v in values if v), "").lower())
    return found


def _is_noise(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    if tag in DROPPED or tag in SKIPPED or (tag == "header" and not inside_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in DROPPED_ROLES:
        return True
    return "style" in attributes and _HIDES.search(attributes["style"]) is not None


def _doubt(tag: str, attributes: dict[str, str], inside_article: bool) -> int:
    """2 if a whole class or id is a noise word, 1 if a part of one is, else 0."""
    most = 0
    if not attributes or tag in ("html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"):
        return most
    for token in (*attributes.get("class", "").split(), *attributes.get("id", "").split()):
        if NOISE.fullmatch(token) and not (inside_article and token == "header"):
            most = 2
        elif NOISE.search(token):
            most = max(most, 1)
    return most


class _Path:
    """The open elements, root first, and where each tag is open: every question takes constant time."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]

    @property
    def here(self) -> Node:
        return self.nodes[-1]

    def innermost(self, tags: set[str]) -> int:
        last = -1
        for tag in tags:
            places = self.places.get(tag)
            if places and places[-1] > last:
                last = places[-1]
        return last

    def open(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Close the element at ``place`` and all it holds."""
        while len(self.nodes) > place:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def close_within(self, tags: set[str], limits: set[str]) -> None:
        place = self.innermost(tags)
        if place > 0 and place > self.innermost(limits):
            self.close(place)


def parse(page: str) -> Node:
    """The page's tree. Unclosed and misnested tags are closed where the language would.

    A tag that another ``<`` or the page's end cuts short is text, but for those that hold a
    value or are a bare block's name.
    """
    root = Node("html", None, False)
    path = _Path(root)
    at = 0
    endless: set[str] = set()  # raw elements that no end tag follows
    while True:
        found = _TAG.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            path.here.items.append(text)
        if not found:
            return root
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if not found[4] and (at == len(page) or not ("=" in found[3] or (tag in BLOCKS and not found[3].strip()))):
            path.here.items.append(found[0])
            continue
        if found[1]:
            place = path.innermost({tag})
            # An inline end tag does not close the block around it.
            if place > 0 and (tag in BLOCKS or tag in SKIPPED or place > path.blocks[-1]):
                path.close(place)
            elif tag == "p":
                path.here.items.append(Node("p", path.here, False))
            continue
        if tag in ("html", "body"):
            continue
        empty = _EMPTY.search(found[3]) is not None
        if tag in RAW:
            if empty or tag in endless:
                continue
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if end is None:
                if tag in ("script", "style"):
                    return root
                endless.add(tag)
                continue
            close = page.find(">", end.start())
            at = close + 1 if close >= 0 else len(page)
            continue
        if tag in BLOCKS:
            path.close_within(FOREIGN, set())
            path.close_within({"p"}, {"table", "td", "th", "button", "caption"})
        if tag in CLOSES:
            path.close_within(*CLOSES[tag])
        inside = path.innermost({"article", "main"}) > 0
        attributes = _attributes(found[3]) if _MAY_READ.search(found[3]) else {}
        node = Node(tag, path.here, _is_noise(tag, attributes, inside), _doubt(tag, attributes, inside))
        path.here.items.append(node)
        if tag not in VOID and not empty:
            path.open(node)


def blocks(node: Node) -> list[str]:
    """The texts of the blocks under a node, noise left out, in page order."""
    found: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip()
        if text:
            found.append(text)
        line.clear()

    todo: list[Node | str | None] = [node]  # None ends a block
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(item)
        elif item.noise and item is not node:
            if item.tag in BLOCKS:
                flush()
        elif item.tag == "br":
            line.append(" ")
        else:
            if item.tag in BLOCKS:
                flush()
                todo.append(None)
            todo += reversed(item.items)
    flush()
    return found


PASSED_UP = {"p", "pre", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "dd", "dt"}


def _points(node: Node) -> float:
    """What the text of a block earns by itself."""
    inline = [i for i in node.items if isinstance(i, str) or i.tag not in BLOCKS]
    size = sum(len(i.strip()) if isinstance(i, str) else i.length for i in inline if isinstance(i, str) or not i.noise)
    if size == 0 or node.tag not in BLOCKS:
        return 0.0
    return 1 + sum(i.count(",") for i in inline if isinstance(i, str)) + min(size / 100, 3)


def _measure(root: Node) -> list[Node]:
    """The elements that are no noise, parents first, with their lengths, points and what they hold."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [i for i in node.items if isinstance(i, Node) and not i.noise]
    for node in reversed(order):  # children first
        children = [i for i in node.items if isinstance(i, Node) and not i.noise]
        node.length = len("".join([i for i in node.items if isinstance(i, str)]).strip()) + sum(c.length for c in children)
        node.linked = node.length if node.tag == "a" else sum(c.linked for c in children)
        free = 1 - node.linked / node.length if node.length else 0.0
        node.points = _points(node) * free + sum(c.points for c in children)
        node.holds = any(c.holds or c.tag in ("article", "main") for c in children)
    return order


def _settle(root: Node) -> None:
    """Doubted elements become noise, but for those that hold an article or most of the page's points.

    Where only a part of a name is a noise word, the element must be mostly links besides.
    """
    for node in _measure(root):
        if node.doubt and not node.holds and 2 * node.points <= root.points:
            node.noise = node.doubt == 2 or 2 * node.linked > node.length


def _score(root: Node) -> Node | None:
    """Give every container its score; the best one."""
    _settle(root)
    order = _measure(root)
    for node in order:
        points = _points(node)
        if not points:
            continue
        # A block's own text counts for the block, then for what contains it, half as much a step.
        target, share = (node.parent if node.tag in PASSED_UP else node), 1.0
        while target is not None and share > 0.05:
            target.score += points * share
            share *= DOUBT / 2 if target.doubt == 2 and not target.holds else 0.5
            target = target.parent
    best, most = None, 0.0
    for node in order:
        if node.tag not in BLOCKS and node is not root:
            continue
        node.score *= 1 - (node.linked / node.length if node.length else 0)
        node.score *= 1.5 if node.tag in ("article", "main") else 1.0
        if node.score > most:
            best, most = node, node.score
    return best


def main_text(page: str | None) -> str:
    """The article of a page; empty for a null or empty page or one without any text."""
    if not page:
        return ""
    root = parse(page)
    best = _score(root)
    if best is None:
        return ""
    # Inside an article element all of it is the article.
    above = best
    while above is not None and above.tag != "article":
        above = above.parent
    best = above if above is not None else best
    if best.parent is None:
        return "\n".join(blocks(best))
    return "\n".join(text for run in _beside(best) for text in blocks(run))


def _beside(best: Node) -> list[Node]:
    """The best container with the siblings that belong to it, in page order; loose text as runs of its own."""
    items = best.parent.items
    # A page's own level has all sorts beside the article; inside a container of its own, all is of a piece.
    page_level = best.parent.parent is None or any(isinstance(i, Node) and i.tag in CHROME for i in items)
    kept = []
    for place, item in enumerate(items):
        if not isinstance(item, Node) or item.noise:
            continue
        dense = item.length and item.linked / item.length > 0.3
        if item is best:
            kept.append(place)
        elif best.tag == "article":
            if item.tag == "article" and item.score >= SIBLING * best.score:
                kept.append(place)
        elif item.length and not dense and item.doubt < 2 and item.tag in BLOCKS:
            if not page_level or item.tag in PROSE or item.score >= SIBLING * best.score:
                kept.append(place)
    first, last = kept[0], kept[-1]
    runs: list[Node] = []
    loose: Node | None = None
    for place in range(first, last + 1):
        item = items[place]
        if isinstance(item, Node) and item.tag in BLOCKS:
            loose = None
            dense = item.length and item.linked / item.length > 0.3
            between = best.tag != "article" and not item.noise and item.doubt < 2 and not dense
            if place in kept or between:
                runs.append(item)
        elif best.tag != "article":
            if loose is None:
                loose = Node("div", None, False)
                runs.append(loose)
            loose.items.append(item)
    return runs


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) added in place of the html.

    Null, empty and text-free pages have an empty text. Pages of any length are read whole, and
    malformed ones as far as they go. Columns of ``pages`` called text or n_chars are replaced.
    """

    @F.pandas_udf("string")
    def run(found: pd.Series) -> pd.Series:
        return found.map(lambda page: main_text(page), na_action=None)

    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    text: Column = run(F.col(html_col))
    return pages.select(*kept, text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
