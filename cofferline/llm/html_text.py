"""Main text of web pages by scoring a tree.

The page is parsed to a tree and furniture (menus, headers, footers, side bars, notices, adverts, forms,
scripts, reader comments) is cut off: by tag, role or visibility at once, by words in class, id or
label after scoring, and only where the element does not hold most of the page's points. Paragraphs
pass points for length and commas to their ancestors, a container's points are discounted by its
share of link text, and the best container is kept with everything around it that is not mostly
links.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?:(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<rest>[^>]*+)(?:>|\Z))|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?P<name>[^\s=/>\"']+)(?:\s*=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s>\"']+)))?")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_DROP = frozenset(
    "script style noscript template nav footer aside form button select option textarea input iframe svg math "
    "canvas object audio video dialog menu head title noembed noframes".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_MAIN = frozenset(("article", "main"))
#: Opening one of the keys ends an open element of the values; rows and cells have their own rule.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table div article section body html main aside nav header footer form blockquote td th".split())
#: Words in class, id or aria-label that mark furniture.
_FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertise(?:ment)?s?|adsense|banners?|sponsor(?:ed|s)?|promo(?:tion|s)?|sidebars?|side-?nav|menus?|menubar|nav|"
    r"navbar|navigation|breadcrumbs?|footers?|masthead|site-?header|page-?header|topbar|cookies?|consent|gdpr|notices?|"
    r"alerts?|pop-?ups?|modal|overlay|newsletter|subscribe|subscription|signup|login|search|comments?|commentlist|"
    r"disqus|respond|replies|discussion|share|sharing|social|related|recommended|recommendations?|widgets?|toolbar|"
    r"pagination|pager|skip-?link|hidden|complementary|contentinfo)(?:$|[\s_-]|\d)",
    re.I,
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|replies|discussion)(?:$|[\s_-]|\d)", re.I)
#: An element that only a word marks as furniture stays while it holds more than this share of all points.
_MOST_POINTS = 0.5
#: A part beside the best container is kept while less of its text than this is in links.
_MOST_LINKED = 0.5


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "suspect", "role", "score", "points", "chars", "linked")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.dropped, self.suspect, self.role = parent is not None and parent.dropped, False, None
        self.score, self.points, self.chars, self.linked = 0.0, 0.0, 0, 0


def _judge(node: Node, attrs: str) -> None:
    """Set an element's role, and whether it is cut off or only suspected to be furniture."""
    values = {}
    for found in _ATTR.finditer(attrs):
        values[found["name"].lower()] = found["a"] or found["b"] or found["c"] or ""
    role = node.role = values.get("role", "").lower()
    if role in ("main", "article"):
        return
    names = " ".join(values.get(x, "") for x in ("class", "id", "aria-label"))
    if "hidden" in values or values.get("aria-hidden") == "true" or _HIDDEN.search(values.get("style", "")):
        node.dropped = True
    elif node.tag in ("article", "main", "body", "html"):
        node.dropped = bool(re.search(r"(?:^|[\s_-])comments?(?:$|[\s_-]|\d)", values.get("class", ""), re.I))
    elif role in ("navigation", "banner", "search", "alert", "dialog", "form", "menu", "complementary", "contentinfo"):
        node.dropped = True
    elif names.strip():
        node.dropped = bool(_COMMENTS.search(names))
        node.suspect = not node.dropped and bool(_FURNITURE.search(names))


class _Open:
    """The open elements, from the root inwards, with the depths at which names are open, so that no end
    or implied end has to look through all of them."""

    def __init__(self, root: Node):
        self.path, self.depths = [root], {}
        self.blocks, self.scopes, self.cells = [], [], []

    def _marks(self, tag: str) -> list[list[int]]:
        out = [self.depths.setdefault(tag, [])]
        if tag in _BLOCK:
            out.append(self.blocks)
        if tag in ("td", "th"):
            out.append(self.cells)
        elif tag in _SCOPE:
            out.append(self.scopes)
        return out

    def push(self, node: Node) -> None:
        for marks in self._marks(node.tag):
            marks.append(len(self.path))
        self.path.append(node)

    def close_from(self, depth: int) -> None:
        """Close the element at this depth and all inside it."""
        while len(self.path) > depth:
            for marks in self._marks(self.path.pop().tag):
                marks.pop()

    def deepest(self, *tags: str) -> int:
        return max((self.depths[tag][-1] for tag in tags if self.depths.get(tag)), default=0)

    def end(self, tag: str) -> None:
        """A written end; a stray one does nothing, and an inline one does not reach out of its block."""
        depth = self.deepest(tag)
        if depth and (tag in _BLOCK or not self.blocks or depth > self.blocks[-1]):
            self.close_from(depth)

    def imply(self, tag: str) -> None:
        """Ends that an opened element implies: of a paragraph by blocks, of list items and cells by their like."""
        scope = self.scopes[-1] if self.scopes else 0
        inner = max(scope, self.cells[-1] if self.cells else 0)
        if tag in _BLOCK and self.deepest("p") > inner:
            self.close_from(self.deepest("p"))
        if tag == "tr":
            depth = self.deepest("tr")
            depth = depth if depth > scope else self.deepest("td", "th")
            if depth > scope:
                self.close_from(depth)
        elif tag in ("td", "th"):
            if self.deepest("td", "th") > scope:
                self.close_from(self.deepest("td", "th"))
        elif tag in _ENDS:
            inner = max(self.scopes[-1] if self.scopes else 0, self.cells[-1] if self.cells else 0)
            if self.deepest(*_ENDS[tag]) > inner:
                self.close_from(self.deepest(*_ENDS[tag]))


def parse(page: str) -> Node:
    """The page as a tree. Ends that HTML implies are supplied, stray ends are ignored."""
    root = Node("#root", None)
    at, opened, size = 0, _Open(root), len(page)
    while at < size:
        found = _TAG.search(page, at)
        stop, here = found.start() if found else size, opened.path[-1]
        if stop > at and not here.dropped:
            text = page[at:stop]
            here.children.append(html.unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        name = found["name"]
        if not name:
            continue
        tag = name.lower()
        if found["end"]:
            opened.end(tag)
            continue
        attrs = found["attrs"] or found["rest"] or ""
        opened.imply(tag)
        here = opened.path[-1]
        node = Node(tag, here)
        if attrs and not attrs.isspace() and not node.dropped:
            _judge(node, attrs)
        if tag in _DROP or tag == "header" and not node.dropped and not _inside_main(here):
            node.dropped = True
        here.children.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
            opened.push(node)
        elif tag not in _VOID and not attrs.endswith("/"):
            opened.push(node)
    return root


def _marked(node: Node) -> bool:
    return node.tag in _MAIN or node.role in ("main", "article")


def _inside_main(node: Node | None) -> bool:
    while node is not None:
        if _marked(node):
            return True
        node = node.parent
    return False


def _score(root: Node) -> list[Node]:
    """Give points; returns all kept elements in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        node.score = node.points = 0.0
        order.append(node)
        stack.extend(child for child in reversed(node.children) if isinstance(child, Node))
    for node in reversed(order):
        own = "".join(child for child in node.children if isinstance(child, str))
        kids = [child for child in node.children if isinstance(child, Node) and not child.dropped]
        node.chars = len(" ".join(own.split())) + sum(kid.chars for kid in kids)
        node.linked = node.chars if node.tag == "a" else sum(kid.linked for kid in kids)
        text = node.tag in ("p", "pre", "blockquote", "td", "li") or any(
            isinstance(child, str) and not child.isspace() for child in node.children
        )
        node.points = sum(kid.points for kid in kids)
        if not text or node.parent is None or node.tag not in _BLOCK or node.chars < 25:
            continue
        commas = sum(child.count(",") for child in node.children if isinstance(child, str))
        points = 1 + commas + min(node.chars // 100, 3)
        node.points += points * (1 - node.linked / node.chars)
        above, share = node.parent, 1.0
        while above is not None and share > 0.2:
            above.score += points * share
            above, share = above.parent, share / 2
    for node in order:
        node.score *= 1 - (node.linked / node.chars if node.chars else 0.0)
    return order


def _without_furniture(root: Node) -> list[Node]:
    """Cut off what a word marks as furniture and what does not hold most of the page's points, outermost
    first; inside a part that stays the same holds. Returns the scored elements that are left."""
    order = _score(root)
    cut = False
    for node in order:
        if node.suspect and not _within_dropped(node) and node.points <= _MOST_POINTS * root.points:
            node.dropped = cut = True
    return _score(root) if cut else order


def _within_dropped(node: Node) -> bool:
    """Elements of a part that has just been cut off are met after it."""
    node.dropped = node.dropped or (node.parent is not None and node.parent.dropped)
    return node.dropped


def _containers(root: Node) -> list[Node]:
    """The best container and what belongs to it, in page order."""
    order = _without_furniture(root)
    best = max(order, key=lambda node: node.score)
    if best.score <= 0:
        marked = [node for node in order if _marked(node) and node.chars]
        bodies = [node for node in order if node.tag == "body"]
        return marked[:1] or bodies[:1] or [root]
    node: Node | None = best
    while node is not None:
        if _marked(node):
            best = node
        node = node.parent
    return _around(best)


def _links(parts: list[Node | str]) -> float:
    chars = sum(len(" ".join(part.split())) if isinstance(part, str) else part.chars for part in parts)
    return sum(part.linked for part in parts if isinstance(part, Node)) / chars if chars else 1.0


def _units(parent: Node, path: Node) -> Iterator[list[Node | str]]:
    """Children of an element: blocks and ``path`` one by one, bare text with the inline elements around it."""
    run: list[Node | str] = []
    for child in parent.children:
        if isinstance(child, Node) and child.dropped:
            continue
        if isinstance(child, Node) and (child is path or child.tag in _BLOCK or child.score > 0):
            if run:
                yield run
            yield [child]
            run = []
        else:
            run.append(child)
    if run:
        yield run


def _around(best: Node) -> list[Node]:
    """The best container with all that is not furniture and mostly no links beside it, up to the highest
    element in which other parts score. An element that holds nothing else is passed through."""
    top, node = best, best
    while node.parent is not None and node.tag not in ("body", "html"):
        above = node.parent
        others = [unit for unit in _units(above, node) if unit[0] is not node and _links(unit) < _MOST_LINKED]
        if others and (top is best or any(isinstance(part, Node) and part.score > 0 for unit in others for part in unit)):
            top = above
        node = above
    kept, node = _inside(best), best
    while node is not top:
        above, parts = node.parent, []
        for unit in _units(above, node):
            parts += kept if unit[0] is node else _unlinked(unit)
        kept, node = parts, above
    return kept


def _unlinked(unit: list[Node | str]) -> list[Node]:
    """A part as elements, or nothing if it is mostly links."""
    if _links(unit) >= _MOST_LINKED:
        return []
    if len(unit) > 1 or isinstance(unit[0], str):
        block = Node("div", None)
        block.children = unit
        return [block]
    return unit


def _inside(best: Node) -> list[Node]:
    """The best container; of a whole page only the parts that are not mostly links."""
    if best.tag not in ("body", "html", "#root"):
        return [best]
    out: list[Node] = []
    for unit in _units(best, best):
        out += _unlinked(unit) if not (isinstance(unit[0], Node) and unit[0].tag in ("body", "html")) else _inside(unit[0])
    return out


def _blocks(node: Node, out: list[str]) -> None:
    """Texts of the blocks below ``node`` in page order; deep trees need no recursion."""
    line: list[str] = []

    def flush():
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif not item.dropped:
            if item.tag in _BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by empty lines."""
    if not page:
        return ""
    out: list[str] = []
    for node in _containers(parse(page)):
        _blocks(node, out)
    return "\n\n".join(out)


def _extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        yield pa.array([main_text(page) for page in pages.to_pylist()], pa.string())


def extract_main_text(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """Add ``text``, the main text of every page; a column of that name is replaced.

    Null and empty pages give an empty text; a page without tags is one block; a page on which nothing
    scores gives the text of its article, else of its body. Repeated rows give the same text each. Rows stay
    where they are: no shuffle.
    """
    return pages.withColumn(text, F.arrow_udf(_extract, "string")(F.col(page)))
