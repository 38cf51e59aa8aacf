"""Main text of a web page by composite text density.

What says plainly that it is boilerplate is cut off first: tags such as ``nav`` or ``script``,
roles, and class names or ids made of such words alone (``cookie-notice``, not ``share-price``).
For every node left, the density is its characters per tag, adjusted by the share of link
text; a node's children's densities are summed. The node with the largest sum is the centre
of the text, the least density on its path up to the top the threshold. On that path the
whole page is written, direct text included, but for blocks beside the text that stay below
the threshold:

* where the centre lies in an ``article`` or ``main``, or around some, all blocks without a
  heading outside of them;
* elsewhere, blocks with a doubtful name (``share-price``), and blocks of links alone, unless
  these hold paragraphs.

Links that follow the text at once, as a list of sources does, stay. Nothing inside an article, or inside the centre, goes by its density.

Defined results: NULL and empty pages have empty text, text outside any tag is a block,
unclosed and crossing tags are closed where HTML closes them or where their parent ends,
pages of any depth and length are read whole, repeated pages are read one by one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select textarea option iframe "
    "object svg canvas audio video dialog menu input label map applet".split()
)
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside form caption".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion promoted "
    "banner cookie cookies consent gdpr notice notices notification comment comments commentlist disqus replies reply respond "
    "sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead social share sharing "
    "related recommended recommendations newsletter subscribe subscription signup login search pagination pager popup modal "
    "overlay widget widgets skip toolbar paywall disclaimer".split()
)
#: Words that say nothing about a block beside one of those above: ``site-footer``, ``ad-slot-2``.
NEUTRAL_NAMES = frozenset(
    "site page main global top bottom left right upper lower inner outer primary secondary block box list item items section area "
    "wrap wrapper container content inline slot unit bar panel pane col column row grid group post article articles story stories "
    "user users reader readers form button buttons link links text title header head icon icons js ui sticky fixed desktop mobile".split()
)
#: Headers of a page go, headers within the article hold its title.
HEADER_NAMES = frozenset(("header", "topbar"))
NEVER_DROPPED = frozenset(("html", "body", "main", "article"))
#: A start tag that closes an open element, up to one of the given limits.
_P_ENDS = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "caption"}
_CLOSES = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dd", {"dl"}), "dd": ("dt", {"dl"}), "tr": ("tr", {"table"}),
    "td": ("td", {"tr", "table"}), "th": ("th", {"tr", "table"}), "option": ("option", {"select"}),
}
_SCOPES = frozenset("html body table td th caption article section div main aside header footer nav blockquote li dd".split())
_NAME = re.compile(r"[^a-z]+")
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_TEXTS = ("article", "main")


class Node:
    __slots__ = (
        "best", "chars", "children", "density", "doubtful", "headings", "link_chars", "link_tags", "paragraphs", "parent", "sum", "tag", "tags",
    )

    def __init__(self, tag: str, parent: Node | None, doubtful: bool = False):
        self.tag, self.parent, self.children, self.doubtful = tag, parent, [], doubtful
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.headings, self.paragraphs = int(tag in _HEADINGS), int(tag == "p")
        self.density = self.sum = 0.0
        self.best = self


class _Builder(HTMLParser):
    """The tree of what isn't dropped; children are nodes and texts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", None)
        self.nodes = [self.root]  # parents before children
        self.stack = [self.root]
        self.open: dict[str, int] = {}
        self.dropped = 0  # depth of the stack where dropping began

    def _push(self, tag: str, kept: bool, doubtful: bool = False) -> None:
        node = Node(tag, self.stack[-1], doubtful)
        if kept:
            self.stack[-1].children.append(node)
            self.nodes.append(node)
        self.stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            self.open[self.stack.pop().tag] -= 1
        if self.dropped and len(self.stack) < self.dropped:
            self.dropped = 0

    def _close(self, tag: str, limits: frozenset | set = frozenset()) -> None:
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            here = self.stack[i].tag
            if here == tag:
                self._pop_to(i)
                return
            if here in limits:
                return

    def _named(self, tag: str, attrs: dict[str, str]) -> tuple[bool, bool]:
        """Whether an element is boilerplate by its tag, role or name, and whether it may be."""
        if tag in NEVER_DROPPED:
            return False, False
        inside = self.open.get("article") or self.open.get("main")
        if tag in DROPPED or tag == "header" and not inside:
            return True, False
        if attrs.get("role", "").lower() in DROPPED_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True, False
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
            return True, False
        doubtful = False
        for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
            parts = {x for x in _NAME.split(name) if x}
            told = parts & (DROPPED_NAMES if inside else DROPPED_NAMES | HEADER_NAMES)
            if told and told | NEUTRAL_NAMES >= parts:
                return True, False
            doubtful |= bool(told)
        return False, doubtful

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _P_ENDS:
            self._close("p", _SCOPES)
        if tag in _CLOSES:
            self._close(tag, _CLOSES[tag][1])
            self._close(_CLOSES[tag][0], _CLOSES[tag][1])
        if tag in ("html", "body") and self.open.get(tag):
            return
        if tag == "body":
            self._close("head")
        if self.dropped:
            if tag not in VOID:
                self._push(tag, False)
            return
        if tag in VOID:
            if tag == "br":
                self.stack[-1].children.append(" ")
            elif tag not in ("wbr",):
                self.stack[-1].children.append(Node(tag, self.stack[-1]))
                self.nodes.append(self.stack[-1].children[-1])
            return
        goes, doubtful = self._named(tag, {k: v or "" for k, v in attrs})
        self._push(tag, not goes, doubtful)
        if goes:
            self.dropped = len(self.stack)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash doesn't close an element

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._close(tag, {"article", "body", "html"} - {tag} if tag not in ("body", "html") else frozenset())

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.stack[-1].children.append(data)


def _measure(nodes: list[Node], top: Node) -> None:
    """Counts, densities and their sums, children before parents."""
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            else:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
                node.headings += child.headings
                node.paragraphs += child.paragraphs
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    share = top.link_chars / top.chars if top.chars else 0.0
    for node in reversed(nodes):
        c, lc = node.chars, node.link_chars
        if c:
            plain = max(c - lc, 1)
            base = math.log(c / plain * lc + share * c + math.e)
            inner = c / max(lc, 1) * max(node.tags, 1) / max(node.link_tags, 1)
            node.density = max(c / max(node.tags, 1) * math.log(max(inner, 1.0)) / max(math.log(base), 1.0), 0.0)
        inside = [child for child in node.children if isinstance(child, Node)]
        node.sum = sum(child.density for child in inside)
        for child in inside:
            if child.best.sum > node.best.sum:
                node.best = child.best
        if node.best.sum == node.sum:
            node.best = node


def _blocks(top: Node) -> Iterator[str]:
    """Texts between the borders of block elements, white space joined."""
    held: list[str] = []
    todo: list = [top]
    while todo:
        x = todo.pop()
        if x is None:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                yield text
        elif isinstance(x, str):
            held.append(x)
        elif x.tag in BLOCKS or x is top:
            todo += [None, *reversed(x.children), None]
        else:
            todo += reversed(x.children)


def _path(node: Node) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _following(node: Node) -> Node | None:
    """The sibling that follows a node with no text between them."""
    rest = iter(node.parent.children if node.parent else ())
    for x in rest:
        if x is node:
            break
    for x in rest:
        if x.strip() if isinstance(x, str) else x.chars:
            return x if isinstance(x, Node) else None
    return None


def _cut_sparse(nodes: list[Node], top: Node) -> None:
    """Takes the blocks beside the text that are below the threshold out of the tree."""
    if top.link_chars == top.chars:
        return  # a page of links is no menu beside a text
    path = list(_path(top.best))
    threshold = min(n.density for n in path)
    on_path = {id(n) for n in path}
    held = {id(n) for n in nodes if n.tag in _TEXTS and n.chars}
    around: set[int] = set()  # articles and what is above them
    for node in nodes:
        for x in _path(node) if id(node) in held else ():
            if id(x) in around:
                break
            around.add(id(x))
    anchored = id(top.best) in around or not held.isdisjoint(on_path)
    around |= on_path
    if not anchored:
        held.add(id(top.best))
    after = [x for x in map(_following, path) if x is not None]
    held |= {id(x) for x in after if x.link_chars == x.chars}
    todo = [top]
    while todo:
        node = todo.pop()
        if id(node) in held:
            continue
        stays = []
        for c in node.children:
            beside = isinstance(c, Node) and c.chars and id(c) not in around and id(c) not in held
            if beside and c.density < threshold and (c.doubtful or c.tag in BLOCKS):
                menu = c.link_chars == c.chars and not c.headings + c.paragraphs
                if c.doubtful or menu or anchored and not c.headings:
                    continue
            stays.append(c)
        node.children = stays
        todo += [c for c in stays if isinstance(c, Node)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    top = builder.root  # text after the body's end tag is the body's
    _measure(builder.nodes, top)
    _cut_sparse(builder.nodes, top)
    return "\n".join(_blocks(top))


def extracted(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each."""

    @F.pandas_udf("string")
    def text(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in html], dtype=object)

    return pages.withColumn(into, text(F.col(html_col)))
