"""Main text of HTML pages by composite text density.

A page becomes a tree. Elements that are boilerplate by name, role, class or id (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, reader comments) are cut off, unless they
hold an article or most of the page's text. For each node left, the composite text density is its characters per tag, lowered as the share of linked
characters and linked tags rises. The node whose children's densities have the largest sum holds
the main text; the least density on the path from it to the body is the threshold, and every
node that reaches it gives its own maximum-sum subtree.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.llm.units import text_slices, without

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title select noframes xmp".split())
#: Elements that nest and are left out, and elements of other languages, where <x/> is a whole element.
LEFT_OUT, FOREIGN = frozenset("svg template annotation annotation-xml".split()), frozenset("svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Start tags that end an open element of these names (up to a list, table or section).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("body ul ol dl menu table article section div main blockquote foreignobject object template".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form button menu dialog label fieldset head".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies disclaimer disqus footer header masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pagination paywall popup promo related respond share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget".split()
)
KEEPERS = frozenset("article main".split())
READER_WORDS = frozenset("comment comments commentlist related".split())
#: Words of class names that say what an element has, and last words that only name a part of what comes before them.
MODIFIERS = frozenset("has with without no not is".split())
PART_WORDS = frozenset(
    "area articles bar block body bottom box button buttons col column container content form group icon icons inner item items left "
    "link links list main media outer panel post posts primary right row secondary section stories text title top widgets wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose ids lay out a page, also in an article; other ids there are anchors of its parts.
LAYOUT = frozenset("aside div ol ul".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORDS = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "parts", "inside", "chars", "linked", "tags", "linked_tags", "density", "total", "foreign", "code", "cut", "plain", "keeper")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.inside = tag in KEEPERS or (parent is not None and parent.inside)  # an article or main element
        self.code = tag in ("pre", "code") or (parent is not None and parent.code)
        self.cut = 0.0  # the share of the page's text from which on this boilerplate is not cut off; 0: no boilerplate
        #: Where text goes on after the svg or math element that this node is in; text inside foreignObject is no such language.
        self.foreign = parent.foreign if parent else None
        if tag in FOREIGN:
            self.foreign = self.foreign or parent
        elif tag in ("foreignobject", "desc", "annotation-xml"):
            self.foreign = None
        self.chars = self.linked = self.tags = self.linked_tags = 0


def _roles(names: str) -> set[str]:
    """What classes or ids call their element: ``menu`` for main-menu and menu-list, nothing for has-menu."""
    found = set()
    for name in names.lower().split():
        words = WORDS.findall(name.split("--")[0])
        words = words[: next((i for i, x in enumerate(words) if x in MODIFIERS), len(words))]
        while len(words) > 1 and (words[-1] in PART_WORDS or words[-1][0].isdigit()):
            words.pop()
        found.update(words[-1:])
    return found


def _boilerplate(tag: str, attributes: str, parent: Node) -> float:
    """The share of a page's unlinked text up to which an element below ``parent`` is cut off (0: it stays)."""
    inside = parent.inside  # it stands in an article or main element
    if tag in BOILERPLATE_TAGS or (tag == "header" and not inside):
        return 0.5
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        value, name = "".join(values), name.lower()
        if name == "role":
            if set(WORDS.findall(value.lower())) & BOILERPLATE_ROLES:
                return 0.5
        elif tag not in HEADINGS and not parent.code:
            readers = tag in KEEPERS or (name == "id" and inside and tag not in LAYOUT)
            if _roles(value) & (READER_WORDS if readers else BOILERPLATE_WORDS) - ({"header"} if inside else set()):
                return 0.9  # it is called so: a long notice above a short text is one, too
    return 0.0


def _prune(root: Node) -> None:
    """Cut boilerplate off that holds no article or main element or, on pages without any, most of the unlinked text."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo += [x for x in node.parts if isinstance(x, Node)]
    for node in reversed(nodes):
        inner = [x for x in node.parts if isinstance(x, Node)]
        node.keeper = any(x.keeper or (x.tag in KEEPERS and not x.cut) for x in inner)
        own = sum(len(x) - x.count(" ") for x in node.parts if isinstance(x, str))
        node.plain = own + sum(x.plain for x in inner) if node.tag != "a" else 0
    for node in nodes:
        node.parts = [
            x for x in node.parts if isinstance(x, str) or not x.cut or x.keeper or (not root.keeper and x.plain > x.cut * root.plain)
        ]


def parse(page: str) -> Node:
    """The body of a page as a tree of nodes; ``parts`` has text and child nodes in page order."""
    root = Node("body", None)
    node, at, end = root, 0, len(page)
    while at < end:
        open_at = page.find("<", at)
        if open_at < 0:
            open_at = end
        if open_at > at:
            node.parts.append(html.unescape(page[at:open_at]))
        if open_at == end:
            break
        if page.startswith("<!--", open_at):
            close = page.find("-->", open_at + 4)
            at = end if close < 0 else close + 3
            continue
        found = TAG.match(page, open_at)
        if not found:
            if open_at + 1 < end and (page[open_at + 1].isalpha() or page[open_at + 1] in "/!?"):
                close = page.find(">", open_at)
                at = end if close < 0 else close + 1
            else:
                node.parts.append("<")
                at = open_at + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if closing:
            up = node
            while up.parent and up.tag != tag:
                up = up.parent
            if up.parent and up.tag == tag:
                node = up.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            at = end if not close else (page.find(">", close.end()) + 1 or end)
            continue
        if tag in BLOCKS:
            if node.foreign:  # HTML ends a picture or formula that was not closed
                node = node.foreign
            up = node
            while up.parent and up.tag != "p" and up.tag not in SCOPES:
                up = up.parent
            if up.tag == "p" and up.parent:
                node = up.parent
        if tag in ENDS:
            up = node
            while up.parent and up.tag not in ENDS[tag] and up.tag not in SCOPES:
                up = up.parent
            if up.tag in ENDS[tag] and up.parent:
                node = up.parent
                if tag == "tr" and node.tag == "tr" and node.parent:
                    node = node.parent
        child = Node(tag, node)
        if tag in LEFT_OUT:
            if not attributes.endswith("/") or not child.foreign:
                node = child  # parsed to find its end, but hangs on no node
        elif tag not in VOID and not attributes.endswith("/"):
            child.cut = _boilerplate(tag, attributes, node)
            node.parts.append(child)
            node = child
        else:
            node.parts.append(child)
    return root


def _upward(node: Node | None) -> Iterator[Node]:
    while node:
        yield node
        node = node.parent


def _measure(root: Node) -> list[Node]:
    """Fill in counts, densities and density sums; nodes in page order."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo += [x for x in reversed(node.parts) if isinstance(x, Node)]
    for node in reversed(nodes):
        own = sum(len(x) - x.count(" ") for x in node.parts if isinstance(x, str))
        node.chars += own
        if node.tag == "a":
            node.linked, node.linked_tags = node.chars, node.tags + 1
        if node.parent:
            up = node.parent
            up.chars += node.chars
            up.linked += node.linked
            up.tags += node.tags + (node.foreign is None)  # a formula's tags are not layout
            up.linked_tags += node.linked_tags
    share = root.linked / max(root.chars, 1)
    for node in reversed(nodes):
        node.density = _density(node, share)
        node.total = sum(x.density if isinstance(x, Node) else len(x.strip()) * (node.tag != "a") for x in node.parts)
    return nodes


def _density(node: Node, share: float) -> float:
    if not node.chars:
        return 0.0
    tags = max(node.tags, 1)
    plain = max(node.chars - node.linked, 1)
    base = math.log(node.chars / plain * node.linked + share * node.chars + math.e)
    ratio = node.chars / max(node.linked, 1) * tags / max(node.linked_tags, 1)
    return node.chars / tags * max(math.log(ratio) / max(math.log(base), 1e-9) if base > 1 + 1e-9 else ratio, 0.0)


def _best(node: Node) -> Node:
    """The node of the largest density sum below (the first of equals)."""
    best, todo = node, [node]
    while todo:
        x = todo.pop()
        if x.total > best.total:
            best = x
        todo += [c for c in reversed(x.parts) if isinstance(c, Node)]
    return best


def _marked(root: Node) -> set[int]:
    """Ids of the roots of all content subtrees."""
    best = _best(root)
    least = min(x.density for x in _upward(best))
    home = next((x for x in _upward(best) if x.tag in KEEPERS), best)
    marked, above, todo = {id(home)}, {id(x) for x in _upward(home)}, [root]
    while todo:
        node = todo.pop()
        if id(node) in marked:
            continue
        if node.chars and node.density >= least and id(node) not in above:
            marked.add(id(_best(node)))
        todo += [c for c in node.parts if isinstance(c, Node)]
    return marked


def _blocks(root: Node, marked: set[int]) -> list[str]:
    """Texts of the blocks below marked nodes, in page order."""
    blocks, line = [], []

    def close() -> None:
        text = SPACE.sub(" ", "".join(line)).strip()
        line.clear()
        if text:
            blocks.append(text)

    todo: list = [(root, False)]
    while todo:
        part, taken = todo.pop()
        if part is None:
            close()
        elif isinstance(part, str):
            if taken:
                line.append(part)
        elif part.tag == "br":
            line.append(" ")
        else:
            taken = taken or id(part) in marked
            block = part.tag in BLOCKS
            if block:
                close()
                todo.append((None, False))
            todo += [(x, taken) for x in reversed(part.parts)]
    close()
    return blocks


def main_text(page: str) -> str:
    """The main text of one page, blocks joined by ``\\n``; empty if there is none."""
    root = parse(page)
    _prune(root)
    _measure(root)
    return "\n".join(_blocks(root, _marked(root))) if root.chars else ""


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Each page with ``text``, its main text.

    Rows are independent: no shuffle, repeated rows get equal texts. Null and empty pages, and
    pages without text, give an empty text. Pages of any length are read whole; unfinished
    tags at the end are left out. An input column named like ``text_col`` is replaced.
    """
    pages = pages.select([F.col(f"`{x}`") for x in without(pages.columns, [text_col])])
    names = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(names.index(html_col))):
                part = batch.slice(a, b - a)
                found = pa.array([main_text(x.decode()) for x in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), found], [*names, text_col])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(text_col, T.StringType())]))
