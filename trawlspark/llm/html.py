"""Main text of web pages by composite text density (operator 7)."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# Fixed values of HTML: elements without an end tag, with raw text, and those that break a line of text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CONTAINERS = set("article body center div main section td".split())
# A start tag ends an open element of these kinds, up to the nearest border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# Parts of a page that are not its article: by element, by role, and by names in class and id.
NOISE_TAGS = RAW | set(
    "aside audio button canvas datalist dialog footer head menu nav noscript object picture select svg template video".split()
)
NOISE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NOISE_WORDS = set(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "promotion recommended recommendations related replies reply respond share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets".split()
)
COMMENT_WORDS = set("comment comments disqus replies reply respond".split())
ARTICLE_NOISE = set("comment comments reply ad sponsored related".split())
# Words at the end of a name that do not change what it names, and words of names that tell how a page is laid out.
PART_WORDS = set(
    "area bar block bottom box container form group holder inner item items left link links list outer panel post posts "
    "right section slot top wrap wrapper".split()
)
LAYOUT_WORDS = set("col column columns content grid has layout no non not text with without".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?|[^=>])*+)>"
    r"|<[/A-Za-z][^>]*(?:>|\Z)",
    re.S,
)
_LENIENT = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_WORDS = re.compile(r"[A-Za-z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "named", "chars", "tags", "link_chars", "links", "density", "inner")

    def __init__(self, tag: str, parent: Node | None, noise: bool, named: bool = False):
        self.tag, self.parent, self.noise, self.named = tag, parent, noise, named
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.links = 0
        self.density = self.inner = 0.0


def names(value: str, words: set[str]) -> set[str]:
    """The words of the set that a class or id list names something by.

    A name counts by its last word that is not just a part ("left-sidebar", "comment-list"); names of a layout
    ("has-sidebar") and names of other things ("social-science") do not.
    """
    out = set()
    for name in value.split():
        parts = [w.lower() for w in _WORDS.findall(name)]
        while len(parts) > 1 and parts[-1] in PART_WORDS:
            parts.pop()
        if parts and parts[-1] in words and not LAYOUT_WORDS & set(parts):
            out.add(parts[-1])
    return out


def _is_noise(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """(whether the element is noise, whether by a name that ``judge`` may overrule)."""
    if tag in NOISE_TAGS or tag == "header" and not in_article:
        return True, False
    if tag == "form":
        return True, True  # some page frames wrap the whole page in one
    if not attributes.strip() or tag in ("html", "body"):
        return False, False
    found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)}
    found = {k: unescape(v) for k, v in found.items()} if "&" in attributes else found
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True, False
    if found.get("role", "").lower() in NOISE_ROLES:
        return True, False
    words = ARTICLE_NOISE if tag in ("article", "main") else NOISE_WORDS if in_article else NOISE_WORDS | {"header"}
    named = names(found.get("class", "") + " " + found.get("id", ""), words)
    return bool(named), bool(named) and not named & COMMENT_WORDS


def judge(nodes: list[Node]) -> None:
    """Blocks that are noise by name alone, and forms, are left to their density if they hold over half of the page's text."""
    volume = {}
    for node in reversed(nodes):
        inside = (len(c.strip()) if isinstance(c, str) else volume[c] for c in node.children)
        volume[node] = 0 if node.noise and not node.named else sum(inside)
    for node in nodes:
        own = node.noise and not (node.named and 2 * volume[node] > volume[nodes[0]])
        node.noise = own or bool(node.parent and node.parent.noise)


def parse(html: str) -> list[Node]:
    """The elements of a page in page order, the root first; tolerant of missing and crossed end tags."""
    root = Node("html", None, False)
    nodes, open_nodes, at, size = [root], [root], 0, len(html)

    def add_text(text: str) -> None:
        if text:
            open_nodes[-1].children.append(unescape(text) if "&" in text else text)

    for m in iter(lambda: _TAG.search(html, at), None):
        add_text(html[at : m.start()])
        at = m.end()
        if m[2] is None and m[0][1] not in "!?":
            m = _LENIENT.match(m[0])  # its quotes do not match up; a tag that the end of input cuts off is dropped
        tag = m[2].lower() if m and m[2] else ""
        if not tag:
            continue
        if m[1]:
            _close(open_nodes, tag)
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in open_nodes):
            continue
        if tag in BLOCK:
            _implied(open_nodes, {"p"}, {"td", "th", "button", "table", "div", "section", "article", "body"})
        if tag in CLOSES:
            _implied(open_nodes, *CLOSES[tag])
        parent = open_nodes[-1]
        inside = any(n.tag in ("article", "main") for n in open_nodes)
        node = Node(tag, parent, *_is_noise(tag, m[3], inside))
        parent.children.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else size
        elif tag not in VOID and not m[3].endswith("/"):
            open_nodes.append(node)
        elif tag not in VOID and tag in BLOCK | {"a", "b", "i", "em", "strong", "span"}:
            open_nodes.append(node)  # "/>" does not close these elements
    add_text(html[at:])
    judge(nodes)
    return nodes


def _implied(open_nodes: list[Node], closed: set[str], borders: set[str]) -> None:
    for k in range(len(open_nodes) - 1, 0, -1):
        if open_nodes[k].tag in closed:
            del open_nodes[k:]
            return
        if open_nodes[k].tag in borders:
            return


def _close(open_nodes: list[Node], tag: str) -> None:
    for k in range(len(open_nodes) - 1, 0, -1):
        if open_nodes[k].tag == tag:
            del open_nodes[k:]
            return
        if tag not in BLOCK and open_nodes[k].tag in BLOCK or open_nodes[k].tag in ("body", "article", "main") and tag not in ("html", "body"):
            return  # the end of an inline element does not reach beyond its block


def measure(nodes: list[Node]) -> None:
    """Composite text density of every node, and the sum over its children, from the last node up to the root.

    Density is characters per tag times the logarithm of (characters per link character) x (tags per link), to a base
    that grows with the share of link text. Noise counts nothing.
    """
    for node in reversed(nodes):
        if node.noise:
            continue
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
            elif not child.noise:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
                node.links += child.links + (child.tag == "a")
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    link_share = body.link_chars / max(1, body.chars)
    for node in nodes:
        if node.chars and not node.noise:
            links, tags = max(1, node.link_chars), max(1, node.tags)
            base = node.chars / max(1, node.chars - node.link_chars) * node.link_chars + link_share * node.chars + math.e
            ratio = max(1.0, node.chars / links) * max(1.0, tags / max(1, node.links))
            node.density = node.chars / tags * math.log(max(ratio, 1.0 + 1e-9)) / math.log(math.log(base) + 1.0)
            if node.parent:
                node.parent.inner += node.density


def main_nodes(nodes: list[Node]) -> list[Node]:
    """Roots of the article, in page order.

    The container with the greatest sum of child densities is the core; its article or main element, if it has one,
    is the whole article. Otherwise parts beside the path from the core to the body join it if they are as dense as
    the thinnest node of that path; a link alone is no part.
    """
    measure(nodes)
    choices = [n for n in nodes if n.tag in CONTAINERS and not n.noise and n.chars]
    if not choices:
        return [n for n in nodes[:1] if n.chars]
    core = max(choices, key=lambda n: n.inner)
    path = [core]
    while path[-1].parent and path[-1].tag != "body":
        path.append(path[-1].parent)
    for kind in ("article", "main"):
        outer = [n for n in path if n.tag == kind]
        if outer:
            return [outer[-1]]
    threshold = min(n.density for n in path)
    chosen = [core]
    for lower, upper in zip(path, path[1:], strict=False):
        place = next(k for k, c in enumerate(upper.children) if c is lower)
        beside = [(k, c) for k, c in enumerate(upper.children) if isinstance(c, Node) and c is not lower]
        fits = [(k, c) for k, c in beside if not c.noise and c.tag != "a" and c.chars and c.density >= threshold]
        chosen = [c for k, c in fits if k < place] + chosen + [c for k, c in fits if k > place]
    return chosen


def extract_text(html: str | None) -> str:
    """Blocks of the main article, one per line; white space inside a block is one blank."""
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(text)
        parts.clear()

    for root in main_nodes(parse(html or "")):
        todo: list = [root]
        while todo:
            item = todo.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                parts.append(item)
            elif item.tag == "br":
                parts.append(" ")
            elif not item.noise:
                edge = [None] if item.tag in BLOCK else []
                todo += [*edge, *reversed(item.children), *edge]
        flush()
    return "\n".join(blocks)


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page from its whole html.

    Null and empty pages, and pages without an article, give an empty text. Repeated rows come out once each, null ids
    and urls are carried along, other columns are not read, and an empty table gives an empty result. Pages are parsed
    where they lie; nothing is shuffled.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html", 1_000_000):
                texts = [extract_text(h) for h in batch.column(2).to_pylist()]
                columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col(html).cast("string").alias("html"))
    return rows.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
