"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each at the end of a root-to-leaf path of block-level tags. Furniture that says what
it is (by tag, role, class or id) is left out first; a class or id is not believed of an element around most of the text
(`_believed`). For each remaining path the text length and the punctuation of
its blocks are summed and divided by the number of blocks; both ratios are smoothed over the paths in page order,
fused by multiplication, and paths above the threshold hold content. The article is the article or main element with most
content text, else the smallest element around all content blocks and what stands beside them; all its blocks make the text, headings and short
lines included.

Character references are decoded, white space in a block becomes one space, and blocks are joined by a line feed. Null,
empty and furniture-only pages give an empty text, unless the furniture has sentences and says so by class or id alone. Work is linear in the length of a page, whatever its nesting.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlens.llm.common import text_slices

# What the tag names mean.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr picture source".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object select option canvas audio video".split())
FURNITURE_TAGS = frozenset("aside button dialog fieldset footer form head header menu nav".split())
FURNITURE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adbox advert advertisement adverts banner breadcrumb breadcrumbs byline consent cookie cookies copyright disclaimer "
    "footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promoted recommended related search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar "
    "widget widgets".split()
)
READER_WORDS = frozenset("comment comments commentlist disqus reactions replies reply respond".split())
ROOTS = frozenset(["html", "body", "main", "article"])
CONTENT_ROOTS = frozenset(["main", "article"])
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split()
)
# A start tag of a key ends an open element of its values, unless one of the third set stands between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
}

# Part of the mean of the fused ratios that a content path reaches.
THRESHOLD = 0.5
SMOOTHING = np.array([1.0, 2.0, 1.0]) / 4

EXTRACTED = "page_id long, url string, text string, n_chars long"

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<[!?][^>]*+>", re.DOTALL
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.IGNORECASE) for tag in RAW}
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")


class Node:
    """An open block-level element."""

    __slots__ = ("tag", "parent", "path", "furniture", "reader", "sure", "whole", "holds_root", "depth", "out")

    def __init__(self, tag: str, parent: Node | None, path: int, told: tuple[bool, bool, bool, bool] = (False,) * 4):
        self.tag, self.parent, self.path = tag, parent, path
        self.furniture, self.reader, self.sure, self.whole = told
        self.holds_root = False
        self.depth = parent.depth + 1 if parent else 0
        self.out = False


def _attributes(held: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(held)}


def _told(tag: str, attributes: dict[str, str]) -> tuple[bool, bool, bool, bool]:
    """Whether an element is page furniture, whether it holds reader comments, whether tag, role or style make it furniture,
    and whether a class or id is one of the words as a whole, not a compound such as has-sidebar."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    said = set(re.split(r"[^a-z0-9]+", names))
    reader = bool(said & READER_WORDS) and tag not in ("html", "body", "main")
    hidden = "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", "").lower()) is not None
    shown_by = hidden or attributes.get("role", "").lower() in FURNITURE_ROLES
    sure = tag in FURNITURE_TAGS or (shown_by and tag not in ROOTS)
    whole = not (FURNITURE_WORDS | READER_WORDS).isdisjoint(names.split())
    return sure or (bool(said & FURNITURE_WORDS) and tag not in ROOTS), reader, sure, whole


def _believed(nodes: list[Node], blocks: list[tuple[Node, list[str]]]) -> None:
    """Take back what class or id say of elements that hold the greater part of the page's sentences.

    Compounds are taken back if no article or main element has sentences elsewhere; whole words only if there are
    no sentences elsewhere, as comments can be longer than what they are about.
    """
    if not any((n.furniture or n.reader) and not n.sure for n in nodes):
        return
    rooted = {n: n.tag in CONTENT_ROOTS for n in nodes}
    for node in reversed(nodes[1:]):
        rooted[node.parent] |= rooted[node]
    away: dict[Node, bool] = {nodes[0]: False}
    root_near: dict[Node, bool] = {nodes[0]: False}
    for node in nodes[1:]:
        away[node] = away[node.parent] or (node.sure and not rooted[node])
        root_near[node] = root_near[node.parent] or (node.tag in CONTENT_ROOTS and not node.reader)
    held, in_roots = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for node, parts in blocks:
        text = " ".join(html.unescape("".join(parts)).split())
        if not away[node] and any(unicodedata.category(c) == "Po" for c in text):
            held[node] += len(text)
            in_roots[node] += len(text) * root_near[node]
    for node in reversed(nodes[1:]):
        held[node.parent] += held[node]
        in_roots[node.parent] += in_roots[node]
    total, total_roots = held[nodes[0]], in_roots[nodes[0]]
    for node in nodes[1:]:
        if node.sure or not (node.furniture or node.reader) or 2 * held[node] <= total:
            continue
        if held[node] == total or (not node.whole and in_roots[node] == total_roots):
            node.furniture = node.reader = False
            above = node.parent if node.tag in CONTENT_ROOTS else None
            while above is not None and not above.holds_root:
                above.holds_root = True
                above = above.parent


def blocks_of(page: str) -> list[tuple[Node, str]]:
    """The blocks of a page in order: the element around each, and its text."""
    root = Node("", None, 0)
    nodes, stack, open_tags = [root], [root], {"": 1}
    paths: dict[tuple[int, str], int] = {}
    blocks: list[tuple[Node, list[str]]] = []
    text: list[str] = []

    def flush() -> None:
        if text:
            blocks.append((stack[-1], list(text)))
            text.clear()

    def pop_to(tag: str) -> None:
        while True:
            gone = stack.pop()
            open_tags[gone.tag] -= 1
            if gone.tag == tag:
                return

    def end_implied(names: tuple[str, ...], barriers: tuple[str, ...]) -> None:
        if not any(open_tags.get(n) for n in names):
            return
        for node in reversed(stack):
            if node.tag in barriers:
                return
            if node.tag in names:
                pop_to(node.tag)
                return

    at, last = 0, page.rfind(">") + 1
    while at < len(page):
        m = _MARKUP.search(page, at, last) if at < last else None
        text.append(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end() if not m[0].startswith("<!--") or m[0].endswith("-->") else len(page)
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW and not closing:
            end = None if m[3].endswith("/") else _RAW_END[tag].search(page, at)
            at = end.end() if end else at if m[3].endswith("/") else len(page)
            continue
        if tag in INLINE or tag in RAW:
            if tag == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            if open_tags.get(tag):
                pop_to(tag)
            continue
        if tag in CLOSES_PARAGRAPH and open_tags.get("p"):
            end_implied(("p",), ("table", "td", "th", "li", "button"))
        if tag in CLOSES:
            end_implied(*CLOSES[tag])
        if tag in VOID:
            continue
        attributes = _attributes(m[3]) if m[3] else {}
        told = _told(tag, attributes) if attributes or tag in FURNITURE_TAGS else (False,) * 4
        parent = stack[-1]
        key = (parent.path, f"{tag}.{attributes.get('class', '')}")
        node = Node(tag, parent, paths.setdefault(key, len(paths) + 1), told)
        if tag in CONTENT_ROOTS and not node.reader:
            above = parent
            while above is not None and not above.holds_root:
                above.holds_root = True
                above = above.parent
        stack.append(node)
        nodes.append(node)
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    _believed(nodes, blocks)
    for node in nodes[1:]:
        # An element that says it is furniture but is wrapped around the article is only a wrapper.
        node.out = node.parent.out or node.reader or (node.furniture and not node.holds_root)
    shown = ((node, " ".join(html.unescape("".join(held)).split())) for node, held in blocks if not node.out)
    return [(node, held) for node, held in shown if held]


def _content_paths(blocks: list[tuple[Node, str]]) -> set[int]:
    """Paths whose smoothed and fused ratios reach the threshold."""
    sums: dict[int, list[int]] = {}
    for node, held in blocks:
        own = sums.setdefault(node.path, [0, 0, 0])
        own[0] += len(held)
        own[1] += sum(unicodedata.category(c) == "Po" for c in held)
        own[2] += 1
    table = np.array(list(sums.values()), dtype=np.float64)
    lengths, marks = table[:, 0] / table[:, 2], 1 + table[:, 1] / table[:, 2]
    smooth = lambda x: np.convolve(np.pad(x, 1, mode="edge"), SMOOTHING, mode="valid")
    fused = smooth(lengths) * smooth(marks)
    reaches = fused >= min(THRESHOLD * fused.mean(), fused.max())
    return {path for path, yes in zip(sums, reaches, strict=True) if yes}


def _around(nodes: list[Node]) -> Node:
    """The smallest element around all of them."""
    common = nodes[0]
    for node in nodes[1:]:
        while node is not common:
            if node.depth > common.depth:
                node = node.parent
            else:
                common = common.parent
    return common


def main_text(page: str) -> str:
    """The article of a page: its blocks, one a line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    paths = _content_paths(blocks)
    weight: dict[Node, int] = {}
    root_of: dict[Node, Node | None] = {}

    def content_root(node: Node) -> Node | None:
        seen = []
        while node is not None and node not in root_of and node.tag not in CONTENT_ROOTS:
            seen.append(node)
            node = node.parent
        found = root_of.get(node, node) if node is not None else None
        for n in seen:
            root_of[n] = found
        return found

    chosen = [(node, held) for node, held in blocks if node.path in paths]
    for node, held in chosen:
        if (root := content_root(node)) is not None:
            weight[root] = weight.get(root, 0) + len(held)
    if weight and 2 * sum(weight.values()) >= sum(len(held) for _, held in chosen):
        top = max(weight, key=weight.__getitem__)
    else:
        top = _around([node for node, _ in chosen])
        if any(node is top for node, _ in chosen) and top.parent and top.parent.tag not in ("", "html", "body"):
            top = top.parent  # a heading or a line beside the only paragraph
    inside: dict[Node, bool] = {top: True}

    def within(node: Node | None) -> bool:
        seen = []
        while node is not None and node not in inside:
            seen.append(node)
            node = node.parent
        found = node is not None and inside[node]
        for n in seen:
            inside[n] = found
        return found

    return "\n".join(held for node, held in blocks if within(node))


def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, pages in text_slices(batch, column="html"):
            texts = [main_text(page.decode()) for page in pages.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages` (page_id, url, html)."""
    ready = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return ready.mapInArrow(extracted, EXTRACTED)
