"""Main text of web pages by wrapper induction.

Pages of one host are made from one template. One page of a host is its pivot; the DOM tree of every
other page is aligned with the pivot's by simple tree matching (Yang, 1991), so that each block of
text falls onto a node of the pivot or onto none. Counted over all different pages of the host (copies
of a page say nothing about its template), a text that a node almost always holds is template there;
other texts of the node, nodes whose text varies, and what has no counterpart, are slots for content.

What varies is not always the article: menus, adverts and footers vary too. Elements that say what they
are (``nav``, ``footer``, ``form``, class and id words) never count, unless a class or id word names an
element that holds most of the page's text. Of the slots, those inside the page's ``article`` (else
``main``) are its text; a page that has neither gives all its slots.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.text import map_slices
from tidemark.session import written

# A node is template if at least this many pages have it, and this share of them with one text.
MIN_PAGES = 5
CONSTANT_SHARE = 0.9
# Template inside an article goes only if it is less than this share of its text: where whole
# articles repeat, the article is constant too and is still the content.
MAX_TEMPLATE_SHARE = 0.3
# The same for pages without an article, where much more may be the site's own text.
MAX_TEMPLATE_SHARE_OUTSIDE = 0.7
# An element with more than this share of a page's text is its content, whatever its class says.
MOST = 0.5
# Tables of sibling scores are held whole up to this many cells.
MAX_CELLS = 1_000_000
# Pivots and template nodes are broadcast up to this size (checked), else joined with a shuffle.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe template svg math object audio video canvas xmp".split())
_BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address details summary center header footer nav aside menu form fieldset dialog "
    "button select option hgroup search head".split()
)
_ENDS_PARAGRAPH = _BLOCK - {"button", "select", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head"}
# An opening tag closes an open one of these, up to the element that holds such.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NEVER = frozenset("nav footer aside menu form dialog button select search head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "signup share sharing social related recommended comment comments respond reply replies disqus widget pagination "
    "pager login toolbar".split()
)
_OUTER_NOISE_WORDS = frozenset(["header", "topbar", "search"])
# With one of these, a class says what an element has or lacks, not what it is: has-sidebar, ad-free.
_QUALIFIERS = frozenset("no not non without with has have hide is free".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACES = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    """An element that makes blocks. ``blocks`` are the numbers of the texts that stand right in it."""

    __slots__ = ("tag", "parent", "children", "blocks", "noise", "named", "article", "main", "shape", "index", "size", "tags")

    def __init__(self, tag: str, parent: Node | None, noise: bool, article: bool, main: bool):
        self.tag, self.parent = tag, parent
        self.children: list[Node] = []
        self.blocks: list[int] = []
        self.noise, self.article, self.main = noise, article, main
        self.named = False
        self.shape = self.index = -1
        self.size = 1
        # Tags of the element and of all above it: one set for as long as none is new.
        above = parent.tags if parent is not None else frozenset()
        self.tags = above if tag in above else above | {tag}


class Page:
    """The tree of a page, its nodes in page order, and its blocks of text with their nodes."""

    def __init__(self, source: str):
        self.root = Node("html", None, False, False, False)
        self.nodes = [self.root]
        self.texts: list[str] = []
        self.owners: list[Node] = []
        self._open = self.root
        self._pending: list[str] = []
        self._read(source)
        for k, node in enumerate(self.nodes):
            node.index = k
        self._judge_names()

    def _judge_names(self) -> None:
        """Elements named like noise become noise, unless they hold most of the page's text."""
        if not any(node.named for node in self.nodes):
            return
        sizes = [0 if node.noise else sum(len(self.texts[b]) for b in node.blocks) for node in self.nodes]
        for node in reversed(self.nodes[1:]):
            sizes[node.parent.index] += sizes[node.index]
        for node, size in zip(self.nodes[1:], sizes[1:], strict=True):
            node.noise = node.noise or node.parent.noise or (node.named and size <= MOST * sizes[0])

    def _flush(self) -> None:
        if self._pending:
            text = _SPACES.sub(" ", "".join(self._pending)).strip()
            self._pending = []
            if text:
                self._open.blocks.append(len(self.texts))
                self.texts.append(text)
                self.owners.append(self._open)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            m = _TAG.search(source, at)
            if m is None:
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"), decode=False)
                continue
            name = name.lower()
            if m[1]:
                self._end(name)
            elif name in _RAW:
                if not m[3].endswith("/>") or name not in ("svg", "math"):
                    closed = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(source, at)
                    at = closed.end() if closed else len(source)
                self._pending.append(" ")
            elif name in _BLOCK:
                self._start(name, m[3])
            elif name == "br" or name == "hr":
                self._pending.append(" ")
                if name == "hr":
                    self._flush()
        self._text(source[at:])
        self._flush()

    def _text(self, text: str, decode: bool = True) -> None:
        self._pending.append(html.unescape(text) if decode and "&" in text else text)

    def _close(self, tags: set[str], limits: set[str] | frozenset[str]) -> None:
        """Close the nearest open element of these tags that no limit stands before."""
        node = self._open
        while node.parent is not None and not node.tags.isdisjoint(tags):
            if node.tag in tags:
                self._open = node.parent
                return
            if node.tag in limits:
                return
            node = node.parent

    def _start(self, name: str, rest: str) -> None:
        self._flush()
        if name in ("html", "body") and any(n.tag == name for n in self.nodes[1:]):
            return
        if name in _ENDS_PARAGRAPH:
            self._close({"p"}, {"td", "th", "button", "table", "caption"})
        if name[0] == "h" and name[1:].isdigit() and self._open.tag[0] == "h" and self._open.tag[1:].isdigit():
            self._open = self._open.parent
        if name in _SIBLINGS:
            closes, limits = _SIBLINGS[name]
            for tag in closes:
                self._close({tag}, limits)
        if name == "body":
            self._close({"head"}, set())
        parent = self._open
        article, main = parent.article or name == "article", parent.main or name == "main"
        noise = parent.noise or name in _NEVER or (name == "header" and not (article or main))
        named = False
        if len(rest) > 1:
            given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest[:-1])}
            role = given.get("role", "").lower()
            main = main or role == "main"
            if name not in ("html", "body", "article", "main"):
                noise = noise or _hidden(given, role)
                named = _named_noise(given, article or main)
        node = Node(name, parent, noise, article, main)
        node.named = named
        parent.children.append(node)
        self.nodes.append(node)
        self._open = node

    def _end(self, name: str) -> None:
        if name not in _BLOCK or name in ("html", "body"):
            return
        self._flush()
        self._close({name}, {"td", "th"} if name not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot") else set())


def _hidden(given: dict[str, str], role: str) -> bool:
    if role in _ROLES or "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return True
    return bool(_HIDDEN.search(given.get("style", "")))


def _named_noise(given: dict[str, str], inside: bool) -> bool:
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        found = {w.lower() for w in _WORD.findall(_CAMEL.sub(" ", name))}
        if not found & _QUALIFIERS and (found & _NOISE_WORDS or (not inside and found & _OUTER_NOISE_WORDS)):
            return True
    return False


_shapes: dict[tuple, int] = {}
_scores: dict[tuple[int, int], int] = {}


def _forget() -> None:
    """Start anew where a worker remembers much; only between pages, as shapes are compared by number."""
    if len(_shapes) > 50_000 or len(_scores) > 500_000:
        _shapes.clear()
        _scores.clear()
        _pivot.cache_clear()


def _shaped(page: Page) -> Page:
    """Number the shapes of subtrees: equal tags with equal children have one number in a worker."""
    for node in reversed(page.nodes):
        key = (node.tag, *(c.shape for c in node.children))
        node.size = 1 + sum(c.size for c in node.children)
        node.shape = _shapes.setdefault(key, len(_shapes))
    return page


def _known(a: Node, b: Node) -> int | None:
    """The score of two nodes if it needs no table, or its table was made."""
    if a.tag != b.tag:
        return 0
    if not a.children or not b.children:
        return 1
    return _scores.get((a.shape, b.shape))


def _ends(a: list[Node], b: list[Node]) -> tuple[int, int]:
    """How many siblings have equal shapes at the start and, of the others, at the end.

    Equal subtrees score the most that either can, and two pairs that use them crosswise would cross:
    some best matching pairs them.
    """
    most = min(len(a), len(b))
    head = next((k for k in range(most) if a[k].shape != b[k].shape), most)
    tail = next((k for k in range(most - head) if a[-1 - k].shape != b[-1 - k].shape), most - head)
    return head, tail


def _weights(a: list[Node], b: list[Node]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Scores of the different shapes of both lists, and the place of each sibling's shape in them."""
    kinds_a = {x.shape: x for x in a}
    kinds_b = {y.shape: y for y in b}
    scores = np.array([[_known(x, y) for y in kinds_b.values()] for x in kinds_a.values()], np.int64)
    place_a = {shape: k for k, shape in enumerate(kinds_a)}
    place_b = {shape: k for k, shape in enumerate(kinds_b)}
    return scores, [place_a[x.shape] for x in a], np.array([place_b[y.shape] for y in b], np.int64)


def _rows(scores: np.ndarray, at_a: list[int], at_b: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of the table of best scores of the first siblings of both lists, one for each of ``at_a``."""
    row = np.zeros(len(at_b) + 1, np.int64)
    yield row
    for k in at_a:
        below = row.copy()
        np.maximum(row[1:], row[:-1] + scores[k][at_b], out=below[1:])
        row = np.maximum.accumulate(below)
        yield row


def _last_row(scores: np.ndarray, at_a: list[int], at_b: np.ndarray) -> np.ndarray:
    return deque(_rows(scores, at_a, at_b), maxlen=1)[0]


def _siblings_score(a: list[Node], b: list[Node]) -> int:
    """The score of two lists of siblings; scores of their children are known."""
    head, tail = _ends(a, b)
    score = sum(x.size for x in a[:head]) + sum(x.size for x in a[len(a) - tail :])
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if a and b:
        score += int(_last_row(*_weights(a, b))[-1])
    return score


def match(a: Node, b: Node) -> int:
    """Simple tree matching: the most nodes that can be paired, parents with parents, in order.

    Pairs of shapes wait on a list until the pairs of their children are done, however deep they lie.
    """
    work = [(a, b)]
    while work:
        x, y = work[-1]
        if _known(x, y) is None:
            if x.shape == y.shape:
                _scores[x.shape, y.shape] = x.size
            else:
                head, tail = _ends(x.children, y.children)
                kinds_x = {c.shape: c for c in x.children[head : len(x.children) - tail]}
                kinds_y = {c.shape: c for c in y.children[head : len(y.children) - tail]}
                open_pairs = [(c, d) for c in kinds_x.values() for d in kinds_y.values() if _known(c, d) is None]
                if open_pairs:
                    work += open_pairs
                    continue
                _scores[x.shape, y.shape] = 1 + _siblings_score(x.children, y.children)
        work.pop()
    return _known(a, b)


def _paired(a: list[Node], b: list[Node]) -> Iterator[tuple[Node, Node]]:
    """The siblings that a best matching pairs (scores of their children are known).

    A table of more than ``MAX_CELLS`` cells is halved at the middle of ``a`` (Hirschberg, 1975), so
    memory grows with the sum of both lengths, not with their product.
    """
    work = [(a, b)]
    while work:
        a, b = work.pop()
        head, tail = _ends(a, b)
        yield from zip(a[:head], b[:head], strict=True)
        yield from zip(a[len(a) - tail :], b[len(b) - tail :], strict=True)
        a, b = a[head : len(a) - tail], b[head : len(b) - tail]
        if not a or not b:
            continue
        scores, at_a, at_b = _weights(a, b)
        if len(a) > 1 and len(a) * len(b) > MAX_CELLS:
            middle = len(a) // 2
            before = _last_row(scores, at_a[:middle], at_b)
            after = _last_row(scores, at_a[: middle - 1 : -1], at_b[::-1])[::-1]
            cut = int(np.argmax(before + after))
            work += [(a[:middle], b[:cut]), (a[middle:], b[cut:])]
            continue
        rows = list(_rows(scores, at_a, at_b))
        i, j = len(a), len(b)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                yield a[i], b[j]


def align(page: Page, pivot: Page) -> dict[int, int]:
    """Numbers of the page's nodes and of the pivot's nodes that they are matched with."""
    match(page.root, pivot.root)
    pairs = {}
    work = [(page.root, pivot.root)]
    while work:
        a, b = work.pop()
        pairs[a.index] = b.index
        if not a.children or not b.children:
            continue
        # Equal shapes need no table above them; below unequal ones the scores are there.
        work += _paired(a.children, b.children)
    return pairs


@lru_cache(maxsize=64)
def _pivot(source: str) -> Page:
    return _shaped(Page(source))


def aligned_blocks(source: str, pivot_source: str) -> list[dict]:
    """Blocks of a page that may be content, each with its pivot node (-1: none).

    With an ``article`` or ``main``, those inside it; else all outside of what is never content.
    """
    _forget()
    page = _shaped(Page(source))
    open_blocks = [k for k, owner in enumerate(page.owners) if not owner.noise]
    inside = [k for k in open_blocks if page.owners[k].article] or [k for k in open_blocks if page.owners[k].main]
    pairs = align(page, _pivot(pivot_source))
    chosen = inside or open_blocks
    return [
        {
            "node": pairs.get(page.owners[k].index, -1),
            "text": page.texts[k],
            "content": xxh64_intdigest(page.texts[k].encode()) - (1 << 63),
            "inside": bool(inside),
        }
        for k in chosen
    ]


def content(blocks: list[dict], template: set[tuple[int, int]]) -> list[str]:
    """Texts of the content blocks in page order; ``template`` has nodes with the hash of their text."""
    total = sum(len(b["text"]) for b in blocks)
    slots = [b for b in blocks if (b["node"], b["content"]) not in template]
    inside = bool(blocks) and blocks[0]["inside"]
    if sum(len(b["text"]) for b in slots) < (1 - (MAX_TEMPLATE_SHARE if inside else MAX_TEMPLATE_SHARE_OUTSIDE)) * total:
        slots = blocks
    return [b["text"] for b in slots]


def _small(df: DataFrame, size) -> DataFrame:
    """Broadcast if the size counted is within the bound."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= MAX_BROADCAST_BYTES else df


_BLOCKS = "array<struct<node:int,text:string,content:long,inside:boolean>>"


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: blocks joined by an empty line.

    Null pages are empty; a page without content has an empty text. Pages without a host in their
    address are one host. Repeated rows stay rows of their own; an empty table gives an empty result.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    named = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    by_chance = F.struct(F.xxhash64("page_id", "url"), F.xxhash64("html"))
    pivots = written(named.groupBy("host").agg(F.min_by("html", by_chance).alias("pivot")), "pivots")
    joined = named.join(_small(pivots, F.octet_length("pivot") + 100), "host")

    def aligned(columns: dict[str, list]):
        found = [aligned_blocks(h, p) for h, p in zip(columns["html"], columns["pivot"], strict=True)]
        # Copies have the same blocks at the same nodes.
        same = [xxh64_intdigest(repr([(b["node"], b["content"]) for b in blocks])) - (1 << 63) for blocks in found]
        yield {name: columns[name] for name in ("page_id", "url", "host")} | {"copy": same, "blocks": found}

    schema = f"page_id long, url string, host string, copy long, blocks {_BLOCKS}"
    blocks = written(map_slices(joined, aligned, schema, text="html"), "blocks")
    placed = F.filter("blocks", lambda b: b["node"] >= 0)
    placed = F.transform(placed, lambda b: F.struct(b["node"].alias("node"), b["content"].alias("content")))
    seen = blocks.select("host", "copy", F.explode(placed).alias("b")).select("host", "copy", "b.*").distinct()
    texts = seen.groupBy("host", "node", "content").agg(F.count("*").alias("n"))
    nodes = texts.groupBy("host", "node").agg(
        F.sum("n").alias("pages"), F.max("n").alias("same"), F.max_by("content", "n").alias("content")
    )
    constant = nodes.where((F.col("pages") >= MIN_PAGES) & (F.col("same") >= CONSTANT_SHARE * F.col("pages")))
    # At most one entry for each node of a pivot.
    entry = F.struct("node", "content")
    templates = written(constant.groupBy("host").agg(F.collect_set(entry).alias("template")), "templates")
    with_template = blocks.join(_small(templates, 16 * F.size("template") + 100), "host", "left")

    def chosen(columns: dict[str, list]):
        pairs = zip(columns["blocks"], columns["template"], strict=True)
        texts = ["\n\n".join(content(b, {(x["node"], x["content"]) for x in t or ()})) for b, t in pairs]
        yield {
            "page_id": columns["page_id"],
            "url": columns["url"],
            "text": texts,
            "n_chars": [len(t) for t in texts],
        }

    return map_slices(with_template, chosen, "page_id long, url string, text string, n_chars long", text="url")
