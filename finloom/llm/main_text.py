"""Main text of web pages by wrapper induction.

Pages of one host share a template. They are brought together by host; a host with many pages is dealt into cells of
about ``CELL`` pages, so that no host meets in one task. Inside a cell every page is parsed into a tree of its
elements, without those that never hold an article (menus, headers, footers, sidebars, forms, scripts, notices,
adverts, reader comments: by element or by name). Trees are aligned with the fullest page of their layout by simple tree
matching: the largest set of node pairs that keeps order, parents and tags. A node whose text is the same on most
pages of the layout is template; nodes whose text varies are slots. The element that holds the varying text (an article or
main element where there is one) is the content, and its text without template nodes is the result.

A node counts as template only where at least ``SAME_PAGES`` different pages, ``SAME_SHARE`` of those of the layout, have
it, and only while such nodes are a small part of the content on the middle page of the layout: pages that are copies
of each other are no template. Pages without text take no part.

Defined cases: a null or empty html gives an empty text; a page alone on its host is its own slot; a null or odd url
is a host of its own; repeated rows are extracted alike; a line break inside a block is white space; white space is what
Unicode calls so; unclosed and crossed elements end with their parent, stray end tags mean nothing. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm.common import cut, table

CELL = 64
BROADCAST_ROWS = 200_000  # busy hosts, of about 50 bytes
SAME_PAGES = 8
SAME_SHARE = 0.8
TEMPLATE_SHARE = 0.3
DEPTH = 200  # elements nested deeper stand beside each other, as browsers do it
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|[^<]+|<", re.S)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
# Element and class names of web pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
SKIP = frozenset("head script style noscript template iframe svg canvas object embed nav header footer aside form "
                 "button select textarea input label fieldset dialog menu title xmp noembed noframes audio video "
                 "map".split())
BLOCK = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 "
                  "h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
SKIP_BLOCK = frozenset("nav header footer aside form menu dialog fieldset".split())
SKIP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs footer sidebar aside notice notices cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments commentlist "
    "disqus respond replies widget pagination pager toolbar contentinfo complementary search".split())
SKIP_NAMES = frozenset("header site-header page-header masthead topbar banner-top site-notice".split())
PARAGRAPH_FENCES = frozenset("div td th article section main li blockquote".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}}


FLAGS = frozenset("has no with without".split())
MARKED = frozenset(("article", "main"))


class Node:
    """A block element: its texts and child blocks in page order. Inline elements leave only their text."""

    __slots__ = ("tag", "parts", "skip", "own")

    def __init__(self, tag: str, skip: bool = False):
        self.tag, self.parts, self.skip, self.own = tag, [], skip, None

    @property
    def children(self) -> list[Node]:
        return [p for p in self.parts if not isinstance(p, str)]

    def text(self) -> str:
        """The text outside of child blocks."""
        if self.own is None:
            self.own = " ".join("".join(p for p in self.parts if isinstance(p, str)).split())
        return self.own


def skipped(tag: str, rest: str) -> bool:
    if tag in SKIP:
        return True
    if tag in ("html", "body", "main", "article") or not rest:
        return False
    return bool(UNSEEN.search(rest))


def named(rest: str) -> bool:
    """Whether a class, id or role says that an element is no content; ``has-sidebar`` and the like say nothing."""
    for _, a, b, c in NAMES.findall(rest):
        for name in (a or b or c).lower().split():
            words = re.split(r"[^a-z0-9]+", name)
            if name in SKIP_NAMES or words[0] not in FLAGS and not SKIP_WORDS.isdisjoint(words):
                return True
    return False


def parse(html: str) -> Node:
    """The tree of a page without what is never content.

    Elements go by their names too, but not where all articles of the page, or else all its text, are below such.
    An article with such a name of its own (a reader's comment) is none.
    """
    root = tree_of(html, set())
    if any(x.tag in MARKED for x in below(root)):
        return root
    wrappers: set[int] = set()
    whole = tree_of(html, None, wrappers)
    if wrappers:
        return tree_of(html, wrappers)
    return root if any(x.text() for x in below(root)) else whole


def tree_of(html: str, spared: set[int] | None, wrappers: set[int] | None = None) -> Node:
    """The tree without elements named so, except those that begin at ``spared`` places (None: all).

    ``wrappers`` takes the places of the elements named so around articles and main elements.
    """
    root = Node("html")
    begun: list[int] = []  # places of the open elements, -1 where the name says nothing
    stack = [root]
    at, size = 0, len(html)
    while at < size:
        token = TOKEN.match(html, at)
        at = token.end()
        tag = token["tag"]
        if tag is None:
            piece = token[0]
            if piece[0] != "<" or piece == "<":
                if not stack[-1].skip:
                    stack[-1].parts.append(unescape(piece) if "&" in piece else piece)
            continue
        tag = tag.lower()
        if token["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        rest = token["rest"]
        if tag in VOID:
            if tag in ("br", "hr"):
                stack[-1].parts.append(" " if tag == "br" else Node(tag))
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        block = tag in BLOCK or tag in SKIP_BLOCK
        if block:  # a new block ends an open paragraph
            close_open(stack, {"p"}, PARAGRAPH_FENCES)
        if tag in CLOSES:
            close_open(stack, CLOSES[tag], FENCES.get(tag, set()))
        if tag == "body":
            del stack[1:]
        if tag in ("html", "body"):
            continue
        own = tag not in ("html", "body", "main") and bool(rest) and named(rest)
        skip = stack[-1].skip or skipped(tag, rest) or (
            own and tag != "article" and spared is not None and at not in spared)
        if not (block or skip):
            continue
        del stack[DEPTH:]
        del begun[len(stack) - 1:]
        if wrappers is not None and tag in MARKED and not skip and not own:
            wrappers.update(x for x in begun if x >= 0)
        begun.append(at if own and tag != "article" else -1)
        node = Node(tag, skip)
        if not skip:
            stack[-1].parts.append(node)
        elif block and not stack[-1].skip:
            stack[-1].parts.append(Node("hr"))  # what stands before and after it are two blocks
        stack.append(node)
    return root


def close_open(stack: list[Node], tags: set[str], fences: set[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in fences:
            return


def match(a: Node, b: Node, known: dict) -> int:
    """Simple tree matching: the number of node pairs in the best alignment of two trees of one tag."""
    key = (id(a), id(b))
    if key not in known:
        left, right = a.children, b.children
        rows = [[0] * (len(right) + 1)]
        for x in left:
            above, row = rows[-1], [0]
            for j, y in enumerate(right):
                best = above[j + 1] if above[j + 1] >= row[j] else row[j]
                if x.tag == y.tag:
                    # Two elements without elements in them are one pair.
                    pair = above[j] + (1 if not x.children and not y.children else match(x, y, known))
                    best = pair if pair > best else best
                row.append(best)
            rows.append(row)
        known[key] = 1 + rows[-1][-1], left, right, rows
    return known[key][0]


def align(a: Node, b: Node) -> dict[int, Node]:
    """Nodes of ``b`` by the id of the node of ``a`` they are aligned with."""
    known: dict = {}
    match(a, b, known)
    out, open_pairs = {}, [(a, b)]
    while open_pairs:
        x, y = open_pairs.pop()
        out[id(x)] = y
        if (id(x), id(y)) not in known:
            continue
        _, left, right, rows = known[id(x), id(y)]
        i, j = len(left), len(right)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                open_pairs.append((left[i], right[j]))
    return out


def below(node: Node) -> Iterator[Node]:
    yield node
    for child in node.children:
        yield from below(child)


def mass(node: Node, template: set[int]) -> int:
    return sum(len(x.text()) for x in below(node) if id(x) not in template)


def container(tree: Node, template: set[int]) -> Node:
    """The element with the content: the fullest article or main element, or else the fullest branch."""
    marked = [x for x in below(tree) if x.tag in ("article", "main")]
    if marked:
        fullest = max(marked, key=lambda x: mass(x, template))
        inner = [x for x in below(fullest) if x is not fullest and x.tag == "article"
                 and 2 * mass(x, template) > mass(fullest, template)]
        return inner[0] if inner else fullest
    return tree


def block_texts(node: Node, template: set[int]) -> Iterator[str]:
    """Texts of the blocks in page order; a block is cut where another one stands inside it."""
    waiting: list[str] = []

    def flush():
        text = " ".join("".join(waiting).split())
        waiting.clear()
        return [text] if text else []

    def walk(x: Node) -> Iterator[str]:
        for part in x.parts:
            if not isinstance(part, str):
                yield from flush()
                yield from walk(part)
                yield from flush()
            elif id(x) not in template:
                waiting.append(part)

    yield from walk(node)
    yield from flush()


def layouts(trees: list[Node]) -> Iterator[list[tuple[int, dict[int, Node]]]]:
    """Pages with text by layout: their numbers, and their nodes by the id of the node of the layout's fullest page.

    A page is of a layout if half of its elements, or of the fullest page's, are aligned with it.
    """
    sizes = [sum(1 for _ in below(tree)) for tree in trees]
    left = [i for i, tree in enumerate(trees) if any(x.text() for x in below(tree))]
    while len(left) >= SAME_PAGES:
        fullest = max(left, key=lambda i: sizes[i])
        found = {i: align(trees[fullest], trees[i]) for i in left}  # the fullest with itself, so that it takes part
        own = [i for i in left if 2 * len(found[i]) >= min(sizes[i], sizes[fullest])]
        yield [(i, found[i]) for i in own]
        left = [i for i in left if i not in set(own)]


def induce(trees: list[Node]) -> list[set[int]]:
    """For each page of a cell the ids of its template nodes."""
    pages = [set() for _ in trees]
    texts = [tuple(x.text() for x in below(tree)) for tree in trees]
    for layout in layouts(trees):
        different = len({texts[i] for i, _ in layout})
        said: dict[tuple[int, str], list[tuple[int, Node]]] = {}
        for i, found in layout:
            for at, node in found.items():
                if node.text():
                    said.setdefault((at, node.text()), []).append((i, node))
        for same in said.values():
            support = len({texts[i] for i, _ in same})
            if support >= SAME_PAGES and support >= SAME_SHARE * different:
                for i, node in same:
                    pages[i].add(id(node))
        shares = []
        for i, _ in layout:
            content = container(trees[i], pages[i])
            whole = mass(content, set())
            shares.append((whole - mass(content, pages[i])) / max(1, whole))
        if sorted(shares)[len(shares) // 2] > TEMPLATE_SHARE:
            for i, _ in layout:
                pages[i].clear()
    return pages


def extract(htmls: list[str]) -> list[str]:
    """Main texts of pages that share a host."""
    trees = [parse(html) for html in htmls]
    return ["\n".join(block_texts(container(tree, template), template))
            for tree, template in zip(trees, induce(trees), strict=True)]


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    named = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                         F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"))
    many = (named.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
            .select(F.col("host").alias("many"), F.ceil(F.col("n") / CELL).alias("cells")))
    many = cut(many, "busy-hosts")
    if many.count() <= BROADCAST_ROWS:  # pages then move once, by host and cell
        many = F.broadcast(many)
    dealt = (named.join(many, F.col("host") == F.col("many"), "left")
             .withColumn("cell", F.coalesce(F.pmod(F.xxhash64("page_id", "url"), "cells"), F.lit(0))))

    def wrap(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["page_id", "html"], ignore_index=True)
        texts = extract(cell["html"].tolist())
        return pd.DataFrame({"page_id": cell["page_id"], "url": cell["url"], "text": texts,
                             "n_chars": [len(text) for text in texts]})

    kinds = dict(pages.dtypes)
    # Beyond that bound the join has dealt pages by host alone: the cells are dealt anew.
    dealt = dealt.select("page_id", "url", "html", "host", "cell").repartition("host", "cell")
    return dealt.groupBy("host", "cell").applyInPandas(
        wrap, f"page_id {kinds['page_id']}, url string, text string, n_chars long")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
