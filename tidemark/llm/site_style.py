"""Main text of web pages by site style trees.

The element trees of a host's pages are merged: elements with one path of tags and class names
are one node. A node's *presentation* importance is the entropy of the child sequences that it
has on the host's pages, over the logarithm of the number of pages: 0 where it always looks the
same, 1 where it never does twice. Its *content* importance is one less the mean entropy of the
text blocks below it over the pages that have them: 0 where every page repeats them, 1 where
each page has its own. A branch whose presentation and content both are of low importance is
boilerplate and is cut out of each page. The root of the tree is the whole page: a text block that
``MOST`` of the host's pages repeat is boilerplate wherever it stands, in an article, too.

Menus, headers, footers, sidebars, forms, scripts and elements named as adverts, notices or
comments are cut by their markup and do not count as places of a text. Articles and main elements are likely main text, which the tree
can overrule: their branches are cut at an importance that is lower by ``PRIOR``, and the open text
beside them is main text, too, if its weight is more than ``ARTICLE`` times theirs. The weight of a
block is its characters times the content importance of its element. If the tree would leave
nothing of the articles, or no text of the others by repetition alone, the host's pages are copies
of one another and their text stays. A name is a whole class, id or role (``sidebar``, not ``has-sidebar``)
of an element that is no text element (paragraph, heading, list item, cell). It does not cut what
holds an article or main element, unless it names readers' comments and there is another one.

Statistics are counted for each host, node and value, combined before the shuffle; a host that
holds a third of all pages is spread by its nodes and values. Page texts are not shuffled unless
the table of judgements, one row per host, is too large for Spark to send to all tasks.

Defined results: a null page is an empty one, whose text is empty. Broken markup is read as far
as it goes. Pages whose address has no host, and hosts with fewer than ``LEAST_PAGES`` pages, are
judged by their markup and the blocks' characters alone. An embedded element (svg, noscript, ...) without an end tag is not cut,
as the text after it would be, too. Rows that repeat each have their result. Nothing is dropped or
cut to a length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import quoted, text_of
from tidemark.llm.page_tree import EMBEDDED, Node, parse
from tidemark.session import durable

LEAST_PAGES = 4  # pages of a host from which its style tree says something
LOW = 0.2
PRIOR = 0.1  # of importance, for what is in an article or main element
MOST = 0.8  # of a host's pages; copies of one page seldom are as many
ARTICLE = 2
ROOT = 0  # the node that stands for the whole page

CONTENT = frozenset("article main".split())
CUT_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe button select textarea menu "
    "dialog svg title object canvas input label fieldset legend".split()
)
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar "
    "cookie cookies consent notice notices notification alert banner popup modal overlay newsletter "
    "subscribe subscription share sharing social comment comments reply replies discussion respond "
    "disqus search login signup form widget pagination pager complementary contentinfo".split()
)
COMMENT_NAMES = frozenset("comment comments reply replies discussion respond disqus".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th figcaption caption".split())


def host_of(url: str) -> Column:
    """The lower-cased host of an address, empty if there is none."""
    address = F.lower(F.coalesce(F.col(quoted(url)).cast("string"), F.lit("")))
    return F.regexp_extract(address, r"^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]+)", 1)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class Judge:
    """What the markup itself says of an element."""

    def __init__(self, root: Node) -> None:
        self.known: dict[int, tuple[Node, str]] = {}
        # articles and main elements that are not named as something else, in all and below an element
        self.regions, self.below = 0, Counter[int]()
        todo = [root]
        while todo:
            node = todo.pop()
            todo += node.children
            if node.tag == "main" or node.tag == "article" and not self._names(node) & CUT_NAMES:
                self.regions += 1
                above = node.parent
                while above is not None:
                    self.below[id(above)] += 1
                    above = above.parent

    def role(self, node: Node) -> str:
        """cut, content, or open to the statistics; inherited from the parent where it says so."""
        found = self.known.get(id(node))
        if found is None:
            found = self.known[id(node)] = (node, self._role(node))
        return found[1]

    def _role(self, node: Node) -> str:
        above = self.role(node.parent) if node.parent is not None else "open"
        inside = self._inside(node)
        if above == "cut" or node.tag in CUT_TAGS and (node.ended or node.tag not in EMBEDDED):
            return "cut"
        if node.tag == "header" and not inside:
            return "cut"
        if self._named(node):
            return "cut"
        if node.tag in CONTENT:
            return "content"
        return "content" if inside and node.tag in TEXT_TAGS else "open"

    @staticmethod
    def _names(node: Node) -> set[str]:
        return set(node.names.split())

    def _named(self, node: Node) -> bool:
        """Its name says that it is not main text."""
        if node.tag in ("html", "body", "main") or node.tag in TEXT_TAGS:
            return False
        names, below = self._names(node), self.below[id(node)]
        if below:
            return below < self.regions and not names.isdisjoint(COMMENT_NAMES)
        return not names.isdisjoint(CUT_NAMES)

    @staticmethod
    def _inside(node: Node) -> bool:
        above = node.parent
        while above is not None:
            if above.tag in CONTENT:
                return True
            above = above.parent
        return False


def _line(node: Node) -> list[Node]:
    """The element and its ancestors below the body."""
    out = []
    while node is not None and node.tag not in ("", "html", "body"):
        out.append(node)
        node = node.parent
    return out


def _in_article(line: list[Node]) -> bool:
    return any(n.tag in CONTENT for n in line)


def _text(text: str, inside: bool) -> int:
    """A text block's value at the root, where one of an article and one beside it are two."""
    return _hash(text) ^ inside


def observations(page: str) -> set[tuple[int, bool, int]]:
    """What a page adds to its host's tree: (node, is presentation, value) with hashed names."""
    root, blocks = parse(page)
    judge = Judge(root)
    seen: set[tuple[int, bool, int]] = {(ROOT, True, 0)}
    todo = [root]
    while todo:
        node = todo.pop()
        todo += node.children
        if node.tag not in ("", "html", "body"):
            look = "|".join(f"{c.tag}.{c.names}" for c in node.children)
            seen.add((_hash(node.path), True, _hash(look)))
    for owner, text in blocks:
        value, line = _hash(text), _line(owner)
        if judge.role(owner) != "cut":
            seen.add((ROOT, False, _text(text, _in_article(line))))
        for node in line:
            seen.add((_hash(node.path), False, value))
    return seen


def _counts(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Per host, node, kind and value: the pages ``c`` that have it."""
    rows = pages.select(host_of(url).alias("host"), text_of(html).alias("html")).filter("host <> ''")

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, node, look, value = [], [], [], []
            for i, page in enumerate(batch.column("html")):
                for n, is_look, v in observations(page.as_py()):
                    owner.append(i)
                    node.append(n)
                    look.append(is_look)
                    value.append(v)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host").take(pa.array(owner, pa.int64())),
                    pa.array(node, pa.int64()),
                    pa.array(look, pa.bool_()),
                    pa.array(value, pa.int64()),
                ],
                ["host", "node", "look", "value"],
            )

    seen = rows.mapInArrow(observe, "host string, node long, look boolean, value long")
    return seen.groupBy("host", "node", "look", "value").agg(F.count(F.lit(1)).alias("c"))


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Per host and node: ``pages`` that have it, ``presentation`` and ``content`` importance."""
    return _importance(_counts(pages, url, html))


def _importance(counts: DataFrame) -> DataFrame:
    c = F.col("c").cast("double")
    looks, texts = F.col("look"), ~F.col("look")
    nodes = counts.groupBy("host", "node").agg(
        F.coalesce(F.sum(F.when(looks, F.col("c"))), F.lit(0)).alias("pages"),
        F.sum(F.when(looks, c * F.log(c))).alias("_looks"),
        F.count(F.when(texts, 1)).alias("_texts"),
        F.sum(F.when(texts, F.log(c))).alias("_shared"),
    )
    size = F.log(F.col("pages").cast("double"))
    several = F.col("pages") > 1
    return nodes.select(
        "host",
        "node",
        "pages",
        F.when(several, 1 - F.col("_looks") / F.col("pages") / size).otherwise(1.0).alias("presentation"),
        F.when(~several, 1.0)
        .when(F.col("_texts") == 0, 0.0)
        .otherwise(F.greatest(F.lit(0.0), 1 - F.col("_shared") / F.col("_texts") / size))
        .alias("content"),
    )


def judgements(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Per host what its pages need of the tree: ``nodes``, an array of (node, importance, content
    importance) without the nodes that matter as they are, and ``texts``, the repeated ones."""
    counts = durable(_counts(pages, url, html), "counts")  # two readers
    tree = _importance(counts).filter(F.col("pages") >= LEAST_PAGES)
    sizes = tree.filter(F.col("node") == ROOT).select("host", F.col("pages").alias("size"))
    # few are left of a host's texts before they meet its size
    texts = counts.filter(
        (F.col("node") == ROOT) & ~F.col("look") & (F.col("c") >= F.lit(MOST * LEAST_PAGES))
    )
    texts = texts.join(sizes, "host").filter(F.col("c") >= MOST * F.col("size"))
    # a low importance implies a low content importance
    low = tree.filter((F.col("node") != ROOT) & (F.col("content") < 0.5))
    nodes = F.struct("node", F.greatest("presentation", "content").alias("importance"), "content")
    text = F.col("value").alias("text")
    both = low.select("host", nodes.alias("node"), F.lit(None).cast("long").alias("text")).unionByName(
        texts.select("host", F.lit(None).cast(low.select(nodes.alias("n")).schema["n"].dataType).alias("node"), text)
    )
    return both.groupBy("host").agg(F.collect_list("node").alias("nodes"), F.collect_list("text").alias("texts"))


NOTHING: dict[int, tuple[float, float]] = {}


def _main_text(
    page: str, repeated: frozenset[int], nodes: dict[int, tuple[float, float]] = NOTHING
) -> str:
    """``repeated`` texts and the importance and content importance of ``nodes``, by hash; nodes
    that are not in it matter fully."""
    root, blocks = parse(page)
    judge = Judge(root)
    known: dict[int, tuple[float, float]] = {}

    def matters(node: Node) -> tuple[float, float]:
        if id(node) not in known:
            known[id(node)] = nodes.get(_hash(node.path), (1.0, 1.0)) if nodes else (1.0, 1.0)
        return known[id(node)]

    found: list[tuple[bool, bool, str]] = []  # in an article, shared, text
    weight = {True: 0.0, False: 0.0}
    for owner, text in blocks:
        if judge.role(owner) == "cut":
            continue
        line = _line(owner)
        inside = _in_article(line)
        low = any(matters(n)[0] + PRIOR * inside < LOW for n in line)
        if low and not inside:
            continue
        shared = low or bool(repeated) and _text(text, inside) in repeated
        found.append((inside, shared, text))
        if not shared:
            weight[inside] += len(text) * matters(owner)[1]
    # a region of which nothing would be left is one that pages have copied
    own = {inside for inside, shared, _ in found if not shared}
    main = any(inside for inside, _, _ in found)
    if True not in own:
        weight[True] = sum(len(text) for inside, _, text in found if inside)
    beside = not main or weight[False] > ARTICLE * weight[True]
    cut = {True: True in own or beside, False: False in own}
    return "\n".join(
        text
        for inside, shared, text in found
        if (inside or beside) and not (shared and cut[inside])
    )


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Every page with its main ``text`` and ``n_chars``."""
    tree = durable(judgements(pages, url, html), "tree")
    rows = pages.select(
        F.col(quoted(key)).alias("key"),
        F.col(quoted(url)).alias("url"),
        host_of(url).alias("host"),
        text_of(html).alias("html"),
    ).join(tree, "host", "left")
    schema = T.StructType(
        [
            T.StructField(key, rows.schema["key"].dataType),
            T.StructField("url", rows.schema["url"].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, tuple[frozenset[int], dict[int, tuple[float, float]]]] = {}
        for batch in batches:
            texts = []
            for host, page, nodes, same in zip(*map(batch.column, ("host", "html", "nodes", "texts"))):
                name = host.as_py()
                if name not in trees:
                    if len(trees) > 1000:
                        trees.clear()
                    known = {n["node"]: (n["importance"], n["content"]) for n in nodes.as_py() or ()}
                    trees[name] = frozenset(same.as_py() or ()), known
                texts.append(_main_text(page.as_py(), *trees[name]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(np.array([len(t) for t in texts], "i8")),
                ],
                schema.names,
            )

    return rows.select("key", "url", "host", "html", "nodes", "texts").mapInArrow(extract, schema)
