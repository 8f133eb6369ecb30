"""Main text of web pages by wrappers, inferred as union-free regular expressions.

A page is a stream of tags and texts. Streams of one host are aligned one after the other
with the host's wrapper: equal tags match, groups of one to three tags that follow themselves
become repeated, what only one side has becomes optional. Nesting keeps the alignment local:
it runs over the groups inside one pair of tags. A text of the wrapper is constant where the
pages of the host agree on it, else it is a slot: texts are held against those at the same
place, the path of groups, of all other pages of the host. That comparison is a count of
(host, place, text) on Spark, so it is exact for hosts of any size.

The main text is what stands inside the article (or main) of a host that has one; elsewhere
it is the slots, that is what differs between pages, if at least ``AGREEING`` different pages
tell (a page that is constant throughout keeps its texts). Menus, headers, footers, sidebars,
notices, adverts, forms, scripts and comment sections that are named as such by their tag,
class, id or role go in any case: pages do not tell a list of related articles, which varies,
from an article.

Different shapes of a host are few, and are reduced before they meet: equal shapes of a
host count once, and wrappers are merged in parts of at most about ``FOLDED`` shapes, round
by round, so no host fills a task. Wrappers are sent to all tasks if their measured size
allows, else joined with a salt.

Nulls: null html counts as empty and has no text; pages without a host in their ``url``
share one wrapper. Repeated rows are extracted each; unclosed tags and pages that end
inside a tag are read as far as they go. Pages may be long and nested to any depth. An empty
table gives no rows; columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import code_on_workers, stored, table
from callgrove.plans.lineage import cut_and_observe
from callgrove.plans.lookup import lookup, measured_bytes

#: Shapes of a host that one task merges.
FOLDED = 256
#: Different pages of a host that have to share a text, and the part of them, to make it constant.
AGREEING, AGREEING_PART = 3, 0.5
#: Longest group of tags that is seen to repeat.
PERIOD = 3

#: Elements of HTML by their role.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title"}
VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "col", "area", "base", "embed", "track", "param"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"} | RAW
#: Words of a class or id that name something other than main text.
MARKS = {
    "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "menu", "nav", "navigation", "navbar",
    "breadcrumb", "breadcrumbs", "header", "footer", "sidebar", "side", "aside", "widget", "notice", "cookie",
    "cookies", "consent", "popup", "newsletter", "subscribe", "share", "social", "related", "comment", "comments",
    "reply", "replies", "disqus", "login", "search",
}
#: Opening tags that end an open element of their own kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


@dataclass
class Node:
    """An element of a page, or a group of a wrapper: once, optional or repeated."""

    key: str
    children: list = field(default_factory=list)
    optional: bool = False
    repeated: bool = False

    @property
    def tag(self) -> str:
        return self.key.partition(".")[0]


SLOT = "#"
#: What the key of a group of several tags begins with.
GROUP = "("


def parsed(page: str) -> Node:
    """Tree of a page; text is kept in children that are strings, still escaped."""
    root = Node("")
    stack = [root]
    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        closing, tag, attributes, text = m.groups()
        if text is not None:
            stack[-1].children.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in CLOSES and len(stack) > 1:
            inner = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag not in INLINE), 0)
            if inner and stack[inner].tag in CLOSES[tag]:
                del stack[inner:]
        elif tag not in INLINE and stack[-1].tag != "" and any(n.tag == "p" for n in stack[-3:]):
            # A block ends an open paragraph.
            depth = next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == "p")
            if all(n.tag in INLINE for n in stack[depth + 1 :]):
                del stack[depth:]
        names = sorted({w for g in _NAMED.findall(attributes) for w in re.split(r"[^a-z0-9]+", "".join(g).lower())} & MARKS)
        node = Node(".".join([tag, *names]))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(node)
    return root


def nested(call: Generator) -> Any:
    """Value of a function that yields its calls of itself: pages nest deeper than Python does."""
    calls, value = [call], None
    while calls:
        try:
            inner = calls[-1].send(value)
        except StopIteration as done:
            calls.pop()
            value = done.value
        else:
            calls.append(inner)
            value = None
    return value


def shape(node: Node) -> Node:
    """A page's own wrapper: texts as slots, groups that follow themselves as repeated ones."""

    def shaped(node: Node) -> Generator:
        children: list[Node] = []
        for child in node.children:
            yield from _append(children, Node(SLOT) if isinstance(child, str) else (yield shaped(child)))
        return Node(node.key, children)

    return nested(shaped(node))


def _append(children: list[Node], child: Node) -> Generator:
    """Add a child; the last few children become a repeated group where they follow themselves."""
    children.append(child)
    for period in range(1, PERIOD + 1):
        last, before = children[-period:], children[-2 * period : -period]
        keys = [c.key for c in last]
        if period > 1 and len(children) > period and children[-period - 1].key == _group_key(keys):
            before = children[-period - 1].children
            del children[-period - 1 :]
        elif len(before) == period and keys == [c.key for c in before]:
            del children[-2 * period :]
        else:
            continue
        both = []
        for a, b in zip(before, last, strict=True):
            one = yield _merging(a, b)
            one.optional = a.optional or b.optional
            both.append(one)
        if period > 1:
            children.append(Node(_group_key(keys), both, False, True))
        else:
            both[0].repeated = both[0].key != SLOT
            both[0].optional = before[0].optional and last[0].optional
            children.append(both[0])
        return


def _group_key(keys: list[str]) -> str:
    """Key of a group that has no tag of its own."""
    return GROUP + " ".join(keys)


def merged(a: Node, b: Node) -> Node:
    """Align two groups of one key: what only one of them has becomes optional."""
    return nested(_merging(a, b))


def _merging(a: Node, b: Node) -> Generator:
    left, right = a.children, b.children
    # Longest common subsequence of keys; lists of distinct groups are short.
    n, m = len(left), len(right)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            if left[i].key == right[j].key:
                best[i][j] = best[i + 1][j + 1] + 1
            else:
                best[i][j] = max(best[i + 1][j], best[i][j + 1])
    out: list[Node] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and left[i].key == right[j].key:
            child = yield _merging(left[i], right[j])
            child.optional = left[i].optional or right[j].optional
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            child = Node(left[i].key, left[i].children, True, left[i].repeated)
            i += 1
        else:
            child = Node(right[j].key, right[j].children, True, right[j].repeated)
            j += 1
        yield from _append(out, child)
    return Node(a.key, out, a.optional or b.optional, a.repeated or b.repeated)


def as_text(node: Node) -> str:
    """A wrapper as text: key, number of children and flags of its groups in pre-order."""
    flat: list = []
    stack = [node]
    while stack:
        one = stack.pop()
        flat += [one.key, len(one.children), one.optional + 2 * one.repeated]
        stack += reversed(one.children)
    return json.dumps(flat, separators=(",", ":"))


def _unpacked(text: str) -> Node:
    flat = json.loads(text)
    root = Node("")
    open_ = [(root, 1)]
    for at in range(0, len(flat), 3):
        key, size, flags = flat[at : at + 3]
        node = Node(key, [], bool(flags & 1), bool(flags & 2))
        parent, left = open_.pop()
        parent.children.append(node)
        if left > 1:
            open_.append((parent, left - 1))
        if size:
            open_.append((node, size))
    return root.children[0]


@lru_cache(4096)
def from_text(text: str) -> Node:
    return _unpacked(text)


def fold(shapes: list[str]) -> str:
    """Wrapper of several shapes, aligned one after the other."""
    wrapper: Node | None = None
    for one in sorted(shapes, key=lambda s: (-len(s), s)):
        node = _unpacked(one)
        wrapper = node if wrapper is None else merged(wrapper, node)
    return as_text(wrapper)


def expression(node: Node) -> str:
    """The wrapper as a regular expression over tags, for people."""

    def written(node: Node) -> Generator:
        parts = []
        for child in node.children:
            parts.append((yield written(child)))
        inner = " ".join(parts)
        plain = not node.key or node.key.startswith(GROUP)
        body = SLOT if node.key == SLOT else inner if plain else f"<{node.key}>{f' {inner} ' if inner else ''}</>"
        if not (node.optional or node.repeated):
            return body
        return f"({body})" + ("*" if node.optional and node.repeated else "+" if node.repeated else "?")

    return nested(written(node))


def _tags(node: Node) -> set[str]:
    """Tags of a wrapper outside of boilerplate."""
    found, stack = set(), [node]
    while stack:
        for child in stack.pop().children:
            if child.tag not in BOILERPLATE:
                found.add(child.tag)
                stack.append(child)
    return found


@lru_cache(4096)
def region(text: str) -> frozenset[str]:
    """Tags that hold the main text of a wrapper, empty if it has none of them."""
    tags = _tags(from_text(text))
    return next((frozenset({t}) for t in ("article", "main") if t in tags), frozenset())


Block = tuple[str, str]


def main_blocks(page: str, holders: frozenset[str]) -> list[Block]:
    """(place, text) of the blocks that may be main text, in page order.

    The place of a block is a digest of the path of groups that it stands in.
    """
    blocks: list[tuple[str, list[str]]] = [("", [])]

    def read(node: Node, path: str, inside: bool) -> Generator:
        for child in node.children:
            if isinstance(child, str):
                if inside:
                    blocks[-1][1].append(child)
                continue
            tag, *marks = child.key.split(".")
            if tag in BOILERPLATE and not (tag == "header" and inside and holders):
                continue
            if marks and tag not in holders and tag not in ("html", "body"):
                continue
            if tag in ("br", "wbr"):
                blocks[-1][1].append(" " if tag == "br" else "")
            elif tag in INLINE:
                yield read(child, path, inside)
            else:
                inner = hashlib.md5(f"{path}/{child.key}".encode("utf-8", "surrogatepass")).hexdigest()
                blocks.append((inner, []))
                yield read(child, inner, inside or tag in holders)
                blocks.append((path, []))

    nested(read(parsed(page), "", not holders))
    texts = ((place, " ".join(references.unescape("".join(parts)).split())) for place, parts in blocks)
    return [(place, text) for place, text in texts if text]


def digest_of(block: Block) -> int:
    """Signed 64-bit digest of a text and its place."""
    raw = hashlib.md5("\0".join(block).encode("utf-8", "surrogatepass")).digest()
    return int.from_bytes(raw[:8], "little", signed=True)


def main_text(page: str, wrapper_text: str, constants: frozenset[int] = frozenset()) -> str:
    """Text of a page's main slots; constants of its host are left out where any slot is left."""
    blocks = main_blocks(page, region(wrapper_text))
    slots = [block for block in blocks if digest_of(block) not in constants] if constants else blocks
    return "\n".join(text for _, text in slots or blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) inferred from all pages (host, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            new = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                key = (host, as_text(shape(parsed(page.as_py() or ""))))
                if key not in seen:
                    new[key] = None
            # Equal shapes of a task go out once; the set is only a saving and may be dropped.
            seen = seen | new.keys() if len(seen) < 100_000 else set(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in new], pa.string()), pa.array([k[1] for k in new], pa.string())], ["host", "shape"]
            )

    shapes = pages.select("host", "html").mapInArrow(run, "host string, shape string").distinct()

    def fold_rows(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "shape": [fold(list(rows["shape"]))]})

    # Parts of about FOLDED shapes, then parts of what they gave, until each host has one.
    shapes = stored(shapes)
    while True:
        counts = shapes.groupBy("host").agg(F.count(F.lit(1)).alias("_n"))
        counts, seen = cut_and_observe(counts, most=F.max("_n"), hosts=F.count(F.lit(1)))
        if (seen.get("most") or 0) <= 1:
            return shapes.select("host", F.col("shape").alias("wrapper"))
        sized = lookup(shapes, counts, ["host"], table_bytes=96.0 * seen.get("hosts"), spread=["shape"])
        part = F.pmod(F.xxhash64("shape"), F.ceil(F.col("_n") / FOLDED)).alias("_part")
        shapes = stored(
            sized.select("host", "shape", part).groupBy("host", "_part").applyInPandas(fold_rows, "host string, shape string")
        )


def constant_texts(pages: DataFrame) -> DataFrame:
    """(host, constants): digests of the texts that the different pages of a host share.

    Only hosts whose wrapper names no article need them. ``pages`` has host, html, wrapper.
    Equal pages count as one. A constant stands on at least half of a host's pages, so there
    are at most twice as many as texts on an average page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, digests = [], []
            columns = (batch.column(c) for c in ("host", "html", "wrapper"))
            for host, page, wrapper in zip(*columns, strict=True):
                if not region(wrapper.as_py()):
                    found = {digest_of(block) for block in main_blocks(page.as_py() or "", frozenset())}
                    hosts += [host.as_py()] * (len(found) + 1)
                    # The null stands for the page itself.
                    digests += [None, *found]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(digests, pa.int64())], ["host", "digest"])

    once = pages.groupBy("host", F.xxhash64("html"), F.md5("html")).agg(F.first("html").alias("html"), F.first("wrapper").alias("wrapper"))
    counts = once.select("host", "html", "wrapper").mapInArrow(run, "host string, digest long")
    counts = stored(counts.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("_n")).where(f"digest is null or _n >= {AGREEING}"))
    totals = counts.where("digest is null").select("host", F.col("_n").alias("_pages"))
    shared = counts.where("digest is not null").join(totals, "host").where(F.col("_n") >= AGREEING_PART * F.col("_pages"))
    return shared.groupBy("host").agg(F.collect_list("digest").alias("constants"))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    code_on_workers(pages.sparkSession)
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    found = wrappers(rows)
    size = measured_bytes(found, F.length("wrapper") + F.length("host") + 64)
    plain = stored(found.join(constant_texts(lookup(rows, _without_article(found), ["host"], table_bytes=size, spread=["page_id", "url"])), "host", "left"))
    size += measured_bytes(plain, 8 * F.coalesce(F.size("constants"), F.lit(0)))
    joined = lookup(rows, plain, ["host"], table_bytes=size, spread=["page_id", "url"])
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                columns = (part.column(c) for c in ("html", "wrapper", "constants"))
                texts = [
                    main_text(page.as_py() or "", wrapper.as_py(), frozenset(constants.as_py() or ()))
                    for page, wrapper, constants in zip(*columns, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
                )

    return joined.select("page_id", "url", "html", "wrapper", "constants").mapInArrow(
        run, f"page_id {kind}, url string, text string"
    )


def _without_article(found: DataFrame) -> DataFrame:
    """Wrappers of hosts in which no tag holds the main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not region(w.as_py()) for w in batch.column("wrapper")], pa.bool_()))

    return found.select("host", "wrapper").mapInArrow(run, "host string, wrapper string")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extracted(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
