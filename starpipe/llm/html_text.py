"""Main text of web pages by site style trees.

A page is a tree of elements; an element's path of tags, classes and ids is its presentation. Pages
of one host are merged: a node of the host's style tree is a presentation, and what its elements hold
on the host's pages, their text and the order of their children, has an entropy. A node whose text
and shape are the same on page after page says nothing about any one of them: its importance, the
larger entropy relative to that of as many different contents, is low, and its branch is removed from
every page of the host. Where no article or main element says what the text is, each text at a node
is judged, too: its importance is the entropy that the node would have if all other pages differed. Elements whose tag or name says what they are (menus, footers, adverts,
forms, comments ...) are removed on any page, since their contents may well differ.

Trees are merged as counts of (host, node, content) with partial aggregates, so a host with a third of
all pages is no larger task than another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import cut
from starpipe.llm.url_filter import host_of

#: Different pages of a host that must have a node before its importance counts.
MIN_PAGES = 5
#: Nodes below this importance are removed.
MIN_IMPORTANCE = 0.1

# What HTML calls its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_SIBLING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: Never text of an article.
NOISE_TAGS = frozenset(
    "aside button canvas dialog footer form head iframe input menu nav noscript object script select "
    "style svg template textarea title".split()
)
NOISE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
#: Words in classes and ids of what surrounds an article. An article inside such an element still counts.
AROUND = frozenset(
    "banner breadcrumb breadcrumbs footer header login masthead menu nav navbar navigation pagination "
    "search sidebar skip toolbar topbar widget widgets".split()
)
#: Classes and ids made of these words alone name what stands in or beside an article and is none,
#: whatever it contains.
BESIDE = frozenset(
    "ad ads advert advertisement advertising adverts comment comments consent cookie cookies disqus "
    "gdpr modal newsletter notice notices overlay popup promo promoted promotion related replies reply "
    "respond share sharing signup social sponsor sponsored subscribe subscription teaser".split()
)

#: Words that only say that something is a box.
BOX = frozenset(
    "area bar block box btn button buttons container content form group inner item items link links list "
    "main outer panel section slot thread top unit wrap wrapper".split()
)

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

TEXTS = "page_id long, url string, text string, n_chars long"


class _Element:
    __slots__ = ("beside", "key", "noise", "region", "tag")

    def __init__(self, tag: str, key: str, noise: bool, beside: bool, region: str):
        self.tag, self.key, self.noise, self.beside, self.region = tag, key, noise, beside, region


def _is_beside(names: str) -> bool:
    """Whether a class or id, as a whole, names what stands beside an article."""
    for name in names.split():
        words = {word.lower() for word in _WORDS.findall(name) if not word.isdigit()}
        if words & BESIDE and words <= BESIDE | BOX:
            return True
    return False


class _Page(HTMLParser):
    """Collects blocks: (path, text, in which region) for text outside of noise, and shapes."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.blocks: list[tuple[tuple[str, ...], str, str]] = []
        self.children: list[tuple[tuple[str, ...], str]] = []
        self.pieces: list[str] = []

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                region = self.open[-1].region if self.open else ""
                self.blocks.append((tuple(e.key for e in self.open), text, region))

    def _pop(self, at: int) -> None:
        self.flush()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br" or tag == "wbr":
            self.pieces.append(" ")
            return
        if tag in VOID and tag != "hr":
            return
        if tag not in BLOCKS and tag not in NOISE_TAGS:
            # Inline elements have no part in the tree, unless they are named as noise.
            if not any(name in ("class", "id", "role") for name, _ in attrs):
                return
        elif tag in BLOCKS:
            self.flush()
            if self.open and self.open[-1].tag == "p":
                self._pop(len(self.open) - 1)
        if tag == "hr":
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag in CLOSED_BY_SIBLING.get(tag, ()):
                self._pop(i)
            elif self.open[i].tag in ("ul", "ol", "dl", "table", "select", "div", "section", "article"):
                break
        self._push(tag, dict(attrs))

    def _push(self, tag: str, attrs: dict[str, str | None]) -> None:
        up = self.open[-1] if self.open else _Element("", "", False, False, "")
        names = " ".join(attrs.get(name) or "" for name in ("class", "id"))
        words = {word.lower() for word in _WORDS.findall(names)}
        frame = tag in ("html", "body")
        text_body = tag in ("article", "main")
        # The name of an article's own element is often made of its title.
        beside = up.beside or tag in NOISE_TAGS
        beside = beside or (not frame and not text_body and _is_beside(names))
        beside = beside or (attrs.get("role") or "").lower() in NOISE_ROLES
        around = not up.region and (tag == "header" or bool(words & AROUND))
        noise = beside or (not text_body and not frame and (up.noise or around))
        region = up.region
        if text_body and not beside and up.region != "main":
            region = tag
        if tag not in BLOCKS and not noise:
            return
        key = tag + "".join(f".{x}" for x in sorted(names.split()))
        if not noise:
            self.children.append((tuple(e.key for e in self.open), tag))
        self.open.append(_Element(tag, key, noise, beside, region))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash at the end closes nothing but what is void anyway.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self._pop(i)
                return
            if self.open[i].tag in ("article", "main", "body") and tag not in ("html", "body"):
                if tag not in ("main", "article"):
                    return

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1].noise):
            self.pieces.append(data)


def parse(html: str | None) -> _Page:
    page = _Page()
    if html:
        page.feed(html)
        page.close()
        page.flush()
    return page


def main_blocks(page: _Page) -> list[tuple[tuple[str, ...], str]]:
    """Blocks of the main element, else of articles, else all."""
    for region in ("main", "article"):
        if chosen := [(path, text) for path, text, where in page.blocks if where == region]:
            return chosen
    return [(path, text) for path, text, _ in page.blocks]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, node, kind, value): a page's text and shape at each node of its tree."""
    for batch in batches:
        rows: list[tuple[str, int, str, str, int]] = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = parse(html)
            blocks = main_blocks(page)
            texts: dict[tuple[str, ...], list[str]] = {}
            shapes: dict[tuple[str, ...], list[str]] = {}
            for path, text in blocks:
                for depth in range(1, len(path) + 1):
                    texts.setdefault(path[:depth], []).append(text)
            for path, tag in page.children:
                if path in texts:
                    shapes.setdefault(path, []).append(tag)
            leaves = {} if any(region for *_, region in page.blocks) else dict.fromkeys(blocks)
            own = _hash("\n".join(text for _, text in blocks))
            for kind, values in (("text", texts), ("shape", shapes)):
                rows += [
                    (host, own, " ".join(path), kind, _hash("\n".join(parts)))
                    for path, parts in values.items()
                ]
            rows += [(host, own, " ".join(path), "leaf", _hash(text)) for path, text in leaves]
        if rows:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                names=["host", "page", "node", "kind", "value"],
            )


def node_counts(pages: DataFrame) -> DataFrame:
    """(host, node, kind, value, n): on how many pages of (host, html) a node has a content.

    Pages with equal main text count once, so copies of a page make none of it unimportant.
    """
    rows = pages.where("host <> ''").mapInArrow(
        _nodes, "host string, page long, node string, kind string, value long"
    )
    return rows.distinct().groupBy("host", "node", "kind", "value").agg(F.count("*").alias("n"))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of the style trees of (host, html)."""
    return node_importance(node_counts(pages))


def node_importance(counts: DataFrame) -> DataFrame:
    counts = counts.where("kind <> 'leaf'")
    total = F.sum("n")
    # Entropy of n_i / N relative to log N: 1 if all contents differ, 0 if all are equal.
    entropy = 1 - F.sum(F.col("n") * F.log("n")) / (total * F.log(total))
    kinds = counts.groupBy("host", "node", "kind").agg(
        total.alias("pages"), F.when(total > 1, entropy).otherwise(1.0).alias("entropy")
    )
    return kinds.groupBy("host", "node").agg(
        F.max("pages").alias("pages"), F.max("entropy").alias("importance")
    )


def dull_leaves(counts: DataFrame, nodes: DataFrame, min_pages: int, least: float) -> DataFrame:
    """(host, node, value) of texts that are on nearly all pages that have their node."""
    leaves = counts.where((F.col("kind") == "leaf") & (F.col("n") >= min_pages))
    joined = leaves.join(nodes.select("host", "node", "pages"), ["host", "node"])
    same = F.col("n") * F.log("n") / (F.col("pages") * F.log("pages"))
    return joined.where(1 - same < least).select("host", "node", "value")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        columns = [batch.column(name).to_pylist() for name in ("html", "low", "leaves")]
        for html, low, leaves in zip(*columns):
            page = parse(html)
            blocks = main_blocks(page)
            if leaves and not any(region for *_, region in page.blocks):
                dull = {(leaf["node"], leaf["value"]) for leaf in leaves}
                blocks = [(path, text) for path, text in blocks if (" ".join(path), _hash(text)) not in dull]
            if low:
                nodes = {tuple(node.split(" ")) for node in low}
                blocks = [
                    (path, text)
                    for path, text in blocks
                    if not any(path[:depth] in nodes for depth in range(1, len(path) + 1))
                ]
            texts.append("\n".join(text for _, text in blocks))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_texts(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_pages: int = MIN_PAGES,
    min_importance: float = MIN_IMPORTANCE,
) -> DataFrame:
    """page_id, url, text, n_chars: a row for each row of ``pages``.

    Character references are decoded, white space in a block becomes one space, blocks are joined
    by a line feed. Null and empty pages have an empty text. Pages without a host (null url, no
    ``://``) are judged by tags and names alone. Repeated rows are answered alike. Other columns are
    ignored, whatever their names; an empty table gives an empty result. A page must fit into memory.
    """
    given = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.col(f"`{html}`").cast("string").alias("html"),
    ).withColumn("host", host_of(F.col("url")))
    counts = cut(node_counts(given.select("host", "html")), "style-counts")
    tree = cut(node_importance(counts), "style-nodes")
    dull = tree.where((F.col("pages") >= min_pages) & (F.col("importance") < min_importance))
    leaf = F.struct("node", "value")
    leaves = dull_leaves(counts, tree, min_pages, min_importance).groupBy("host")
    # One row for each host with such nodes or texts; written, so that Spark knows its size when it joins.
    low = dull.groupBy("host").agg(F.collect_list("node").alias("low"))
    low = low.join(leaves.agg(F.collect_list(leaf).alias("leaves")), "host", "full")
    joined = given.join(cut(low, "style-trees"), "host", "left")
    joined = joined.select("page_id", "url", "html", "low", "leaves")
    return joined.mapInArrow(_texts, TEXTS)
