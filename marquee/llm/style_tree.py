"""Main text of web pages by site style trees (operator 1).

The pages of a host are merged into one tree: an element is known by the labels (tag and classes)
on the way to it. Each of its presentations (the order of its children's labels) and each of its
texts is counted over the host's pages. The importance of a presentation node is the entropy of its
presentations, that of a content node is 1 less the mean entropy of its texts over the pages: text
that stands on every page tells nothing. Both mix into a composite importance, in which the mean of
the content nodes of a branch weighs more the fewer presentations its root has. A branch whose every node
stays below ``LEAST`` is cut from the pages of the host, if at least ``PAGES`` of them have it.

Pages say themselves what much of their boilerplate is, and a host's menus or adverts can differ on
every page. So elements that declare such a role (nav, footer, aside, form, class "ad", "comments",
...) have no importance from the start. The tree covers the rest of the body: a page's content begins
at its article or main element only if that holds all of it. A form or the like that holds the page's
title, an article or most of its text is a wrapper and declares nothing. Headings and plain paragraphs
are cut only with a branch, and a page keeps its text where cutting would leave none, if need be that
of elements that declare a role, but for hidden ones.

Counting is partial before it is shuffled, and only counts are. Branches to cut are one array a
host, joined to the pages; Spark broadcasts that table if its files are small, else it shuffles.

Defined cases: a null or empty html gives an empty text. A page whose url is null or has no host
belongs to no tree. Repeated rows count each time. Elements deeper than ``DEPTH`` share the node of
the ancestor at that depth; their text is kept. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written
from marquee.llm.html import HEADINGS, Element, parse
from marquee.llm.words import text_slices

#: Least importance of a branch, pages that must have it, discount a presentation, and levels of the tree.
LEAST, PAGES, DISCOUNT, DEPTH = 0.3, 10, 0.9, 24
#: Elements and names that declare boilerplate.
NOISE_TAGS = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
NOISE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "alerts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "contentinfo", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "form", "gdpr", "hidden", "login", "masthead", "menu", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promotion", "promoted", "related", "replies", "reply",
    "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
}
#: The others don't declare it for an element that holds the page's title: a wrapper named "with-sidebar" is no sidebar.
NEVER_TITLED = {"banner", "comment", "comments", "hidden", "masthead", "menu", "nav", "navbar", "navigation"}
#: Inside a text only these declare it.
INLINE_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "hidden", "promo", "promoted", "promotion", "sponsor", "sponsored"}
#: Words that say nothing beside such a name: "comment-list" declares comments, "related-work" or "overflow-hidden" nothing.
PLAIN_NAMES = {
    "area", "bar", "block", "body", "bottom", "box", "boxes", "button", "buttons", "col", "column", "container", "content", "desktop", "global", "group", "inner", "item", "items",
    "left", "link", "links", "list", "main", "mobile", "module", "outer", "page", "panel", "primary", "right", "row", "secondary", "section", "site", "slot", "text", "top", "unit",
    "widget", "wrap", "wrapper",
}
#: These elements declare it only if the page isn't wrapped in them.
WRAPPERS = {"form", "fieldset", "dialog"}
CONTENT = {"article", "main"}
#: These declare it only outside an article or main element, where they hold the article's own title.
OUTER = {"header", "topbar"}


_ROLES = NOISE_NAMES | OUTER


@lru_cache(maxsize=1 << 16)
def _roles(names: frozenset) -> frozenset:
    """The roles that an element's class, id and role declare; a token counts as a whole."""
    tokens = [set(name.split("-")) for name in names]
    return frozenset(w for words in tokens if words <= _ROLES | PLAIN_NAMES for w in words & _ROLES)


def _inline_noise(names: frozenset) -> bool:
    return not _roles(names).isdisjoint(INLINE_NAMES)


def _named(e: Element) -> bool:
    return e.tag != "main" and not _roles(e.names).isdisjoint(NOISE_NAMES)


def _declared(e: Element) -> bool:
    if e.tag in NOISE_TAGS and not (e.tag in WRAPPERS and e.titled):
        return True
    return _named(e) and not (e.titled and _roles(e.names).isdisjoint(NEVER_TITLED))


def _outer(e: Element) -> bool:
    return e.tag in OUTER or not _roles(e.names).isdisjoint(OUTER)


def _mark_wrappers(root: Element) -> None:
    """Forms and the like that hold an article or, outside of articles, most of the page's text count as titled, and so do the elements around them.

    On a page without article and main elements this also holds for elements that only a name declares."""
    every = list(root.walk())
    named = set() if any(e.tag in CONTENT for e in every) else {e for e in every if e.names and _named(e)}
    if not named and not any(e.tag in WRAPPERS for e in every):
        return
    size, holds, inside = {}, set(), set()
    for e in every:
        if e.tag in CONTENT or e.parent in inside:
            inside.add(e)
    for e in reversed(every):
        size[e] = sum(len(text) for _, text in e.blocks) + sum(size[c] for c in e.children)
        if any(c in holds or (c.tag == "article" and not _declared(c)) for c in e.children):
            holds.add(e)
    for e in every:
        if (e.tag in WRAPPERS or e in named) and (e in holds or (e not in inside and 2 * size[e] > size[root])):
            while e is not None and not e.titled:
                e.titled, e = True, e.parent


def _read(html: str) -> Element:
    root = parse(html, _inline_noise)
    _mark_wrappers(root)
    return root


def content_root(root: Element) -> Element:
    """The innermost article or main element that holds all of the page's text, without what declares boilerplate; else the page."""
    inner, every, todo = {}, [], [(root, True)]
    while todo:
        e, outer = todo.pop()
        every.append(e)
        outer = outer and e.tag not in CONTENT
        inner[e] = [c for c in e.children if not _declared(c) and not (outer and _outer(c))]
        todo.extend((c, outer) for c in inner[e])
    full = set()
    for e in reversed(every):
        if e.blocks or any(c in full for c in inner[e]):
            full.add(e)
    e = found = root
    while not e.blocks and len(below := [c for c in inner[e] if c in full]) == 1:
        e = below[0]
        if e.tag in CONTENT:
            found = e
    return found


def _key(*parts: object) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def branches(root: Element) -> Iterator[tuple[Element, tuple[int, ...]]]:
    """Elements of the content that don't declare boilerplate, with the keys of the nodes from the content's root to them."""
    todo = [(root, (_key(root.label),), True)]
    while todo:
        e, keys, outer = todo.pop()
        yield e, keys
        outer = outer and e.tag not in CONTENT
        for child in reversed(e.children):
            if not _declared(child) and not (outer and _outer(child)):
                todo.append((child, keys if len(keys) >= DEPTH else (*keys, _key(keys[-1], child.label)), outer))


def extract(html: str, cut: set[int]) -> str:
    """The main text of a page, without the branches whose nodes are in ``cut``."""
    page = _read(html)
    kept: list[tuple[int, str]] = []
    every: list[tuple[int, str]] = []
    plain = HEADINGS | {"p"}
    for e, keys in branches(content_root(page)):
        every.extend(e.blocks)
        removable = keys[1:-1] if e.tag in plain and not e.names else keys[1:]
        if not cut or cut.isdisjoint(removable):
            kept.extend(e.blocks)
    if not every:
        every = [b for e in page.walk(lambda e: "hidden" not in _roles(e.names)) for b in e.blocks]
    return " ".join(text for _, text in sorted(kept or every))


def _host() -> Column:
    return F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


_COUNTS = "host string, node long, up array<long>, kind int, feature long, n long, n_log_n double, pages long"
_PRESENTATION, _TEXT = 0, 1


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Presentations and texts of the nodes, added up over each batch."""
    for batch in text_slices(batches, "html"):
        total: dict[tuple, list] = {}
        for host, html in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
            here: Counter = Counter()
            for e, keys in branches(content_root(_read(html))):
                look = tuple(dict.fromkeys(c.label for c in e.children))
                here[(keys, _PRESENTATION, _key(*look), len(look))] += 1
                for _, text in e.blocks:
                    here[(keys, _TEXT, _key(text), 0)] += 1
            first = set()
            for (keys, kind, feature, _), n in here.items():
                row = total.setdefault((host, keys, kind, feature), [0, 0.0, 0])
                row[0] += n
                row[1] += n * math.log(n)
                if (keys, kind) not in first:
                    first.add((keys, kind))
                    row[2] += 1
        host, keys, kind, feature = zip(*total) if total else ((), (), (), ())
        columns = [pa.array(host, pa.string()), pa.array([k[-1] for k in keys], pa.int64()), pa.array([k[:-1] for k in keys], pa.list_(pa.int64())), pa.array(kind, pa.int32()), pa.array(feature, pa.int64())]
        columns += [pa.array([r[i] for r in total.values()], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "node", "up", "kind", "feature", "n", "n_log_n", "pages"])


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, up, pages, importance): the merged tree of each host, with composite importances."""
    source = pages.select(_host().alias("host"), "html").where("host <> '' AND html IS NOT NULL")
    features = source.mapInArrow(_counts, _COUNTS).groupBy("host", "node", "kind", "feature")
    features = features.agg(F.first("up").alias("up"), F.sum("n").alias("n"), F.sum("n_log_n").alias("n_log_n"), F.sum("pages").alias("pages"))
    nodes = features.groupBy("host", "node", "kind").agg(
        F.first("up").alias("up"), F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.count("*").alias("features"), F.count_if(F.col("feature") != _key()).alias("styles"),
        F.sum(F.col("n") * F.log("n")).alias("n_log_n"), F.sum(F.log("n") - F.col("n_log_n") / F.col("n")).alias("entropies"),
    )
    base = F.log(F.greatest(F.col("pages"), F.lit(2)))
    looks = (F.log("n") - F.col("n_log_n") / F.col("n")) / base
    texts = 1 - F.col("entropies") / F.col("features") / base
    nodes = nodes.withColumn("own", F.when(F.col("pages") < 2, 1.0).when(F.col("kind") == _PRESENTATION, looks).otherwise(texts))
    nodes = nodes.groupBy("host", "node").agg(
        F.first("up").alias("up"), F.max(F.when(F.col("kind") == _PRESENTATION, F.col("pages"))).alias("pages"),
        F.max(F.when(F.col("kind") == _PRESENTATION, F.col("own"))).alias("looks"), F.max(F.when(F.col("kind") == _PRESENTATION, F.col("styles"))).alias("styles"),
        F.max(F.when(F.col("kind") == _TEXT, F.col("own"))).alias("texts"), F.coalesce(F.max(F.when(F.col("kind") == _TEXT, F.col("n"))), F.lit(0)).alias("weight"),
    )
    nodes = written(nodes, "style-nodes")
    lines = F.explode(F.concat("up", F.array("node")))
    below = nodes.where("weight > 0").select("host", lines.alias("node"), "texts", "weight")
    below = below.groupBy("host", "node").agg((F.sum(F.col("texts") * F.col("weight")) / F.sum("weight")).alias("content"))
    discount = F.pow(F.lit(DISCOUNT), F.col("styles"))  # 1 for elements without children
    composite = F.when(F.col("content").isNull(), 0.0).otherwise((1 - discount) * F.col("looks") + discount * F.col("content"))
    return nodes.join(below, ["host", "node"], "left").select("host", "node", "up", "pages", composite.alias("importance"))


def noise(tree: DataFrame) -> DataFrame:
    """(host, cut): the nodes of each host whose branches are cut, without those below them."""
    lines = tree.select("host", F.explode(F.concat("up", F.array("node"))).alias("node"), "importance")
    best = lines.groupBy("host", "node").agg(F.max("importance").alias("best"))
    low = tree.join(best, ["host", "node"]).where((F.col("best") < LEAST) & (F.col("pages") >= PAGES)).select("host", "node", "up")
    under = low.select("host", "node", F.explode("up").alias("above"))
    under = under.join(low.select("host", F.col("node").alias("above")), ["host", "above"], "left_semi").select("host", "node")
    return low.join(under.distinct(), ["host", "node"], "left_anti").groupBy("host").agg(F.sort_array(F.collect_set("node")).alias("cut"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text (the main text; empty if there is none) of every page."""
    cut = written(noise(written(style_tree(pages), "style-tree")), "style-noise")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.coalesce(_host(), F.lit("")).alias("host")).join(cut, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = [extract(html, set(nodes or ())) for html, nodes in zip(batch["html"].to_pylist(), batch["cut"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.select("page_id", "url", "html", "cut").mapInArrow(run, rows.select("page_id", "url").schema.add("text", "string"))
