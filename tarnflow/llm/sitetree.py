"""Main text of web pages by site style trees.

The pages of a host are merged to one tree: a node is a chain of elements (tag and class) from the
root, with counts of how its subtree looks (the sequence of its child elements) and what it says (its
text). A node that looks or reads differently from page to page is important, one that repeats is
not: with m different pages its importance is the larger of the two entropies, in units of log m, so
between 0 and 1. Among what a node says, a content on n of the host's m pages has importance
1 - log n / log m, as its occurrences are spread evenly over n pages. Branches and contents below
``threshold`` are taken out of every page of the host, inside ``article`` and ``main`` as outside. Elements
that are no content by their kind (menus, forms, scripts, adverts, comments ...) have importance 0.

Pages of a host with one main text count once, so copies of an article under one host stay whole. The
tree is never built in one place: nodes are hashed chains, counts and entropies are aggregates, and each
page gets those of its own nodes that are unimportant, by a join on host and node. A page's text is
that of its ``article``, else of its ``main``, else what remains of the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tarnflow.llm.common import unkeyed, written
from tarnflow.llm.urls import host

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+")

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr del img nobr".split()
)
NO_CONTENT = frozenset(
    "head nav header footer aside form script style noscript template iframe svg button select textarea dialog menu object "
    "canvas audio video title xmp noembed noframes fieldset optgroup option datalist".split()
)
NO_CONTENT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe signup nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside widget widgets footer comment comments respond replies disqus share sharing social related recommended "
    "toolbar pagination pager login search skip copyright masthead topbar alert".split()
)
HEADER_WORDS = frozenset("header masthead banner topbar".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements that end at the start of one of their own kind, and where that search ends.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


class Element:
    __slots__ = ("tag", "dropped", "low", "article", "main", "path", "looks", "says", "marks")

    def __init__(self, tag, dropped, low, article, main, path):
        self.tag, self.dropped, self.low, self.article, self.main, self.path = tag, dropped, low, article, main, path
        self.looks, self.says, self.marks = 0, 0, ()


def by_kind(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is no content by its tag, role, class or id."""
    if tag in NO_CONTENT and not (tag == "header" and in_article):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES:
        return True
    if "style" in attributes and re.search(r"display\s*:\s*none", attributes["style"], re.I):
        return True
    named = attributes.get("class", "") + " " + attributes.get("id", "")
    words = NO_CONTENT_WORDS.intersection(WORDS.findall(named.lower()))
    return bool(words - HEADER_WORDS if in_article else words) and tag not in ("html", "body", "main")


def read(page: str, unimportant: frozenset = frozenset(), nodes: list | None = None) -> str:
    """Main text of a page without unimportant nodes, given by path or, for one content, by path xor says.

    ``nodes`` collects (path, looks, says) of every block element that isn't dropped by kind.
    """
    root = Element("", False, False, False, False, 0)
    stack, outs, opened = [root], ([], [], []), Counter()
    follow = nodes is not None or bool(unimportant)

    def close(count: int) -> None:
        for _ in range(count):
            done = stack.pop()
            opened[done.tag] -= 1
            if nodes is not None and not done.dropped and done.tag not in INLINE:
                nodes.append((done.path, done.looks, done.says))
            if done.tag not in INLINE and done.says and done.path ^ done.says in unimportant:
                for out, mark in zip(outs, done.marks):
                    del out[mark:]
            above = stack[-1]
            above.says = (above.says * 31 + done.says + 7) & 0xFFFFFFFFFFFFFFF if done.says else above.says
        gap()

    def gap() -> None:
        for out in outs:
            out.append(" ")

    def say(text: str) -> None:
        top = stack[-1]
        if top.dropped or not text:
            return
        low = top.low
        text = entities.unescape(text) if "&" in text else text
        if top.article and not low:
            outs[0].append(text)
        if top.main and not low:
            outs[1].append(text)
        if not low:
            outs[2].append(text)
        if follow and not text.isspace():
            top.says = (top.says * 31 + xxhash.xxh64_intdigest(" ".join(text.split()))) & 0xFFFFFFFFFFFFFFF

    def find(tags: tuple, stops: tuple) -> int:
        """How many elements to close up to the innermost of ``tags``; 0 if a stop comes first."""
        for depth in range(1, len(stack)):
            tag = stack[-depth].tag
            if tag in tags:
                return depth
            if tag in stops or (not stops and tag not in INLINE):
                return 0
        return 0

    at, size, last = 0, len(page), max(page.rfind(">"), page.rfind("<!--"))
    while at < size:
        begin = page.find("<", at)
        if begin < 0 or begin > last:  # no tag can end any more
            break
        m = TOKEN.match(page, begin)
        if not m:  # a lone "<" is text
            say(page[at : begin + 1])
            at = begin + 1
            continue
        say(page[at:begin])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing = tag.lower(), m[1] or m[4]
        if closing:
            count = next(d for d in range(1, len(stack)) if stack[-d].tag == tag) if opened[tag] else 0
            if tag in INLINE:
                for _ in range(find((tag,), ()) if count else 0):
                    done = stack.pop()
                    opened[done.tag] -= 1
                    stack[-1].says = (stack[-1].says * 31 + done.says) & 0xFFFFFFFFFFFFFFF if done.says else stack[-1].says
            elif count:
                close(count)
            else:
                gap()
            continue
        if tag in VOID:
            if tag not in INLINE:
                gap()
            continue
        if tag in INLINE and len(stack) > 500:  # says nothing at this depth
            continue
        top = stack[-1]
        if tag not in INLINE:
            own, around = SIBLINGS.get(tag, ((), ()))
            if any(opened[t] for t in own):
                count = next(d for d in range(1, len(stack)) if stack[-d].tag in own + around)
                if stack[-count].tag in own:
                    close(count)
            count = find(("p",), ())
            if count:
                close(count)
            gap()
            top = stack[-1]
        raw = m[3] if m[2] else m[6]
        attributes = {}
        if raw and not top.dropped and not raw.isspace():
            for a in ATTRIBUTE.finditer(raw):
                attributes.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
        style = tag + "." + attributes.get("class", "")
        path = xxhash.xxh64_intdigest(style, top.path) if tag not in INLINE else top.path
        if nodes is not None and tag not in INLINE:
            top.looks = (top.looks * 31 + path) & 0xFFFFFFFFFFFFFFF
        inside = top.article or top.main
        dropped = top.dropped or by_kind(tag, attributes, inside)
        low = top.low or path in unimportant
        opened[tag] += 1
        stack.append(Element(
            tag, dropped, low, top.article or (tag == "article" and not dropped), top.main or (tag == "main" and not dropped), path
        ))
        stack[-1].marks = tuple(map(len, outs)) if unimportant and tag not in INLINE else ()
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            close(1)
    say(page[at:])
    if follow:
        close(len(stack) - 1)
    for out in outs:
        text = " ".join("".join(out).split())
        if text:
            return text
    return ""


def nodes_of(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Nodes of pages: host, page (hash), main (hash of its main text), path, looks, says."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, page, body in zip(batch["host"], batch["page"].tolist(), batch["html"]):
                nodes: list = []
                main = xxhash.xxh64_intdigest(read(body, nodes=nodes)) >> 1
                out += [(name, page, main, *(v - (1 << 64) if v >> 63 else v for v in n)) for n in nodes]
            yield pd.DataFrame(out, columns=["host", "page", "main", "path", "looks", "says"])

    rows = pages.select(host(F.col(url)).alias("host"), F.xxhash64(html).alias("page"), F.col(html).alias("html"))
    return rows.where("html is not null").mapInPandas(
        run, "host string, page bigint, main bigint, path bigint, looks bigint, says bigint"
    )


def unimportant(nodes: DataFrame, threshold: float = 0.2, least: int = 4) -> DataFrame:
    """``host``, ``path`` and ``says`` (null: all contents) of nodes of importance below ``threshold``.

    ``nodes`` are different rows of :func:`nodes_of`. A node or content counts from ``least`` main texts on.
    """

    def entropy(column: str) -> DataFrame:
        each = nodes.groupBy("host", "main", "path", column).agg(F.lit(1).alias("n")).groupBy("host", "path", column).agg(F.sum("n").alias("n"))
        sums = each.groupBy("host", "path").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
        return sums.where(F.col("m") >= least).select(
            "host", "path", (1 - F.col("s") / F.col("m") / F.log("m")).alias(f"of_{column}")
        )

    both = entropy("looks").join(entropy("says"), ["host", "path"])
    low = both.where(F.greatest("of_looks", "of_says") < threshold).select("host", "path", F.lit(None).cast("bigint").alias("says"))
    all_mains = nodes.select("host", "main").distinct().groupBy("host").agg(F.count("*").alias("m"))
    contents = nodes.where("says <> 0").select("host", "path", "says", "main").distinct().groupBy("host", "path", "says").agg(F.count("*").alias("n"))
    contents = contents.where(F.col("n") >= least).join(all_mains, "host")
    return low.union(contents.where(1 - F.log("n") / F.log("m") < threshold).select("host", "path", "says"))


def extract(
    pages: DataFrame, threshold: float = 0.2, least: int = 4, key: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    Character references are decoded, white space inside a block becomes one space, blocks are joined
    by one space in page order. A null page, or one without main text, gives an empty text. Pages
    without a host share one tree. Repeated rows give repeated results, an empty table none;
    other columns are not read.
    """
    nodes = written(nodes_of(pages, url, html).distinct())
    low = written(unimportant(nodes, threshold, least))
    # The unimportant nodes of each page, not more than it has nodes.
    mine = nodes.select("host", "page", "path", "says").distinct().join(low.withColumnRenamed("says", "_says"), ["host", "path"])
    mine = mine.where("_says is null or _says = says").select(
        "host", "page", F.when(F.col("_says").isNull(), F.col("path")).otherwise(F.col("path").bitwiseXOR(F.col("says"))).alias("code")
    ).groupBy("host", "page").agg(F.collect_set("code").alias("codes"))
    rows = pages.select(
        pages[key].cast("string").alias("_key"), pages[url].alias("_url"), pages[html].alias("_html"),
        host(pages[url]).alias("host"), F.xxhash64(pages[html]).alias("page"),
    ).join(written(mine), ["host", "page"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for body, codes in zip(batch["_html"], batch["codes"]):
                known = frozenset(int(c) & 0xFFFFFFFFFFFFFFFF for c in codes) if codes is not None else frozenset()
                texts.append(read(body, known) if body else "")
            yield pd.DataFrame({
                "_key": batch["_key"].array, "_url": batch["_url"].array, "text": texts, "n_chars": np.array(list(map(len, texts)), dtype=np.int64),
            })

    found = rows.select("_key", "_url", "_html", "codes").mapInPandas(run, "_key string, _url string, text string, n_chars bigint")
    return unkeyed(found, pages, key).withColumnRenamed("_url", url)
