"""Main text of web pages: gradient-boosted trees over the features of DOM nodes, decoded along the tree.

A page is read into a tree of block elements; inline markup joins the text around it, scripts, styles and the head
are never text. Each node gets features of its subtree's density, its attribute tokens, its depth and its siblings,
and the boosted trees give the odds that it belongs to the article. Decoding picks the best choice over the whole
tree under which no kept node lies below a dropped one, so ancestors and descendants never contradict each other.

Training. Pages carry no labels, so the trees learn from pages made of pieces of the given ones: what stands in an
``article`` or ``main`` element serves as article, everything else as surroundings, under many layouts, element names
and attribute tokens. The pieces come from ``SAMPLE_PAGES`` pages with the smallest hashes; the classifier is the
only thing fitted on a bounded sample. Reading, features, odds and decoding cover every whole page.

Null and empty pages have an empty text; unclosed elements, cut-off pages and stray end tags are read as browsers
do, roughly; repeated pages get equal results; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import stored, table

SAMPLE_PAGES = 200
# Training pages made of the sample's pieces: of fewer pages, more are made of each.
TRAINING_PAGES = 800
TREES, DEPTH, STEP = 20, 5, 0.3
SEED = 7
PAGES_AT_ONCE = 64

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not text of the page.
OPAQUE = frozenset("script style title noscript template svg math iframe object textarea select canvas video audio head".split())
# An opening tag on the left closes an open element on the right.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("ul ol dl table body div section article".split())
GROUPS = [
    {"article"}, {"main"}, {"section"}, {"div"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "menu"},
    {"li", "dt", "dd"}, {"nav"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "button", "legend"},
    {"table", "tbody", "thead", "tr", "td", "th"}, {"blockquote", "pre"}, {"figure", "figcaption"}, {"body", "html"},
]
INSIDE = [{"article", "main"}, {"nav"}, {"header"}, {"footer"}, {"aside"}, {"form"}]
# Attribute tokens that name the article, and those that name its surroundings.
ARTICLE_WORDS = frozenset("article content post entry story text main body prose articlebody maincontent".split())
OTHER_WORDS = frozenset(
    "nav navigation navbar menu header masthead topbar footer bottom copyright sidebar aside side widget ad ads advert "
    "advertisement banner promo sponsor sponsored cookie consent notice alert popup modal overlay comment comments reply "
    "replies disqus discussion form newsletter subscribe signup login search share sharing social related recommended "
    "breadcrumb breadcrumbs pagination pager tags toolbar legal hidden".split())

# A tag from its ``<`` to its ``>``. Quotes enclose a value only right after ``=``; nothing is tried twice.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block element."""

    __slots__ = ("tag", "parent", "tokens", "children", "own", "links", "tags", "depth", "keep")

    def __init__(self, tag: str, parent: int, tokens: tuple, depth: int, keep: bool):
        self.tag, self.parent, self.tokens, self.depth, self.keep = tag, parent, tokens, depth, keep
        self.children: list[int] = []
        self.own = self.links = self.tags = 0


class Page(NamedTuple):
    """Nodes in page order, and the texts of blocks with their node."""

    nodes: list[Node]
    texts: list[tuple[int, str]]


def _attributes(raw: str) -> tuple[tuple, bool | None]:
    """Naming tokens, and the mark of a training page's element."""
    tokens, keep = [], None
    for name, *values in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            tokens += [w.lower() for w in _WORD.findall(value)]
        elif name == "data-keep":
            keep = value == "1"
        elif name == "style" and "none" in value or name == "aria-hidden" and value == "true":
            tokens.append("hidden")
    return tuple(tokens), keep


def read_page(source: str) -> Page:
    """The page as a tree of block elements."""
    nodes, texts = [Node("html", -1, (), 0, False)], []
    stack, at = [0], 0
    # How many of each inline and block element are open, and whose end tags do not come any more.
    inline, open_blocks, endless = Counter(), Counter(), set()
    run: list[str] = []

    def flush():
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                texts.append((stack[-1], text))
                nodes[stack[-1]].own += len(text)

    def add(raw):
        if raw:
            run.append(raw)
            if inline["a"]:
                nodes[stack[-1]].links += len(raw)

    def leave(up):
        """Closes the blocks from a place of the stack on."""
        open_blocks.subtract(nodes[i].tag for i in stack[up:])
        del stack[up:]

    size = len(source)
    while at < size:
        start = source.find("<", at)
        if start < 0:
            add(source[at:])
            break
        kind = source[start + 1:start + 2]
        if kind in ("!", "?"):
            add(source[at:start])
            ends = "-->" if source.startswith("<!--", start) else ">"
            at = source.find(ends, start + 2)
            if at < 0:  # cut off
                break
            at += len(ends)
            continue
        if not (kind.isascii() and kind.isalpha() or kind == "/" and source[start + 2:start + 3].isascii() and source[start + 2:start + 3].isalpha()):
            add(source[at:start + 1])  # no tag
            at = start + 1
            continue
        add(source[at:start])
        match = _TAG.match(source, start)
        if match is None:  # a tag that is cut off
            break
        at = match.end()
        tag = match[2].lower()
        if match[1]:
            if tag in INLINE:
                if inline[tag]:
                    inline[tag] -= 1
            elif open_blocks[tag]:
                up = len(stack) - 1
                while nodes[stack[up]].tag != tag:
                    up -= 1
                flush()
                leave(up)
                inline.clear()
            continue
        if tag in OPAQUE and not match[3].endswith("/"):
            end = None if tag in endless else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            if end is None:
                endless.add(tag)
            if tag == "head" and end is None:
                continue
            at = end.end() if end else size
            continue
        if tag in INLINE:
            nodes[stack[-1]].tags += 1
            if tag in ("br", "img", "input", "wbr"):
                run.append(" " if tag == "br" else "")
            elif tag != "a" or not inline["a"]:
                inline[tag] += 1
            continue
        flush()
        inline.clear()
        if tag in VOID:
            continue
        if tag == "html" or tag == "body" and len(stack) > 1:
            continue
        # A block ends an open paragraph; list items and cells end their like.
        if nodes[stack[-1]].tag == "p":
            leave(len(stack) - 1)
        closes = CLOSES.get(tag, ())
        for up in range(len(stack) - 1, 0, -1) if any(open_blocks[c] for c in closes) else ():
            open_ = nodes[stack[up]].tag
            if open_ in closes:
                leave(up)
                break
            if open_ in SCOPES:
                break
        tokens, keep = _attributes(match[3]) if match[3] else ((), None)
        parent = stack[-1]
        nodes.append(Node(tag, parent, tokens, len(stack), nodes[parent].keep if keep is None else keep))
        nodes[parent].children.append(len(nodes) - 1)
        stack.append(len(nodes) - 1)
        open_blocks[tag] += 1
    flush()
    return Page(nodes, texts)


def features(page: Page) -> np.ndarray:
    """One row of features per node."""
    nodes = page.nodes
    n = len(nodes)
    total, links, tags, stops, blocks = ([0.0] * n for _ in range(5))
    for node, text in page.texts:
        stops[node] += text.count(".") + text.count(",")
        blocks[node] += 1
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        total[i] += node.own
        links[i] += min(node.links, node.own)
        tags[i] += node.tags + 1
        if node.parent >= 0:
            for sums in (total, links, tags, stops, blocks):
                sums[node.parent] += sums[i]
    place, alike = [0] * n, [1] * n
    for node in nodes:
        same = Counter(nodes[c].tag for c in node.children)
        for k, child in enumerate(node.children):
            place[child], alike[child] = k, same[nodes[child].tag]
    # What lies inside the parent, carried down.
    inside = [[False] * len(INSIDE)] * n
    good, bad = [0] * n, [0] * n
    out = np.zeros((n, len(GROUPS) + len(INSIDE) + 18))
    for i, node in enumerate(nodes):
        up = node.parent
        own_good = sum(t in ARTICLE_WORDS for t in node.tokens)
        own_bad = sum(t in OTHER_WORDS for t in node.tokens)
        above_good, above_bad = (good[up], bad[up]) if up >= 0 else (0, 0)
        good[i], bad[i] = above_good + own_good, above_bad + own_bad
        flags = inside[up] if up >= 0 else inside[i]
        hits = [node.tag in group for group in INSIDE]
        if any(hits):
            flags = [a or b for a, b in zip(flags, hits)]
        inside[i] = flags
        brothers = nodes[up].children if up >= 0 else [i]
        at = place[i]
        before = total[brothers[at - 1]] if at else 0
        after = total[brothers[at + 1]] if at + 1 < len(brothers) else 0
        row = [node.tag in group for group in GROUPS]
        row += flags
        row += [
            own_good, own_bad, above_good, above_bad, math.log1p(total[i]), math.log1p(node.own),
            links[i] / (total[i] + 1), math.log1p(total[i] / tags[i]), stops[i] / (total[i] + 1) * 50,
            node.depth, math.log1p(len(brothers)), at / len(brothers), alike[i] / len(brothers),
            total[i] / (total[0] + 1), math.log1p(before), math.log1p(after),
            sum(nodes[c].tag == "p" for c in node.children), total[i] / (blocks[i] + 1) / 100,
        ]
        out[i] = row
    return out


def decoded(page: Page, odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the choice of the largest weighted sum of log odds without a kept node under a dropped one."""
    nodes = page.nodes
    gain = np.array([odds[i] * (0.3 + math.log1p(node.own)) for i, node in enumerate(nodes)])
    best = gain.copy()  # of the subtree, if its root is kept
    for i in range(len(nodes) - 1, 0, -1):
        best[nodes[i].parent] += max(best[i], 0.0)
    keep = np.zeros(len(nodes), bool)
    keep[0] = best[0] > 0
    for i in range(1, len(nodes)):
        keep[i] = keep[nodes[i].parent] and best[i] > 0
    return keep


class Trees(NamedTuple):
    """Boosted trees as arrays: feature (-1 at a leaf), threshold or value, and the two children of each node."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: list
    weights: list

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(x), root)
            while (inner := self.feature[at] >= 0).any():
                go = x[rows, np.maximum(self.feature[at], 0)] <= self.value[at]
                at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
            total += weight * self.value[at]
        return 2 * total


def flattened(model) -> Trees:
    """The fitted model's trees, read from their printed form."""
    feature, value, left, right, roots = [], [], [], [], []

    def grow(lines):
        line = next(lines).strip()
        me = len(feature)
        for column in (feature, value, left, right):
            column.append(-1)
        if line.startswith("Predict"):
            value[me] = float(line.split(":")[1])
            return me
        found = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line)
        feature[me], value[me] = int(found[1]), float(found[2])
        left[me] = grow(lines)
        next(lines)  # Else
        right[me] = grow(lines)
        return me

    for tree in model.trees:
        roots.append(grow(iter(tree.toDebugString.strip().split("\n")[1:])))
    return Trees(np.array(feature), np.array(value, float), np.array(left), np.array(right), roots, list(model.treeWeights))


_ROUND = frozenset("nav header footer aside form".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())


def _pieces(page: Page) -> tuple[list[str], list[str]]:
    """Texts inside the article elements, and all others.

    Of a page without any, paragraphs and headings outside the elements around an article serve instead.
    """
    nodes = page.nodes
    inside, round_ = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        up = node.parent
        inside[i] = node.tag in ("article", "main") or up >= 0 and inside[up]
        round_[i] = node.tag in _ROUND or up >= 0 and round_[up]
    if not any(inside):
        inside = [node.tag in _PROSE and not r for node, r in zip(nodes, round_)]
    return [t for i, t in page.texts if inside[i]], [t for i, t in page.texts if not inside[i]]


def layout(article: list[str], other: list[str], rng: random.Random) -> str:
    """A training page of these texts; ``data-keep`` marks the article (1) and what is inside but not of it (0)."""
    def words(n):
        return html.escape(" ".join(rng.choice(other or article or ["x"]).split()[:n]) or "x")

    def named(tags, tokens, body, keep=None):
        name = rng.choice(tags)
        token = rng.choice(tokens)
        how = rng.choice(("class", "id", "class")) if name in ("div", "section", "ul") or rng.random() < 0.6 else None
        return f"<{name}{f' {how}="{token}"' if how else ''}{'' if keep is None else f' data-keep={keep}'}>{body}</{name}>"

    def links(n):
        return "<ul>" + "".join(f'<li><a href="#">{words(3)}</a></li>' for _ in range(n)) + "</ul>"

    def sentences():
        return html.escape(rng.choice(article or other or ["x"]))

    def paragraphs(n):
        return "".join(f"<p>{sentences()}</p>" for _ in range(n))

    body = []
    for k, text in enumerate(article):
        kind = "h1" if k == 0 else "h2" if rng.random() < 0.05 else "li" if rng.random() < 0.05 else "blockquote" if rng.random() < 0.05 else "p"
        piece = html.escape(text)
        if rng.random() < 0.2:
            piece = f'<b>{piece}</b> <a href="#">{words(2)}</a>'
        body.append(f"<ul><li>{piece}</li></ul>" if kind == "li" else f"<{kind}>{piece}</{kind}>")
        if rng.random() < 0.03:
            body.append(named(["div", "aside"], ["ad", "promo", "related-links", "share"], f"<p>{words(12)}</p>", keep=0))
    main = named(["article", "div", "div", "main", "section"], ["content", "article-body", "post", "entry-content", "story", "main-text"], "".join(body), keep=1)
    blocks = {
        "nav": lambda: named(["nav", "div", "ul"], ["menu", "nav", "navigation", "navbar"], links(rng.randint(2, 9))),
        "header": lambda: named(["header", "div"], ["header", "masthead", "topbar"], f"<p>{words(6)}</p>" + rng.choice(["", links(3)])),
        "ad": lambda: named(["div", "aside", "section"], ["ad", "ads", "banner", "promo", "sponsored"], rng.choice([words(14), f"<p>{words(20)}</p>"])),
        "notice": lambda: named(["div", "section"], ["cookie-notice", "notice", "alert", "consent-banner"], f"<p>{words(25)}</p>"),
        "form": lambda: named(["form", "form", "div"], ["newsletter", "subscribe", "search-form", "login"], f"<label>{words(4)}</label><input><p>{words(8)}</p>"),
    }
    tail = {
        "side": lambda: named(["aside", "div"], ["sidebar", "side", "widget"], f"<h3>{words(3)}</h3>" + rng.choice([links(5), paragraphs(2)])),
        "comments": lambda: named(["section", "div"], ["comments", "comment-list", "discussion", "replies"],
                                  "<h3>" + words(2) + "</h3>" + "".join(named(["div", "li", "article"], ["comment", "reply"], paragraphs(rng.randint(1, 2))) for _ in range(rng.randint(1, 6)))),
        "related": lambda: named(["div", "section"], ["related", "recommended"], links(4)),
        "ad": blocks["ad"], "form": blocks["form"],
        "footer": lambda: named(["footer", "footer", "div"], ["footer", "bottom", "copyright"], words(15) + rng.choice(["", links(3)])),
    }
    first = [blocks[k]() for k in rng.sample(sorted(blocks), rng.randint(1, 4))]
    last = [tail[k]() for k in rng.sample(sorted(tail), rng.randint(1, 4))]
    if rng.random() < 0.4:
        split = rng.randint(0, len(last))
        main, last = f'<div class="{rng.choice(["wrapper", "container", "page", "row"])}">{main}{"".join(last[:split])}</div>', last[split:]
    return f"<html><body>{''.join(first)}{main}{''.join(last)}</body></html>"


def examples(source: str, seed: int, layouts: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of some training pages made of one page's pieces."""
    article, other = _pieces(read_page(source))
    if not article:
        return np.zeros((0, 1)), np.zeros(0)
    xs, ys = [], []
    for k in range(layouts):
        rng = random.Random(seed * layouts + k)
        made = layout(article, other, rng)
        page = read_page(made)
        nodes = page.nodes
        label = np.array([node.keep for node in nodes], bool)
        # What holds a kept element is kept.
        for i in range(len(nodes) - 1, 0, -1):
            label[nodes[i].parent] |= label[i]
        xs.append(features(page))
        ys.append(label)
    return np.concatenate(xs), np.concatenate(ys).astype(float)


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Trees | None:
    """Boosted trees from the pieces of ``sample`` different pages: such with an article element, if there are any.

    None if no page has a text that could serve as article.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, seed in zip(batch.column("html").to_pylist(), batch.column("seed").to_pylist()):
                x, y = examples(source, seed, layouts)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.tolist()), pa.array(y)], names=["x", "label"])

    seed = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "html"), 1)
    named = F.col("html").ilike("%<article%") | F.col("html").ilike("%<main%")
    for pool in (pages.where(named), pages.where(F.length("html") > 0)):
        pool = pool.select("html", seed.alias("seed"))
        seeds = pool.select("seed").distinct().orderBy("seed").limit(sample)
        # As many rows as the sample has pages.
        some = stored(pool.join(F.broadcast(seeds), "seed").dropDuplicates(["seed"]), "sample")
        if some.take(1):
            break
    layouts = -(-TRAINING_PAGES // max(some.count(), 1))
    rows = stored(some.mapInArrow(make, "x array<double>, label double"), "examples")
    if not rows.where("label = 1").take(1) or not rows.where("label = 0").take(1):
        return None
    learner = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
    return flattened(learner.fit(rows.select(array_to_vector("x").alias("features"), "label").coalesce(1)))


def main_texts(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """(``id``, ``url``, ``text``) per row of ``pages`` (``id``, ``url``, ``html``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(first, PAGES_AT_ONCE)
                read = [read_page(source or "") for source in part.column("html").to_pylist()]
                odds = trees.odds(np.concatenate([features(p) for p in read])) if trees else -np.ones(sum(len(p.nodes) for p in read))
                texts, at = [], 0
                for page in read:
                    keep = decoded(page, odds[at:at + len(page.nodes)])
                    at += len(page.nodes)
                    texts.append("\n".join(t for i, t in page.texts if keep[i]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])

    kind = pages.schema["id"].dataType.simpleString()
    return pages.select("id", "url", "html").mapInArrow(run, f"id {kind}, url string, text string")


def op7_boosted_dom_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("id"), "url", "html")
    found = main_texts(pages, fit(pages))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
