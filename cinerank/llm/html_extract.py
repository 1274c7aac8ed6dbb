"""Operator 6: main text of web pages by minimum-cut labelling.

A page's text blocks are the nodes of a graph. A logistic classifier of each
block gives its terminal capacities: -log(1-p) to call it boilerplate,
-log(p) to call it content. Smoothness edges join blocks that follow one
another, weaker the further apart in the DOM, and blocks of one parent that
follow one another there. The minimum cut separates content from boilerplate.

The classifier is fitted here, on at most SAMPLE_PAGES distinct pages in the order of
a hash of their HTML and at most SAMPLE_BLOCKS of their blocks: those inside
article or main elements are content, those inside nav, header, footer,
aside and form elements are not. Each counts twice, once with the elements'
own features blanked, so that pages without such elements are told apart by
what is left. Weights start from, and are drawn towards, fixed priors.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, distinct_sample, prepare, small
from cinerank.llm.mincut import labels

SAMPLE_PAGES = 300
SAMPLE_BLOCKS = 10_000
SMOOTH = 0.7          # weight of an edge between blocks of one parent

_TOKEN = re.compile(r"<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')|=)*+>|[^>]*(?:>|$))|[!?/][^>]*(?:>|$))", re.S)
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=>/])|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
# Fixed values of HTML: elements whose text isn't shown as prose, elements that start blocks.
_RAW = frozenset(["script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"])
_UNSEEN = frozenset(["head", "select", "button", "svg", "object", "canvas", "audio", "video", "math", "map", "datalist"])
_IN_HEAD = frozenset(["head", "base", "link", "meta", "title", "style", "script", "noscript", "template"])
_VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"])
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_BAD_WORDS = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|nav\w*|menu|sidebar|aside|foot(?:er)?|(?:site|page|top)-?header|masthead|"
                        r"cookies?|consent|gdpr|banner|notice|alert|popup|modal|share|sharing|social|related|recommend\w*|comments?|replies|disqus|"
                        r"breadcrumbs?|subscribe|newsletter|login|signup|search|widget|pagination|pager|toc|copyright|legal|skip)(?:$|[^a-z])", re.I)
_GOOD_WORDS = re.compile(r"(?:^|[^a-z])(?:article|content|post|entry|main|story|text|prose)(?:$|[^a-z])", re.I)

# Fixed priors of the weights, by feature.
FEATURES = {
    "bias": -0.3, "in_article": 2.5, "in_nav": -5.5, "in_header": -2.0, "in_footer": -5.5, "in_aside": -5.5, "in_form": -5.5,
    "bad_name": -5.0, "good_name": 0.8, "hidden": -6.0, "links": -2.5, "length": 0.5, "marks": 0.4, "paragraph": 0.6, "heading": 0.8,
    "list": -0.5, "table": -0.2, "legal": -1.5,
}
_NAMES = list(FEATURES)
_OWN = [_NAMES.index(x) for x in ("in_article", "in_nav", "in_header", "in_footer", "in_aside", "in_form", "bad_name", "good_name")]
_AT = {n: i for i, n in enumerate(_NAMES)}
_LEGAL = re.compile(r"^\W*(?:©|\(c\)\s|copyright\b)|all rights reserved", re.I)


class Node:
    """An open element: its tag, its parent, how deep it lies, the marks of it and its ancestors."""
    __slots__ = ("tag", "up", "depth", "marks")

    def __init__(self, tag: str, up: Node | None, marks: tuple[str, ...]):
        self.tag, self.up, self.depth = tag, up, up.depth + 1 if up else 1
        self.marks = tuple(dict.fromkeys((up.marks if up else ()) + marks))


class Block:
    __slots__ = ("text", "node", "features")

    def __init__(self, text: str, node: Node | None, features: list[float]):
        self.text, self.node, self.features = text, node, features


def _between(a: Node | None, b: Node | None) -> tuple[int, int]:
    """How many elements lie above a, and above b, below the nearest that holds both."""
    up = down = 0
    while a is not b:
        if b is None or a is not None and a.depth >= b.depth:
            a, up = a.up, up + 1
        else:
            b, down = b.up, down + 1
    return up, down


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, with DOM path and features.

    Inline elements don't cut text; a line break is a blank. Unclosed and
    stray tags are repaired as browsers do in the plain cases: an end tag
    closes up to its element, or nothing; paragraphs and list items close
    their like.
    """
    out: list[Block] = []
    top: Node | None = None
    open_: Counter = Counter()                 # block elements that are open, by tag
    unseen: list[str] = []                     # open elements whose text isn't shown
    ends: dict[str, int] = {}                  # where the next end tag of such an element lies
    piece: list[tuple[str, bool]] = []
    anchor = 0

    def flush() -> None:
        if piece:
            text = " ".join("".join([p for p, _ in piece]).split())
            if text:
                linked = sum(len(p) for p, a in piece if a) / max(1, sum(len(p) for p, _ in piece))
                out.append(Block(text, top, _features(text, linked, top)))
            piece.clear()

    def ended(tag: str, at: int) -> bool:
        if ends.get(tag, -1) < at:
            found = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            ends[tag] = found.start() if found else len(page) + 1
        return ends[tag] <= len(page)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            if unseen == ["head"] and not page[at:stop].isspace():
                unseen.clear()                 # text can't be in a head: its end tag was left out
            if not unseen:
                piece.append((html.unescape(page[at:stop]), anchor > 0))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing = m[1] == "/"
        if not closing and "head" in unseen and tag not in _IN_HEAD:
            unseen.remove("head")              # nor can other elements
        if tag == "br":
            piece.append((" ", False))
        elif tag == "a":
            anchor = max(0, anchor - 1) if closing else 1
        elif tag in _RAW:
            if not closing:
                close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                at = close.start() if close else end
        elif tag in _UNSEEN:
            if closing:
                if tag in unseen:
                    del unseen[len(unseen) - 1 - unseen[::-1].index(tag):]
            elif tag == "head":
                unseen.append(tag)
            elif not m[3].endswith("/>"):
                if tag in ("button", "select") and tag in unseen:
                    del unseen[unseen.index(tag):]      # a second one ends the first
                if ended(tag, at):
                    unseen.append(tag)
                else:                          # never ended: only the text up to the next tag is its own
                    at = page.find("<", at) if page.find("<", at) >= 0 else end
        elif tag in _BLOCK:
            flush()
            anchor = 0
            if closing:
                if open_[tag] or tag in _HEADINGS and any(open_[h] for h in _HEADINGS):
                    while True:
                        gone = top.tag
                        open_[gone] -= 1
                        top = top.up
                        if gone == tag or (tag in _HEADINGS and gone in _HEADINGS):
                            break
            elif tag not in _VOID:
                while top and (top.tag == "p" or top.tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")
                               or top.tag in _HEADINGS and tag in _HEADINGS):
                    open_[top.tag] -= 1
                    top = top.up
                top = Node(tag, top, _marks(tag, m[3]))
                open_[tag] += 1
    flush()
    return out


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    found = []
    kind = {"article": "in_article", "main": "in_article", "nav": "in_nav", "menu": "in_nav", "header": "in_header", "footer": "in_footer",
            "aside": "in_aside", "dialog": "in_aside", "form": "in_form", "fieldset": "in_form"}.get(tag)
    if kind:
        found.append(kind)
    if "=" in attributes or "hidden" in attributes:
        names = " ".join(filter(None, (x for m in _ATTRIBUTE.findall(attributes) for x in m)))
        if names and tag not in ("html", "body"):
            if _BAD_WORDS.search(names):
                found.append("bad_name")
            elif _GOOD_WORDS.search(names):
                found.append("good_name")
        if _HIDDEN.search(attributes):
            found.append("hidden")
    return tuple(found)


def _features(text: str, linked: float, node: Node | None) -> list[float]:
    x = [0.0] * len(_NAMES)
    x[0] = 1.0
    for mark in node.marks if node else ():
        x[_AT[mark]] = 1.0
    tags, up = [], node
    while up and len(tags) < 4:
        tags.insert(0, up.tag)
        up = up.up
    x[_AT["links"]] = linked
    x[_AT["length"]] = min(6.0, np.log1p(text.count(" "))) - 2
    x[_AT["marks"]] = min(3.0, text.count(".") + text.count(",") + text.count("!") + text.count("?"))
    x[_AT["paragraph"]] = float("p" in tags or "pre" in tags or "blockquote" in tags)
    x[_AT["heading"]] = float(bool(tags) and tags[-1] in _HEADINGS)
    x[_AT["list"]] = float("li" in tags)
    x[_AT["table"]] = float("td" in tags or "th" in tags)
    x[_AT["legal"]] = float(bool(_LEGAL.search(text)))
    return x


def _edges(found: list[Block]) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for i, b in enumerate(found):
        parent = b.node.up if b.node else None
        if i:
            edges.append((i - 1, i, SMOOTH / max(1, sum(_between(found[i - 1].node, b.node)) - 1)))
        if last.get(parent, i - 1) != i - 1:
            edges.append((last[parent], i, SMOOTH / 2))
        last[parent] = i
    return edges


def main_text(page: str | None, weights: np.ndarray) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    score = np.clip(np.array([b.features for b in found]) @ weights, -30, 30)
    keep = labels(np.logaddexp(0, score).tolist(), np.logaddexp(0, -score).tolist(), _edges(found))
    return " ".join(b.text for b, k in zip(found, keep, strict=True) if k)


def fit(pages: DataFrame, *, sample_pages: int = SAMPLE_PAGES, sample_blocks: int = SAMPLE_BLOCKS) -> np.ndarray:
    """Weights of FEATURES; the priors where the sample tells nothing."""
    prepare(pages.sparkSession)
    some = distinct_sample(columns(pages, "html").where("html is not null"), "html", sample_pages).orderBy("h").select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rows = [x.features for page in b.column(0).to_pylist() for x in blocks(page)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["x"])

    got = some.mapInArrow(run, "x array<double>").limit(sample_blocks).collect()
    prior = np.array(list(FEATURES.values()))
    x = np.array([r["x"] for r in got]).reshape(-1, len(prior))
    bad = x[:, [_AT[n] for n in ("in_nav", "in_footer", "in_aside", "in_form")]].any(1) | (x[:, _AT["bad_name"]] > 0)
    good = (x[:, _AT["in_article"]] > 0) & ~bad
    bad |= (x[:, _AT["in_header"]] > 0) & ~good
    x, y = x[good | bad], good[good | bad].astype(float)
    if not len(x):
        return prior
    blank = x.copy()
    blank[:, _OWN] = 0
    x, y = np.concatenate((x, blank)), np.concatenate((y, y))
    w = prior.copy()
    for _ in range(25):  # Newton steps of ridge regression around the priors
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 2.0 * (w - prior)
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 2.0 * np.eye(len(w)), slope)
    return w


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """Per row of `pages` (`page_id`, `url`, `html`): page_id, url, text,
    n_chars (code points). A null or empty page gives an empty text. Ids and
    urls may be null or repeated; other columns are ignored; no rows give no
    rows. White space is what Unicode calls so."""
    spark = pages.sparkSession
    prepare(spark)
    w = spark.sparkContext.broadcast(fit(pages) if weights is None else weights)
    rows = columns(pages, "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = [main_text(p, w.value) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
