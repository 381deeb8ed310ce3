"""Main text of web pages by a tree-structured graphical model over the page's elements.

A page becomes a tree of its block elements. Each has a hidden state, content or not; potentials on an element come
from its tag, names and texts, potentials on an edge from the states of parent and child. Sum-product messages go
from the leaves up and from the root down and give the exact marginal of every element; a text belongs to the
nearest block, and stays if that is more likely content. The weights are trained on labelled pages by the gradient
of the conditional likelihood. The trees of many pages are one forest: a step handles a whole depth of all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewflow.llm.common import blocks, texts
from viewflow.llm.labelled_pages import DROPPED, PAGES

#: Training steps, their size, and the weight of the penalty on large weights.
STEPS, STEP, PENALTY = 1500, 0.5, 0.0005

_BLOCKS = (
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header html iframe label legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead tr ul"
).split()
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What may come before a page's body; anything else opens the body where its tag is missing.
_BEFORE_BODY = frozenset("html head title meta link base script style template noscript".split())
#: What is never text, by its end tag.
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in "script style template textarea title".split()}
_ENDS_P = frozenset(_BLOCKS) - {"button", "label", "html", "body", "option", "optgroup", "legend", "summary"}
#: An element that ends an open one, up to the element that holds both.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "option": ({"option"}, {"select"}),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
#: Names that say what an element is for.
_NAMES = {
    "menu": r"nav|menu|breadcrumb|toolbar|pagination|pager|tabs|toc",
    "advert": r"(?:^|[\W_])(?:ads?|adv|advert\w*|banner|sponsor\w*|promo\w*|dfp)(?=$|[\W_\d])",
    "footer": r"foot|copyright|legal|colophon|contentinfo",
    "header": r"head(?!line)|masthead|logo|topbar|site-?title",
    "side": r"side|aside|widget|related|recommend|complementary|trending|popular|teaser",
    "notice": r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|dialog|paywall|disclaimer",
    "comment": r"comment|repl(?:y|ies)|disqus|discuss|respond|reader|review",
    "form": r"form|login|signin|sign-?up|subscri|newsletter|search|register",
    "share": r"share|social|follow|tweet|tags?(?=$|[\W_])|meta|byline",
    "content": r"article|content|main|post|entry|story|body|text",
}
_NAME = [re.compile(pattern, re.I) for pattern in _NAMES.values()]
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*.?true", re.I)
_TAGS = "aside body button dd details dialog dl dt figcaption figure footer form h1 h2 header label legend li main menu nav ol p pre td tr ul".split()
_COLUMNS = ["bias", *(f"tag {t}" for t in _TAGS), *(f"name {n}" for n in _NAMES), "hidden", "in article", "header in article", "links", "short", "long", "sentence"]
_COLUMN = {name: number for number, name in enumerate(_COLUMNS)}
_TAG_COLUMN = {t: _COLUMN[f"tag {t}"] for t in _TAGS}
_NAME_COLUMNS = [_COLUMN[f"name {n}"] for n in _NAMES]


@dataclass
class Forest:
    """Block elements of many pages: parents come before their children."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    #: Set features as pairs of element and column.
    at: list[int] = field(default_factory=list)
    column: list[int] = field(default_factory=list)
    #: Texts in page order with their element, and where each page's texts end.
    text: list[str] = field(default_factory=list)
    owner: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    dropped: list[bool] = field(default_factory=list)

    def add(self, html: str) -> None:
        """Parses a page; what is broken is mended as browsers do in the common cases, a missing body included."""
        root = self._element(-1, "html", "", False)
        # Open elements: tag, block element that holds their text, whether inside an article.
        stack: list[tuple[str, int, bool]] = [("html", root, False)]
        parts: list[str] = []
        linked = [0, 0]  # characters of the current text, and those in links
        in_link = 0
        last = stop = 0
        unclosed: set[str] = set()  # tags of `_RAW` that have no end tag any more
        bodied = False

        def flush(own: int) -> None:
            if parts:
                joined = " ".join("".join(parts).split())
                parts.clear()
                if joined:
                    self._text(own, joined, linked[1] / max(linked[0], 1))
            linked[:] = 0, 0

        def open_body() -> None:
            del stack[1:]
            stack.append(("body", self._element(root, "body", "", False), False))

        while match := _TOKEN.search(html, stop):
            start, stop = match.span()
            if start > last:
                raw = html[last:start]
                if not bodied and not raw.isspace():
                    open_body()
                    bodied = True
                raw = unescape(raw) if "&" in raw else raw
                parts.append(raw)
                linked[0] += len(raw)
                linked[1] += len(raw) if in_link else 0
            last = stop
            tag = match["tag"] or match["tag2"]
            if tag is None:
                continue
            tag = tag.lower()
            attrs = match["attrs"] or match["attrs2"] or ""
            block = tag in _BLOCK_SET
            if match["end"] or match["end2"]:
                for level in range(len(stack) - 1, 0, -1):
                    if stack[level][0] == tag:
                        if any(x[0] in _BLOCK_SET for x in stack[level:]):
                            flush(stack[-1][1])
                        in_link -= sum(x[0] == "a" for x in stack[level:])
                        del stack[level:]
                        break
                    if not block and stack[level][0] in _BLOCK_SET:
                        break
                continue
            if not bodied and tag not in _BEFORE_BODY:
                if tag != "body":
                    open_body()
                bodied = True
            if tag in _RAW:
                if not attrs.endswith("/"):
                    last = stop = self._raw_end(html, tag, stop, stack, unclosed)
                continue
            if tag in _VOID:
                if tag in ("br", "hr"):
                    parts.append(" ")
                continue
            if block:
                flush(stack[-1][1])
                if tag in ("iframe", "select") and attrs.endswith("/"):
                    continue
                in_link -= self._close(stack, tag)
                if tag in ("html", "body") and any(x[0] == tag for x in stack):
                    if attrs:
                        self._features(stack[0][1], tag, attrs, False)
                    continue
                inside = stack[-1][2]
                element = self._element(stack[-1][1], tag, attrs, inside)
                stack.append((tag, element, inside or tag in ("article", "main")))
            elif not attrs.endswith("/"):
                in_link += tag == "a"
                stack.append((tag, stack[-1][1], stack[-1][2]))
        if last < len(html):
            if not bodied and not html[last:].isspace():
                open_body()
            parts.append(unescape(html[last:]))
        flush(stack[-1][1])
        self.ends.append(len(self.text))

    @staticmethod
    def _raw_end(html: str, tag: str, start: int, stack: list[tuple[str, int, bool]], unclosed: set[str]) -> int:
        """Where what is no text ends: behind its end tag, or else before that of an element around it."""
        end = None if tag in unclosed else _RAW[tag].search(html, start)
        if end:
            return end.end()
        unclosed.add(tag)
        if tag in ("title", "textarea"):
            return start
        around = "|".join(sorted({re.escape(x[0]) for x in stack}))
        end = re.compile(rf"</(?:{around})(?=[\s/>])", re.I).search(html, start)
        return end.start() if end else len(html)

    @staticmethod
    def _close(stack: list[tuple[str, int, bool]], tag: str) -> int:
        """Closes what the new block ends by itself; the links that were closed."""
        ended, limit = _ENDS.get(tag, (set(), set()))
        cut = None
        for level in range(len(stack) - 1, 0, -1):
            own = stack[level][0]
            if own in limit or own in ("table", "button") and tag != own:
                break
            if own in ended or own == "p" and tag in _ENDS_P:
                cut = level
                break
            if own in _BLOCK_SET and not ended:
                break
        if cut is None:
            return 0
        links = sum(x[0] == "a" for x in stack[cut:])
        del stack[cut:]
        return links

    def _element(self, parent: int, tag: str, attrs: str, inside: bool) -> int:
        number = len(self.parent)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.dropped.append(DROPPED in attrs or parent >= 0 and self.dropped[parent])
        self.at.append(number)
        self.column.append(0)
        self._features(number, tag, attrs.replace(DROPPED, ""), inside)
        return number

    def _features(self, number: int, tag: str, attrs: str, inside: bool) -> None:
        found = [_TAG_COLUMN[tag]] if tag in _TAG_COLUMN else []
        if inside:
            found.append(_COLUMN["in article"])
            if tag == "header":
                found.append(_COLUMN["header in article"])
        if attrs and not attrs.isspace():
            names = " ".join(a[1] or a[2] or a[3] for a in _ATTR.findall(attrs) if a[0].lower() in ("class", "id", "role", "aria-label"))
            if names:
                found += [c for c, pattern in zip(_NAME_COLUMNS, _NAME) if pattern.search(names)]
            if _HIDDEN.search(attrs):
                found.append(_COLUMN["hidden"])
        self.at += [number] * len(found)
        self.column += found

    def _text(self, own: int, text: str, links: float) -> None:
        self.text.append(text)
        self.owner.append(own)
        found = []
        if links > 0.5:
            found.append(_COLUMN["links"])
        found.append(_COLUMN["short" if len(text) < 25 else "long"])
        if text[-1] in ".!?…。":
            found.append(_COLUMN["sentence"])
        self.at += [own] * len(found)
        self.column += found


_BLOCK_SET = frozenset(_BLOCKS)


class Graph:
    """The factor graph of a forest."""

    def __init__(self, forest: Forest):
        self.parent, self.depth = np.array(forest.parent), np.array(forest.depth)
        self.features = np.unique(np.array(forest.at, dtype=np.int64) * len(_COLUMNS) + np.array(forest.column, dtype=np.int64))
        self.at, self.column = np.divmod(self.features, len(_COLUMNS))
        order = np.argsort(self.depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(self.depth))[:-1]) if len(order) else []

    def marginals(self, weights: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability of content of each element, and of each edge's states (parent, child) by child."""
        unary = np.zeros((len(self.parent), 2))
        unary[:, 1] = np.bincount(self.at, weights=weights[self.column], minlength=len(self.parent))
        up = unary.copy()  # own potential and all messages from below
        message = np.zeros_like(up)
        for level in self.levels[:0:-1]:
            own = up[level]
            message[level] = np.stack([np.logaddexp(edge[s, 0] + own[:, 0], edge[s, 1] + own[:, 1]) for s in (0, 1)], axis=1)
            np.add.at(up, self.parent[level], message[level])
        belief = up.copy()
        joint = np.zeros((len(self.parent), 2, 2))
        for level in self.levels[1:]:
            above = belief[self.parent[level]] - message[level]
            down = np.stack([np.logaddexp(above[:, 0] + edge[0, s], above[:, 1] + edge[1, s]) for s in (0, 1)], axis=1)
            belief[level] = up[level] + down
            both = above[:, :, None] + edge[None] + up[level][:, None, :]
            both -= both.max(axis=(1, 2), keepdims=True)
            joint[level] = np.exp(both) / np.exp(both).sum(axis=(1, 2), keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


@dataclass
class Model:
    weights: np.ndarray
    edge: np.ndarray


def trained() -> Model:
    """Trained on the labelled pages: expected counts are moved to the observed ones."""
    forest = Forest()
    for page in PAGES:
        forest.add(page)
    graph = Graph(forest)
    state = np.where(np.array(forest.dropped), 0, 1)
    child = graph.parent >= 0
    weights, edge = np.zeros(len(_COLUMNS)), np.zeros((2, 2))
    observed = np.bincount(graph.column, weights=state[graph.at], minlength=len(weights))
    seen = np.zeros((2, 2))
    np.add.at(seen, (state[graph.parent[child]], state[child]), 1)
    for _ in range(STEPS):
        content, joint = graph.marginals(weights, edge)
        expected = np.bincount(graph.column, weights=content[graph.at], minlength=len(weights))
        weights += STEP * ((observed - expected) / len(PAGES) - PENALTY * weights)
        edge += STEP * ((seen - joint[child].sum(axis=0)) / len(state) - PENALTY * edge)
    return Model(weights, edge)


def main_texts(pages: list[str], model: Model) -> list[str]:
    """The content blocks of each page, joined by empty lines."""
    forest = Forest()
    for page in pages:
        forest.add(page)
    content, _ = Graph(forest).marginals(model.weights, model.edge)
    kept = (content > 0.5).tolist()
    out, first = [], 0
    for end in forest.ends:
        out.append("\n\n".join([forest.text[i] for i in range(first, end) if kept[forest.owner[i]]]))
        first = end
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (empty if there is none) and n_chars of every page.

    A null or empty page, or one without content, has an empty text; a page without any tag is its whole text in one
    block. Repeated rows stay repeated; broken markup never fails.
    """

    model = pages.sparkSession.sparkContext.broadcast(trained())  # a weight for each feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 2):
            found = main_texts(texts(block.column(2)), model.value)
            yield pa.record_batch(
                [block.column(0), block.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select("page_id", "url", pages["html"].cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    return chosen.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
