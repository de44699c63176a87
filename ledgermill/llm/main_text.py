"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags.  Each block is described by its word
count and link density, those of its neighbours, and the elements it stands in
(article or main, navigation and other page furniture, reader comments, told by
tag, role and class names).  A decision tree, grown from a small labelled table,
says which blocks are main text.  Scripts, styles, form controls, comments and
markup never become blocks.

Null and empty pages, and pages without a block of main text, give an empty text.
Every row gives one row; repeated rows and further columns do not matter.  Markup
that is cut off or badly nested is read as far as it goes; nothing is cut short.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.text import slices

LABELLED = Path(__file__).with_name("main_text_labelled.txt")

# Names of HTML elements.
RAW = {"script", "style", "title", "textarea", "iframe", "noscript", "xmp", "noembed", "noframes"}
SKIPPED = {"svg", "math", "select", "button", "template", "object", "canvas", "datalist", "video", "audio", "map", "dialog"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "label",
    "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
HELD = {
    "address", "article", "aside", "blockquote", "center", "details", "div", "dl", "fieldset", "figure", "footer", "form", "header",
    "main", "menu", "nav", "ol", "section", "span", "table", "td", "th", "tr", "ul", *SKIPPED,
}
APART = {"aside", "footer", "form", "header", "menu", "nav"}

# Words in class, id and role that tell what an element holds.
FURNITURE = {
    "ad", "ads", "advert", "advertisement", "adverts", "alert", "author", "banner", "bio", "breadcrumb", "breadcrumbs", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog", "disclaimer", "footer", "gdpr", "header", "login", "masthead", "menu",
    "menubar", "meta", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "outbrain", "overlay", "pager", "pagination", "popup",
    "promo", "promotion", "recommended", "related", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "tags", "teaser", "toolbar", "topbar", "widget", "widgets",
}
DISCUSSION = {"comment", "comments", "commentlist", "disqus", "discussion", "replies", "reply", "respond", "responses", "reviews"}
CONTENT = {"article", "blog", "body", "content", "entry", "main", "post", "story", "text"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=|["'])*+)>""")
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
# Last words of a name that say nothing about what is held, and first words that speak of something else on the page.
NEUTRAL = {
    "area", "bar", "block", "bottom", "box", "buttons", "container", "inner", "item", "items", "left", "links", "list", "media", "outer",
    "panel", "posts", "right", "section", "slot", "top", "unit", "wrap", "wrapper",
}
ABOUT = {"has", "no", "with", "without"}


def names(attributes: str) -> set[str]:
    """What the class, id and role names of a tag say: of each name the word that the others qualify, its last that is not neutral."""
    out = set()
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = _WORD.findall(name)
            while len(words) > 1 and words[-1] in NEUTRAL:
                words.pop()
            if words and words[0] not in ABOUT:
                out.add(words[-1])
    return out


@dataclass
class Block:
    text: str
    words: int
    linked: int
    tag: str
    article: bool
    content: bool
    furniture: bool
    apart: bool
    discussion: bool
    nearest: int


@dataclass(frozen=True)
class _Place:
    """What is open at a place of the page, from the outside to the element ``name``."""

    name: str = ""
    skip: bool = False
    inner: bool = False  # in an article or main
    article: bool = False
    content: bool = False
    furniture: bool = False  # inside the innermost article or main, if there is one
    apart: bool = False
    discussion: bool = False
    nearest: int = 0  # kind of the innermost holder that has one

    def enter(self, name: str, kind: int) -> _Place:
        inner = name in ("article", "main")
        return _Place(
            name, name in SKIPPED, self.inner or inner, self.article or name == "article", self.content or kind == 1,
            not inner and (self.furniture or kind == -1), self.apart or (name in APART and kind < 0),
            self.discussion or kind == -2, kind or self.nearest,
        )


@dataclass
class _Page:
    """Reads one page from left to right; every tag costs the same, however deep it stands."""

    blocks: list[Block] = field(default_factory=list)
    open: list[_Place] = field(default_factory=lambda: [_Place()])
    depth: dict[str, int] = field(default_factory=dict)  # open elements by name
    pieces: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)
    link: bool = False
    tag: str = "body"
    skipped: int = 0

    def text(self, piece: str) -> None:
        if not self.skipped and piece:
            self.pieces.append(piece)
            if self.link:
                self.links.append(piece)

    def end(self, tag: str) -> None:
        """Close the block that is being read."""
        text = " ".join(unescape("".join(self.pieces)).split())
        if text:
            linked = len(unescape(" ".join(self.links)).split())
            words, at = text.count(" ") + 1, self.open[-1]
            self.blocks.append(
                Block(
                    text, words, min(words, linked), self.tag, at.inner, at.content, at.furniture, at.apart, at.discussion, at.nearest,
                )
            )
        self.pieces, self.links, self.tag = [], [], tag

    def _kind(self, name: str, attributes: str) -> int:
        """1 for holders of content, -1 for page furniture, -2 for reader comments, else 0."""
        words, inner = names(attributes), self.open[-1].article
        if words & DISCUSSION:
            return -2
        if name in ("nav", "aside", "footer", "form", "menu") or (name == "header" and not inner):
            return -1
        if words & FURNITURE and not (name in ("article", "main") or (name == "header" and inner)):
            return -1
        return 1 if name in ("article", "main") or words & CONTENT else 0

    def start_tag(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.end(name)
        elif name == "br":
            self.text(" ")
        if name == "a":
            self.link = True
        if name in HELD and not attributes.endswith("/"):
            self.open.append(self.open[-1].enter(name, self._kind(name, attributes)))
            self.depth[name] = self.depth.get(name, 0) + 1
            self.skipped += self.open[-1].skip

    def end_tag(self, name: str) -> None:
        if name in BLOCKS:
            self.end("body")
        if name == "a":
            self.link = False
        if self.depth.get(name):
            while True:
                last = self.open.pop()
                self.depth[last.name] -= 1
                self.skipped -= last.skip
                if last.name == name:
                    break


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in page order."""
    page, at = _Page(), 0
    lower: str | None = None
    while True:
        tag = html.find("<", at)
        if tag < 0:
            page.text(html[at:])
            break
        page.text(html[at:tag])
        if html.startswith("<!--", tag):
            end = html.find("-->", tag + 4)
            at = len(html) if end < 0 else end + 3
        elif html.startswith(("<!", "<?"), tag):
            end = html.find(">", tag)
            at = len(html) if end < 0 else end + 1
        elif m := _TAG.match(html, tag):
            name, at = m[2].lower(), m.end()
            if m[1]:
                page.end_tag(name)
            elif name in RAW and not m[3].endswith("/"):
                lower = lower if lower is not None else _ascii_lower(html)
                end = lower.find(f"</{name}", at)
                close = html.find(">", end) if end >= 0 else -1
                at = len(html) if close < 0 else close + 1
            else:
                page.start_tag(name, m[3])
        elif tag + 1 < len(html) and (html[tag + 1].isalpha() or html[tag + 1] == "/"):
            end = html.find(">", tag)
            at = len(html) if end < 0 else end + 1  # a tag that is cut off, or no tag name
        else:
            page.text("<")
            at = tag + 1
    page.end("body")
    return page.blocks


_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _ascii_lower(html: str) -> str:
    return html.translate(_LOWER)


# ---- features and tree ----------------------------------------------------

FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "in_article", "in_content",
    "furniture", "apart", "discussion", "nearest", "heading", "list_item",
]


def features(found: list[Block]) -> np.ndarray:
    """One row per block of one page."""
    words = np.array([b.words for b in found], float)
    density = np.array([b.linked / b.words for b in found], float)

    def near(values: np.ndarray, step: int) -> np.ndarray:
        out = np.zeros(len(values))
        if step < 0:
            out[1:] = values[:-1]
        else:
            out[:-1] = values[1:]
        return out

    own = [
        [b.article, b.content, b.furniture, b.apart, b.discussion, b.nearest, len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit(), b.tag == "li"]
        for b in found
    ]
    columns = [words, density, near(words, -1), near(density, -1), near(words, 1), near(density, 1)]
    return np.column_stack([*columns, np.array(own, float).reshape(len(found), 8)])


@dataclass
class Tree:
    """Node ``i`` sends values up to ``cut[i]`` of ``feature[i]`` to ``left[i]``, others to ``right[i]``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    main: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        while (inner := self.feature[node] >= 0).any():
            at = node[inner]
            low = rows[inner, self.feature[at]] <= self.cut[at]
            node[inner] = np.where(low, self.left[at], self.right[at])
        return self.main[node]


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """A classification tree by Gini impurity."""
    nodes: list[list] = []

    def node(own: np.ndarray, level: int) -> int:
        here = len(nodes)
        share = labels[own].mean()
        nodes.append([-1, 0.0, 0, 0, share >= 0.5])
        if level == depth or share in (0, 1) or len(own) < 2 * least:
            return here
        best = (share * (1 - share) * len(own) - 1e-9, -1, 0.0)
        for f in range(rows.shape[1]):
            order = own[np.argsort(rows[own, f], kind="stable")]
            value, hits = rows[order, f], np.cumsum(labels[order])
            n = np.arange(1, len(order))
            cost = hits[:-1] * (1 - hits[:-1] / n) + (hits[-1] - hits[:-1]) * (1 - (hits[-1] - hits[:-1]) / (len(order) - n))
            cost[(value[1:] == value[:-1]) | (n < least) | (len(order) - n < least)] = np.inf
            k = int(cost.argmin())
            if cost[k] < best[0]:
                best = (cost[k], f, (value[k] + value[k + 1]) / 2)
        if best[1] >= 0:
            low = rows[own, best[1]] <= best[2]
            left, right = node(own[low], level + 1), node(own[~low], level + 1)
            nodes[here][:4] = best[1], best[2], left, right
        return here

    node(np.arange(len(rows)), 0)
    kinds = (np.int64, float, np.int64, np.int64, bool)
    return Tree(*[np.array([n[k] for n in nodes], kind) for k, kind in enumerate(kinds)])


def read_labelled(path: Path = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    rows, labels = [], []
    for page in path.read_text().splitlines():
        if page and not page.startswith("#"):
            found = blocks(re.sub(r"\[(\d+)(\*?)\]", lambda m: " ".join(["main" if m[2] else "rest"] * int(m[1])), page))
            rows.append(features(found))
            labels += ["main" in b.text for b in found]
    return np.concatenate(rows), np.array(labels)


def train() -> Tree:
    return grow(*read_labelled())


def main_text(tree: Tree, html: str | None) -> str:
    found = blocks(html or "")
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, tree(features(found)), strict=True) if keep)


def extract(frame: DataFrame, tree: Tree, key: str = "page_id", html: str = "html") -> DataFrame:
    """The key and ``text`` of every page."""
    shared = frame.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [main_text(shared.value, page) for page in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], ["key", "main"])

    picked = frame.selectExpr(key, f"CAST(`{html}` AS STRING) AS text")
    name = picked.columns[0]
    picked = picked.toDF("key", "text")
    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(run, f"key {kind}, main string").selectExpr(f"key AS `{name}`", "main AS text")
