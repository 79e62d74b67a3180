"""Main text of web pages: flat blocks of text, judged by a decision tree from what they hold and what stands around them.

A page is read once from start to end. Tags that flow with the text (links, emphasis) don't end a block, all others do,
so that what is left is a list of blocks; no tree of elements is built, and tags that are never closed do no harm. A block
is described by its words and their share in links, by those of its two neighbours, by where it stands, and by a few
signs in it; a small tree, learned from the labelled blocks of LABELLED, says whether it is main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import chunks, without

# Elements whose content is no text of the page (of which the first only end at their own end tag), those that flow with the text, and those that are parts of a page.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
SILENT = RAW | {"noscript", "template", "svg", "math", "object", "canvas", "select", "button", "audio", "video", "datalist"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "nobr", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
PARTS = {"article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl", "table", "td", "blockquote", "figure", "details", "dialog", "menu", "fieldset", "address", "body"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
AROUND, MAIN = {"nav", "footer", "aside", "form", "dialog", "menu", "fieldset"}, {"article", "main"}
# Words in the class, id or role of a part that say what it is for.
AROUND_WORDS = {
    "ad", "adv", "advert", "advertisement", "advertising", "banner", "breadcrumb", "comment", "complementary", "consent", "contentinfo", "cookie", "copyright", "discussion", "disqus", "footer", "form", "gdpr", "header", "legal", "links", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "tags", "toc", "toolbar", "topbar", "widget",
}
TOP_WORDS = {"header", "masthead"}
MAIN_WORDS = {"article", "body", "content", "entry", "main", "maintext", "post", "story", "text"}

#: A comment, a declaration, or a tag: whether it ends something, its name, and the rest up to its end.
TAG = re.compile(r"""<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>)""")
PLAIN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)")
NAMED = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "around", "main", "heading", "item", "sentence", "rights"]


@dataclass
class Block:
    """A run of text between tags that end one: its text, words in it and in its links, and where it stands."""

    text: str
    words: int
    linked: int
    around: bool
    main: bool
    heading: bool
    item: bool


@lru_cache(4096)
def _purpose(name: str, rest: str) -> int:
    """1 for parts that main text stands in, -1 for those around it, -2 for heads (around it, unless they stand in it), 0 where nothing tells.

    A part's element tells first, then its class, id and role: the first of their names that has a known word.
    """
    if name in AROUND or name == "header":
        return -1 if name in AROUND else -2
    if name in MAIN or name == "body":
        return int(name in MAIN)
    for named in " ".join(v.strip("\"'") for v in NAMED.findall(rest)).split():
        words = [w for part in WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", named).lower()) for w in (part, part.removesuffix("s"))]
        if words and words[0] not in ("has", "ha", "with", "no", "is"):
            if any(w in AROUND_WORDS for w in words):
                return -2 if not any(w in AROUND_WORDS - TOP_WORDS for w in words) else -1
            if any(w in MAIN_WORDS for w in words):
                return 1
    return 0


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order; those without any text are none.

    Character references are decoded after tags have gone, white space becomes single spaces. A silent element lasts to
    its end tag, or to the end of the page. A tag or comment that is never closed takes the rest of the page; a quote that
    is never closed is none.
    """
    out: list[Block] = []
    parts: list[tuple[str, int]] = []  # open parts and their purpose
    said: list[tuple[str, bool]] = []
    heading = item = linked = False
    at, size, tag = 0, len(html), TAG

    def end() -> None:
        text = SPACES.sub(" ", unescape("".join(s for s, _ in said))).strip()
        if text:
            purposes = [p for _, p in parts if p]
            inside = sum(len(s.split()) for s, in_link in said if in_link)
            out.append(Block(text, len(text.split()), inside, bool(purposes) and purposes[-1] < 0, bool(purposes) and purposes[-1] > 0, heading, item))
        said.clear()

    while at < size:
        start = html.find("<", at)
        if start < 0:
            said.append((html[at:], linked))
            break
        m = tag.match(html, start)
        if m is None:
            after = html[start + 1 : start + 3].removeprefix("/")[:1]
            opens = after.isascii() and after.isalpha()
            if opens and tag is TAG:  # an odd quote: from here on quotes mean nothing, so that the page is scanned once
                tag = PLAIN
                continue
            said.append((html[at : start if opens else start + 1], linked))
            at = size if opens else start + 1
            continue
        said.append((html[at:start], linked))
        name = (m[2] or "").lower()
        if not name:  # a comment or a declaration
            comment = html.startswith("<!--", start)
            stop = html.find("-->" if comment else ">", start + (2 if comment else 1))
            at = size if stop < 0 else stop + (3 if comment else 1)
            continue
        at, closes = m.end(), bool(m[1])
        if name in SILENT:
            if not closes and not (name in ("svg", "math") and m[3].endswith("/")):
                over = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at)
                at = over.end() if over else size if name in RAW else at
            said.append(("" if name in ("script", "style", "template", "noscript") else " ", linked))
            continue
        if name in INLINE:
            if name == "a":
                linked = not closes
            elif name in ("br", "img"):
                said.append((" ", linked))
            continue
        end()
        linked = linked and not closes  # an open link doesn't outlast the part that it is in
        if name in HEADINGS:
            heading = not closes
        elif name in ("li", "dt", "dd"):
            item = not closes
        elif name == "p":
            heading = item = False
        elif name in PARTS:
            heading = item = False
            if not closes:
                purpose = _purpose(name, m[3])
                last = next((p for _, p in reversed(parts) if p), 0)
                parts.append((name, purpose if purpose > -2 else 0 if last > 0 else -1))
            elif (last := next((i for i in range(len(parts) - 1, -1, -1) if parts[i][0] == name), None)) is not None:
                del parts[last:]
    end()
    return out


def features(page: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block of a page; beyond its ends there are no words."""
    own = np.array([(b.words, b.linked / b.words) for b in page], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    near = np.concatenate([np.concatenate([none, own])[: len(page)], np.concatenate([own, none])[1:]], 1)
    signs = [(b.around, b.main, b.heading, b.item, b.text[-1] in ".!?:;\"'”»…。", "©" in b.text or "(c)" in b.text.lower() or "rights reserved" in b.text.lower()) for b in page]
    return np.concatenate([own, near, np.array(signs, float).reshape(-1, 6)], 1)


@dataclass
class Tree:
    """A decision tree as arrays: rows go left where feature <= cut; leaves have feature -1 and say whether a block is kept."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    keep: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while len(at := np.flatnonzero(self.feature[node] >= 0)):
            here = node[at]
            low = x[at, self.feature[here]] <= self.cut[here]
            node[at] = np.where(low, self.left[here], self.right[here])
        return self.keep[node]


def fit(x: np.ndarray, keep: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """A tree of so many levels at most, whose leaves have `least` rows or more; each cut takes the most impurity (Gini's) away, the first feature and lowest cut of equals."""
    nodes: list[list] = []

    def impurity(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 2 * ones * (n - ones) / np.maximum(n, 1)

    def grow(rows: np.ndarray, level: int) -> int:
        me, y = len(nodes), keep[rows]
        nodes.append([-1, 0.0, 0, 0, bool(y.mean() > 0.5)])
        best = (impurity(y.sum(), len(y)) - 1e-9, -1, 0.0)
        if level < depth and 0 < y.sum() < len(y):
            for f in range(x.shape[1]):
                order = np.argsort(x[rows, f], kind="stable")
                v, ones = x[rows[order], f], np.cumsum(y[order])
                n = np.arange(1, len(v))
                cost = impurity(ones[:-1], n) + impurity(ones[-1] - ones[:-1], len(v) - n)
                cost[(v[:-1] == v[1:]) | (n < least) | (len(v) - n < least)] = np.inf
                if len(cost) and cost.min() < best[0]:
                    i = int(cost.argmin())
                    best = (cost[i], f, (v[i] + v[i + 1]) / 2)
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            nodes[me][:4] = [best[1], best[2], grow(rows[low], level + 1), grow(rows[~low], level + 1)]
        return me

    grow(np.arange(len(x)), 0)
    return Tree(*(np.array(c) for c in zip(*nodes, strict=True)))


@lru_cache(1)
def learned() -> Tree:
    """The tree of the labelled blocks: the same in every task."""
    from .pages import LABELLED

    x, keep = [], []
    for html, kept in LABELLED:
        page = blocks(html)
        if len(page) != len(kept):
            raise ValueError(f"{len(page)} blocks, but {len(kept)} labels: {html[:80]}")
        x.append(features(page))
        keep.append(np.array([c == "+" for c in kept]))
    return fit(np.concatenate(x), np.concatenate(keep))


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """The kept blocks of each page, a line each."""
    read = [blocks(p) for p in pages]
    kept = tree.predict(np.concatenate([features(p) for p in read])) if any(read) else np.zeros(0, bool)
    out, at = [], 0
    for p in read:
        out.append("\n".join(b.text for b, k in zip(p, kept[at : at + len(p)], strict=True) if k))
        at += len(p)
    return out


def extract(pages: DataFrame, html: str = "html", tree: Tree | None = None) -> DataFrame:
    """pages with `text`, each page's main text, and `n_chars`, its code points, in the place of any columns of these names.

    Null and empty pages have an empty text, as have those without main text; pages are read whole, whatever their length,
    and repeated ones alike. An empty table stays empty. Each page is read by the task that has its row: no shuffle.
    """
    found, page = tree or learned(), "_html"
    while page.lower() in {c.lower() for c in pages.columns}:
        page = f"_{page}"
    rest = without(pages, "text", "n_chars")
    kind = T.StructType([*rest.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in chunks(batch, page)):
            texts = main_texts([t or "" for t in part.column(page).to_pylist()], found)
            own = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*part.schema.names[:-1], "text", "n_chars"])

    return pages.select(*(pages[f"`{c}`"] for c in rest.columns), pages[f"`{html}`"].alias(page)).mapInArrow(run, kind)
