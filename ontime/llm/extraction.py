"""Main text of HTML pages by boosted trees over the nodes of a page (operator 12).

A page is parsed to a tree of blocks (``htmlblocks``).  Every node gets features: its tag, the words of its
class, id, role and itemprop (each word's log-odds of main text, learned), the same over its ancestors,
depth, size and density of its subtree (links, punctuation, blocks, form controls), and how it compares with
its siblings.  Gradient-boosted trees give each node the log-odds that it holds main text.  They are fitted
in one task on ``TRAINING_PAGES`` made-up pages with known main text (``pagesamples``); nothing of the given
table is learned from.

Decoding is hierarchical: a node can only be kept if its parent is, and of all such choices the one with the
greatest sum of log-odds is taken (one pass up the tree, one down), so that no kept text stands in a dropped
ancestor.  The kept text leaves, in page order, are the blocks of the result.

Scoring is one map over the pages, without a shuffle.

Defined results: null and empty pages, and pages without main text, give an empty text; ``<br>`` is white
space; repeated rows are extracted each; any id type, null included, passes through; columns other than
page_id, url and html are left aside; an empty table gives no rows.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ontime.llm.htmlblocks import Page, parse
from ontime.llm.pagesamples import MARK, labelled_pages
from ontime.llm.text import slices

TRAINING_PAGES, SEED = 1600, 7
TREES, DEPTH, RATE, BINS, SMOOTH = 80, 4, 0.2, 32, 1.0
#: Bytes of HTML that are parsed before their nodes are scored together.
PAGE_BYTES = 1 << 21
_PUNCTUATION = ".,;:!?"
#: Words of nodes that stand above all text of a page and tell nothing.
EVERYWHERE = ("<#root", "<html", "<body", "<#text")

FEATURES = ["tag", "word_min", "word_max", "path_min", "path_max", "parent_tag", "depth", "log_chars", "link_share", "tags_per_char",
            "page_share", "children", "text_blocks", "mean_block", "longest_block", "punctuation", "place", "siblings", "sibling_chars",
            "parent_share", "link_share_before", "link_share_after", "page_place", "is_text", "controls", "media", "paragraph_share",
            "link_share_siblings", "parent_log_chars", "parent_blocks", "parent_paragraph_share", "parent_punctuation", "above_chars"]


@dataclass
class Nodes:
    """The nodes of several pages, one after the other, as arrays; ``page`` has the offsets of the pages."""

    page: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    words: list[tuple[str, ...]]
    texts: list[str]
    counts: np.ndarray  # chars, link chars, punctuation, blocks, controls, media, paragraph chars, elements


def nodes(pages: list[Page]) -> Nodes:
    off = np.concatenate([[0], np.cumsum([len(p.tag) for p in pages])]).astype(np.int64)
    parent = np.concatenate([np.array(p.parent, np.int64) + at for p, at in zip(pages, off)]) if pages else np.zeros(0, np.int64)
    parent[off[:-1]] = -1
    texts = [t.removeprefix(MARK) for p in pages for t in p.text]
    tags = [t for p in pages for t in p.tag]
    chars = np.array([len(t) for t in texts], np.float64)
    is_text, of_p = chars > 0, np.array([t == "p" for t in tags], bool)
    of_p |= np.array([t == "#text" for t in tags], bool) & of_p[parent] if len(tags) else of_p
    counts = np.column_stack([
        chars, np.array([x for p in pages for x in p.links], np.float64),
        np.array([sum(map(t.count, _PUNCTUATION)) if t else 0 for t in texts], np.float64), is_text,
        np.array([x for p in pages for x in p.controls], np.float64), np.array([x for p in pages for x in p.media], np.float64),
        np.where(of_p, chars, 0), np.array([t != "#text" for t in tags], bool)])
    words = [("<" + t, *w) for p in pages for t, w in zip(p.tag, p.tokens)]
    return Nodes(off, parent, np.array([d for p in pages for d in p.depth], np.int64), words, texts, counts)


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """Indices of the nodes of each depth, from the root down."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))


def features(n: Nodes, odds: dict[str, float]) -> np.ndarray:
    """nodes x ``FEATURES``."""
    size = len(n.parent)
    if not size:
        return np.zeros((0, len(FEATURES)), np.float32)
    levels, has = _levels(n.depth), n.parent >= 0
    up = np.where(has, n.parent, np.arange(size))
    total, longest = n.counts.copy(), n.counts[:, 0].copy()
    for own in reversed(levels[1:]):
        np.add.at(total, n.parent[own], total[own])
        np.maximum.at(longest, n.parent[own], longest[own])
    tag = np.array([odds.get(w[0], 0.0) for w in n.words])
    named = [[odds.get(t, 0.0) for t in w[1:]] or [0.0] for w in n.words]
    least, most = np.array([min(v) for v in named]), np.array([max(v) for v in named])
    path_min, path_max = np.minimum(least, tag), np.maximum(most, tag)
    for own in levels[1:]:
        path_min[own] = np.minimum(path_min[own], path_min[n.parent[own]])
        path_max[own] = np.maximum(path_max[own], path_max[n.parent[own]])
    chars, links, punctuation, blocks, controls, media, in_p, elements = total.T
    some = np.maximum(chars, 1)
    children = np.bincount(n.parent[has], minlength=size).astype(np.float64)
    # siblings stand side by side when nodes are sorted by parent
    order = np.lexsort((np.arange(size), n.parent))
    first = np.searchsorted(n.parent[order], n.parent)
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    place, siblings = np.where(has, rank - first, 0).astype(np.float64), np.where(has, children[up], 1)
    share = links / some
    before = np.where(has & (place > 0), share[order[np.maximum(rank - 1, 0)]], -1)
    after = np.where(has & (place < siblings - 1), share[order[np.minimum(rank + 1, size - 1)]], -1)
    page = np.repeat(np.arange(len(n.page) - 1), np.diff(n.page))
    root = n.page[page]
    running = np.concatenate([[0], np.cumsum(n.counts[:, 0])])
    page_chars = np.maximum(chars[root], 1)
    others = np.maximum(chars[up] - chars, 0)
    return np.column_stack([
        tag, least, most, path_min, path_max, np.where(has, tag[up], 0), n.depth, np.log1p(chars), share, elements / some,
        chars / page_chars, children, blocks, chars / np.maximum(blocks, 1), np.log1p(longest), punctuation / some,
        place / np.maximum(siblings - 1, 1), siblings, np.log1p(others / np.maximum(siblings - 1, 1)), chars / np.maximum(chars[up], 1),
        before, after, (running[:-1] - running[root]) / page_chars, n.counts[:, 3], controls, media, in_p / some,
        np.maximum(links[up] - links, 0) / np.maximum(others, 1), np.log1p(chars[up]), blocks[up], (in_p / some)[up],
        (punctuation / some)[up], np.log1p(chars[up[up]])]).astype(np.float32)


class Boosted:
    """Gradient-boosted trees of one depth for the logistic loss."""

    def __init__(self) -> None:
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # feature, threshold of inner nodes; leaf values
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.column_stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)])
        wide = binned.shape[1] * BINS
        cell = binned + np.arange(binned.shape[1]) * BINS
        mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = math.log(mean / (1 - mean))
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            slope, bend = y - p, p * (1 - p)
            at = np.zeros(len(y), np.int64)
            feature, threshold = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf, np.float32)
            for level in range(DEPTH):
                start, many = 2 ** level - 1, 2 ** level
                key = ((at - start)[:, None] * wide + cell).ravel()
                shape = many, binned.shape[1], BINS
                g = np.bincount(key, np.repeat(slope, binned.shape[1]), many * wide).reshape(shape).cumsum(axis=2)
                h = np.bincount(key, np.repeat(bend, binned.shape[1]), many * wide).reshape(shape).cumsum(axis=2)
                gain = g ** 2 / (h + SMOOTH) + (g[..., -1:] - g) ** 2 / (h[..., -1:] - h + SMOOTH)
                best = gain.reshape(many, -1).argmax(axis=1)
                for i, (f, b) in enumerate(zip(*np.divmod(best, BINS))):
                    feature[start + i] = f
                    if b < len(cuts[f]):
                        threshold[start + i] = cuts[f][b]
                at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > threshold[at])
            leaf = at - (2 ** DEPTH - 1)
            value = RATE * np.bincount(leaf, slope, 2 ** DEPTH) / (np.bincount(leaf, bend, 2 ** DEPTH) + SMOOTH)
            score += value[leaf]
            self.trees.append((feature, threshold, value))
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (2 ** DEPTH - 1)]
        return out


def decode(n: Nodes, log_odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the choice of greatest total log-odds in which a kept node's parent is kept."""
    gain = log_odds.astype(np.float64)
    levels = _levels(n.depth)
    for own in reversed(levels[1:]):
        np.add.at(gain, n.parent[own], np.maximum(gain[own], 0))
    keep = gain > 0
    for own in levels[1:]:
        keep[own] &= keep[n.parent[own]]
    return keep


@dataclass
class Model:
    odds: dict[str, float]
    trees: Boosted

    def main_texts(self, sources: list[str | None]) -> list[str]:
        """The main text of each page."""
        n = nodes([parse(s) for s in sources])
        keep = decode(n, self.trees.log_odds(features(n, self.odds)))
        return ["\n\n".join(n.texts[i] for i in range(a, b) if keep[i] and n.texts[i]) for a, b in zip(n.page[:-1], n.page[1:])]


def _labels(pages: list[Page], n: Nodes) -> np.ndarray:
    """1 for the nodes whose subtree holds main text."""
    label = np.array([t.startswith(MARK) for p in pages for t in p.text], np.float64)
    for own in reversed(_levels(n.depth)[1:]):
        np.maximum.at(label, n.parent[own], label[own])
    return label


def train(n_pages: int = TRAINING_PAGES, seed: int = SEED) -> Model:
    """Words' log-odds from one half of the made-up pages, trees from the other."""
    pages = [parse(s) for s in labelled_pages(n_pages, seed)]
    held: dict[bool, tuple[Nodes, np.ndarray]] = {}
    for half in (False, True):
        own = [p for i, p in enumerate(pages) if i % 2 == half]
        held[half] = (n := nodes(own)), _labels(own, n)
    n, label = held[False]
    good, seen = Counter(), Counter()
    for words, y in zip(n.words, label):
        for w in set(words):
            good[w] += y
            seen[w] += 1
    rate = float(label.mean())
    prior = math.log(rate / (1 - rate))
    odds = {w: math.log((good[w] + 2 * rate) / (k - good[w] + 2 * (1 - rate))) - prior for w, k in seen.items() if w not in EVERYWHERE}
    n, label = held[True]
    return Model(odds, Boosted().fit(features(n, odds), label))


def fit(spark: SparkSession, n_pages: int = TRAINING_PAGES, seed: int = SEED) -> Model:
    """``train`` in a task."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(n_pages, seed))], pa.binary())], names=["model"])

    return pickle.loads(spark.range(1, numPartitions=1).mapInArrow(task, "model binary").first()["model"])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars (code points) of each row of ``pages`` (page_id, url, html)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", PAGE_BYTES):
            texts = model.main_texts(part.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(task, f"page_id {kind}, url string, text string, n_chars long")
