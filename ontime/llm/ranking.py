"""Ranked lexical search: exact inner-product search with sparse ball trees (operator 11).

A document is a sparse vector of integer term contributions, an item a sparse vector of integer term
weights, and a score is their inner product.  Documents are read once: every term that an item holds is
counted in every whole text and staged with the length of the text, in slices.  Statistics (number of
documents, of terms, document frequencies) are sums over the staged slices.  A task then gathers slices
into balls of up to ``LEAVES`` leaves, splits them along two far-apart documents until a leaf has at most
``LEAF`` documents, and gives every node a centroid and a radius.  An item walks each tree best-first:
no document below a node scores more than item . centroid + |item| radius, where both centroid and radius
are rounded so that the bound holds for the exact integers.  Subtrees whose bound stays below the worst
score in the item's list are left out; leaves are scored exactly with 64-bit integers.

A task hands on at most ``top`` documents an item.  They are ranked within parts first and then over all,
so that no task gets more rows of an item than its part or the parts' lists.

Items are dealt to blocks of bounded size; each block's terms go to all tasks and each block reads the
documents once.

Defined results: null and empty texts, and texts without a term, count for no statistic and are never
returned; equal (item_id, text) rows are one item; items of one id and different texts are ranked each by
itself, and so is a null id; rows that repeat a document are documents of their own; a null ``doc_id`` sorts
last among equal scores; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ontime.llm.text import LOWER, flat, gather, prefix_sums, slices, span_hash, sums_by, words
from ontime.session import shared_dir

#: Bytes between terms: ASCII other than digits and letters.
SEPARATOR = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
TOP = 20
LEAF, LEAVES = 64, 128
#: Terms with a document that a tree gathers at most (unless one slice alone has more).
TREE_TERMS = 1_000_000
#: Bytes of text and number of items in a block.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 22, 4096
_PARTS = 64
#: Relative rounding of a bound; sums of n terms in doubles are off by less than n 2^-52 of their sum.
_SAFE = 1e-9


class Vocabulary:
    """Finds the terms of a block among the words of texts, by hash and then by their bytes."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(t) for t in raw], dtype=np.int64)
        starts = ends - [len(t) for t in raw]
        h = span_hash(prefix_sums(self.data), starts, ends) if raw else np.zeros(0, np.uint64)
        self.order = np.argsort(h, kind="stable")
        self.hash, self.starts, self.size = h[self.order], starts[self.order], (ends - starts)[self.order]
        self.tries = max(np.unique(h, return_counts=True)[1], default=0)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The index of each word's term, or -1."""
        found = np.full(len(starts), -1, np.int64)
        if not len(starts) or not len(self.hash):
            return found
        h = span_hash(prefix_sums(data), starts, ends)
        at = np.searchsorted(self.hash, h)
        for step in range(self.tries):
            place = np.minimum(at + step, len(self.hash) - 1)
            some = np.flatnonzero((self.hash[place] == h) & (self.size[place] == ends - starts) & (found < 0))
            size, place = self.size[place[some]], place[some]
            equal = data[gather(starts[some], size)] == self.data[gather(self.starts[place], size)]
            same = np.logical_and.reduceat(equal, np.cumsum(size) - size) if len(some) else np.zeros(0, bool)
            found[some[same]] = self.order[place[same]]
        return found


def terms(text: str | None) -> list[str]:
    """The terms of one text; for the few items, the documents go through ``staged``."""
    data, off = flat(pa.array([text], pa.string()))
    data = LOWER[data]
    starts, ends, _ = words(data, off, SEPARATOR)
    return [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]


def staged(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A row for each slice of documents: ids, lengths, and per document its terms of the vocabulary with counts."""
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("length", pa.binary()), ("count", pa.binary()),
                        ("term", pa.binary()), ("times", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, off = flat(part.column("text"))
            data = LOWER[data]
            starts, ends, at = words(data, off, SEPARATOR)
            term = vocabulary.find(data, starts, ends)
            length = np.diff(at)
            doc = np.repeat(np.arange(len(length)), length)[term >= 0]
            width = max(len(vocabulary.hash), 1)
            key, times = np.unique(doc * width + term[term >= 0], return_counts=True)
            some = np.flatnonzero(length)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.column("doc_id").take(pa.array(some)).to_pylist()], schema[0].type),
                 *(pa.array([a.tobytes()], pa.binary()) for a in
                   (length[some].astype(np.int64), np.bincount(key // width, minlength=len(length))[some].astype(np.int64),
                    (key % width).astype(np.int32), times.astype(np.int64)))], schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(task, "ids array<bigint>, length binary, count binary, term binary, times binary"))


def _slice(batch: pa.RecordBatch, i: int, *names: str) -> list[np.ndarray]:
    return [np.frombuffer(batch.column(n)[i].as_py(), np.int32 if n == "term" else np.int64) for n in names]


def statistics(slices_: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms, document frequency of each term of the vocabulary)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms + 2, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                length, term = _slice(batch, i, "length", "term")
                total[:-2] += np.bincount(term, minlength=n_terms)
                total[-2:] += len(length), length.sum()
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k])], names=["k", "n"])

    total = np.zeros(n_terms + 2, np.int64)
    for r in slices_.select("length", "term").mapInArrow(task, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        total[r["k"]] = r["n"]
    return int(total[-2]), int(total[-1]), total[:-2]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def contributions(times: np.ndarray, length: np.ndarray, count: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term with this count adds to the score of its document, for each unit of weight."""
    m = np.array([75 + 25 * n * n_docs // n_terms for n in length.tolist()], np.int64)
    return 1_000_000_000 * times // (1000 * times + 12 * np.repeat(m, count))


class Tree:
    """A ball tree over sparse documents (``off``: offsets of their terms)."""

    def __init__(self, off: np.ndarray, term: np.ndarray, value: np.ndarray, width: int):
        self.off, self.term, self.value = off, term, value
        self.nodes: list[tuple] = []  # (centroid terms, centroid values, radius, children or None, documents)
        self._dense = np.zeros(width)
        self._grow(np.arange(len(off) - 1))
        del self._dense

    def _entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, terms, values) of some documents."""
        size = self.off[docs + 1] - self.off[docs]
        at = gather(self.off[docs], size)
        return np.concatenate([[0], np.cumsum(size)]), self.term[at], self.value[at].astype(np.float64)

    def _distances(self, of: tuple, squares: np.ndarray, terms_: np.ndarray, values: np.ndarray) -> np.ndarray:
        """At least the squared distances of documents to a point, rounded up."""
        self._dense[terms_] = values
        product = sums_by(self._dense[of[1]] * of[2], of[0])
        self._dense[terms_] = 0
        own = float(values @ values)
        return np.maximum(squares - 2 * product + own, 0) + _SAFE * (squares + own)

    def _grow(self, docs: np.ndarray) -> None:
        pending = [(docs, -1)]
        while pending:
            docs, parent = pending.pop()
            number = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][3].append(number)
            of = self._entries(docs)
            squares = sums_by(of[2] * of[2], of[0])
            mean = np.bincount(of[1], of[2], len(self._dense)) / max(len(docs), 1)
            held = np.flatnonzero(mean)
            distance = self._distances(of, squares, held, mean[held])
            radius = math.sqrt(float(distance.max(initial=0))) * (1 + _SAFE)
            self.nodes.append((held, mean[held], radius, [], docs))
            if len(docs) <= LEAF:
                continue
            # split by the nearer of two far-apart documents, half and half
            one = int(distance.argmax())
            a = slice(of[0][one], of[0][one + 1])
            from_one = self._distances(of, squares, of[1][a], of[2][a])
            two = int(from_one.argmax())
            b = slice(of[0][two], of[0][two + 1])
            side = np.argsort(from_one - self._distances(of, squares, of[1][b], of[2][b]), kind="stable")
            half = len(docs) // 2
            pending += [(docs[side[:half]], number), (docs[side[half:]], number)]

    def search(self, dense: np.ndarray, norm: float, ids: np.ndarray, best: list[tuple[int, int]], top: int) -> None:
        """Put the documents that belong there into ``best``, a heap of (score, -id).  ``dense``: integer
        weight of every term, ``norm``: at least the item's length."""
        def bound(number: int) -> float:
            held, mean, radius, _, _ = self.nodes[number]
            return (float(dense[held] @ mean) + norm * radius) * (1 + _SAFE)

        frontier = [(-bound(0), 0)]
        while frontier:
            most, number = heapq.heappop(frontier)
            if len(best) == top and -most < best[0][0]:
                return
            _, _, _, children, docs = self.nodes[number]
            if children:
                for child in children:
                    limit = bound(child)
                    if len(best) < top or limit >= best[0][0]:
                        heapq.heappush(frontier, (-limit, child))
                continue
            size = self.off[docs + 1] - self.off[docs]
            at = gather(self.off[docs], size)
            running = np.concatenate([[0], np.cumsum(dense[self.term[at]] * self.value[at])])
            ends = np.cumsum(size)
            score = running[ends] - running[ends - size]
            for i in np.flatnonzero(score >= (best[0][0] if len(best) == top else 1)).tolist():
                found = (int(score[i]), -int(ids[docs[i]]))
                if len(best) < top:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)


_NO_ID = (1 << 63) - 1


def _candidates(slices_: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray, n_docs: int, n_terms: int,
                top: int) -> DataFrame:
    """item (its number), doc_id, score: each task's best documents of each item."""
    weight = weights(n_docs, df)
    queries = [(own, times * weight[own]) for own, times in items]
    norms = [math.sqrt(sum(w * w for w in own.tolist())) * (1 + _SAFE) for _, own in queries]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        held: list[tuple] = []
        dense = np.zeros(len(weight), np.int64)

        def walk() -> None:
            ids, count, term, value = (np.concatenate(c) for c in zip(*held))
            held.clear()
            tree = Tree(np.concatenate([[0], np.cumsum(count)]), term, value, len(weight))
            for (own, w), norm, found in zip(queries, norms, best):
                dense[own] = w
                tree.search(dense, norm, ids, found, top)
                dense[own] = 0

        size = docs = 0
        for batch in batches:
            for i in range(batch.num_rows):
                length, count, term, times = _slice(batch, i, "length", "count", "term", "times")
                ids = np.array([_NO_ID if d is None else d for d in batch.column("ids")[i].as_py()], np.int64)
                value = contributions(times, length, count, n_docs, n_terms)
                if held and (size + len(term) > TREE_TERMS or docs + len(ids) > LEAF * LEAVES):
                    walk()
                    size = docs = 0
                held.append((ids, count, term, value))
                size, docs = size + len(term), docs + len(ids)
        if held:
            walk()
        rows = [(q, None if -d == _NO_ID else -d, s) for q, found in enumerate(best) for s, d in found]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 3)],
                                         names=["item", "doc_id", "score"])

    return slices_.mapInArrow(task, "item long, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item with their rank, first within parts and then over all."""
    order = F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    rows = found.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)))
    for keys in (["item", "_part"], ["item"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return rows.drop("_part")


def _block(docs: DataFrame, items: list[tuple[int | None, str]], top: int) -> DataFrame:
    spark = docs.sparkSession
    counted = [Counter(terms(text)) for _, text in items]
    vocabulary = sorted(set().union(*counted))
    index = {t: i for i, t in enumerate(vocabulary)}
    held = [(np.array([index[t] for t in own], np.int64), np.array(list(own.values()), np.int64)) for own in counted]
    folder = shared_dir(spark, "ranking-slices")
    cut = staged(docs, Vocabulary(vocabulary))
    cut.write.parquet(folder)
    slices_ = spark.read.schema(cut.schema).parquet(folder)
    n_docs, n_terms, df = statistics(slices_, len(vocabulary))
    folder = shared_dir(spark, "ranking-found")
    _ranked(_candidates(slices_, held, df, n_docs, n_terms, top), top).write.parquet(folder)
    found = spark.read.schema("item long, doc_id long, score long, rank int").parquet(folder)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item long, item_id long")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of ``docs`` (doc_id, text) for each row of
    ``items`` (item_id, text)."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, math.ceil(size["n"] / BLOCK_ITEMS), math.ceil((size["bytes"] or 0) / BLOCK_BYTES))
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for block in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in asked.where(of == block).collect()]
        found = _block(docs, rows, top)
        out = found if out is None else out.unionByName(found)
    return out
