"""Benchmark decontamination by spaced-seed hashing (operator 5).

A token is a word, A-Z lower-cased and without a final ``.,!?;:``.  Each of the fixed ``MASKS`` is laid
over every position of every text; the hash of the tokens at its marked places ignores the others,
so a substituted token spoils few seeds.  Whichever ``AGREE`` of the places of a window are equal, a
mask lies on equal places alone (tested over all patterns), so no overlap is missed.  The seeds of the test items are joined with those of the
documents; every hit gives a diagonal (item start within the document), along which the aligned
tokens are compared.  A document overlaps an item when some ``WINDOW`` consecutive aligned places (all
places of a shorter item) hold at least ``AGREE`` of equal tokens.

The test items are dealt to shards of about ``SHARD`` tokens, of which each is broadcast in turn; the
documents are one pass a shard, without a shuffle, so no group can be hot.  What a shard finds is
written before the next one is collected, so the driver holds one at a time.

Defined results: an item of fewer than ``LEAST`` tokens overlaps the documents whose tokens are the same and
no more (inside longer texts so few words prove nothing), items without a token none; null or empty texts overlap nothing; a document that
overlaps several items gives a row for each, at its best place; repeated documents give repeated rows, repeated
items one; with an empty benchmark nothing overlaps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm import text as tx
from ontime.session import shared_dir

#: 1 marks the places of a seed that count.
MASKS = ("1111", "10111", "11011", "11101", "110101", "110011")
WINDOW, AGREE, LEAST, SHARD = 20, 0.7, 5, 400_000
#: The most seed hits that are verified at once (a common phrase has many).
BLOCK = 50_000
_FINAL = np.zeros(256, bool)
_FINAL[[ord(c) for c in ".,!?;:"]] = True


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, token offsets per text)."""
    data, off = tx.flat(column)
    data = tx.LOWER[data]
    starts, ends, of = tx.words(data, off)
    if len(ends):
        ends = np.maximum(ends - _FINAL[data[ends - 1]], starts + 1)
    return tx.span_hash(tx.prefix_sums(data), starts, ends), of


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each position at which the mask fits into ``hashes``."""
    places = [i for i, c in enumerate(mask) if c == "1"]
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask) + 1, np.uint64)
    for i in places:
        out = (out ^ hashes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return tx.mix(out)


class Items:
    """Test items and their seeds, sorted by mask and hash."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        self.hashes, self.of = tokens(pa.array(texts, pa.string()))
        size = np.diff(self.of)
        self.masks = {m: size >= max(LEAST, len(m)) for m in MASKS}
        self.short = {tuple(self.hashes[self.of[i]:self.of[i + 1]].tolist()): i for i in np.flatnonzero((size > 0) & (size < LEAST)).tolist()[::-1]}
        self.seeds = {}
        for mask, fits in self.masks.items():
            found, item, place = [], [], []
            for i in np.flatnonzero(fits).tolist():
                s = seeds(self.hashes[self.of[i]:self.of[i + 1]], mask)
                found.append(s)
                item.append(np.full(len(s), i))
                place.append(np.arange(len(s)))
            if found:
                found, item, place = map(np.concatenate, (found, item, place))
                order = np.argsort(found, kind="stable")
                maybe = np.zeros(1 << 22, bool)  # by the first 22 bits: most positions stop here
                maybe[found >> np.uint64(42)] = True
                self.seeds[mask] = found[order], item[order], place[order], maybe

    def hits(self, hashes: np.ndarray, of: np.ndarray) -> Iterator[np.ndarray]:
        """Blocks of distinct (document, item, diagonal as a position in ``hashes``) of the seed hits."""
        for mask, (found, item, place, maybe) in self.seeds.items():
            s = seeds(hashes, mask)
            at = np.flatnonzero(maybe[s >> np.uint64(42)])
            low, high = np.searchsorted(found, s[at], "left"), np.searchsorted(found, s[at], "right")
            some = high > low
            at, low, high = at[some], low[some], high[some]
            doc_at = np.searchsorted(of, at, "right") - 1
            inside = at + len(mask) <= of[doc_at + 1]
            at, low, high, doc_at = at[inside], low[inside], high[inside], doc_at[inside]
            total = np.concatenate([[0], np.cumsum(high - low)])
            for first in range(0, int(total[-1]), BLOCK):
                pick = np.arange(first, min(first + BLOCK, int(total[-1])))
                again = np.searchsorted(total, pick, "right") - 1
                pick += low[again] - total[again]
                yield np.unique(np.stack([doc_at[again], item[pick], at[again] - place[pick]], axis=1), axis=0)

    def overlaps(self, hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Verified (document, item, first aligned position in the document, aligned places, equal
        tokens), the best of each document and item."""
        rows = self.whole(hashes, of)
        for hit in self.hits(hashes, of):
            rows = self.best(np.concatenate([rows, self.verified(hashes, of, hit)]))
        return rows

    def whole(self, hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The rows of ``overlaps`` of documents that are a short item."""
        size = np.diff(of)
        out = []
        for d in np.flatnonzero((size > 0) & (size < LEAST)).tolist() if self.short else []:
            i = self.short.get(tuple(hashes[of[d]:of[d + 1]].tolist()))
            if i is not None:
                out.append((d, i, 0, int(size[d]), int(size[d])))
        return np.array(out, np.int64).reshape(-1, 5)

    def verified(self, hashes: np.ndarray, of: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """The rows of ``overlaps`` of all diagonals of ``hit`` that overlap."""
        doc, item, diagonal = hit.T
        first = np.maximum(diagonal, of[doc])
        end = np.minimum(diagonal + self.of[item + 1] - self.of[item], of[doc + 1])
        size = end - first
        mine = tx.gather(first, size)
        theirs = tx.gather(self.of[item] + first - diagonal, size)
        equal = hashes[mine] == self.hashes[theirs]
        total = np.concatenate([[0], np.cumsum(equal)])
        at = np.concatenate([[0], np.cumsum(size)])
        window = np.minimum(WINDOW, np.diff(self.of)[item])
        need = np.ceil(AGREE * window - 1e-9).astype(np.int64)
        # the best window of each diagonal; one cut off by the document's edge counts as it is
        start = tx.gather(at[:-1], size)
        own = tx.owner(size)
        best = np.maximum.reduceat(total[np.minimum(start + window[own], at[own + 1])] - total[start], at[:-1])
        good = np.flatnonzero(best >= need)
        return np.stack([doc, item, first - of[doc], size, total[at[1:]] - total[at[:-1]]], axis=1)[good]

    @staticmethod
    def best(rows: np.ndarray) -> np.ndarray:
        order = np.lexsort((rows[:, 2], -rows[:, 4], rows[:, 1], rows[:, 0]))
        rows = rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        return rows[new]


def _shards(benchmark: DataFrame, shard: int) -> tuple[int, DataFrame]:
    """(number of shards, the distinct items with their shard): about ``shard`` tokens each, however large the
    benchmark is."""
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, math.ceil(total / shard))
    return n, rows.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))


def _items(rows: DataFrame, k: int) -> Items:
    own = rows.where(F.col("shard") == k).orderBy("item_id", "text").collect()
    return Items([r.item_id for r in own], [r.text for r in own])


def _staged(frame: DataFrame) -> DataFrame:
    folder = shared_dir(frame.sparkSession, "decontaminate")
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def overlaps(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD) -> DataFrame:
    """doc_id, item_id, start (word of the document), places, equal: one row per document of ``docs``
    (doc_id, text) and item of ``benchmark`` (item_id, text) that overlap."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("places", pa.int64()),
                        ("equal", pa.int64())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def against(items: Items) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids = np.array(items.ids, object)
            for part in tx.slices(batches, "text"):
                found = items.overlaps(*tokens(part.column("text")))
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(found[:, 0])), pa.array(ids[found[:, 1]].tolist(), pa.int64()),
                         *(pa.array(found[:, k]) for k in (2, 3, 4))], schema=schema)

        return rows.mapInArrow(task, "doc_id long, item_id long, start long, places long, equal long")

    n, items = _shards(benchmark, shard)
    out = None
    for k in range(n):
        part = against(_items(items, k))
        part = part if n == 1 else _staged(part)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap no item."""
    def without(rows: DataFrame, items: Items) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in tx.slices(batches, "text"):
                found = items.overlaps(*tokens(part.column("text")))
                keep = np.ones(part.num_rows, bool)
                keep[found[:, 0]] = False
                yield part.filter(pa.array(keep))

        return rows.mapInArrow(task, rows.schema)

    n, items = _shards(benchmark, shard)
    for k in range(n):
        docs = without(docs, _items(items, k))
        docs = docs if n == 1 else _staged(docs)
    return docs
