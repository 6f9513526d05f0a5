"""Substring dedup with suffix automata of reference shards (operator 10).

A window is ``n`` consecutive words (runs of bytes other than space and 0x09-0x0D) of one text; every
word of a window that also starts anywhere else, the same text included, is removed.  Windows are
judged on the input.

The reference is the corpus itself and has no size bound, so its shards are not broadcast whole but
dealt by content, together with the texts that can match them:

1. Each window has one anchor: the word 8-gram in it with the least hash (the last of equals).  The
   anchor and its place depend on the window's words alone, so equal windows have equal anchors;
   consecutive windows with one anchor form a segment, and the windows within a segment's words are
   exactly those of the segment.
2. Segments whose anchor occurs once hold no repeated window.  Of the others, each different segment
   (by anchor and a hash of its words) is fetched once, with the number of its occurrences.
3. All different segments of an anchor are a reference shard.  The task that gets them builds their
   suffix automaton, with the number of places at which each state's strings end, and streams the
   segments through it: the matching statistic at a word is the longest stretch ending there that
   ends at two places or more.  Where it reaches ``n`` the window ending there is repeated.
4. These windows go back to all occurrences of the segment, and from there to the texts.

An anchor with more than ``SHARD`` occurrences is split: its segments are cut into single windows,
dealt by a hash of their words, so a shard stays small however common its passage is.  Segments of
equal words are counted map-side before they meet.  Joins with hot keys are sort-merge joins, whose
skewed partitions Spark splits.

Defined results: null text stays null and has no words; texts of fewer than ``n`` words lose nothing;
repeated rows are separate texts, and so lose all their windows; kept words are joined by one space;
result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm import text as tx
from ontime.session import shared_dir

WORDS, GRAM, SHARD = 35, 8, 2000


# ---- segments ----------------------------------------------------------------------------------

def segments(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor, hash of the words) of each segment of the texts whose
    word hashes are ``hashes[of[i]:of[i + 1]]``; windows are named by the position of their first word."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    gram = min(GRAM, n)
    if len(hashes) < n:
        return none
    anchors = tx.run_hash(hashes, gram)
    span = n - gram + 1  # 8-grams in a window
    place = np.uint64((1 << 28) - 1) - np.arange(len(anchors), dtype=np.uint64)
    least = (anchors & ~np.uint64((1 << 28) - 1)) | place  # ties: the last place
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    inside = np.ones(len(hashes), bool)  # windows that lie within one text
    ends = of[1:]
    inside[tx.gather(np.maximum(of[:-1], ends - (n - 1)), np.minimum(ends - of[:-1], n - 1))] = False
    at = np.flatnonzero(inside[:len(least)])
    if not len(at):
        return none
    anchor = (np.uint64((1 << 28) - 1) - (least[at] & np.uint64((1 << 28) - 1))).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * tx._table("up", tx._P, len(hashes))[:len(hashes)], out=sums[1:])
    return start, count, anchors[anchor[first]], tx.span_hash(sums, start, start + count + n - 1)


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, off = tx.flat(column)
    starts, ends, of = tx.words(data, off)
    return tx.span_hash(tx.prefix_sums(data), starts, ends), of


def _occurrences(docs: DataFrame, n: int) -> DataFrame:
    """anchor, segment, key, start (word), windows: all segments of ``docs`` (key, text)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            hashes, of = _word_hashes(part.column("text"))
            start, count, anchor, segment = segments(hashes, of, n)
            text = np.searchsorted(of, start, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(segment.view(np.int64)), part.column("key").take(pa.array(text)),
                 pa.array((start - of[text]).astype(np.int32)), pa.array(count.astype(np.int32))],
                names=["anchor", "segment", "key", "start", "windows"])

    return docs.mapInArrow(task, "anchor long, segment long, key long, start int, windows int")


# ---- the automaton -----------------------------------------------------------------------------

class Automaton:
    """Suffix automaton of several word sequences, each with a number of occurrences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.ends = [-1], [0], [0]

    def _state(self, length: int, next_: dict, link: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of ``q`` for the strings that reach it from ``p``, if those are shorter than its longest."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: list[int], times: int) -> None:
        last = 0
        for word in words:
            p, q = last, self.next[last].get(word)
            if q is not None:
                last = self._split(p, word, q)
            else:
                last = self._state(self.length[p] + 1, {}, 0)
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = last
                    p = self.link[p]
                if p >= 0:
                    self.link[last] = self._split(p, word, self.next[p][word])
            self.ends[last] += times

    def count(self) -> None:
        """Make ``ends`` the number of places at which a state's strings end."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[s]] += self.ends[s]

    def repeated(self, words: list[int]) -> Iterator[int]:
        """Matching statistics: for each word, the longest stretch ending there that ends at two places."""
        state, size = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            at, found = state, size
            while at > 0 and self.ends[at] < 2:
                at = self.link[at]
                found = self.length[at]
            yield found


def repeated_windows(shard: list[tuple[list[int], int]], n: int) -> list[int]:
    """For each (words, occurrences) of a shard, the bits of its windows that occur twice or more."""
    automaton = Automaton()
    for words, times in shard:
        automaton.add(words, times)
    automaton.count()
    out = []
    for words, _ in shard:
        bits = 0
        for i, found in enumerate(automaton.repeated(words)):
            if found >= n:
                bits |= 1 << (i - n + 1)
        out.append(bits)
    return out


# ---- the Spark job -----------------------------------------------------------------------------

def _fetched(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The words of the wanted segments: anchor, part, segment, times, shift, words (hashes)."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "segment", "start", "windows", "times", "parts")).alias("wanted"))
    schema = pa.schema([("anchor", pa.int64()), ("part", pa.int64()), ("segment", pa.int64()), ("times", pa.int64()),
                        ("shift", pa.int32()), ("words", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            hashes, of = _word_hashes(part.column("text"))
            out = []
            for i, wants in enumerate(part.column("wanted").to_pylist()):
                for w in wants:
                    at = int(of[i]) + w["start"]
                    words = hashes[at:at + w["windows"] + n - 1]
                    if w["parts"] == 1:
                        out.append((w["anchor"], 0, w["segment"], w["times"], 0, words.tobytes()))
                        continue
                    for j, h in enumerate((tx.run_hash(words, n) % np.uint64(w["parts"])).tolist()):
                        out.append((w["anchor"], h, w["segment"], w["times"], j, words[j:j + n].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return docs.join(lists.hint("shuffle_hash"), "key").select("text", "wanted").mapInArrow(
        task, "anchor long, part long, segment long, times long, shift int, words binary")


def _judged(fetched: DataFrame, n: int) -> DataFrame:
    """anchor, segment, bits of the repeated windows; segments without one are left out."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard, names = None, [], []

        def close() -> list[tuple[int, int, int]]:
            return [(now[0], name, bits << shift) for (name, shift), bits in zip(names, repeated_windows(shard, n)) if bits]

        for batch in batches:
            out = []
            for anchor, part, segment, times, shift, words in zip(*(batch.column(k).to_pylist() for k in (
                    "anchor", "part", "segment", "times", "shift", "words"))):
                if now != (anchor, part):
                    if shard:
                        out += close()
                    now, shard, names = (anchor, part), [], []
                shard.append((np.frombuffer(words, np.int64).tolist(), times))
                names.append((segment, shift))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["anchor", "segment", "bits"])
        if shard and (out := close()):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["anchor", "segment", "bits"])

    return (fetched.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "segment", "shift")
            .mapInArrow(task, "anchor long, segment long, bits long")
            .groupBy("anchor", "segment").agg(F.bit_or("bits").alias("bits")))


def remove_repeated(docs: DataFrame, n: int = WORDS, shard: int = SHARD) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the kept words as ``text``, and n_words, n_removed."""
    if not GRAM <= n <= 62 + GRAM:
        raise ValueError(f"windows of {GRAM} to {62 + GRAM} words")
    spark = docs.sparkSession
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    folder = shared_dir(spark, "segments")
    _occurrences(keyed, n).write.parquet(folder)
    found = spark.read.parquet(folder)
    # staged, so that the join reads both sides from plain exchanges and Spark can split a hot anchor
    often_at = shared_dir(spark, "anchors")
    found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").write.parquet(often_at)
    often = spark.read.parquet(often_at)
    hits_at = shared_dir(spark, "segments-repeated")
    found.join(often, "anchor").write.parquet(hits_at)
    hits = spark.read.parquet(hits_at)
    parts = F.floor(F.max("n") / F.lit(shard)) + 1
    wanted = (hits.groupBy("anchor", "segment")
              .agg(F.count("*").alias("times"), parts.cast("long").alias("parts"), F.min(F.struct("key", "start", "windows")).alias("at"))
              .select("anchor", "segment", "times", "parts", "at.key", "at.start", "at.windows"))
    judged_at = shared_dir(spark, "segments-judged")
    _judged(_fetched(keyed, wanted, n), n).write.parquet(judged_at)
    judged = spark.read.parquet(judged_at)
    spans = (hits.join(judged, ["anchor", "segment"]).groupBy("key")
             .agg(F.collect_set(F.struct("start", "bits")).alias("spans")))
    return _without(docs, spans, n)


def _without(docs: DataFrame, spans: DataFrame, n: int) -> DataFrame:
    """``docs`` without the words of the windows in ``spans`` (key, spans)."""
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    fields = [docs.schema[c] for c in names]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "__llm_text"):
            texts, sizes, gone = [], [], []
            for text, found in zip(part.column("__llm_text").to_pylist(), part.column("__llm_spans").to_pylist()):
                words = (text or "").encode().split()
                keep = np.ones(len(words), bool)
                for span in found or ():
                    bits, at = span["bits"], span["start"]
                    while bits:
                        j = (bits & -bits).bit_length() - 1
                        keep[at + j:at + j + n] = False
                        bits &= bits - 1
                kept = words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()]
                texts.append(None if text is None else b" ".join(kept).decode())
                sizes.append(len(words))
                gone.append(len(words) - len(kept))
            columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[*names, "n_words", "n_removed"])

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*fields, StructField("n_words", LongType()), StructField("n_removed", LongType())])
    rows = docs.select(*names, F.col("text").alias("__llm_text"), F.xxhash64("doc_id", "text").alias("__llm_key"))
    spans = spans.select(F.col("key").alias("__llm_key"), F.col("spans").alias("__llm_spans"))
    return rows.join(spans.hint("shuffle_hash"), "__llm_key", "left").mapInArrow(task, schema)
