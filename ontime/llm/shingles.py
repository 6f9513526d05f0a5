"""N-gram Jaccard join with MinHash banding in place of an LSH forest (operator 4).

A text's shingles are its runs of ``GRAM`` words (of a shorter text: all its words, as one); two texts
link when the Jaccard similarity of their shingle sets is at least the threshold.

1. Each text gets a hash of its shingle set and MinHash values in ``TREES`` bands (trees).
   Texts with equal sets are one node from here on, with a number of copies.
2. In each tree, nodes with equal keys are candidates.  A key hashes a fixed number of values: the
   most, up to ``DEEPEST``, with which pairs at the threshold are found with the target recall
   (``prefix_length``).  So this is banding of one depth in place of a forest's descent.
3. A group of nodes with one prefix is compared in one task, or, if large, chunk by chunk in many.
   Groups with the same members in several trees are compared once, and a pair only in the first
   tree in which it meets.  Verification is exact, on the shingle sets of the whole texts: the
   sizes of all intersections come from products of 0/1 matrices of the shared shingles.
4. Of each group come the number of links of each node and a node it is connected with, never the
   pairs; connected components of these are the classes.

Defined results: null texts and texts without a word are a class of their own without links;
repeated rows are copies (each counts as a link of the others); a null doc_id is in the class of its
text, and rows that share a doc_id stay separate rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm import text as tx
from ontime.llm.links import Union, components
from ontime.session import shared_dir

GRAM, THRESHOLD = 5, 0.8
TREES, DEEPEST, RECALL = 20, 8, 0.9999
CHUNK = 256
_CELLS = 1 << 22  # of a 0/1 matrix at a time


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, deepest: int = DEEPEST, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability ``recall``."""
    length = deepest
    while length > 1 and 1 - (1 - threshold ** length) ** trees < recall:
        length -= 1
    return length


def shingles(column: pa.Array, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles, shingle offsets per text), repeats included."""
    data, off = tx.flat(column)
    starts, ends, of = tx.words(data, off)
    hashes = tx.span_hash(tx.prefix_sums(data), starts, ends)
    words = np.diff(of)
    count = np.where(words >= gram, words - gram + 1, np.minimum(words, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    runs = tx.run_hash(hashes, gram)
    out = np.zeros(at[-1], np.uint64)
    long = words >= gram
    if len(runs):
        out[tx.gather(at[:-1][long], count[long])] = runs[tx.gather(of[:-1][long], count[long])]
    for i in np.flatnonzero(~long & (words > 0)).tolist():
        own = hashes[of[i]:of[i + 1]]
        out[at[i]] = tx.mix(tx.run_hash(own, len(own)) + np.uint64(len(own)))[0]
    return out, at


def distinct_by_text(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each text, and their offsets."""
    who = tx.owner(np.diff(off))
    order = np.lexsort((values, who))
    values, who = values[order], who[order]
    new = np.ones(len(values), bool)
    new[1:] = (who[1:] != who[:-1]) | (values[1:] != values[:-1])
    return values[new], np.searchsorted(who[new], np.arange(len(off)))


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _signatures(docs: DataFrame, trees: int, length: int) -> DataFrame:
    """doc_id, th (text hash), set (null without a word), k0 ... : a key for the prefix in each tree."""
    rng = np.random.default_rng(20250101)
    a = rng.integers(1, 1 << 63, trees * length, np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, trees * length, np.uint64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            values, off = distinct_by_text(*shingles(part.column("text")))
            some = np.flatnonzero(np.diff(off))
            start = off[:-1][some]
            keys = np.zeros((trees, part.num_rows), np.uint64)
            sets = np.zeros(part.num_rows, np.uint64)
            if len(some):
                sets[some] = tx.mix(np.add.reduceat(tx.mix(values), start) + np.diff(off)[some].astype(np.uint64))
                for t in range(trees):
                    key = np.full(len(some), t + 1, np.uint64)
                    for k in range(t * length, (t + 1) * length):
                        key = tx.mix(key ^ np.minimum.reduceat(values * a[k] + b[k], start))
                    keys[t, some] = key
            none = np.ones(part.num_rows, bool)
            none[some] = False
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array(_signed(sets), mask=none), *(pa.array(_signed(k)) for k in keys)],
                names=["doc_id", "th", "set", *(f"k{t}" for t in range(trees))])

    columns = ", ".join(f"k{t} long" for t in range(trees))
    return docs.mapInArrow(task, f"doc_id long, th long, set long, {columns}")


def similar_pairs(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs i < j of shingle sets (sorted, distinct) with at least that Jaccard similarity."""
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        ok = common >= threshold * (size.sum() - common) - 1e-9
        return (np.array([0]), np.array([1])) if ok else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    who = tx.owner(size)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    who, column = who[use], number[column[use]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, _CELLS // len(sets))
    for low in range(0, int(shared.sum()), width):
        own = (column >= low) & (column < low + width)
        block = np.zeros((len(sets), min(width, int(shared.sum()) - low)), np.float32)
        block[who[own], column[own] - low] = 1
        common += block @ block.T
    ok = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-3 / max(1, size.max())
    i, j = np.nonzero(np.triu(ok, 1))
    exact = common[i, j].astype(np.float64)
    keep = exact >= threshold * (size[i] + size[j] - exact) - 1e-9
    return i[keep], j[keep]


def _compared(units: DataFrame, trees: int, threshold: float) -> DataFrame:
    """set, links, root: for each node with a link in a unit (tree, key, one, two)."""
    def close(unit: list[tuple]) -> list[tuple[int, int, int]]:
        (tree, _, one, two), seen, rows = unit[0][0], set(), []
        for row in unit:  # a node whose text is in repeated rows comes more than once
            if row[1] not in seen:
                seen.add(row[1])
                rows.append(row)
        if len(rows) < 2:
            return []
        i, j = similar_pairs([r[4] for r in rows], threshold)
        keys = np.array([r[5] for r in rows])
        keep = (keys[i] == keys[j]).argmax(axis=1) == tree
        if one != two:
            chunk = np.array([r[2] for r in rows])
            keep &= chunk[i] != chunk[j]
        i, j = i[keep], j[keep]
        copies = np.array([r[3] for r in rows])
        links = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
        union = Union(len(rows))
        union.link(i, j)
        return [(rows[k][1], int(links[k]), rows[union.label[k]][1]) for k in np.flatnonzero(links).tolist()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[tuple] = []
        for part in tx.slices(batches, "text"):
            values, off = distinct_by_text(*shingles(part.column("text")))
            head = zip(*(part.column(c).to_pylist() for c in ("tree", "key", "one", "two")))
            keys = np.stack([part.column(f"k{t}").to_numpy() for t in range(trees)], axis=1)
            out = []
            for i, (at, node, chunk, copies) in enumerate(zip(head, *(part.column(c).to_pylist() for c in ("set", "chunk", "copies")))):
                if unit and unit[0][0] != at:
                    out += close(unit)
                    unit = []
                unit.append((at, node, chunk, copies, values[off[i]:off[i + 1]], keys[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["set", "links", "root"])
        if unit and (out := close(unit)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["set", "links", "root"])

    where = ("tree", "key", "one", "two")
    return (units.repartition(*where).sortWithinPartitions(*where).mapInArrow(task, "set long, links long, root long"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL,
                    chunk: int = CHUNK) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), n_links (documents linked directly), kept
    (doc_id = class_id) for each row of ``docs`` (doc_id, text)."""
    return _classes(docs, threshold, trees, recall, chunk).select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce(F.col("doc_id") == F.coalesce("class_id", "doc_id"), F.lit(True)).alias("kept"))


def _classes(docs: DataFrame, threshold: float, trees: int, recall: float, chunk: int) -> DataFrame:
    """doc_id, th, set, class_id, n_links; the last two are null without a word."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")

    def staged(frame: DataFrame, name: str) -> DataFrame:
        folder = shared_dir(spark, f"shingles-{name}")
        frame.write.parquet(folder)
        return spark.read.parquet(folder)

    signed = staged(_signatures(rows, trees, prefix_length(threshold, trees, DEEPEST, recall)), "signatures")
    keys = [f"k{t}" for t in range(trees)]
    # values of equal sets are equal: the least stands for any
    nodes = staged(signed.where("set IS NOT NULL").groupBy("set").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.min_by("th", F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("th"),
        *(F.min(k).alias(k) for k in keys)), "nodes")
    members = nodes.select("set", F.posexplode(F.array(*keys)).alias("tree", "key"))
    groups = members.groupBy("tree", "key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("set")).alias("who")).where("n > 1")
    groups = groups.groupBy("n", "who").agg(F.min(F.struct("tree", "key")).alias("at")).select("n", "at.tree", "at.key")
    chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("chunks")).cast("int")
    met = staged(members.join(groups, ["tree", "key"]).withColumn("chunks", chunks).withColumn("chunk", own)
                 .drop("n"), "groups")
    wanted = nodes.join(met.select("set").distinct(), "set").withColumnRenamed("doc_id", "rep").withColumnRenamed("th", "rep_th")
    texts = staged(rows.join(wanted.hint("shuffle_hash"), rows.doc_id.eqNullSafe(wanted.rep) & (rows.th == wanted.rep_th))
                   .select("set", "copies", "text", *keys), "texts")
    units = (met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("tree", "key", "set", "chunk", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two")))
    found = staged(_compared(units.join(texts, "set"), trees, threshold), "links")
    links = found.groupBy("set").agg(F.sum("links").alias("links"))
    connected = components(found.select(F.col("set").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "set")
    classed = (nodes.select("set", "copies", "doc_id").join(links, "set", "left").join(connected, "set", "left")
               .withColumn("component", F.coalesce("component", "set")))
    least = staged(classed.groupBy("component").agg(F.min("doc_id").alias("class_id")), "least")
    classed = staged(classed.join(least, "component").select(
        "set", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes")
    return signed.select("doc_id", "th", "set").join(classed, "set", "left")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the rows whose class has a lesser doc_id; of repeated rows
    that are the least of their class one stays.  Texts without a word all stay, and so do rows with
    a null doc_id of which no copy has an id."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "shingles-kept")
    (_classes(docs, threshold, TREES, RECALL, CHUNK).where("class_id IS NULL OR doc_id = class_id")
     .groupBy("doc_id", "th").agg(F.when(F.max("set").isNull(), 1).otherwise(F.count("*")).alias("rows"))
     .select(F.col("doc_id").alias("__llm_id"), F.col("th").alias("__llm_th"), F.col("rows").alias("__llm_rows"))
     .write.parquet(folder))
    kept = spark.read.parquet(folder)
    rows = docs.withColumn("__llm_key", F.xxhash64("text"))
    out = rows.join(kept.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_id"))
                    & (F.col("__llm_key") == F.col("__llm_th")))
    if not kept.where("__llm_rows > 1").isEmpty():
        again = out.where("__llm_rows > 1 AND doc_id IS NOT NULL").dropDuplicates(["doc_id", "__llm_key"])
        out = out.where("__llm_rows = 1 OR doc_id IS NULL").unionByName(again)
    return out.drop("__llm_key", "__llm_id", "__llm_th", "__llm_rows")
