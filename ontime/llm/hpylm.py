"""Language-model scoring with a hierarchical Pitman-Yor model (operator 3).

Tokens are the words of a text, A-Z lower-cased, and one end token.  Every word is a context and a
dish: a restaurant for each context (the word before, or the start of a text), whose parent, shared
by all contexts, is the unigram restaurant.  Its base is uniform over the known words with a share
for unseen words, which count as one.

Seating is sampled by sweeps.  A sweep takes the customers of every dish out of every context's
restaurant and seats them again one after the other by the Chinese restaurant process, given the
parent's predictive probabilities and the tables of the context; this is done for ``CHAINS`` seatings
and their mean number of tables is what the next sweep is given.  Tables are the parent's customers,
which are seated again before each sweep.  The kept sweeps are averaged, and then ``CHAINS`` chains of
the parent, given the mean tables, as Spark tasks.

The pairs (context, word) of the corpus are all counted and kept.  They are dealt to parts of about
``PART`` tokens by a hash, those of a rarer context by the context alone, so that its restaurant is in
one part; a part is one packed row, in a folder of its own, that tasks read by its number.  What is
broadcast is bounded: hashes, counts and tables of at most ``FREQUENT`` words, and the probability of
a word by its tables (distinct numbers that sum to N are fewer than the square root of 2N).  What
rarer words have as dishes is gathered by a grouped sum and looked up by a shuffle join.  They sit at
a table for each context while the sweeps run; then the tables that were opened are added.

Texts are scored part by part too: their tokens meet the pairs of the part, and the sums for each
text are packed by groups of texts.

Defined results: null text is empty and has the end token alone; an empty training set gives
N = V = 0, base 1 / 1 a token, and the score of a uniform base over end and unseen words; repeated
rows are scored each for itself; rows with a null id are neither held out nor lost; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ontime.llm import text as tx
from ontime.session import shared_dir
from ontime.sources.catalog import remove
from ontime.sources.zipcsv import filesystem

FREQUENT = 1 << 18
#: Gibbs: seatings of each restaurant, sweeps before and while averaging.
CHAINS, BURN_IN, KEPT = 6, 6, 6
#: Strengths of the context restaurants and of the unigram restaurant.
STRENGTH = (1.0, 1.0)
END = np.uint64(0x2545F4914F6CDD1D)  # in place of a word's hash
#: Tokens of a part, bytes of text whose tokens are dealt at once, texts (as a power of two) whose sums are packed together.
PART, SLICE, GROUP = 1 << 20, 2 << 20, 12
_EXACT = 64  # customers seated one by one before gaps between new tables are drawn
_RARE = np.uint64(1 << 63)  # set in the code of a word that is not frequent; the rest is its hash
_KEY = np.uint64(0x9E3779B97F4A7C15)
_PAIRS = "part int, u binary, w binary, c binary"
_SEATS = "part int, tables binary, contexts binary, words binary, opened binary"
_BLOCKS = "part int, texts long, kind int, a binary, b binary, c binary, d binary, e binary, f binary"
#: Kinds of ``_BLOCKS``: tokens of a part; rarer words; texts; rarer words of a part with their counts; sums.
_TOKENS, _RARER, _TEXTS, _LOOKED_UP, _SUMS = range(5)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, token offsets per text); each text ends with ``END``."""
    data, off = tx.flat(column)
    data = tx.LOWER[data]
    starts, ends, of = tx.words(data, off)
    n = np.diff(of)
    out = np.full(len(starts) + len(n), END, np.uint64)
    out[np.arange(len(starts)) + tx.owner(n)] = tx.span_hash(tx.prefix_sums(data), starts, ends)
    return out, of + np.arange(len(of))


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Position of each key in ``sorted_keys``; -1 where it is not."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


class Places:
    """Positions of hashes in a sorted array, found from their first bits."""

    def __init__(self, sorted_keys: np.ndarray, bits: int = 20):
        self.shift = np.uint64(64 - bits)
        self.keys = np.append(sorted_keys, np.uint64(2 ** 64 - 1))
        self.start = np.searchsorted(sorted_keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Of each key; -1 where it is not."""
        at = self.start[keys >> self.shift]
        before = np.flatnonzero(self.keys[at] < keys)
        while len(before):
            at[before] += 1
            before = before[self.keys[at[before]] < keys[before]]
        return np.where((self.keys[at] == keys) & (at < len(self.keys) - 1), at, -1)


def coded(frequent: Places, rank: np.ndarray, hashes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, context's code) of each token: the rank of a frequent word, or the hash marked ``_RARE``; the
    number behind all ranks is the end as a word, the start as a context."""
    at = frequent.find(hashes)
    code = hashes | _RARE
    code[at >= 0] = rank[at[at >= 0]]
    code[hashes == END] = len(rank)
    context = np.empty_like(code)
    context[1:] = code[:-1]
    context[off[:-1]] = len(rank)
    return code, context


def part_of(u: np.ndarray, w: np.ndarray, parts: int) -> np.ndarray:
    """The part of each pair: a rarer context has all its pairs in one, a frequent one in all."""
    return (tx.mix(np.where(u >= _RARE, u, u * _KEY + w)) % np.uint64(parts)).astype(np.int64)


def dealt(u: np.ndarray, w: np.ndarray, part: np.ndarray, frequent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, positions) of the pairs of a part, in the order of pairs: first of two frequent words, then the others."""
    bits = np.uint64(int(frequent).bit_length())
    both = (u < _RARE) & (w < _RARE)
    some, others = np.flatnonzero(both), np.flatnonzero(~both)
    key = (((part[some].astype(np.uint64) << bits) | u[some]) << bits) | w[some]
    for order in (some[np.argsort(key)], others[np.lexsort((w[others], u[others], part[others]))]):
        for k, s in _runs(part[order]):
            yield k, order[s]


def pack(values: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes first, and so on, compressed: sorted and small numbers get small."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes(),
                       codec="zstd", asbytes=True) + len(values).to_bytes(4, "little")


def unpack(data: bytes, kind=np.uint64) -> np.ndarray:
    size, n = np.dtype(kind).itemsize, int.from_bytes(data[-4:], "little")
    flat = pa.decompress(data[:-4], n * size, codec="zstd", asbytes=True)
    return np.frombuffer(flat, np.uint8).reshape(size, n).T.copy().view(kind).reshape(-1)


def _runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    edge = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])[:len(sorted_keys)])
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(sorted_keys)]):
        yield int(sorted_keys[a]), slice(a, b)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _pair_rows(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(rows, [pa.int32()] + [pa.binary()] * 3, ["part", "u", "w", "c"])


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r + (None,) * (9 - len(r)) for r in rows]
    return _batch(rows, [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 6, ["part", "texts", "kind", *"abcdef"])


def _by(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, Iterator[tuple]]]:
    """(value, rows) of each run of rows with one value in ``column``; the rows of a run must be read before the next."""
    from itertools import groupby

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield tuple(batch.column(k)[i].as_py() for k in range(batch.num_columns))

    yield from groupby(rows(), key=lambda r: r[column])


def load(folder: str, part: int, columns: list[str]) -> list[list]:
    """The values of the columns in the part's folder, read by a task; none if the part has no rows."""
    fs, at = filesystem(f"{folder}/part={part}")
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)) if f.path.endswith(".parquet")]
    tables = [pq.read_table(f, columns=columns, filesystem=fs, partitioning=None) for f in sorted(files)]
    return [[x for t in tables for x in t.column(c).to_pylist()] for c in columns]


# ---- seating -----------------------------------------------------------------------------------

def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating ``customers`` of one dish one by one: with n seated at t tables the next
    one opens a table with odds ``fresh`` : n - discount * t.  After ``_EXACT`` customers they come
    in blocks of a sixteenth of those seated, with the odds of the middle of their block."""
    order = np.argsort(-customers, kind="stable")     # then those with more than n customers come first
    fewer, fresh = -customers[order], fresh[order]
    tables = (fewer < 0).astype(np.float64)
    for n in range(1, min(_EXACT, int(customers.max(initial=0)))):
        k = int(np.searchsorted(fewer, -n))
        a, t = fresh[:k], tables[:k]
        odds = t * -discount
        odds += a
        odds += n
        odds *= rng.random(k)
        t += odds < a
    n = _EXACT
    while k := int(np.searchsorted(fewer, -n)):
        step = np.minimum(n // 16, -fewer[:k] - n)
        a, t = fresh[:k], tables[:k]
        t += rng.binomial(step, np.clip(a / (a + n + step / 2 - discount * t), 0, 1))
        n += n // 16
    out = np.empty(len(tables), np.int64)
    out[order] = tables
    return out


def seat_words(count: np.ndarray, words: np.ndarray, fresh: float, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Mean tables of the ``words[i]`` words with ``count[i]`` customers each, every one seated as by ``seat``.
    Of words with few customers it is drawn how many open a table with their next customer, given how
    many words have how many tables."""
    mean = np.ones(len(count))
    for i in np.flatnonzero((count > 1) & (count <= _EXACT)).tolist():
        of = np.zeros(int(count[i]) + 1, np.int64)      # words by tables
        of[1] = words[i]
        for n in range(1, int(count[i])):
            t = np.arange(1, n + 1)
            up = rng.binomial(of[1:n + 1], fresh / (fresh + n - discount * t))
            of[1:n + 1] -= up
            of[2:n + 2] += up
        mean[i] = (of * np.arange(len(of))).sum() / words[i]
    many = np.flatnonzero(count > _EXACT)
    own = tx.owner(words[many])
    tables = seat(count[many][own], np.full(len(own), fresh), discount, rng)
    mean[many] = np.bincount(own, tables, len(many)) / words[many]
    return mean


def discount_of(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.05, 0.95))


def chain(counts: np.ndarray, seed: int) -> np.ndarray:
    """Mean predictive probabilities of each dish in each context; ``counts`` is contexts x dishes, all of them
    known.  The same sampler in one small table, which the distributed one is tested against."""
    rng = np.random.default_rng(seed)
    context, dish = np.nonzero(counts)
    c = counts[context, dish]
    d = discount_of((c == 1).sum(), (c == 2).sum())
    d0, (theta, theta0) = 0.5, STRENGTH
    m = counts.shape[1]
    total = counts.sum(axis=1).astype(np.float64)
    t = np.ones(len(c), np.int64)
    k = np.ones(m, np.int64)
    mean = np.zeros(counts.shape)
    for sweep in range(BURN_IN + KEPT):
        below = np.bincount(dish, t, m).astype(np.int64)  # the parent's customers
        k = seat(below, (theta0 + d0 * k.sum()) / m * np.ones(m), d0, rng)
        root = (np.maximum(below - d0 * k, 0) + (theta0 + d0 * k.sum()) / m) / (theta0 + below.sum())
        t_all = np.bincount(context, t, len(total))
        t = seat(c, (theta + d * t_all[context]) * root[dish], d, rng)
        if sweep >= BURN_IN:
            t_all = np.bincount(context, t, len(total))
            mean += ((theta + d * t_all) / (theta + total))[:, None] * root
            mean[context, dish] += (c - d * t) / (theta + total[context])
    return mean / KEPT


def unigram_sweep(count: np.ndarray, words: np.ndarray, t_all: float,
                  rng: np.random.Generator) -> tuple[np.ndarray, float, float]:
    """Seats the parent's customers: (predictive probability of a word with each of ``count``, of all unseen
    words together, tables).  ``words[i]`` words have ``count[i]`` customers; there were ``t_all`` tables."""
    theta = STRENGTH[1]
    few = {n: float(words[count == n].sum()) for n in (1, 2)}
    d = discount_of(few[1], few[2])
    # the base's share for unseen words makes their mass that of the words seen once (Good-Turing)
    share = float(np.clip(few[1] / (theta + d * t_all), 0.05, 0.95))
    base = (1 - share) / float(words.sum())
    tables = seat_words(count, words, (theta + d * t_all) * base, d, rng)
    t_all = float((tables * words).sum())
    n = float((count * words).sum())
    fresh = (theta + d * t_all) / (theta + n)
    return (count - d * tables) / (theta + n) + fresh * base, fresh * share, t_all


def shared_chain(count: np.ndarray, words: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """(mean predictive probability of a word with each of ``count``, of all unseen words together)."""
    if not len(count):
        return np.zeros(0), 1.0
    rng, t_all = np.random.default_rng(seed), float(words.sum())
    mean, unseen = np.zeros(len(count)), 0.0
    for sweep in range(BURN_IN + KEPT):
        p, rest, t_all = unigram_sweep(count, words, t_all, rng)
        if sweep >= BURN_IN:
            mean += p
            unseen += rest
    return mean / KEPT, unseen / KEPT


# ---- the model ---------------------------------------------------------------------------------

@dataclass
class Model:
    train_tokens: int        # N
    distinct: int            # V
    frequent: np.ndarray     # sorted hashes of the frequent words
    rank: np.ndarray         # and their ranks
    frequent_count: np.ndarray   # counts by rank, that of the end behind them
    parts: int
    pairs: str               # folders by part: the pairs and their counts
    seats: str               # tables of the pairs that come more than once, of the rarer contexts
    words: str               # folder of (w, c, t): code, count and tables of every rarer word
    discount: float
    total: np.ndarray        # customers of each frequent context and of the start
    tables: np.ndarray       # and their tables
    root: np.ndarray         # probabilities of the frequent words and the end in the unigram restaurant
    count: np.ndarray        # numbers of tables of a word in all contexts, sorted
    of_count: np.ndarray     # probability of a word with each of them
    unseen: float            # of an unseen word

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1.0) / (self.train_tokens + self.distinct + 1.0))


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _vocabulary(docs: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            h, c = np.unique(tokens(part.column("text"))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(c)], names=["h", "c"])

    return docs.select("text").mapInArrow(task, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _summed(u: np.ndarray, w: np.ndarray, c: np.ndarray, frequent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every pair of a part once, with the sum of its counts."""
    order = np.concatenate([np.zeros(0, np.int64), *(x for _, x in dealt(u, w, np.zeros(len(u), np.int64), frequent))])
    u, w, c = u[order], w[order], c[order]
    first = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (w[1:] != w[:-1]))[:len(u)])
    return u[first], w[first], np.add.reduceat(c, first) if len(first) else c


def _pairs(docs: DataFrame, frequent: np.ndarray, rank: np.ndarray, parts: int) -> DataFrame:
    """part, u, w, c: contexts, words and counts of all pairs of a part, packed in a row."""
    m = len(frequent)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(frequent)
        for part in tx.slices(batches, "text", SLICE):
            w, u = coded(places, rank, *tokens(part.column("text")))
            out = []
            for k, some in dealt(u, w, part_of(u, w, parts), m):
                a, b = u[some], w[some]
                edge = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                out.append((k, pack(a[edge]), pack(b[edge]), pack(np.diff(edge, append=len(a)))))
            yield _pair_rows(out)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in _by(batches, 0):
            held = [(unpack(r[1]), unpack(r[2]), unpack(r[3], np.int64)) for r in rows]
            u, w, c = _summed(*(np.concatenate(x) for x in zip(*held)), m)
            yield _pair_rows([(k, pack(u), pack(w), pack(c))])

    return (docs.select("text").mapInArrow(task, _PAIRS).repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(merge, _PAIRS))


def _rare_dishes(pairs: DataFrame, least: int) -> DataFrame:
    """part, w, n: the rarer words of a part and the contexts in which they come at least ``least`` times."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in _by(batches, 0):
            for r in rows:
                w, c = unpack(r[1]), unpack(r[2], np.int64)
                w, n = np.unique(w[(w >= _RARE) & (c >= least)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), k, np.int32)), pa.array(_signed(w)), pa.array(n)],
                                                 names=["part", "w", "n"])

    return pairs.select("part", "w", "c").mapInArrow(task, "part int, w long, n long")


def _joined(packed: list[bytes], kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(unpack(x, kind) for x in packed)])


def _load_pairs(folder: str, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(_joined(x, k) for x, k in zip(load(folder, part, ["u", "w", "c"]), (np.uint64, np.uint64, np.int64)))


def _types(pairs: str, frequent: int):
    """A task's sums: contexts' and words' numbers of pairs, pairs that come once and twice."""
    def task(parts):
        found, few = np.zeros((2, frequent + 1), np.int64), np.zeros(2)
        for part in parts:
            u, w, c = _load_pairs(pairs, part)
            for own, x in zip(found, (u, w)):
                own += np.bincount(x[x < _RARE].astype(np.int64), minlength=frequent + 1)
            few += (c == 1).sum(), (c == 2).sum()
        yield found.astype(np.int32) if found.max() < 1 << 31 else found, few

    return task


@dataclass
class Seating:
    """The restaurants of a part.  Places of contexts and words: the frequent ones, then those of the part."""
    part: int
    u: np.ndarray            # of the pairs that come more than once: context, word, count, tables
    w: np.ndarray
    c: np.ndarray
    t: np.ndarray
    types: np.ndarray        # of the rarer contexts: pairs, tables
    tables: np.ndarray
    words: np.ndarray        # the rarer words' codes, contexts
    word_types: np.ndarray
    t_sum: np.ndarray        # sums over the kept sweeps
    tables_sum: np.ndarray


def _seating(pairs: str, roots: str, frequent: int):
    def build(part: int) -> Seating:
        u, w, c = _load_pairs(pairs, part)
        contexts, types = np.unique(u[u >= _RARE], return_counts=True)
        many = np.flatnonzero(c > 1)
        many = many[np.argsort(-c[many], kind="stable")]        # as ``seat`` takes them
        u, w, c = u[many], w[many], c[many]
        words, n = load(roots, part, ["w", "t"])
        words = np.array(words, np.int64).view(np.uint64)
        order = np.argsort(words)
        words, n = words[order], np.array(n, np.int64)[order]

        def place(x: np.ndarray, own: np.ndarray) -> np.ndarray:
            return np.where(x >= _RARE, frequent + 1 + np.searchsorted(own, x), x.astype(np.int64)).astype(np.int32)

        types = types.astype(np.float32)
        return Seating(part, place(u, contexts), place(w, words), c, np.ones(len(c), np.float32), types, types, words, n,
                       np.zeros(len(c), np.float32), np.zeros(len(types), np.float32))

    return build


def _swept(given, discount: float, sweep: int):
    """A sweep of a part's contexts; ``given``: tables of the frequent contexts, probabilities of the frequent
    words, and the probability by number of tables."""
    def one(s: Seating) -> Seating:
        tables, root, count, of_count = given.value
        m = len(tables)
        every = np.concatenate([tables, s.tables])
        probability = np.concatenate([root, of_count[np.searchsorted(count, s.word_types)]])
        fresh = (STRENGTH[0] + discount * every[s.u]) * probability[s.w]
        t = seat(np.repeat(s.c, CHAINS), np.repeat(fresh, CHAINS), discount, np.random.default_rng((sweep, s.part)))
        t = t.reshape(-1, CHAINS).mean(axis=1).astype(np.float32)
        own = s.u >= m
        now = (s.types + np.bincount(s.u[own] - m, t[own] - 1, len(s.types))).astype(np.float32)
        keep = sweep >= BURN_IN
        return Seating(s.part, s.u, s.w, s.c, t, s.types, now, s.words, s.word_types, s.t_sum + keep * t, s.tables_sum + keep * now)

    return one


def _opened(frequent: int):
    """A task's sums: tables beyond the first of the pairs, by frequent context and by frequent word."""
    def task(rows):
        out = np.zeros((2, frequent + 1))
        for s in rows:
            for own, x in zip(out, (s.u, s.w)):
                on = x <= frequent
                own += np.bincount(x[on], s.t[on] - 1, frequent + 1)
        yield out.astype(np.float32)

    return task


def _histogram(tables: np.ndarray, rare: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of tables, words that have them) of the frequent words, the end and the rarer words."""
    t = np.concatenate([tables, rare["t"].to_numpy(np.int64)])
    n = np.concatenate([np.ones(len(tables), np.int64), rare["n"].to_numpy(np.int64)])
    count, of = np.unique(t, return_inverse=True)
    return count, np.bincount(of, n, len(count)).astype(np.int64)


def fit(docs: DataFrame, frequent: int = FREQUENT, tokens_of_part: int = PART) -> Model:
    """Learn from all of ``docs`` (text)."""
    spark = docs.sparkSession

    def staged(frame: DataFrame, name: str, by: str | None = None) -> tuple[DataFrame, str]:
        folder = shared_dir(spark, name)
        writer = frame.write if by is None else frame.write.partitionBy(by)
        writer.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder), folder

    vocabulary, vocabulary_at = staged(_vocabulary(docs), "hpylm-vocabulary")
    end = int(END.view(np.int64))
    by_count = vocabulary.groupBy("c", (F.col("h") == end).alias("end")).agg(F.count("*").alias("n")).toPandas()
    n, v = int((by_count["c"] * by_count["n"]).sum()), int(by_count["n"].sum())
    of_words = by_count[~by_count["end"].astype(bool)].sort_values("c", ascending=False)
    fit_in = int((of_words["n"].cumsum() <= frequent).sum())
    least = int(of_words["c"].iloc[fit_in - 1]) if fit_in else np.iinfo(np.int64).max
    top = vocabulary.where((F.col("c") >= least) & (F.col("h") != end)).toArrow()
    keys, key_count = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
    by_rank, by_hash = np.lexsort((keys, -key_count)), np.argsort(keys)
    rank = np.empty(len(keys), np.uint64)
    rank[by_rank] = np.arange(len(keys))
    texts = int(by_count.loc[by_count["end"].astype(bool), "c"].sum())
    keys, rank, key_count = keys[by_hash], rank[by_hash], np.append(key_count[by_rank], texts)
    m, parts = len(keys), max(1, -(-n // tokens_of_part))

    pairs, pairs_at = staged(_pairs(docs, keys, rank, parts), "hpylm-pairs", "part")
    pairs = pairs.select("part", "u", "w", "c")
    # rarer words: a table for each context
    dishes = _rare_dishes(pairs, 1).groupBy("w").agg(F.sum("n").alias("t"))
    counts = vocabulary.where((F.col("c") < least) & (F.col("h") != end)).select(
        F.col("h").bitwiseOR(F.lit(-1 << 63)).alias("w"), "c")
    words, types_at = staged(counts.join(dishes, "w"), "hpylm-types")
    remove(spark, vocabulary_at)
    _, roots_at = staged(_rare_dishes(pairs, 2).select("part", "w").join(words.select("w", "t"), "w"), "hpylm-roots", "part")

    rows = spark.sparkContext.parallelize(range(parts), min(parts, 2 * spark.sparkContext.defaultParallelism))
    found = rows.mapPartitions(_types(pairs_at, m)).collect()
    types, few = sum((x[0] for x in found), np.zeros((2, m + 1))), sum((x[1] for x in found), np.zeros(2))
    discount = discount_of(*few)
    total, tables, word_tables = key_count.astype(np.float64), types[0], types[1]
    rare = words.groupBy("t").agg(F.count("*").alias("n")).toPandas()
    seatings = rows.map(_seating(pairs_at, roots_at, m)).persist(StorageLevel.MEMORY_AND_DISK)
    kept, rng, t_all = np.zeros((2, m + 1)), np.random.default_rng(0), float(v)
    for sweep in range(BURN_IN + KEPT if n else 0):
        at = np.rint(word_tables).astype(np.int64)
        count, of = _histogram(at, rare)
        of_count, _, t_all = unigram_sweep(count, of, t_all, rng)
        given = spark.sparkContext.broadcast((tables, of_count[np.searchsorted(count, at)], count, of_count))
        before, seatings = seatings, seatings.map(_swept(given, discount, sweep)).persist(StorageLevel.MEMORY_AND_DISK)
        opened = sum(seatings.mapPartitions(_opened(m)).collect(), np.zeros((2, m + 1)))
        before.unpersist()
        tables, word_tables = types[0] + opened[0], types[1] + opened[1]
        if sweep >= BURN_IN:
            kept += tables, word_tables
    tables, word_tables = kept / KEPT

    def seated(s: Seating) -> tuple:
        opened = np.bincount(s.w[s.w > m] - m - 1, (s.t_sum / KEPT - 1)[s.w > m], len(s.words))
        return s.part, pack((s.t_sum / KEPT).astype(np.float32)), pack((s.tables_sum / KEPT).astype(np.float32)), pack(s.words), pack(opened)

    seats, seats_at = staged(spark.createDataFrame(seatings.map(seated), _SEATS), "hpylm-seats", "part")
    seatings.unpersist()

    def extra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, t in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(unpack(w.as_py(), np.int64)), pa.array(unpack(t.as_py(), np.float64))],
                                                 names=["w", "more"])

    more = seats.select("words", "opened").mapInArrow(extra, "w long, more double").groupBy("w").agg(F.sum("more").alias("more"))
    words, words_at = staged(words.join(more, "w", "left").select(
        "w", "c", (F.col("t") + F.rint(F.coalesce("more", F.lit(0.0))).cast("long")).alias("t")), "hpylm-words")
    for folder in (types_at, roots_at):
        remove(spark, folder)
    rare = words.groupBy("t").agg(F.count("*").alias("n")).toPandas()
    at = np.rint(word_tables).astype(np.int64)
    count, of = _histogram(at, rare) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def chains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for seed in batch["id"].tolist():
                mean, unseen = shared_chain(count, of, seed)
                yield pd.DataFrame({"of_count": [mean.tobytes()], "unseen": [unseen]})

    sampled = spark.range(0, CHAINS, 1, CHAINS).mapInPandas(chains, "of_count binary, unseen double").collect()
    of_count = np.mean([np.frombuffer(r.of_count, np.float64) for r in sampled], axis=0)
    unseen = float(np.mean([r.unseen for r in sampled]))
    root = of_count[np.searchsorted(count, at)] if n else np.full(1, 0.5)
    return Model(n, v, keys, rank, key_count, parts, pairs_at, seats_at, words_at, discount, total, tables, root, count, of_count,
                 unseen if n else 0.5)


class Part:
    """The pairs of a part: what a context's own customers give a word, and what it leaves to the parent."""

    def __init__(self, model: Model, part: int):
        u, w, c = _load_pairs(model.pairs, part)
        t, tables = (_joined(x, np.float32) for x in load(model.seats, part, ["tables", "contexts"]))
        theta, d = STRENGTH[0], model.discount
        self.contexts, of = np.unique(u[u >= _RARE], return_inverse=True)
        total = np.concatenate([model.total, np.bincount(of, c[u >= _RARE], len(self.contexts))])
        self.left = (theta + d * np.concatenate([model.tables, tables])) / (theta + total)
        place = u.astype(np.int64)
        place[u >= _RARE] = len(model.total) + of
        seats, many = np.ones(len(c)), np.flatnonzero(c > 1)
        seats[many[np.argsort(-c[many], kind="stable")]] = t
        key = u * _KEY + w
        order = np.argsort(key)
        self.key, self.own = key[order], ((c - d * seats) / (theta + total[place]))[order]

    def score(self, u: np.ndarray, w: np.ndarray, root: np.ndarray) -> np.ndarray:
        """log10 probabilities of words after their contexts."""
        key = u * _KEY + w
        order = np.argsort(key)
        at = find(self.key, key[order])
        own = np.zeros(len(u))
        own[order[at >= 0]] = self.own[at[at >= 0]]
        left = np.ones(len(u))
        frequent = u < _RARE
        left[frequent] = self.left[u[frequent].astype(np.int64)]
        rare = np.flatnonzero(~frequent)
        at = find(self.contexts, u[rare])
        left[rare[at >= 0]] = self.left[len(self.left) - len(self.contexts) + at[at >= 0]]
        return np.log10(own + left * root)


def _emitted(model: Model):
    """Texts -> blocks: their tokens by part, their rarer words, and what is known of them."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, places = TaskContext.get().partitionId() << 40, Places(model.frequent)
        for part in tx.slices(batches, "text", SLICE):
            hashes, off = tokens(part.column("text"))
            code, context = coded(places, model.rank, hashes, off)
            n = np.diff(off)
            rows = row + np.arange(len(n))
            row += len(n)
            known = code < _RARE
            c = model.frequent_count[np.where(known, code, 0).astype(np.int64)]
            base, seen = tx.sums_by(np.where(known, model.base(c), 0.0), off), tx.sums_by(known & (c > 0), off).astype(np.int64)
            ids = part.column("doc_id")
            no_id = np.asarray(ids.is_null()).astype(np.uint8)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out = [(g % model.parts, g, _TEXTS, *(pack(x[s]) for x in (rows, ids, no_id, n, seen, base))) for g, s in _runs(rows >> GROUP)]
            who = rows[tx.owner(n)]
            rest = np.flatnonzero(~known)
            out.append((int(rows[0]) % model.parts, None, _RARER, *(pack(x[rest]) for x in (context, code, who))))
            some = np.flatnonzero(known)
            u, w, who = context[some], code[some], who[some]
            out += [(k, None, _TOKENS, *(pack(x[own]) for x in (u, w, who)))
                    for k, own in dealt(u, w, part_of(u, w, model.parts), len(model.frequent))]
            yield _block_rows(out)

    return task


def _scored(model: Model):
    """Blocks by part -> blocks with the sums of each text; other blocks as they are."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in _by(batches, 0):
            own, held, size = None, {_TOKENS: [], _LOOKED_UP: []}, {_TOKENS: 0, _LOOKED_UP: 0}

            def sums(kind: int) -> pa.RecordBatch:
                u, w, who, *more = (np.concatenate(x) for x in zip(*held[kind]))
                held[kind], size[kind] = [], 0
                if kind == _TOKENS:
                    more = [own.score(u, w, model.root[w.astype(np.int64)])]
                else:
                    more = [own.score(u, w, more[0]), model.base(more[1]), (more[1] > 0).astype(np.float64)]
                texts, of = np.unique(who, return_inverse=True)
                more = [np.bincount(of, x, len(texts)) for x in more]
                return _block_rows([(k, g, _SUMS, pack(texts[s]), *(pack(x[s]) for x in more)) for g, s in _runs(texts >> GROUP)])

            for r in rows:
                if r[2] not in held:
                    yield _block_rows([r])
                else:
                    own = own or Part(model, k)
                    held[r[2]].append([unpack(x, t) for x, t in zip(r[3:8], (np.uint64, np.uint64, np.int64, np.float64, np.int64)) if x is not None])
                    size[r[2]] += len(held[r[2]][-1][0])
                    if size[r[2]] >= PART:
                        yield sums(r[2])
            for kind in held:
                if held[kind]:
                    yield sums(kind)

    return task


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the groups of texts -> a row for each text."""
    for _, found in _by(batches, 1):
        found = list(found)
        texts = [[unpack(x, k) for x, k in zip(r[3:], (np.int64, np.int64, np.uint8, np.int64, np.int64, np.float64))]
                 for r in found if r[2] == _TEXTS]
        rows, ids, no_id, n, seen, base = (np.concatenate(x) for x in zip(*texts))
        order = np.argsort(rows)
        rows, ids, no_id, n = rows[order], ids[order], no_id[order], n[order]
        sums = np.stack([np.zeros(len(rows)), base[order], seen[order]])      # score, base, known
        for r in found:
            if r[2] == _SUMS:
                at = np.searchsorted(rows, unpack(r[3], np.int64))
                for own, x in zip(sums, r[4:7]):
                    if x is not None:
                        own[at] += unpack(x, np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=no_id.astype(bool)), pa.array(n), pa.array(np.rint(sums[2]).astype(np.int64)), pa.array(sums[1]),
             pa.array(sums[0])], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    spark: SparkSession = docs.sparkSession

    def by_part(blocks: DataFrame) -> DataFrame:
        return blocks.repartition(model.parts, "part").sortWithinPartitions("part").mapInArrow(_scored(model), _BLOCKS)

    folder = shared_dir(spark, "hpylm-scored")
    (by_part(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_emitted(model), _BLOCKS))
     .write.parquet(folder))
    staged = spark.read.schema(_BLOCKS).parquet(folder)

    def rarer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(3))):
                u, w, who = (unpack(x.as_py(), np.int64) for x in row)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(w), pa.array(who)], names=["u", "w", "who"])

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: list[list[np.ndarray]]) -> pa.RecordBatch:
            u, w, who, p, c = (np.concatenate(x) for x in zip(*held))
            u, w = u.view(np.uint64), w.view(np.uint64)
            return _block_rows([(k, None, _LOOKED_UP, *(pack(x[own]) for x in (u, w, who, p, c)))
                                for k, own in dealt(u, w, part_of(u, w, model.parts), len(model.frequent))])

        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in range(5)])
            if sum(len(x[0]) for x in held) >= PART // 4:
                yield block(held)
                held = []
        if held:
            yield block(held)

    # counts of words beyond the frequent ones, and their probabilities in the unigram restaurant
    by_tables = spark.createDataFrame([(int(t), float(p)) for t, p in zip(model.count, model.of_count)] or [(-1, 0.0)],
                                      "t long, p double")
    words = spark.read.schema("w long, c long, t long").parquet(model.words).join(F.broadcast(by_tables), "t")
    rest = (staged.where(F.col("kind") == _RARER).select("a", "b", "c").mapInArrow(rarer, "u long, w long, who long")
            .join(words, "w", "left").select("u", "w", "who", F.coalesce("p", F.lit(model.unseen)).alias("p"),
                                             F.coalesce("c", F.lit(0)).cast("long").alias("c")))
    sums = by_part(rest.mapInArrow(looked_up, _BLOCKS))
    whole = staged.where(F.col("kind") != _RARER).unionByName(sums).repartition("texts").sortWithinPartitions("texts").mapInArrow(
        _texts, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return whole.select("doc_id", "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"),
                        "base_score", "score")
