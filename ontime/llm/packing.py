"""Sequence packing as vector bin packing (operator 9).

A bin (sequence) has three capacities at once: tokens, segments (pieces) and loss-bearing tokens.
The dot-product heuristic fills one bin at a time: of the waiting pieces that fit in every
dimension, the one whose demand vector has the largest dot product with what the bin has left
(each dimension as a share of its capacity) goes in.  When none fits, the head of a waiting piece
is cut to the exact rest.  Texts are tokenized and packed in one pass over each input partition:
no shuffle; the waiting pieces of a task are bounded by ``POOL`` pieces and one slice of texts.
What a partition has left at its end fills sequences whose lengths are powers of two, which need
no padding.

Defined results: null or empty text is the end id alone; null ``doc_id`` stays null; repeated rows
are packed each for itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ontime.llm import text as tx

#: The most words whose ids a Python worker remembers between batches.
VOCABULARY = 1_000_000
#: The most pieces that wait for a bin while more texts arrive.
POOL = 512
PIECES = ("doc_id long, start long, length long, ids binary, loss_tokens long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,!?;:"]] = True


def pieces_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``text.words``, also cut between an ASCII letter and one of ``.,!?;:``: the tokenizer's
    pre-tokenizer cuts there and at white space in any case, so the ids of the parts joined are
    those of the whole text."""
    inside, letter, mark = ~tx.SPACE[data], _LETTER[data], _MARK[data]
    cut = np.zeros(len(data) + 1, bool)  # before this byte
    cut[1:-1] = (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1]) | ~inside[:-1] | ~inside[1:]
    cut[off] = True
    starts = np.flatnonzero(inside & cut[:-1])
    return starts, np.flatnonzero(inside & cut[1:]) + 1, np.searchsorted(starts, off)


class Encoder:
    """Token ids of texts, with the ids of words seen before kept by hash in sorted arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = sorted({t.content.encode().translate(tx.LOWER.tobytes()) for t in added})
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids: list[np.ndarray] = []
        self.flat = np.zeros(0, np.uint32)

    def lowered(self, data: np.ndarray) -> np.ndarray:
        """``data`` with A-Z lower-cased, as the tokenizer does, save where that could make an added
        token: these are matched on the raw text."""
        out = tx.LOWER[data]
        raw = out.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                out[at:at + len(token)] = data[at:at + len(token)]
                at = raw.find(token, at + 1)
        return out

    def learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        found = self.tokenizer.encode_batch_fast([raw[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist())],
                                                 add_special_tokens=False)
        new = [x.ids for x in found]
        count = np.fromiter(map(len, new), np.int64, len(new))
        ids = np.fromiter((i for x in new for i in x), np.uint32, int(count.sum()))
        at = len(self.flat) + np.cumsum(count) - count
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, at)
        self.count = np.insert(self.count, where, count)
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, id offsets per text)."""
        data, off = tx.flat(column)
        data = self.lowered(data)
        starts, ends, of = pieces_of(data, off)
        uniq, first, inverse = np.unique(tx.span_hash(tx.prefix_sums(data), starts, ends),
                                         return_index=True, return_inverse=True)
        if len(self.keys) > VOCABULARY:
            self.forget()
        where = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        inner = where < len(self.keys)
        known[inner] = self.keys[where[inner]] == uniq[inner]
        if not known.all():
            self.learn(data, uniq[~known], starts[first[~known]], ends[first[~known]])
            where = np.searchsorted(self.keys, uniq)
        where = where[inverse]
        counts = self.count[where]
        total = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        return self.flat[tx.gather(self.at[where], counts)], total[of]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """Fills bins from waiting pieces (document, start, ids, loss-bearing tokens)."""

    def __init__(self, tokens: int, segments: int, loss: int, first_id: int):
        self.limits = np.array([tokens, segments, loss], np.float64)
        self.tokens, self.next_id = tokens, first_id
        self.waiting: list[tuple] = []  # (doc_id, doc_tokens, start, ids, loss_from)
        self.out: list[tuple] = []

    @staticmethod
    def loss_of(start: int, length: int, loss_from: int) -> int:
        return max(0, start + length - max(start, loss_from))

    def put(self, doc, doc_tokens: int, start: int, ids: np.ndarray, loss_from: int) -> None:
        """A piece that waits; whole sequences of it go out at once."""
        while len(ids) >= self.tokens and self.loss_of(start, self.tokens, loss_from) <= self.limits[2]:
            self.close([(doc, doc_tokens, start, ids[:self.tokens], loss_from)])
            start, ids = start + self.tokens, ids[self.tokens:]
        if len(ids):
            self.waiting.append((doc, doc_tokens, start, ids, loss_from))

    def close(self, members: list[tuple]) -> None:
        total, offset = sum(len(m[3]) for m in members), 0
        for doc, doc_tokens, start, ids, loss_from in members:
            self.out.append((doc, start, len(ids), ids.astype("<u4").tobytes(), self.loss_of(start, len(ids), loss_from),
                             doc_tokens, self.next_id, offset, total))
            offset += len(ids)
        self.next_id += 1

    def run(self, at_most: int, least: int | None = None) -> None:
        """Fill whole bins until at most ``at_most`` pieces, or fewer than ``least`` tokens (by default
        less than a bin), are waiting."""
        need = np.array([(len(w[3]), 1, self.loss_of(w[2], len(w[3]), w[4])) for w in self.waiting], np.float64).reshape(-1, 3)
        free = np.ones(len(need), bool)
        waiting, tokens, least = len(need), int(need[:, 0].sum()), least or self.tokens
        while waiting > at_most and tokens >= least:
            members = self.fill(min(self.tokens, 1 << (tokens.bit_length() - 1)) if tokens < self.tokens else self.tokens, need, free)
            waiting, tokens = int(free.sum()), tokens - sum(len(m[3]) for m in members)
            self.close(members)
        self.waiting = [self.waiting[k] for k in np.flatnonzero(free).tolist()]

    def fill(self, tokens: int, need: np.ndarray, free: np.ndarray) -> list[tuple]:
        """The members of one bin of ``tokens`` tokens; ``need`` and ``free`` are of the waiting pieces."""
        limits = self.limits.copy()
        limits[0] = tokens
        at = np.flatnonzero(free)
        share, left, members = need[at] / limits, np.ones(3), []
        while True:
            fits = np.flatnonzero((share <= left + 1e-9).all(axis=1))
            if not len(fits):
                break
            k = int(fits[np.argmax(share[fits] @ left)])
            members.append(self.waiting[at[k]])
            free[at[k]] = False
            left = left - share[k]
            share[k] = 2  # fits nowhere
        rest, loss = round(left[0] * limits[0]), round(left[2] * limits[2])
        if rest and round(left[1] * limits[1]):
            # the head of the shortest piece that can fill the rest; its tail goes on waiting
            at = np.flatnonzero(free)
            for k in at[np.argsort(need[at, 0], kind="stable")].tolist():
                doc, doc_tokens, start, ids, loss_from = self.waiting[k]
                take = min(rest, len(ids) - 1, max(loss_from - start, 0) + loss)
                if take > 0:
                    members.append((doc, doc_tokens, start, ids[:take], loss_from))
                    self.waiting[k] = (doc, doc_tokens, start + take, ids[take:], loss_from)
                    need[k] = len(ids) - take, 1, self.loss_of(start + take, len(ids) - take, loss_from)
                    break
        return members

    def finish(self) -> None:
        """Pack all that waits; the rest of less than a bin goes into lengths of powers of two."""
        self.run(0, 1)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        out, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("loss_tokens", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                     ("offset", pa.int64()), ("sequence_tokens", pa.int64())])


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, tokens: int = 4096, segments: int = 512,
         loss: int = 4096, loss_from: Column | None = None) -> DataFrame:
    """One row per piece (``PIECES``; ``ids`` little-endian unsigned 32-bit) of ``docs`` (doc_id, text).

    ``loss_from``: ids of a document before the first that bears loss (instruction data: the
    prompt); without it all ids bear loss.  ``sequence_id`` is unique over all partitions and the
    same when a lost task runs again.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        packer = Packer(tokens, segments, loss, TaskContext.get().partitionId() << 40)
        for part in tx.slices(batches, "text"):
            ids, off = enc.encode(part.column("text"))
            for doc, skip, a, b in zip(part.column("doc_id").to_pylist(), part.column("loss_from").to_pylist(),
                                       off[:-1].tolist(), off[1:].tolist()):
                packer.put(doc, b - a + 1, 0, np.append(ids[a:b], np.uint32(end_id)), skip)
            packer.run(POOL)
            if packer.out:
                yield packer.batch(_SCHEMA)
        packer.finish()
        if packer.out:
            yield packer.batch(_SCHEMA)

    skip = F.lit(0) if loss_from is None else F.coalesce(loss_from, F.lit(0))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", skip.cast("long").alias("loss_from"))
            .mapInArrow(task, PIECES))
