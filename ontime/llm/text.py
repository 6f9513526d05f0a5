"""Vectorised text helpers for Arrow batches inside Spark tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D (those six bytes never occur
inside a multi-byte UTF-8 character, so byte positions and character runs agree).  Everything
works on the concatenated bytes of a slice of a batch; a slice holds at most ``CHUNK`` bytes of
text, or one text if that alone is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII lower-casing of bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds at most ``limit`` bytes of ``column`` (or one row)."""
    for batch in batches:
        _, off = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, null as empty; offsets start at 0."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def words(data: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per text) of the words; no word spans two texts."""
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = off[:-1][off[:-1] < off[1:]]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def _table(name: str, base: np.uint64, n: int) -> np.ndarray:
    """Powers of ``base``; no more are kept than a slice of texts needs."""
    if len(_powers[name]) >= n:
        return _powers[name]
    grown = np.full(max(n, CHUNK + 1), base, np.uint64)
    grown[0] = 1
    np.cumprod(grown, out=grown)
    if n <= CHUNK + 1:
        _powers[name] = grown
    return grown


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the bytes, with a leading 0 (64-bit, wrapping)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _table("up", _P, len(data))[:len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, a function of their bytes alone."""
    down = _table("down", _P_INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def run_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries of ``h`` (empty if there are fewer)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _table("up", _P, len(h))[:len(h)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * _table("down", _P_INVERSE, len(h) + 1)[:len(h) - n + 1])


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def owner(counts: np.ndarray) -> np.ndarray:
    """The index of the text that each of its ``counts[i]`` entries belongs to."""
    return np.repeat(np.arange(len(counts)), counts)


def sums_by(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets (0 for an empty stretch)."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]
