"""Vector code compression by integer product quantisation (operator 13).

Vectors become integers, floor(4096 x), and are cut into ``PARTS`` equal parts; every part position has a
codebook of at most ``ENTRIES`` entries, refined in ``ROUNDS`` rounds.  The vectors are staged once as
chunks.  In a chunk each part position is sorted along a Hilbert curve and laid out flat; every ``BLOCK``
neighbours on the curve are a block that stores its bounding box and its componentwise sums.  A round
bounds the squared distance of every entry to every box from below and above.  Entries whose least
distance exceeds some other entry's greatest one cannot be nearest to any vector of the block; what is
left is the block's shortlist.  A block with one entry on its list gives its sums at once, the others
are evaluated by exact integer kernels over the listed entries only.

A round is one map over the staged chunks and one grouped sum; the driver holds the codebooks and their
sums, whose size depends on the vectors' width alone.  Sums travel as base-2^32 digits, so they cannot
overflow.  Components beyond what 64-bit kernels can square are kept as doubles and evaluated with
Python's integers.

Defined results: null vectors and those with null or non-finite components are dropped; vectors shorter
than the longest (or whose length is no multiple of ``PARTS``) are filled with zeros; rows that repeat a
``vec_id`` are rows of their own, a null ``vec_id`` sorts last, and equal ids start the codebooks in order
of their vectors; with fewer than ``ENTRIES`` rows there are as many entries; errors that no long holds
are given as the largest long; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ontime.session import shared_dir

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK = 64
#: Bytes of doubles in a chunk.
CHUNK_BYTES = 1 << 24
#: Leading axes and bits an axis of the Hilbert key (at most 63 bits).
AXES, BITS = 8, 7
#: Bytes of label totals that are broadcast; beyond, they are joined by a salted shuffle.
LABEL_BYTES, SALTS = 1 << 23, 32
_DIGIT = 32
_LONGEST = (1 << 63) - 1

Codebooks = list[list[list[int]]]

_CHUNKS = ("width int, ids array<bigint>, labels array<{label}>, sorted binary, places binary, low binary, high binary, "
           "sums binary, wide binary")


def limit(width: int) -> int:
    """Components below this bound give squared distances that 64 bits hold, for parts of ``width``."""
    return 1 << max(1, 30 - math.ceil(math.log2(max(width, 1)) / 2))


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points with ``bits`` bits an axis (rows of unsigned integers)."""
    x = x.astype(np.uint64).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(len(x)):
            upper = (x[i] & bit) != 0
            change = np.where(upper, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(upper, below, change)
            x[i] ^= change
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & np.uint64(1) != 0, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << np.uint64(1)) | ((axis >> np.uint64(level)) & np.uint64(1))
    return key


def along_curve(points: np.ndarray) -> np.ndarray:
    """The order of integer ``points`` along a Hilbert curve over their widest axes."""
    if not points.size:
        return np.arange(len(points))
    least = points.min(axis=0)
    span = points.max(axis=0) - least + 1
    axes = np.sort(np.argsort(-span, kind="stable")[:AXES])
    cells = (points[:, axes] - least[axes]) * (1 << BITS) // span[axes]
    return np.argsort(hilbert(cells, BITS), kind="stable")


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """blocks x entries: whether an entry can be nearest (ties included) to a vector in the block's box."""
    near, far = np.zeros((len(low), len(entries)), np.int64), np.zeros((len(low), len(entries)), np.int64)
    for i in range(low.shape[1]):
        under, over = low[:, i, None] - entries[:, i], entries[:, i] - high[:, i, None]
        outside = np.maximum(np.maximum(under, over), 0)
        corner = np.maximum(np.abs(under), np.abs(over))
        near += outside * outside
        far += corner * corner
    return near <= far.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, block: np.ndarray, listed: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each point; ``listed`` has the shortlist of the point's block."""
    code, error = np.zeros(len(points), np.int64), np.full(len(points), _LONGEST, np.int64)
    for e in np.flatnonzero(listed.any(axis=0)):
        rows = np.flatnonzero(listed[block, e])
        gap = points[rows] - entries[e]
        distance = np.einsum("ij,ij->i", gap, gap)
        closer = distance < error[rows]
        code[rows[closer]], error[rows[closer]] = e, distance[closer]
    return code, error


def slow_nearest(points: list[list[int]], entries: list[list[int]]) -> tuple[list[int], list[int]]:
    """The same with integers of any size."""
    best = [min((sum((a - b) ** 2 for a, b in zip(p, entry)), e) for e, entry in enumerate(entries)) for p in points]
    return [e for _, e in best], [d for d, _ in best]


def _kernel_entries(entries: list[list[int]], width: int) -> np.ndarray | None:
    """The entries as 64-bit integers, or None if they need larger ones.  Entries so far off that every
    point within the bound is nearer to one within it stand as zeros; ``_far_off`` marks them."""
    bound = limit(width)
    beyond = bound * (2 + 2 * math.isqrt(width - 1) + 2) if width else bound
    sizes = [max(map(abs, e), default=0) for e in entries]
    if any(bound <= s < beyond for s in sizes) or all(s >= bound for s in sizes):
        return None
    return np.array([e if s < bound else [0] * width for e, s in zip(entries, sizes)], np.int64).reshape(len(entries), width)


def _far_off(entries: list[list[int]], width: int) -> np.ndarray:
    return np.array([max(map(abs, e), default=0) >= limit(width) for e in entries], bool)


class Chunk:
    """One staged chunk, part position by part position."""

    def __init__(self, row: dict):
        self.row, self.n, self.part = row, len(row["ids"]), row["width"] // PARTS
        self.blocks = -(-self.n // BLOCK)
        if row["wide"] is not None:
            x = np.frombuffer(row["wide"], np.float64).reshape(self.n, row["width"])
            self.whole = [[math.floor(v) * SCALE if abs(v) >= 1 << 52 else math.floor(v * SCALE) for v in r] for r in x.tolist()]

    def _of(self, name: str, dtype: type, p: int, *shape: int) -> np.ndarray:
        count = math.prod(shape)
        if not count:
            return np.zeros(shape, dtype)
        return np.frombuffer(self.row[name], dtype, count, p * count * np.dtype(dtype).itemsize).reshape(shape)

    def points(self, p: int) -> np.ndarray:
        return self._of("sorted", np.int32, p, self.n, self.part).astype(np.int64)

    def listed(self, p: int, entries: list[list[int]]) -> tuple[np.ndarray, np.ndarray] | None:
        """(64-bit entries, shortlists), or None where 64 bits do not do."""
        kernel = _kernel_entries(entries, self.part)
        if kernel is None:
            return None
        low, high = (self._of(name, np.int32, p, self.blocks, self.part).astype(np.int64) for name in ("low", "high"))
        far = _far_off(entries, self.part)
        listed = np.zeros((self.blocks, len(entries)), bool)
        listed[:, ~far] = shortlist(low, high, kernel[~far])
        return kernel, listed

    def integers(self, p: int) -> list[list[int]]:
        """The part as Python integers, in the chunk's order."""
        if self.row["wide"] is not None:
            return [r[p * self.part:(p + 1) * self.part] for r in self.whole]
        out = np.empty((self.n, self.part), np.int64)
        out[self._of("places", np.int32, p, self.n)] = self.points(p)
        return out.tolist()

    def sums(self, p: int, entries: list[list[int]]) -> tuple[list[list[int]], list[int]]:
        """Of each entry, the componentwise sum and the number of the parts assigned to it."""
        fast = None if self.row["wide"] is not None else self.listed(p, entries)
        if fast is None:
            points = self.integers(p)
            total, count = [[0] * self.part for _ in entries], [0] * len(entries)
            for point, e in zip(points, slow_nearest(points, entries)[0]):
                total[e] = [a + b for a, b in zip(total[e], point)]
                count[e] += 1
            return total, count
        kernel, listed = fast
        total, count = np.zeros((len(entries), self.part), np.int64), np.zeros(len(entries), np.int64)
        block = np.arange(self.n) // BLOCK
        size = np.bincount(block, minlength=self.blocks)
        alone = listed.sum(axis=1) == 1
        only = listed[alone].argmax(axis=1)
        np.add.at(total, only, self._of("sums", np.int64, p, self.blocks, self.part)[alone])
        np.add.at(count, only, size[alone])
        rest = np.flatnonzero(~alone[block])
        points = self.points(p)[rest]
        code, _ = nearest(points, block[rest], listed, kernel)
        np.add.at(total, code, points)
        return total.tolist(), (count + np.bincount(code, minlength=len(entries))).tolist()

    def codes(self, p: int, entries: list[list[int]]) -> tuple[list[int], list[int]]:
        """(entry, squared distance) of each row's part, in the chunk's order."""
        fast = None if self.row["wide"] is not None else self.listed(p, entries)
        if fast is None:
            return slow_nearest(self.integers(p), entries)
        kernel, listed = fast
        places = self._of("places", np.int32, p, self.n)
        code, error = np.empty(self.n, np.int64), np.empty(self.n, np.int64)
        code[places], error[places] = nearest(self.points(p), np.arange(self.n) // BLOCK, listed, kernel)
        return code.tolist(), error.tolist()


def _lay_out(x: np.ndarray, width: int) -> dict[str, bytes]:
    """The flat, Hilbert-sorted blocks of integer vectors ``x``, all part positions one after the other."""
    part = width // PARTS
    out: dict[str, list[bytes]] = {name: [] for name in ("sorted", "places", "low", "high", "sums")}
    starts = np.arange(0, len(x), BLOCK)
    for p in range(PARTS):
        points = x[:, p * part:(p + 1) * part]
        places = along_curve(points)
        points = points[places]
        out["sorted"].append(points.astype(np.int32).tobytes())
        out["places"].append(places.astype(np.int32).tobytes())
        out["low"].append(np.minimum.reduceat(points, starts, axis=0).astype(np.int32).tobytes())
        out["high"].append(np.maximum.reduceat(points, starts, axis=0).astype(np.int32).tobytes())
        out["sums"].append(np.add.reduceat(points, starts, axis=0).tobytes())
    return {name: b"".join(parts) for name, parts in out.items()}


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles), label of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"), "label")
            .where(F.col("embedding").isNotNull() & finite))


def chunks(vectors: DataFrame, width: int) -> DataFrame:
    """The staged form of ``usable`` vectors, filled with zeros to ``width``."""
    rows_of = max(1, CHUNK_BYTES // (8 * max(width, 1)))
    bound = limit(width // PARTS)
    label = vectors.schema["label"].dataType

    def chunk(part: pa.RecordBatch, own: np.ndarray, **stored: bytes) -> dict:
        some = part.take(pa.array(own))
        return {"width": width, "ids": some.column("vec_id").to_pylist(), "labels": some.column("label").to_pylist(),
                **dict.fromkeys(("sorted", "places", "low", "high", "sums", "wide")), **stored}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows_of):
                part = batch.slice(at, rows_of)
                lists = part.column("embedding")
                size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                x = np.zeros((part.num_rows, width))
                x[np.arange(width) < size[:, None]] = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
                with np.errstate(over="ignore"):
                    whole = np.floor(x * SCALE)
                fits = (np.abs(whole) < bound).all(axis=1)
                out = []
                if fits.any():
                    out.append(chunk(part, np.flatnonzero(fits), **_lay_out(whole[fits].astype(np.int64), width)))
                if not fits.all():
                    out.append(chunk(part, np.flatnonzero(~fits), wide=x[~fits].tobytes()))
                fields = [("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(part.column("label").type)),
                          *((name, pa.binary()) for name in ("sorted", "places", "low", "high", "sums", "wide"))]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))

    return vectors.mapInArrow(task, _CHUNKS.format(label=label.simpleString()))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0])


def assigned_sums(staged: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, place, digit, total: exact sums over all chunks; place -1 has the counts.  The value is
    the sum of total * 2^(32 digit)."""
    def digits(value: int) -> Iterator[tuple[int, int]]:
        place = 0
        while not -(1 << 62) <= value < 1 << 62:
            yield place, value & ((1 << _DIGIT) - 1)
            value, place = value >> _DIGIT, place + 1
        yield place, value & ((1 << _DIGIT) - 1)
        yield place + 1, value >> _DIGIT

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[int]] = {}
        for chunk in _rows(batches):
            for p in range(PARTS):
                total, count = chunk.sums(p, books[p])
                for e in range(len(count)):
                    if count[e]:
                        before = held.get((p, e)) or [0] * (chunk.part + 1)
                        held[p, e] = [a + b for a, b in zip(before, [count[e], *total[e]])]
        out = [(p, e, place - 1, digit, value) for (p, e), sums in held.items() for place, s in enumerate(sums)
               for digit, value in digits(s) if value]
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "digit", "total"])

    return (staged.drop("labels").mapInArrow(task, "part long, entry long, place long, digit long, total long")
            .groupBy("part", "entry", "place", "digit").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))


def _refined(staged: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round: entries that have parts become the floor of their mean."""
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in assigned_sums(staged, books).collect():
        of = sums.setdefault((r["part"], r["entry"]), {})
        of[r["place"]] = of.get(r["place"], 0) + (int(r["total"]) << (_DIGIT * r["digit"]))
    return [[[s.get(i, 0) // s[-1] for i in range(len(entry))] if (s := sums.get((p, e))) else entry
             for e, entry in enumerate(book)] for p, book in enumerate(books)]


def _coded(staged: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error of every row."""
    label = staged.schema["labels"].dataType.elementType

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.slice(i, 1).to_pylist()[0])
                by_part = [chunk.codes(p, books[p]) for p in range(PARTS)]
                codes = ["".join(f"{c:02x}" for c in own) for own in zip(*(codes for codes, _ in by_part))]
                errors = [min(sum(own), _LONGEST) for own in zip(*(errors for _, errors in by_part))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk.row["ids"], pa.int64()), pc.list_flatten(batch.slice(i, 1).column("labels")),
                     pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    return staged.mapInArrow(task, f"vec_id long, label {label.simpleString()}, code string, error long")


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def compress(vectors: DataFrame) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error of each usable row of ``vectors`` (vec_id, embedding, label); the codebooks)."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    longest = rows.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    width = -(-(longest or 0) // PARTS) * PARTS
    folder = shared_dir(spark, "vector-chunks")
    laid = chunks(rows, width)
    laid.write.parquet(folder)
    staged = spark.read.schema(laid.schema).parquet(folder)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).collect()
    seeds = [[math.floor(v) * SCALE if abs(v) >= 1 << 52 else math.floor(v * SCALE) for v in r["embedding"]] for r in first]
    seeds = [s + [0] * (width - len(s)) for s in seeds]
    part = width // PARTS
    books = [[s[p * part:(p + 1) * part] for s in seeds] for p in range(PARTS)]
    for _ in range(ROUNDS if first else 0):
        books = _refined(staged, books)
    return _coded(staged, books), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error, the sum of ``error`` over rows of an equal label (nulls together).  Labels are
    summed before they meet the rows; totals are broadcast if they are small, or else spread over salts,
    so that a label of many rows is many tasks."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONGEST)).cast("long")
    totals = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label")
    held = totals.agg(F.sum(F.coalesce(F.octet_length(F.col("_label").cast("string")), F.lit(0)) + 64).alias("bytes")).first()
    same = F.col("label").eqNullSafe(F.col("_label"))
    if (held["bytes"] or 0) <= LABEL_BYTES:
        return coded.join(F.broadcast(totals), same).drop("_label")
    salted = totals.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, same & (F.col("_salt") == F.col("_to"))).drop("_label", "_salt", "_to")
