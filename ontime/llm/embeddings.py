"""Embedding near-dedup by a subspace pigeonhole join (operator 7).

Unit vectors have cosine >= c when their squared distance is at most 2 (1 - c).  The vectors are
rotated onto the principal axes of the whole table, and the axes are dealt to ``BLOCKS`` blocks in
order of variance.  If all blocks of a pair were further apart than their share (by dimensions) of
the squared distance, the pair would be too far apart: so a pair that links is within the share of
some block.  Each block is a range join on its leading axes: a grid of cells as wide as the block's
distance, in which a vector meets those of its own and of the adjacent cells.  Candidates are pairs
within the block's share; each is verified in double precision on the original vectors, in the
first block that finds it only.

The blocks come one after the other.  A block's vectors are written once, in chunks of bounded size:
small cells that follow one another share a chunk, a cell with many vectors is cut into several.  A
unit is two chunks with adjacent cells; the task that compares them reads them from their folders, so
no vector is copied for each chunk that it meets, and a task holds two chunks whatever the table's size.
Links are counted and joined in the task that finds them: it gives each vector's number of links
and the least vector it is connected with, never the pairs.

Vectors of each length are joined by themselves; none of two lengths link.  Inside, every row has a
number of its own, so that null and repeated ids are compared like any other.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing
and are their own component; rows equal in id and vector are one vector, rows of one ``vec_id`` and
different vectors are a vector and a result row each; a null ``vec_id`` is compared too, its component is
the least id reached, or null; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from ontime.llm.links import Union, components
from ontime.session import shared_dir
from ontime.sources.catalog import remove
from ontime.sources.zipcsv import filesystem

BLOCKS, TILE, WIDE = 4, 512, 2048
#: Bytes of the vectors of a chunk; a task holds two.
CHUNK_BYTES = 1 << 24
#: Vectors in the table from which a block's grid has one more axis.
MORE_AXES = (500_000, 5_000_000, 50_000_000)
_AT_ONCE = 50_000
#: Cells along an axis; vectors have length 1.
_CELLS = 100_003


def _matrix(part: pa.RecordBatch | pa.Table, size: int) -> np.ndarray:
    """Vectors of ``size`` components, kept as they were given: as floats or as doubles."""
    values = part.column("v")
    data = b"".join(values.to_pylist())
    kind = np.float32 if len(data) == 4 * size * len(values) else np.float64
    return np.frombuffer(data, kind).reshape(len(values), size).astype(np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """id, v (components as bytes) of the vectors that can link."""
    kind = pa.float32() if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else pa.float64()
    schema = pa.schema([("id", pa.int64()), ("v", pa.binary()), ("size", pa.int32())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            column = part.column("embedding").cast(pa.list_(kind))
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            flat = pc.fill_null(column.flatten(), math.nan).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            # values under a null list do not appear in flatten()
            good = [i for i, (n, e) in enumerate(zip(size.tolist(), ends.tolist()))
                    if n and np.isfinite(flat[e - n:e]).all() and flat[e - n:e].any()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(good, pa.int64())),
                 pa.array([flat[ends[i] - size[i]:ends[i]].tobytes() for i in good], pa.binary()),
                 pa.array(size[good].astype(np.int32))], schema=schema)

    return vectors.mapInArrow(task, "id long, v binary, size int")


def rotation(vectors: DataFrame, size: int) -> np.ndarray:
    """Principal axes (columns, by falling variance) of all vectors, from their grouped moments."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for part in batches:
            if part.num_rows:
                x = _matrix(part, size)
                x = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((len(x), 1))])
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["k", "s"])

    moments = vectors.select("v").mapInArrow(task, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).toPandas()
    total = np.zeros((size + 1) ** 2)
    total[moments["k"].to_numpy(np.int64)] = moments["s"]
    total = total.reshape(size + 1, size + 1)
    n = max(total[-1, -1], 1)
    mean = total[-1, :-1] / n
    return np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))[1][:, ::-1].copy()


class Grid:
    """Blocks of rotated axes, their shares of the squared distance, and the cells of a vector."""

    def __init__(self, axes: np.ndarray, cosine: float, blocks: int, lead: int):
        size = len(axes)
        blocks = min(blocks, size)
        self.axes, self.cosine = axes, cosine
        self.of = [np.arange(b, size, blocks) for b in range(blocks)]
        self.share = [2 * (1 - cosine) * len(own) / size * (1 + 1e-9) + 1e-12 for own in self.of]
        self.lead = [own[:lead] for own in self.of]
        steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * min(lead, size // blocks), indexing="ij"), axis=-1)
        steps = steps.reshape(-1, steps.shape[-1]).tolist()
        #: Of two adjacent cells the lesser is where their vectors meet.
        self.back = [s for s in steps if s <= [0] * len(s)]

    def turn(self, x: np.ndarray) -> np.ndarray:
        return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ self.axes

    def cells(self, y: np.ndarray, block: int) -> np.ndarray:
        """The cell of each vector as a number."""
        width = math.sqrt(self.share[block]) * (1 + 1e-9)
        home = np.floor(y[:, self.lead[block]] / width).astype(np.int64)
        number = np.zeros(len(y), np.int64)
        for k in range(home.shape[1]):
            number = number * _CELLS + home[:, k] + _CELLS // 2
        return number

    def adjacent(self) -> list[int]:
        """What is added to a cell's number for itself and half of its neighbours."""
        return [sum(x * _CELLS ** k for k, x in enumerate(reversed(s))) for s in self.back]


def _sizes(vectors: DataFrame, grid: Grid) -> list[dict[int, int]]:
    """Vectors of each cell, for each block; the cells are as many as the grid has, whatever the number of vectors."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = defaultdict(int)
        for part in batches:
            if part.num_rows:
                y = grid.turn(_matrix(part, len(grid.axes)))
                for b in range(len(grid.of)):
                    for c, n in zip(*np.unique(grid.cells(y, b), return_counts=True)):
                        total[b, int(c)] += int(n)
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in total], pa.int32()), pa.array([c for _, c in total], pa.int64()),
                                          pa.array(list(total.values()), pa.int64())], names=["block", "cell", "n"])

    rows = vectors.select("v").mapInArrow(task, "block int, cell long, n long").groupBy("block", "cell").agg(F.sum("n").alias("n")).collect()
    return [{r["cell"]: r["n"] for r in rows if r["block"] == b} for b in range(len(grid.of))]


def chunks_of(sizes: dict[int, int], chunk: int, steps: list[int]) -> tuple[dict[int, tuple[int, int]], list[tuple[int, int]]]:
    """(first chunk and number of chunks of each cell, the pairs of chunks whose vectors can be close).
    ``steps``: from a cell's number to those of itself and half of its neighbours."""
    at: dict[int, tuple[int, int]] = {}
    last, room = -1, 0
    for cell, n in sorted(sizes.items()):
        if n > chunk:
            at[cell] = last + 1, math.ceil(n / chunk)
            last, room = last + at[cell][1], 0
            continue
        if n > room:
            last, room = last + 1, chunk
        at[cell] = last, 1
        room -= n
    units = set()
    for cell, (one, n) in at.items():
        for step in steps:
            if cell + step in at:
                two, k = at[cell + step]
                units |= {(min(i, j), max(i, j)) for i in range(one, one + n) for j in range(two, two + k)}
    return at, sorted(units)


def _dealt(vectors: DataFrame, grid: Grid, block: int, at: dict[int, tuple[int, int]]) -> DataFrame:
    """chunk, id, v: every vector once, in its chunk of the block."""
    cells = np.array(sorted(at), np.int64)
    first, parts = np.array([at[c] for c in cells.tolist()], np.int64).reshape(-1, 2).T

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                own = np.searchsorted(cells, grid.cells(grid.turn(_matrix(part, len(grid.axes))), block))
                ids = part.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                spread = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                chunk = first[own] + (spread % parts[own].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(chunk.astype(np.int32)), part.column("id"), part.column("v")],
                                                 names=["chunk", "id", "v"])

    return vectors.select("id", "v").mapInArrow(task, "chunk int, id long, v binary")


def _read(folder: str, chunk: int, grid: Grid, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of a chunk, by the block's first axis."""
    fs, at = filesystem(f"{folder}/chunk={chunk}")
    files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(at)) if f.path.endswith(".parquet"))
    whole = pa.concat_tables([pq.read_table(f, columns=["id", "v"], filesystem=fs, partitioning=None) for f in files])
    ids, x = whole.column("id").to_numpy(), _matrix(whole, len(grid.axes))
    order = np.argsort(grid.turn(x)[:, grid.of[block][0]], kind="stable")
    return ids[order], x[order]


def compare(grid: Grid, block: int, ids: np.ndarray, x: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(links, least linked position) of each vector of a unit: the first ``first`` with the others, or
    with one another if there are no others.  Both are in the order of the block's first axis."""
    y = grid.turn(x)
    norm = np.linalg.norm(x, axis=1)
    own = grid.of[block]
    links, union = np.zeros(len(ids), np.int64), Union(len(ids))

    def verify(i: np.ndarray, j: np.ndarray) -> None:
        near = ((y[i[:, None], own] - y[j[:, None], own]) ** 2).sum(axis=1) <= grid.share[block]
        i, j = i[near], j[near]
        for b in range(block):
            first = ((y[i[:, None], grid.of[b]] - y[j[:, None], grid.of[b]]) ** 2).sum(axis=1) > grid.share[b]
            i, j = i[first], j[first]
        ok = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= grid.cosine
        i, j = i[ok], j[ok]
        np.add.at(links, i, 1)
        np.add.at(links, j, 1)
        union.link(i, j)

    # one float32 product per tile, a . b = -(squared distance) / 2, leaves out what is clearly too far
    z = y[:, own].astype(np.float32)
    half, one = (z * z).sum(axis=1) / 2, np.ones(len(z), np.float32)
    left, right = np.column_stack([z, one, -half]), np.column_stack([z, -half, one])
    least = np.float32(-(grid.share[block] + 1e-5) / 2)
    axis, reach = y[:, own[0]], math.sqrt(grid.share[block]) * (1 + 1e-9)
    same = first == len(ids)
    start = 0 if same else first
    for at in range(0, first, TILE):
        end = min(at + TILE, first)
        for to in range(at if same else start, len(ids), WIDE):
            if axis[to] > axis[end - 1] + reach:
                break
            if axis[min(to + WIDE, len(ids)) - 1] < axis[at] - reach:
                continue
            product = left[at:end] @ right[to:to + WIDE].T
            some = np.flatnonzero(product.max(axis=1) >= least)
            i, j = np.nonzero(product[some] >= least)
            i, j = some[i] + at, j + to
            if same:
                once = j > i
                i, j = i[once], j[once]
            for k in range(0, len(i), _AT_ONCE):
                verify(i[k:k + _AT_ONCE], j[k:k + _AT_ONCE])
    return links, union.label


def _compared(units: DataFrame, grid: Grid, block: int, folder: str) -> DataFrame:
    """id, links, root: of each vector with a link in a unit, how many, and a vector it is connected with."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for one, two in zip(part.column("one").to_pylist(), part.column("two").to_pylist()):
                ids, x = _read(folder, one, grid, block)
                first = len(ids)
                if one != two:
                    more, z = _read(folder, two, grid, block)
                    ids, x = np.concatenate([ids, more]), np.concatenate([x, z])
                links, label = compare(grid, block, ids, x, first)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[label[some]])],
                                                 names=["id", "links", "root"])

    return units.mapInArrow(task, "id long, links long, root long")


def _links(good: DataFrame, size: int, n: int, cosine: float, blocks: int, chunk: int | None) -> DataFrame:
    """id, links, root of the vectors of one length (``_compared``), written."""
    spark = good.sparkSession
    grid = Grid(rotation(good, size), cosine, blocks, 1 + sum(n >= least for least in MORE_AXES))
    chunk = chunk or max(1, CHUNK_BYTES // (8 * size))
    out = None
    for block, sizes in enumerate(_sizes(good, grid)):
        at, pairs = chunks_of(sizes, chunk, grid.adjacent())
        chunks = 1 + max(i + k - 1 for i, k in at.values())
        dealt, folder = shared_dir(spark, "vector-chunks"), shared_dir(spark, "vector-links")
        _dealt(good, grid, block, at).repartition(chunks, "chunk").write.partitionBy("chunk").parquet(dealt)
        units = spark.createDataFrame(pairs, "one int, two int").repartition(min(len(pairs), 16 * spark.sparkContext.defaultParallelism))
        found = _compared(units, grid, block, dealt)
        found.write.parquet(folder)
        remove(spark, dealt)
        found = spark.read.schema(found.schema).parquet(folder)
        out = found if out is None else out.unionByName(found)
    return out


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, blocks: int = BLOCKS, chunk: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for each vector of ``vectors`` (vec_id, embedding).
    ``chunk``: vectors of a chunk, by default as many as ``CHUNK_BYTES`` hold."""
    spark = vectors.sparkSession

    def staged(frame: DataFrame, name: str) -> DataFrame:
        folder = shared_dir(spark, name)
        frame.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    rows = staged(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()
                  .withColumn("id", F.monotonically_increasing_id()), "vector-rows")
    good = staged(usable(rows.select("id", "embedding")), "vectors")
    sizes = {r["size"]: r["n"] for r in good.groupBy("size").agg(F.count("*").alias("n")).collect()}
    ids = rows.select("id", "vec_id")
    found = spark.createDataFrame([], "id long, links long, root long")
    for size, n in sorted(sizes.items()):
        if n > 1:
            found = found.unionByName(_links(good.where(F.col("size") == size), size, n, cosine, blocks, chunk))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    connected = staged(components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).join(ids, "id"), "vector-components")
    least = staged(connected.groupBy("component").agg(F.min("vec_id").alias("component_id")), "vector-least")
    named = connected.join(least, "component").select("id", "component_id", F.lit(True).alias("linked"))
    out = ids.join(links, "id", "left").join(named, "id", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
