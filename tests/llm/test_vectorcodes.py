"""Operator 13 against a brute-force version with Python's integers."""

import math

import numpy as np
import pytest

from ontime.llm import vectorcodes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, code string, `label_error` int"


def brute(rows):
    """(vec_id, code, error, label_error) of each usable row, and the codebooks."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(r[1]) for r in good), default=0) // 8) * 8
    whole = [[math.floor(x) * 4096 if abs(x) > 2**60 else math.floor(x * 4096) for x in r[1]] for r in good]
    whole = [w + [0] * (width - len(w)) for w in whole]
    parts = [[w[p * width // 8:(p + 1) * width // 8] for w in whole] for p in range(8)]
    books = [own[:16] for own in parts]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            of = {}
            for x in parts[p]:
                of.setdefault(near(x, books[p])[1], []).append(x)
            books[p] = [[sum(c) // len(of[i]) for c in zip(*of[i])] if i in of else e for i, e in enumerate(books[p])]
    found = [[near(parts[p][i], books[p]) for p in range(8)] for i in range(len(good))]
    error = [min(sum(d for d, _ in f), 2**63 - 1) for f in found]
    by = {}
    for r, e in zip(good, error):
        by[r[2]] = by.get(r[2], 0) + e
    return [(r[0], "".join(f"{e:02x}" for _, e in f), d, min(by[r[2]], 2**63 - 1)) for r, f, d in zip(good, found, error)], books


def run(spark, rows):
    frame = spark.createDataFrame([(r[0], r[1], r[2], "x", 1) for r in rows], SCHEMA)
    coded, books = vc.compress(frame)
    out = vc.with_label_error(coded).select("vec_id", "code", "error", "label_error")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(map(tuple, out.collect()), key=key), books, key


def same(spark, rows):
    got, books, key = run(spark, rows)
    want, want_books = brute(rows)
    assert [list(map(list, b)) for b in books] == want_books
    assert got == sorted(want, key=key)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(20, 24))
    rows = [(int(i), (centre[i % 20] + rng.normal(scale=0.2, size=24)).round(3).tolist(), int(i % 3)) for i in rng.permutation(700)]
    same(spark, rows)


def test_ties_repeats_nulls_and_lengths(spark):
    rows = [(i % 7, [float(i % 2)] * 16, i % 2) for i in range(60)]
    rows += [(None, [0.25] * 16, None), (None, [0.5] * 16, None), (100, None, 1), (101, [1.0, None] * 8, 1),
             (102, [float("nan")] * 16, 1), (103, [float("inf")] * 16, 1), (104, [1.5] * 5, 2), (105, [], 2), (106, [-0.0001] * 19, 2)]
    same(spark, rows)


def test_components_beyond_64_bits(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist(), 0) for i in range(40)]
    rows += [(3, [1e300] * 16, 0), (41, [-1e300] * 16, 1), (42, [7e4] * 16, 1), (43, [1e9, -1e9] * 8, 1), (44, [1e18] * 16, 2)]
    same(spark, rows)


def test_few_rows_and_none(spark):
    same(spark, [(5, [0.1] * 8, 1), (2, [0.3] * 8, 1)])
    got, books, _ = run(spark, [(1, None, 1)])
    assert got == [] and books == [[]] * 8
    assert run(spark, [])[0] == []


def test_labels_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vc, "LABEL_BYTES", 0)
    same(spark, [(i, [i / 10.0] * 8, None if i % 5 == 0 else i % 3) for i in range(50)])


def test_hilbert_neighbours_touch():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        key = vc.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("seed", range(5))
def test_shortlists_hold_every_nearest_entry(seed):
    rng = np.random.default_rng(seed)
    points, entries = rng.integers(-50, 50, (640, 3)), rng.integers(-50, 50, (16, 3))
    points = points[vc.along_curve(points)]
    starts = np.arange(0, 640, vc.BLOCK)
    listed = vc.shortlist(np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts), entries)
    distance = ((points[:, None] - entries) ** 2).sum(axis=2)
    nearest = distance == distance.min(axis=1, keepdims=True)
    assert listed[np.arange(640) // vc.BLOCK][nearest].all()
    code, error = vc.nearest(points, np.arange(640) // vc.BLOCK, listed, entries)
    assert (code == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
