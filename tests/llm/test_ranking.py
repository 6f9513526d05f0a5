"""Operator 11 against a brute-force version with Python's integers."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from ontime.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=20):
    held = [(d, Counter(t.translate(LOWER) for t in TERM.findall(text or ""))) for d, text in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        wanted = Counter(t.translate(LOWER) for t in TERM.findall(text or ""))
        scores = []
        for d, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t, k in wanted.items() if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank + 1, d, -score) for rank, (score, _, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, item_id int, score string")
    items = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int")
    return sorted(map(tuple, ranking.search(docs.repartition(3), items, **options).collect()), key=str)


def made_up(n, seed):
    rng = np.random.default_rng(seed)
    lexicon = [f"w{i}" for i in range(300)] + ["Äpfel", "ß", "été", "日本"]
    texts = [" ".join(rng.choice(lexicon[(g := int(rng.integers(3))) * 100:g * 100 + 104], rng.integers(1, 60)).tolist()) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


def test_matches_brute_force_over_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LEAF", 4)
    docs = made_up(600, 1) + [(1000 + i, "w1 w2 W3") for i in range(40)]
    items = [(i, t) for i, t in made_up(25, 2)] + [(50, "w1 w1 w2"), (51, "w3, W3; w1"), (52, "absent"), (53, "")]
    assert run(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t.,;"), (4, "Apple apple APPLE"), (5, "apple"), (5, "apple"), (None, "apple"), (7, "É é apple"),
            (8, "x " * 50_000 + "apple"), (9, "a\x00b\x7fc"), (10, "apple")]
    items = [(1, "apple é"), (1, "apple é"), (1, "É"), (None, "b c a"), (2, None), (3, "x")]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs = [(1, "a b")]
    assert run(spark, docs, []) == [] and run(spark, [], [(1, "a")]) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", 5)
    docs, items = made_up(80, 3), made_up(12, 4)
    assert run(spark, docs, items, top=7) == brute(docs, items, 7)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_prune(seed, monkeypatch):
    """Every document of a subtree lies in its ball, and a search leaves subtrees out."""
    monkeypatch.setattr(ranking, "LEAF", 8)
    rng = np.random.default_rng(seed)
    rows = [np.arange(6) + 6 * (i % 25) for i in range(400)]
    off = np.arange(0, 2401, 6)
    term, value = np.concatenate(rows).astype(np.int32), rng.integers(900_000, 10**6, 2400)
    tree = ranking.Tree(off, term, value, 200)
    full = np.zeros((400, 200))
    full[np.repeat(np.arange(400), 6), term] = value
    for held, mean, radius, _, docs in tree.nodes:
        centre = np.zeros(200)
        centre[held] = mean
        assert np.linalg.norm(full[docs] - centre, axis=1).max() <= radius
    dense = np.zeros(200, np.int64)
    dense[rows[0]] = rng.integers(1, 30000, 6)
    best, visited = [], []
    heappop = ranking.heapq.heappop
    monkeypatch.setattr(ranking.heapq, "heappop", lambda h: visited.append(h[0][1]) or heappop(h))
    tree.search(dense, math.sqrt(float(dense @ dense)) * (1 + 1e-9), np.arange(400), best, 5)
    score = [int(sum(int(dense[t]) * int(v) for t, v in zip(term[6 * i:6 * i + 6], value[6 * i:6 * i + 6]))) for i in range(400)]
    assert sorted(best, reverse=True) == sorted(((s, -i) for i, s in enumerate(score) if s), reverse=True)[:5]
    assert len(visited) < len(tree.nodes)


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(ranking, "span_hash", lambda sums, starts, ends: np.zeros(len(starts), np.uint64))
    v = ranking.Vocabulary(["aa", "ab", "b"])
    data = np.frombuffer(b"ab b aa ac", np.uint8)
    assert v.find(data, np.array([0, 3, 5, 8]), np.array([2, 4, 7, 10])).tolist() == [1, 2, 0, -1]
