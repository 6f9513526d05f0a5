"""Operators 4, 7 and 10 against brute force, with nulls, ties, repeated rows and empty tables."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from ontime.llm import embeddings, links, queries, shingles, substrings
from tests.llm.conftest import rows

SF = "/root/testdata/sf0.001"


def _components(n, pairs):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(10, 30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(rows(links.components(spark.createDataFrame(pairs, "a long, b long")), "id", "component"))
    assert got == {i: 10 for i in range(10, 31)} | {i: 100 for i in range(100, 140)}
    assert rows(links.components(spark.createDataFrame([], "a long, b long")), "id") == []


def _jaccard_links(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
            and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]


def _check_classes(texts, got):
    pairs = _jaccard_links(texts)
    label, count = _components(len(texts), pairs), [0] * len(texts)
    for i, j in pairs:
        count[i] += 1
        count[j] += 1
    assert got == {i: (label[i], count[i], label[i] == i) for i in range(len(texts))}


def test_ngram_join_equals_brute_force_also_in_chunks(spark):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(200)]
    base = [rng.choice(words) for _ in range(60)]
    texts = [None, "", " \n", "a b", "a  b", "b a"]
    for _ in range(60):  # one large group of near copies
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = rng.choice(words)
        texts.append(" ".join(w))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chunk in (256, 8):
        found = rows(shingles.near_duplicates(docs, chunk=chunk), "doc_id", "class_id", "n_links", "kept")
        _check_classes(texts, {d: (c, n, k) for d, c, n, k in found})


def test_ngram_join_on_the_given_table(spark):
    docs = queries.table(spark, SF, "documents").orderBy("doc_id").select("doc_id", "text").collect()
    found = {r.doc_id: (r.class_id, r.n_links, r.kept) for r in queries.op4_ngram_join(spark, SF).collect()}
    at = {r.doc_id: i for i, r in enumerate(docs)}
    _check_classes([r.text for r in docs], {at[d]: (at[c], n, k) for d, (c, n, k) in found.items()})


def test_ngram_join_odd_rows(spark, odd_docs, no_docs):
    found = rows(shingles.near_duplicates(odd_docs), "doc_id", "class_id", "n_links")
    assert sorted(r for r in found if r[0] in (0, 7)) == [(0, 0, 2), (0, 0, 2), (7, 0, 2)]
    assert [r for r in found if r[0] == 1] == [(1, 1, 0)]
    kept = rows(shingles.one_of_each(odd_docs), "doc_id", "text", "key")
    assert sorted(r[0] for r in kept if r[0] is not None) == [0, 1, 2, 3, 4, 5, 6]
    assert shingles.one_of_each(odd_docs).columns == odd_docs.columns
    assert shingles.near_duplicates(no_docs).count() == 0 and shingles.one_of_each(no_docs).count() == 0


def test_embeddings_equal_brute_force_also_in_chunks(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 12))
    x = np.concatenate([base, base[:20] + 0.12 * rng.normal(size=(20, 12)), base[:1] + 0.1 * rng.normal(size=(50, 12))])
    x = x.astype(np.float32)
    y = x.astype(np.float64)
    cosine = y @ y.T / np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(y, axis=1))
    pairs = [(i, j) for i in range(len(x)) for j in range(i) if cosine[i, j] >= 0.9]
    label = _components(len(x), pairs)
    count = np.bincount(np.array(pairs).ravel(), minlength=len(x))
    odd = [(1000, None), (1001, [0.0] * 12), (1002, [float("nan")] * 12), (1003, [1.0] * 5), (1004, [None] + [1.0] * 11),
           (1005, [])]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + odd + [(0, x[0].tolist())],
                                  "vec_id long, embedding array<float>").withColumn("id", F.lit("clash"))
    expected = {i: (int(count[i]), label[i], label[i] == i) for i in range(len(x))}
    expected |= {i: (0, i, True) for i, _ in odd}
    for chunk, blocks in ((8192, 4), (16, 4), (16, 3)):
        found = rows(embeddings.near_duplicates(frame, chunk=chunk, blocks=blocks), "vec_id", "n_links", "component_id", "kept")
        assert {f[0]: f[1:] for f in found} == expected and len(found) == len(expected)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def _embedding_links(vectors):
    """(pairs of positions with cosine >= 0.9, usable or not told by their absence)."""
    good = [i for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for size in {len(vectors[i]) for i in good}:
        own = [i for i in good if len(vectors[i]) == size]
        y = np.array([vectors[i] for i in own], np.float64)
        norm = np.linalg.norm(y, axis=1)
        i, j = np.nonzero(np.tril(y @ y.T / np.outer(norm, norm) >= 0.9, -1))
        out += [(own[a], own[b]) for a, b in zip(i, j)]
    return out


def _expected_vectors(ids, vectors):
    pairs = _embedding_links(vectors)
    label = _components(len(ids), pairs)
    least = {}
    for i, k in enumerate(label):
        if ids[i] is not None:
            least[k] = min(least.get(k, ids[i]), ids[i])
    count = [0] * len(ids)
    for pair in pairs:
        for i in pair:
            count[i] += 1
    return sorted([(ids[i], count[i], least.get(label[i]), ids[i] == least.get(label[i])) for i in range(len(ids))], key=str)


def test_embeddings_of_two_lengths_with_null_and_repeated_ids(spark):
    rng = np.random.default_rng(9)
    wide, short = rng.normal(size=(30, 8)).round(2), rng.normal(size=(12, 3)).round(2)
    table = [(i, v) for i, v in enumerate(wide.tolist())] + [(100 + i, (2 * v).tolist()) for i, v in enumerate(wide[:10])]
    table += [(200 + i, v) for i, v in enumerate(short.tolist())] + [(300 + i, v) for i, v in enumerate((short[:5] * 3).tolist())]
    table += [(5, (wide[1] * 1.01).tolist()), (None, wide[1].tolist()), (None, wide[29].tolist()), (None, [9.0, 9.0, -40.0]),
              (400, [1.0] * 5), (401, None), (None, None), (402, [])]
    ids, vectors = [i for i, _ in table], [v for _, v in table]
    frame = spark.createDataFrame(table + table[:3], "vec_id long, embedding array<double>").withColumn("size", F.lit("clash"))
    got = rows(embeddings.near_duplicates(frame), "vec_id", "n_links", "component_id", "kept")
    assert sorted(got, key=str) == _expected_vectors(ids, vectors)


def test_embeddings_of_the_given_table_equal_brute_force(spark):
    table = queries.table(spark, "/root/testdata/sf0.01", "embeddings").select("vec_id", "embedding").collect()
    got = rows(queries.op7_embedding_dedup(spark, "/root/testdata/sf0.01"), "vec_id", "n_links", "component_id", "kept")
    assert sorted(got, key=str) == _expected_vectors([r.vec_id for r in table], [r.embedding for r in table])


def _without_repeats(texts, n=35):
    seen, words = {}, [(t or "").encode().split() for t in texts]
    for w in words:
        for i in range(len(w) - n + 1):
            seen[tuple(w[i:i + n])] = seen.get(tuple(w[i:i + n]), 0) + 1
    out = []
    for w in words:
        keep = [True] * len(w)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                keep[i:i + n] = [False] * n
        out.append((len(w), keep.count(False), b" ".join(x for x, k in zip(w, keep) if k)))
    return out


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(1)
    words = ["w%d" % i for i in range(50)]
    passage = [rng.choice(words) for _ in range(90)]
    texts = [None, "", "a", " ".join(passage), "x " * 100, " ".join(passage[:34])]
    for _ in range(40):  # a passage in many texts, cut and changed in places
        a, b = sorted(rng.sample(range(91), 2))
        w = passage[a:b]
        if w and rng.random() < 0.4:
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join([rng.choice(words) for _ in range(rng.randrange(40))] + w + ["end\n\tof"] * rng.randrange(3)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = [(i, *e) for i, e in enumerate(_without_repeats(texts))]
    for shard in (substrings.SHARD, 3):  # 3: hot anchors are split into single windows
        found = rows(substrings.remove_repeated(docs, shard=shard).orderBy("doc_id"), "doc_id", "n_words", "n_removed", "text")
        assert [(d, a, b, (t or "").encode()) for d, a, b, t in found] == expected


def test_substring_query_on_the_given_table(spark):
    docs = queries.table(spark, SF, "documents").orderBy("doc_id").select("doc_id", "text").collect()
    expected = {r.doc_id: (n, gone, hashlib.sha256(kept).hexdigest())
                for r, (n, gone, kept) in zip(docs, _without_repeats([r.text for r in docs]))}
    found = queries.op10_substring_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == expected


def test_substring_dedup_odd_rows(spark, odd_docs, no_docs):
    out = substrings.remove_repeated(odd_docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "n_words", "n_removed"]
    found = {r.doc_id: r for r in out.collect()}
    assert found[1].text is None and found[1].n_words == 0
    assert found[5].n_words == found[5].n_removed == 3000 and found[5].text == ""
    assert found[0].n_removed == 0 and out.count() == odd_docs.count()
    assert substrings.remove_repeated(no_docs).count() == 0
def test_a_vector_is_dealt_once_and_chunks_are_bounded():
    steps = [-101, -100, -99, -1, 0]
    sizes = {100 * a + b: n for a, b, n in ((1, 1, 2), (1, 2, 3), (1, 3, 40), (2, 2, 1), (2, 3, 9), (5, 5, 4), (5, 6, 4))}
    at, units = embeddings.chunks_of(sizes, 10, steps)
    held = {}
    for cell, (one, n) in at.items():
        for k in range(one, one + n):
            held[k] = held.get(k, 0) + math.ceil(sizes[cell] / n)
    assert sorted(held) == list(range(len(held))) and max(held.values()) <= 10 and at[103][1] == 4
    close = {(a, b) for a in at for b in at if abs(a // 100 - b // 100) <= 1 and abs(a % 100 - b % 100) <= 1}
    for a, b in close:
        assert all((min(i, j), max(i, j)) in units for i in range(at[a][0], sum(at[a])) for j in range(at[b][0], sum(at[b])))


def test_a_hot_cell_is_written_once_whatever_its_chunks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.ones(12) + rng.normal(0, 1e-3, (300, 12))       # all in one cell: 30 chunks, 465 units a block
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    dealt, whole = [], embeddings._dealt
    monkeypatch.setattr(embeddings, "_dealt", lambda *a: dealt.append(whole(*a)) or dealt[-1])
    found = rows(embeddings.near_duplicates(frame, chunk=10, blocks=2), "vec_id", "n_links", "component_id", "kept")
    assert sorted(found) == [(i, 299, 0, i == 0) for i in range(300)]
    assert [d.count() for d in dealt] == [300, 300]


