"""Language ID by hierarchical discrimination (operator 8).

A text's family is predicted first (one linear SVM per family against the others), then
one-versus-one linear SVMs vote among the languages of that family.  Features are relative
frequencies of hashed byte bigrams and trigrams of the lower-cased text, so a decision value is
the mean weight over all positions of the whole text.  Every labelled text is learned from: a task
goes through its rows in blocks, descends on each from where the last one ended, and a classifier is
the mean over all blocks of all tasks, by their texts.  Only weights (a fixed number per classifier)
come back.

Defined results: null text and text without a letter are ``und`` with score 0; with no labelled
row everything is ``und``; with one language each text with a letter gets it.  Repeated rows and
null ids are scored like any other row; other columns are ignored.

``calibrated`` adds floors to a model: the scores that spans of held-out labelled texts reach, by the
length of the span.  ``identified`` rejects a text of which less than a third lies in spans that reach
the floor (see ``accepted``).  Spans too short to tell have no floor, nor has a model of one language,
which has no classifier: there, texts with a letter stay.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm import text as tx

#: Families of language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr", "mk"),
}
BITS = (12, 13)  # hash bits of bigrams and trigrams
SIZE = sum(1 << b for b in BITS)
#: Of the SVM: weight of the squared norm, and how sharply margins become probabilities.
DECAY, SHARPNESS = 1e-3, 3.0
#: Texts that are learned together, the frequencies that close a block before, steps on a task's first block (on the
#: n-th an n-th part of them) and the fewest steps on a block.
BLOCK, BLOCK_VALUES, STEPS, LATER = 1024, 1 << 21, 80, 12
#: Of the rejection: characters of the spans that have a floor, and the fewest held-out spans that
#: make one.  It lies halfway between the median scores of the spans and of their letters in random
#: order, but no nearer to the former than ``REACH`` times its distance from their lowest tenth.
SPANS, REACH, ENOUGH = (8, 16, 32, 64), 6.0, 20
_CODE, _RUN = re.compile(r"\S*\d\S*"), re.compile(r"[^\W\d_]+")


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), f"only-{lang}")


@dataclass
class Model:
    """families: name -> languages; weights: (family, "") or (language, language) -> SIZE weights and a bias;
    floors: the least score of a span, by its length in ``SPANS`` (none: nothing is rejected)."""
    families: dict[str, list[str]] = field(default_factory=dict)
    weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    floors: tuple[float, ...] = ()


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature index of every position of every text, offsets); a text has a space before and after it."""
    data, off = tx.flat(column)
    n = np.diff(off)
    padded = np.full(len(data) + 2 * len(n), 32, np.uint8)
    padded[np.arange(len(data)) + 2 * tx.owner(n) + 1] = np.where(tx.SPACE[data], np.uint8(32), tx.LOWER[data])
    start = off + 2 * np.arange(len(off))
    x = padded.astype(np.uint32)
    two = x[:-1] | x[1:] << np.uint32(8)
    three = two[:-1] | x[2:] << np.uint32(16)
    golden = np.uint32(2654435761)
    index = np.empty((len(x), 2), np.int32)
    index[:-1, 0] = two * golden >> np.uint32(32 - BITS[0])
    index[:-2, 1] = (three * golden >> np.uint32(32 - BITS[1])) + np.uint32(1 << BITS[0])
    keep = np.ones(index.shape, bool)  # the last position has no bigram, the last two no trigram
    keep[start[1:] - 1] = False
    keep[start[1:] - 2, 1] = False
    return index[keep], np.concatenate([[0], np.cumsum(2 * (n + 2) - 3)])


@dataclass
class Sparse:
    """Relative frequencies of the features that each text has: ``feature`` and ``value`` by text at ``off``."""
    off: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def __post_init__(self) -> None:
        self.row = tx.owner(np.diff(self.off))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.feature], len(self.off) - 1)

    def columns(self, share: np.ndarray) -> np.ndarray:
        """The sum of the texts, each times its ``share``."""
        return np.bincount(self.feature, self.value * share[self.row], SIZE)


def _joined(parts: list[Sparse]) -> Sparse:
    sizes = [np.zeros(1, np.int64), *(np.diff(p.off) for p in parts)]
    return Sparse(np.cumsum(np.concatenate(sizes)), np.concatenate([p.feature for p in parts]), np.concatenate([p.value for p in parts]))


def _sparse(column: pa.Array) -> Sparse:
    """A slice of the texts at a time, so that only frequencies are held of them all."""
    out = []
    for part in tx.slices([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
        index, off = grams(part.column("text"))
        key, times = np.unique(tx.owner(np.diff(off)) * SIZE + index, return_counts=True)
        row = key // SIZE
        out.append(Sparse(np.append(0, np.cumsum(np.bincount(row, minlength=part.num_rows))), (key % SIZE).astype(np.int32),
                          (times / np.diff(off)[row]).astype(np.float32)))
    return _joined(out)


def fit_svm(x: Sparse, positive: np.ndarray, share: np.ndarray, start: np.ndarray, steps: int) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge loss, each text weighing its ``share``) after ``steps`` of
    accelerated gradient descent from ``start``."""
    y = np.where(positive, 1.0, -1.0)
    scale = 1 / np.sqrt(x.columns(np.ones(len(y))) / len(y) + 1e-5)
    x = Sparse(x.off, x.feature, x.value * scale[x.feature].astype(np.float32))
    rate = 1 / (2 * float((x.value.astype(np.float64) ** 2 * share[x.row]).sum()) + 2 * share.sum() + DECAY)
    w, b = start[:SIZE] / scale, float(start[SIZE])
    old_w, old_b = w, b
    for step in range(steps):
        k = step / (step + 3)
        at_w, at_b = w + k * (w - old_w), b + k * (b - old_b)
        slope = -2 * share * y * np.maximum(0, 1 - y * (x.times(at_w) + at_b))
        old_w, old_b = w, b
        w, b = at_w - 4 * rate * (x.columns(slope) + DECAY * at_w), at_b - 4 * rate * float(slope.sum())
    return np.append(w * scale, b)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[str], Sparse]]:
    """(held, languages, frequencies) of each block of at most ``BLOCK`` texts, held ones by themselves.  A span of
    40 characters of each text is in it too, so that short texts are not strange to a model."""
    waiting: dict[bool, tuple[list, list]] = {}

    def close(held: bool) -> tuple[bool, list[str], Sparse]:
        langs, parts = waiting.pop(held)
        return held, langs, _joined(parts)

    for part in tx.slices(batches, "text"):
        flags = part.column("held").to_numpy(zero_copy_only=False)
        for held in (False, True):
            own = np.flatnonzero(flags == held)
            for i in range(0, len(own), BLOCK // 4):
                at = pa.array(own[i:i + BLOCK // 4])
                texts, langs = part.column("text").take(at), part.column("lang").take(at).to_pylist()
                short = pa.array([t[len(t) // 2:][:40] for t in texts.to_pylist()], pa.string())
                have = waiting.setdefault(held, ([], []))
                have[0].extend(langs + langs)
                have[1].extend([_sparse(texts), _sparse(short)])
                if len(have[0]) > 2 * BLOCK - BLOCK // 2 or sum(len(p.value) for p in have[1]) > BLOCK_VALUES:
                    yield close(held)
    for held in list(waiting):
        yield close(held)


def fit(labelled: DataFrame) -> Model:
    """Learn from all of ``labelled`` (text, lang); rows with a null lang or no letter are left out."""
    return _fitted(labelled.withColumn("held", F.lit(False)))[0]


def _fitted(labelled: DataFrame) -> tuple[Model, Model]:
    """(model of all rows, model of the rows that are not ``held``) of ``labelled`` (text, lang, held), in one pass."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang", "held")
    counts = {(r.lang, r.held): r.n for r in rows.groupBy("lang", "held").agg(F.count("*").alias("n")).collect()}
    langs = sorted({lang for lang, _ in counts})
    whole = Model()
    for lang in langs:
        whole.families.setdefault(family_of(lang), []).append(lang)
    tasks = [(f, "") for f in whole.families] if len(whole.families) > 1 else []
    tasks += [(a, b) for own in whole.families.values() for i, a in enumerate(own) for b in own[i + 1:]]
    if not tasks:
        return whole, whole
    sides = [({lang for lang in whole.families[a]}, set(langs) - set(whole.families[a])) if not b else ({a}, {b}) for a, b in tasks]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = {(k, held): np.zeros(SIZE + 1) for k in range(len(tasks)) for held in (False, True)}
        total, texts, seen = {}, {}, {}
        for held, own, x in _blocks(batches):
            number = seen[held] = seen.get(held, 0) + 1
            lang = np.array(own, object)
            for k, (yes, no) in enumerate(sides):
                rows_ = np.flatnonzero(np.isin(own, sorted(yes | no)))
                if not len(rows_):
                    continue
                n = np.diff(x.off)[rows_]
                at = tx.gather(x.off[rows_], n)
                part = Sparse(np.append(0, np.cumsum(n)), x.feature[at], x.value[at])
                positive = np.isin(lang[rows_].astype(str), sorted(yes))
                # both sides weigh the same over the whole table, so a block's sides weigh what it has of them
                of_side = [sum(counts.get((a, held), 0) for a in side) for side in (no, yes)]
                weight = 0.5 * sum(of_side) / len(rows_) / np.maximum(1, of_side)
                start = now[k, held]
                now[k, held] = fit_svm(part, positive, weight[positive.astype(int)], start, max(LATER, STEPS // number))
                total[k, held] = total.get((k, held), 0) + len(rows_) * now[k, held]
                texts[k, held] = texts.get((k, held), 0) + len(rows_)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in total], pa.int32()), pa.array([h for _, h in total]), pa.array(list(texts.values()), pa.int64()),
                 pa.array([w.tobytes() for w in total.values()], pa.binary())], names=["task", "held", "n", "w"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        w = np.sum([np.frombuffer(x) for x in group["w"]], axis=0)
        return pd.DataFrame({"task": group["task"].iloc[:1], "held": group["held"].iloc[:1], "part": [0], "n": [group["n"].sum()], "w": [w.tobytes()]})

    # sums of weights: added in parts first, so that no task reads those of all partitions
    schema = "task int, held boolean, part int, n long, w binary"
    sums = rows.mapInArrow(task, "task int, held boolean, n long, w binary").withColumn("part", F.spark_partition_id() % 32)
    found = sums.groupBy("task", "held", "part").applyInPandas(add, schema).groupBy("task", "held").applyInPandas(add, schema).collect()

    def model(flags: tuple[bool, ...]) -> Model:
        known = {lang for lang in langs if any(counts.get((lang, h)) for h in flags)}
        out = Model({f: own for f, own in ((f, [x for x in own if x in known]) for f, own in whole.families.items()) if own})
        for k, (a, b) in enumerate(tasks):
            parts = [r for r in found if r.task == k and r.held in flags]
            needed = (a in out.families and len(out.families) > 1) if not b else (a in known and b in known)
            if parts and needed:
                out.weights[a, b] = (sum(np.frombuffer(r.w) for r in parts) / sum(r.n for r in parts)).astype(np.float32)
        return out

    return model((False, True)), model((False,))


def decide(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    index, off = grams(column)
    size = np.diff(off)

    def margin(w: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Of the texts ``own``."""
        if len(own) == len(size):
            at, n = index, size
        else:
            at, n = index[tx.gather(off[own], size[own])], size[own]
        return tx.sums_by(w[at], np.concatenate([[0], np.cumsum(n)])) / np.maximum(1, n) + w[SIZE]

    def probability(m: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(SHARPNESS * m, -50, 50)))

    names = list(model.families)
    every = np.arange(len(size))
    if len(names) > 1:
        p = np.stack([probability(margin(model.weights[f, ""], every)) for f in names])
        family, score = p.argmax(axis=0), p.max(axis=0) / p.sum(axis=0)
    else:
        family, score = np.zeros(len(size), np.int64), np.ones(len(size))
    out = np.empty(len(size), object)
    for k, name in enumerate(names):
        own, langs = np.flatnonzero(family == k), model.families[name]
        if not len(own):
            continue
        votes = np.zeros((len(langs), len(own)))
        for i, a in enumerate(langs):
            for j in range(i + 1, len(langs)):
                p = probability(margin(model.weights[a, langs[j]], own))
                votes[i] += p
                votes[j] += 1 - p
        best = votes.argmax(axis=0)
        out[own] = np.array(langs, object)[best]
        if len(langs) > 1:
            score[own] *= votes.max(axis=0) / (len(langs) - 1)
    return out.tolist(), np.clip(score, 0, 1)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for each row of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            lang, score = decide(model, part.column("text"))
            letter = part.column("letter").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([x if ok else "und" for x, ok in zip(lang, letter)], pa.string()),
                pa.array(np.where(letter, score, 0.0))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    if not model.families:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(task, "doc_id long, lang_pred string, score double")


def spans(text: str) -> list[str]:
    """The distinct letter runs of ``text`` outside words with a digit, in spans of about ``SPANS[-1]``
    characters: numbers, marks and repetitions tell nothing.  Where those are few, of the whole text."""
    joined = " ".join(dict.fromkeys(_RUN.findall(_CODE.sub(" ", text.lower()))))
    if len(joined) < SPANS[1]:
        joined = " ".join(dict.fromkeys(_RUN.findall(text.lower()))) or text
    count = max(1, len(joined) // SPANS[-1])
    cut = [len(joined) * k // count for k in range(count + 1)]
    return [joined[i:j] for i, j in zip(cut, cut[1:])]


def calibrated(labelled: DataFrame) -> Model:
    """A model of ``labelled`` with floors: a model of four fifths of the rows scores spans of all rows of the
    other fifth, cut to each length of ``SPANS``."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    held = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    whole, learned = _fitted(rows.withColumn("held", held))
    if not learned.weights:
        return whole
    known = [lang for own in learned.families.values() for lang in own]

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for i in range(0, len(part), 256):          # so that the spans of few texts are held
                own = [s for text in part["text"].iloc[i:i + 256] for s in spans(text)]
                for k, n in enumerate(SPANS):
                    cut = [s[:n] for s in own if len(s) >= n]
                    if cut:
                        mixed = ["".join(random.Random(s).sample(s, len(s))) for s in cut]
                        score, other = (decide(learned, pa.array(x, pa.string()))[1] for x in (cut, mixed))
                        yield pd.DataFrame({"length": k, "score": score, "other": other})

    texts = rows.where(held & F.col("lang").isin(known)).select("text")
    found = (texts.mapInPandas(one, "length int, score double, other double").groupBy("length")
             .agg(F.count("*").alias("n"), F.percentile_approx("score", [0.1, 0.5], 10000).alias("q"),
                  F.percentile_approx("other", 0.5, 10000).alias("other")).collect())
    floors = [0.0] * len(SPANS)
    for r in found:
        if r.n >= ENOUGH:
            floors[r.length] = max(0.0, min((r.q[1] + r.other) / 2, r.q[1] - REACH * (r.q[1] - r.q[0])))
    return Model(whole.families, whole.weights, tuple(floors))


def accepted(model: Model, column: pa.Array) -> np.ndarray:
    """Whether each text is in a learned language: its score reaches the highest floor, or at least
    a third of it (counted in characters) lies in spans that reach the floor of their length (a text may
    change between languages)."""
    score = decide(model, column)[1]
    if not any(model.floors):
        return np.ones(len(score), bool)
    keep = score >= max(model.floors)
    for i in np.flatnonzero(~keep).tolist():
        own = spans(column[i].as_py() or "")
        size = np.array([len(s) for s in own])
        level = np.searchsorted(SPANS, size, "right")  # 0: shorter than any
        floor = np.concatenate([[0.0], model.floors])[level]
        good = decide(model, pa.array(own, pa.string()))[1] >= floor
        keep[i] = 3 * size[good].sum() >= size.sum()
    return keep


def identified(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` (text, ...), all columns, whose text is in a learned language (``accepted``)
    with a score of at least ``least``; ``und`` is none."""
    if not model.families:
        return docs.limit(0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            keep = part.column("__llm_letter").to_numpy(zero_copy_only=False).copy()
            keep &= accepted(model, part.column("text"))
            if least > 0:
                keep &= decide(model, part.column("text"))[1] >= least
            yield part.drop_columns(["__llm_letter"]).filter(pa.array(keep))

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn("__llm_letter", letter).mapInArrow(task, docs.schema)
