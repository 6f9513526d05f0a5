"""Toxicity: a counterfactual-regularised classifier (operator 1).

A sentence's logit is a bias plus the weights of its words (the whole word and its beginnings of
three to six bytes, hashed); a text's logit is that of its most toxic sentence, so one bad sentence
in a long text counts.  Labels are of texts: learning starts with every sentence bearing its text's
label and goes on with the most toxic sentence of each.  The loss has a term for counterfactuals:
identity terms in the labelled sentences are swapped for others of the same kind, and the squared
change of the logit is added, so that naming a group does not by itself move a score.

The classifier is fitted in one task on at most ``PER_LABEL`` texts of each label; scoring is one
pass over whole texts.

Defined results: a null or empty text has the score of a sentence without words; with no labelled
rows of both labels every score is 0; rows of ``labels`` with a null or other label are left out.
Repeated rows are scored each for itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm import sampling
from ontime.llm import text as tx

#: Identity terms by kind; a term is swapped for the next one of its kind.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("people", "gay", "lesbian", "bisexual", "straight", "queer"),
    ("people", "black", "white", "asian", "latino", "african", "european", "arab"),
    ("people", "immigrants", "refugees", "foreigners", "natives"),
    ("people", "disabled", "blind", "deaf", "autistic"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "schwarze", "weiße", "ausländer", "behinderte"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "noirs", "blancs", "étrangers", "handicapés"),
    ("gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "negros", "blancos", "inmigrantes"),
)
#: The most labelled texts of each label that are learned from.
PER_LABEL = 1500
BITS = 18
BEGINNINGS = (3, 4, 5, 6)
#: Of the fit: weight of the squared norm, weight of the counterfactual term, steps on all sentences and on the worst ones.
DECAY, COUNTERFACTUAL, STEPS = 1e-4, 1.0, (25, 120)
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed features of each word, sentence offsets by word, text offsets by sentence).

    A text has one sentence at least; a sentence ends with a word that ends in ``.``, ``!`` or ``?``."""
    data, off = tx.flat(column)
    data = tx.LOWER[data]
    starts, ends, of = tx.words(data, off)
    sums = tx.prefix_sums(data)
    bits = np.uint64(64 - BITS)
    out = np.zeros((len(starts), 1 + len(BEGINNINGS)), np.int32)
    core = ends - (_STOP[data[ends - 1]] | (data[ends - 1] == ord(","))) if len(ends) else ends
    core = np.maximum(core, starts + 1)
    out[:, 0] = tx.span_hash(sums, starts, core) >> bits
    for k, n in enumerate(BEGINNINGS, 1):
        out[:, k] = tx.mix(tx.span_hash(sums, starts, np.minimum(starts + n, core)) + np.uint64(n)) >> bits
    last = np.zeros(len(starts) + 1, bool)
    last[1:] = _STOP[data[ends - 1]] if len(ends) else False
    last[of] = True
    cuts = np.flatnonzero(last)  # sentence boundaries, as word numbers
    empty = np.flatnonzero(of[1:] == of[:-1])  # texts without a word get an empty sentence
    sentences = np.sort(np.concatenate([cuts, of[empty]]))
    text_off = np.searchsorted(cuts, of) + np.concatenate([[0], np.cumsum(of[1:] == of[:-1])])
    return out, sentences, text_off


def logits(weights: np.ndarray, column: pa.Array) -> np.ndarray:
    """One per text; ``weights`` are those of the hashed features, then the bias."""
    index, sentences, texts = features(column)
    of_words = weights[index].sum(axis=1) if len(index) else np.zeros(0)
    of_sentences = tx.sums_by(of_words, sentences) + weights[-1]
    return np.maximum.reduceat(of_sentences, texts[:-1]) if len(texts) > 1 else np.zeros(0)


def swaps(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of (identity term, the term it is swapped for): each occurrence in the labelled
    sentences ``index``, and each term once, so that terms which the sample lacks are bound too."""
    pairs = [(a, b) for kind in IDENTITY_TERMS for a, b in zip(kind, (*kind[1:], kind[0]))]
    left = features(pa.array([a for a, _ in pairs]))[0]
    right = features(pa.array([b for _, b in pairs]))[0]
    order = np.argsort(left[:, 0], kind="stable")
    at = np.searchsorted(left[order, 0], index[:, 0])
    at = order[np.minimum(at, len(order) - 1)]
    hit = np.flatnonzero((left[at] == index).all(axis=1))
    return np.concatenate([left, index[hit]]), np.concatenate([right, right[at[hit]]])


def fit_weights(texts: list[str], toxic: np.ndarray) -> np.ndarray:
    """Full-batch gradient steps (Adam) on the logistic loss plus the counterfactual term."""
    index, sentences, of = features(pa.array(texts, pa.string()))
    size = (1 << BITS) + 1
    words_in, sentences_in = np.diff(sentences), np.diff(of)
    text_of = tx.owner(sentences_in)
    sentence_of = tx.owner(words_in)
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    left, right = swaps(index)
    w, first, second = np.zeros(size), np.zeros(size), np.zeros(size)

    def scatter(columns: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.bincount(columns.ravel(), np.repeat(slope, columns.shape[1]), size)

    for step in range(1, sum(STEPS) + 1):
        z = tx.sums_by(w[index].sum(axis=1), sentences) + w[-1]
        if step <= STEPS[0]:
            weight = (share / sentences_in)[text_of]
            slope = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - toxic[text_of])
        else:
            top = np.maximum.reduceat(z, of[:-1])
            worst = np.flatnonzero(z >= top[text_of])
            _, where = np.unique(text_of[worst], return_index=True)
            slope = np.zeros(len(z))
            slope[worst[where]] = share * (1 / (1 + np.exp(-np.clip(top, -50, 50))) - toxic)
        used = np.flatnonzero(slope[sentence_of])
        grad = scatter(index[used], slope[sentence_of[used]])
        grad[-1] = slope.sum()
        change = w[left].sum(axis=1) - w[right].sum(axis=1)
        change *= 2 * COUNTERFACTUAL / len(left)
        grad += scatter(left, change) - scatter(right, change) + DECAY * w
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        w = w - 0.3 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-4)
    return w.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> np.ndarray | None:
    """Weights learned from ``labels`` (doc_id, toxic 0/1) of ``docs`` (doc_id, text); None without both labels."""
    rows = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = sampling.sample(rows, "toxic", docs, per_label)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["toxic", "doc_id"])
        toxic = group["toxic"].to_numpy() == 1
        if toxic.all() or not toxic.any():
            return pd.DataFrame({"w": []})
        return pd.DataFrame({"w": [fit_weights(group["text"].fillna("").tolist(), toxic).tobytes()]})

    # one group: the sample is bounded by 2 * per_label texts
    got = texts.withColumn("fit", F.lit("all")).groupBy("fit").applyInPandas(one, "w binary").collect()
    return np.frombuffer(got[0].w, np.float32) if got else None


def score(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """doc_id, score (0 to 1), predicted for each row of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if weights is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            p = 1 / (1 + np.exp(-np.clip(logits(weights, part.column("text")).astype(np.float64), -50, 50)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p),
                                              pa.array((p >= 0.5).astype(np.int32))], schema=schema)

    return rows.mapInArrow(task, "doc_id long, score double, predicted int")
