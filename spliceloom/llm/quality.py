"""Quality classifier: hashed word n-grams, logistic regression trained by follow-the-regularised-leader updates.

Words are runs of letters and digits or of other marks. Features are hashed 1-, 2- and 3-grams over the words and over
their shapes (case, class, length, repetition of the word before); a text's value for each is its share of the text.
Empty and null texts have the bias alone and still get a score. Rows are scored alone, repeated ones each; extra columns
pass through; an empty table gives no rows, and without labelled rows every score is 0.5. Ties at the threshold pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, sampled, slices, text_bytes
from .words import KIND, LOWER, mix, span_hashes, split

BITS = 18
SIZE = 1 << BITS
#: At most about so many labelled rows, picked by a hash of the id, fit the model.
MAX_ROWS = 6000


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, the text of each, and the number of words of each text."""
    starts, ends, at = split(raw, bounds, KIND)
    n = len(starts)
    words = np.diff(at)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words
    low = LOWER[raw]
    h = span_hashes(low, starts, ends)
    upper = np.concatenate([[0], np.cumsum(low != raw)])
    n_upper, length = upper[ends] - upper[starts], ends - starts
    mark = KIND[raw[starts]] == 2
    doc = np.repeat(np.arange(len(words)), words)
    same = np.zeros(n, bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    case = np.where(n_upper == 0, 0, np.where(n_upper * 2 > length, 2, 1))
    shape = mix(np.where(mark, h, (case * 8 + np.minimum(length, 7)).astype(np.uint64)) + same.astype(np.uint64) * np.uint64(977))
    found, of = [h & np.uint64(SIZE - 1), shape & np.uint64(SIZE - 1)], [doc, doc]
    for base in (h, shape):
        gram = base
        for k in (1, 2):
            gram = mix(gram[:-1] * np.uint64(31) + base[k:]) if len(gram) > 1 else gram[:0]
            inside = doc[k:] == doc[: n - k] if n > k else np.zeros(0, bool)
            found.append(gram[inside] & np.uint64(SIZE - 1))
            of.append(doc[k:][inside] if n > k else doc[:0])
    return np.concatenate(found).astype(np.int64), np.concatenate(of), words


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3, seed: int = 7) -> Model:
    """Per-coordinate updates over (feature numbers, values, label); the last coordinate is the bias."""
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    rng = np.random.default_rng(seed)
    weights = lambda i: np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            i, x, y = rows[r]
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    w = weights(np.arange(SIZE + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def _row(text: pa.Array) -> list[bytes]:
    """Per text: distinct feature numbers, then their values, as bytes."""
    raw, bounds = text_bytes(text)
    idx, doc, words = features(raw, bounds)
    key, count = np.unique(doc * SIZE + idx, return_counts=True)
    cut = np.searchsorted(key, np.arange(len(words) + 1) * SIZE)
    value = (count / np.sqrt(np.maximum(words, 1))[key // SIZE] / 8).astype(np.float32)
    return [(key[a:b] % SIZE).astype(np.int32).tobytes() + value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """A model from labelled rows outside fold 0 of 5, at most about max_rows of them; never from other columns.

    Labels that are null are left out; an id with several labels counts as 1 only if all are 1.
    """
    rows = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
    share = min(1.0, max_rows / max(1, rows.count()))
    sample = rows.filter(sampled(F.col("doc_id"), share, 11)).groupBy("doc_id").agg(F.min(label).cast("int").alias("__y")).limit(2 * max_rows)

    @F.arrow_udf("binary")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([r for part in slices(batch) for r in _row(part)], pa.binary())

    got = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(made("text").alias("x"), "__y", "doc_id").toLocalIterator()
    fitted = []
    for x, y, at in sorted(((bytes(r["x"]), r["__y"], r["doc_id"]) for r in got), key=lambda r: r[2]):
        n = len(x) // 8
        fitted.append((np.append(np.frombuffer(x[: 4 * n], np.int32), SIZE), np.append(np.frombuffer(x[4 * n :], np.float32), np.float32(1)), y))
    return fit(fitted)


def scores(text: pa.Array, model: Model) -> np.ndarray:
    """Probability of label 1 for each text: one sparse dot product."""
    raw, bounds = text_bytes(text)
    idx, doc, words = features(raw, bounds)
    dot = np.bincount(doc, weights=model.weights[idx], minlength=len(words)) / np.sqrt(np.maximum(words, 1)) / 8 + model.bias
    return 1 / (1 + np.exp(-np.clip(dot, -30, 30)))


def quality_score(text: Column, model: Model, spark) -> Column:
    """Score of each text, 0 to 1; null counts as empty."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.concatenate([scores(part, shared.value) for part in slices(batch)] or [np.zeros(0)]), pa.float64())

    return scored(text)


def score_documents(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    scored = documents.select("doc_id", quality_score(F.col("text"), model, documents.sparkSession).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_quality(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """documents without the rows that score below the threshold, all columns, whatever their names. Null texts score as
    empty ones, repeated rows alike, whole texts at any length; an empty table stays empty."""
    return documents.filter(quality_score(F.col("text"), model, documents.sparkSession) >= threshold)
