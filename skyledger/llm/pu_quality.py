"""Quality classifier learned from trusted positives and unlabelled text.

The non-negative unbiased risk: with class prior p, loss l and score g, the risk of the negatives is the risk of the
unlabelled rows taken as negative less p times that of the positives taken as negative. A flexible model can push that
difference below zero, which no true risk can be; it is held at zero and such steps walk back. The model is linear in
features of a text's characters, words and lines, so scoring is one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import INK_BYTE, lowered, prefix_hash, sample_fraction, slices, span_hash, stored, text_bytes, word_spans

FIT_POSITIVES = 20_000
FIT_UNLABELLED = 40_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

#: Character classes that features count, by byte.
_CLASSES = {
    "lower": [*range(97, 123)],
    "upper": [*range(65, 91)],
    "digit": [*range(48, 58)],
    "high": [*range(128, 256)],
    "space": [9, 13, 32],
    "line": [10],
    "stop": [33, 63, 46],
    "bang": [33],
    "comma": [44, 58, 59],
    "pipe": [124],
    "quote": [34, 39, 40, 41, 45],
    "symbol": [35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126],
}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[_bytes] = _k
_CLASS_OF[33] = list(_CLASSES).index("bang")


def features(values: pa.Array) -> np.ndarray:
    """One row of features per text; null and empty texts give the same row of zeros."""
    data, offsets = text_bytes(values)
    rows, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(rows), size)
    kinds = len(_CLASSES) + 1
    share = np.bincount(row * kinds + _CLASS_OF[data], minlength=rows * kinds).reshape(rows, kinds) / np.maximum(size, 1)[:, None]
    begin, end, first = word_spans(data, offsets, INK_BYTE)
    words = np.diff(first)
    of = np.repeat(np.arange(rows), words)
    per_word = np.maximum(words, 1)
    length = (end - begin).astype(float)
    mean = np.bincount(of, length, rows) / per_word
    spread = np.sqrt(np.maximum(np.bincount(of, length * length, rows) / per_word - mean * mean, 0))
    low = lowered(data)
    hashed = span_hash(prefix_hash(low), begin, end)
    same = np.zeros(len(of), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
    again = np.bincount(of, same, rows) / per_word
    order = np.lexsort((hashed, of))
    new = np.ones(len(of), bool)
    new[1:] = (hashed[order][1:] != hashed[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order], new, rows) / np.maximum(per_word, 1) ** 0.85
    last, head = data[np.maximum(end - 1, 0)] if len(end) else data[:0], data[begin] if len(begin) else data[:0]
    odd_end = np.bincount(of, (_CLASS_OF[last] == list(_CLASSES).index("symbol")) & (length > 1), rows) / per_word
    lone = np.bincount(of, (length == 1) & (_CLASS_OF[head] >= list(_CLASSES).index("stop")), rows) / per_word
    loud = np.bincount(of, (_CLASS_OF[head] == 1) & (_CLASS_OF[data[np.minimum(begin + 1, len(data) - 1)]] == 1) if len(begin) else same, rows) / per_word
    long_word = np.bincount(of, length > 18, rows) / per_word
    shape = np.stack(
        [np.log1p(words) / 10, mean / 10, spread / 10, again, distinct, odd_end, lone, loud, long_word, words > 0], axis=1
    )
    dense = np.concatenate([share, shape], axis=1)
    return np.concatenate([dense, np.sqrt(np.abs(dense)), dense * dense], axis=1).astype(np.float32)


WIDTH = features(pa.array(["a"])).shape[1]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk with the logistic loss; whole-sample steps, so equal input gives an equal model."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), 1.0 / np.maximum(both.std(axis=0), 1e-4)
    xp, xu = (np.clip((x - mean) * scale, -8, 8) for x in (positive, unlabelled))
    w, b = np.zeros(both.shape[1]), 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        gp, gu = _sigmoid(xp @ w + b), _sigmoid(xu @ w + b)
        # d softplus(-z) / dz = s - 1 for a positive, d softplus(z) / dz = s for a negative
        plus = np.concatenate([xp.T @ (gp - 1), [(gp - 1).sum()]]) * (prior / len(xp))
        minus = np.concatenate([xu.T @ gu, [gu.sum()]]) / len(xu) - np.concatenate([xp.T @ gp, [gp.sum()]]) * (prior / len(xp))
        risk = np.logaddexp(0, xu @ w + b).mean() - prior * np.logaddexp(0, xp @ w + b).mean()
        gradient = plus + minus if risk >= 0 else -minus
        gradient[:-1] += decay * w
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(mean, scale, w, float(b))


def calibrated(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    """The same ranking with slope and offset set so that scores are probabilities on labelled rows of the folds learned from."""
    z = np.clip((x - model.mean) * model.scale, -8, 8) @ model.weights + model.bias
    a, c = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * z + c)
        g = np.array([((p - y) * z).mean() + 1e-3 * (a - 1), (p - y).mean()])
        v = p * (1 - p)
        h = np.array([[(v * z * z).mean() + 1e-3, (v * z).mean()], [(v * z).mean(), v.mean() + 1e-6]])
        a, c = np.array([a, c]) - np.linalg.solve(h, g)
        a = max(a, 0.05)
    return Model(model.mean, model.scale, model.weights * a, float(model.bias * a + c))


def document_features(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, x): the features of every whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(batch.column("text"))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, WIDTH, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, x array<float>")


def _matrix(df: DataFrame) -> np.ndarray:
    column = df.select("x").toArrow().column("x").combine_chunks()
    return column.flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)


def held_out(doc_id) -> object:
    """Fold 0 of five by the CRC of the id as text; a null id is held out too, as nothing can be known of it."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def _some(df: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows at random by the hash of the id, the same ones every time."""
    share = sample_fraction(df.count(), most)
    return df.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))


def fit(
    rows: DataFrame, labels: DataFrame, positives: int = FIT_POSITIVES, unlabelled: int = FIT_UNLABELLED
) -> Model | None:
    """Model from features (doc_id, x) of all documents and ``labels`` (doc_id, quality).

    The driver gets about ``positives`` trusted rows of label 1, as many labelled rows to estimate the class prior and
    set the scale of scores, and ``unlabelled`` rows without their labels; none of the held-out fold. Rows with
    a null label, and ids with conflicting labels, teach nothing. Without positives there is no model.
    """
    learn = rows.where(~held_out(F.col("doc_id")))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_high"))
        .where(F.col("quality") == F.col("_high"))
        .drop("_high")
    )
    sampled = _some(known, positives)
    judged = rows.join(sampled, "doc_id").select("x", "quality").toArrow()  # bounded by ``positives``
    y = judged.column("quality").to_numpy().astype(float)
    if not y.sum():
        return None
    x = judged.column("x").combine_chunks().flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
    prior = float(np.clip(y.mean(), 0.01, 0.99))
    model = fit_nnpu(x[y == 1], _matrix(_some(learn, unlabelled)), prior)
    return calibrated(model, x, y) if 0 < y.mean() < 1 else model


def score(rows: DataFrame, model: Model | None) -> DataFrame:
    """Adds ``score`` to features (doc_id, x); 0.5 for all without a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
            if model is None:
                value = np.full(len(x), 0.5)
            else:
                z = np.clip((x - model.mean) * model.scale, -8, 8) @ model.weights + model.bias
                value = _sigmoid(z)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``docs``, by a model fitted on the folds not held out.

    Null and empty texts are scored like any other. Repeated rows get equal scores. Other columns are ignored.
    """
    rows = stored(document_features(docs), "features")
    scored = score(rows, fit(rows, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
