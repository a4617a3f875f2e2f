"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all it learns from; negative
labels are never read. A first classifier separates positives from unlabelled
text, and the class prior is the smallest ratio of the two score
distributions above a threshold (where only positives are left, the ratio is
the prior). The second minimises the non-negative unbiased risk

    prior * R+(f, positives) + max(0, R-(f, unlabelled) - prior * R-(f, positives))

with logistic loss by full-batch gradient steps. Its output becomes a
probability of quality by the same identity that gave the prior, prior *
density(positives) / density(unlabelled), made monotone. The inputs are statistics of the
whole text, each cut at quantiles into one-hot bins (an additive model).

Fitting reads at most ``MAX_ROWS`` positives and ``MAX_ROWS`` unlabelled rows,
those with the smallest hash of the id; scoring covers every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import chunks, encode, shingles, words

MAX_ROWS = 15_000
BINS = 12
_CLASS = np.zeros((8, 256), np.float32)
_CLASS[0, 0x41:0x5B] = 1  # upper case
_CLASS[1, 0x30:0x3A] = 1  # digits
_CLASS[2, [ord(c) for c in "#*$%&|<>{}[]=_~^\\/@+"]] = 1  # symbols
_CLASS[3, [ord(c) for c in ".,;:?'\"-()"]] = 1  # sentence punctuation
_CLASS[4, [0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 1  # spaces
_CLASS[5, 0x0A] = 1  # line ends
_CLASS[6, 0x21] = 1  # exclamation marks
_CLASS[7, 0x80:] = 1  # not ASCII
NAMES = ("upper", "digit", "symbol", "point", "space", "line", "shout", "other", "length", "word_length", "distinct_words", "distinct_shingles", "symbols_a_word", "same_as_before")


def features(texts: list[str | None]) -> np.ndarray:
    """One row of statistics for each whole text."""
    data, starts = encode(texts)
    n = np.maximum(np.diff(starts) - 1, 1).astype(np.float64)
    out = np.zeros((len(texts), len(NAMES)))
    for k in range(8):
        out[:, k] = np.add.reduceat(_CLASS[k][data], starts[:-1], dtype=np.float64)
    out[:, 5] -= 1  # the line end that encode() adds
    out[:, :8] /= n[:, None]
    hashes, counts = words(texts)
    grams, n_grams = shingles(texts)
    out[:, 8] = np.log1p(counts)
    out[:, 9] = n / np.maximum(counts, 1)
    for column, (h, c) in ((10, (hashes, counts)), (11, (grams, n_grams))):
        ends = np.cumsum(c)
        out[:, column] = [len(np.unique(h[e - m : e])) / m if m else 1.0 for e, m in zip(ends, c, strict=True)]
    # Distinct words fall with length by themselves: relative to the square root of it.
    out[:, 10] *= np.sqrt(np.maximum(counts, 1.0))
    out[:, 12] = out[:, 2] * n / np.maximum(counts, 1)
    same = np.concatenate(([0], np.cumsum(hashes[1:] == hashes[:-1]), [0]))  # same[k]: words up to k like the one before
    ends = np.cumsum(counts)
    some = counts > 1
    out[some, 13] = (same[ends - 1] - same[ends - counts])[some] / counts[some]
    return out


def cut_points(x: np.ndarray, bins: int = BINS) -> list[list[float]]:
    return [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])).tolist() for k in range(x.shape[1])]


def one_hot(x: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    parts = [np.eye(len(c) + 1, dtype=np.float32)[np.searchsorted(c, x[:, k], side="left")] for k, c in enumerate(cuts)]
    return np.hstack([*parts, np.ones((len(x), 1), np.float32)])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _adam(gradient, size: int, steps: int = 600, rate: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.4) -> float:
    """The smallest share ratio unlabelled / positive above a score threshold.

    Thresholds above which fewer than ``least`` of the positives lie are too
    noisy to count. The smallest of noisy ratios is too small, so each is
    raised by its standard error, which vanishes as the samples grow.
    """
    at = np.quantile(positive, np.linspace(0, 1 - least, 91))
    u = np.maximum([(unlabelled >= t).mean() for t in at], 1 / len(unlabelled))
    p = np.array([(positive >= t).mean() for t in at])
    error = np.sqrt((1 - u) / (u * len(unlabelled)) + (1 - p) / (p * len(positive)))
    return float(np.clip((u / p * (1 + error)).min(), 0.01, 0.99))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, class prior) of the non-negative risk minimiser over one-hot rows."""
    size = positive.shape[1]

    def separate(w, x_p, x_u):
        p, u = _sigmoid(x_p @ w), _sigmoid(x_u @ w)
        return (x_p.T @ (p - 1)) / len(p) + (x_u.T @ u) / len(u) + 1e-3 * w

    # Each half of the rows is scored by a classifier that has not seen it.
    scores: tuple[list, list] = ([], [])
    halves = [(positive[k::2], unlabelled[k::2]) for k in (0, 1)]
    for k in (0, 1):
        positive_k, unlabelled_k = halves[k]
        if len(positive_k) and len(unlabelled_k):
            first = _adam(lambda w, p=positive_k, u=unlabelled_k: separate(w, p, u), size, steps=200)
            for out, x in zip(scores, halves[1 - k], strict=True):
                out.append(x @ first)
    prior = class_prior(*map(np.concatenate, scores)) if scores[0] else 0.5

    def risk(w):
        p, u = _sigmoid(positive @ w), _sigmoid(unlabelled @ w)
        # Logistic loss: -log(p) for the positive side, -log(1 - p) for the negative one.
        negative = -np.log1p(-np.minimum(u, 1 - 1e-9)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-9)).mean()
        plus = prior * (positive.T @ (p - 1)) / len(p)
        minus = (unlabelled.T @ u) / len(u) - prior * (positive.T @ p) / len(p)
        # Below zero the negative part is overfitted: its gradient is reversed.
        return (plus + minus if negative >= 0 else -minus) + l2 * w

    return _adam(risk, size), prior


def fit(docs: DataFrame, positives: DataFrame, excluded: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model from the ids in ``positives`` and, as unlabelled text, all documents, the positives too.

    The class prior is a share of all documents, so the unlabelled side is
    drawn from all, whatever their label. ``excluded`` ids (held out) are
    read on neither side. Without a positive or an unlabelled row the model is flat: every
    score is 0.5.
    """
    ids = lambda d: d.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    first = lambda d: d.orderBy(F.xxhash64("id"), "id").limit(MAX_ROWS)
    every = docs.select(F.col(id_col).cast("long").alias("id"))
    good = first(ids(positives).join(every.distinct(), "id", "left_semi").join(ids(excluded), "id", "left_anti"))
    rest = first(every.where("id IS NOT NULL").distinct().join(ids(excluded), "id", "left_anti"))
    chosen = good.withColumn("side", F.lit(1)).union(rest.withColumn("side", F.lit(0)))
    # A bounded side: at most 2 * MAX_ROWS pairs of numbers.
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = text.join(F.broadcast(chosen), "id").select("side", "text").mapInArrow(_measured, "side int, x array<double>").toPandas()
    if not len(rows) or rows["side"].nunique() < 2:
        return {"cuts": [[]] * len(NAMES), "weights": [0.0] * (len(NAMES) + 1), "prior": 0.5, "points": None}
    x, side = np.array(rows["x"].tolist()), rows["side"].to_numpy()
    order = np.lexsort((*x.T, side))  # rows come in any order; sums must not depend on it
    x, side = x[order], side[order]
    cuts = cut_points(x)
    hot = one_hot(x, cuts)
    weights, prior = fit_pu(hot[side == 1], hot[side == 0])
    points = calibrate(hot[side == 1] @ weights, hot[side == 0] @ weights, prior)
    return {"cuts": cuts, "weights": weights.tolist(), "prior": prior, "points": points}


def calibrate(positive: np.ndarray, unlabelled: np.ndarray, prior: float, bins: int = 60) -> tuple[list[float], list[float]]:
    """Points (output, probability): prior * density ratio in bins of the outputs, made monotone."""
    edges = np.unique(np.quantile(unlabelled, np.linspace(0, 1, bins + 1)[1:-1]))
    n_u = np.bincount(np.searchsorted(edges, unlabelled), minlength=len(edges) + 1)
    n_p = np.bincount(np.searchsorted(edges, positive), minlength=len(edges) + 1)
    centre = np.concatenate(([edges[0] - 1], (edges[1:] + edges[:-1]) / 2, [edges[-1] + 1]))
    pools: list[list] = []  # [bins, positives, unlabelled] with growing ratios
    for p, u in zip(n_p, n_u, strict=True):
        pools.append([1, p, u])
        while len(pools) > 1 and pools[-2][1] * max(pools[-1][2], 0.5) >= pools[-1][1] * max(pools[-2][2], 0.5):
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    ratio = np.concatenate([[prior * (p / len(positive)) / (max(u, 0.5) / len(unlabelled))] * k for k, p, u in pools])
    return centre.tolist(), np.clip(ratio, 0.0, 1.0).tolist()


def probability(z: np.ndarray, model: dict) -> np.ndarray:
    """Scores in 0..1; outputs between equal probabilities keep their order by a small share of the sigmoid."""
    if not model["points"]:
        return np.full(len(z), model["prior"])
    return 0.98 * np.interp(z, *model["points"]) + 0.02 * _sigmoid(z)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in chunks(batch):
            x = features(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["side", "x"])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of every row, score in 0..1.

    Null texts count as empty; empty texts, null ids and repeated rows give
    their rows; other columns are not read.
    """
    weights = np.array(model["weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch):
                p = probability(one_hot(features(texts), model["cuts"]) @ weights, model)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64())], names=["id", "score"])

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)
