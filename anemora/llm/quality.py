"""Quality scores by positive-unlabelled learning with the non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import Words, slices, text_bytes

#: Most rows of each kind that a model is fitted to.
POSITIVES, UNLABELLED = 4_000, 8_000

# Classes of bytes; each mark that prose rarely repeats has one of its own.
_MARKS = "#$%&*!|"
_NAMES = ("space", "line", "lower", "upper", "digit", "stop", "other", "wide", *_MARKS)
_CLASS = np.full(256, _NAMES.index("other"), np.int64)
_CLASS[[9, 11, 12, 32]] = 0
_CLASS[[10, 13]] = 1
_CLASS[ord("a"):ord("z") + 1] = 2
_CLASS[ord("A"):ord("Z") + 1] = 3
_CLASS[ord("0"):ord("9") + 1] = 4
_CLASS[[ord(c) for c in ".,;:?"]] = 5
_CLASS[128:] = 7
for _i, _mark in enumerate(_MARKS):
    _CLASS[ord(_mark)] = 8 + _i
_N = len(_NAMES)

_LINES = np.zeros(256, bool)
_LINES[[10, 13]] = True

DENSE = 8
WIDTH = _N + _N * _N + DENSE


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: square roots of the shares of byte classes and of neighbouring classes, and word and line measures."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), np.float32)
    if not len(raw):
        out[:, WIDTH - DENSE + 6] = 1
        return out
    size = np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    kind = _CLASS[raw]
    out[:, :_N] = np.bincount(text * _N + kind, minlength=n * _N).reshape(n, _N)
    same = text[1:] == text[:-1]
    pair = (text[1:] * _N + kind[:-1]) * _N + kind[1:]
    out[:, _N:_N + _N * _N] = np.bincount(pair[same], minlength=n * _N * _N).reshape(n, -1)
    out[:, :_N + _N * _N] = np.sqrt(out[:, :_N + _N * _N] / np.maximum(size, 1)[:, None])
    words, lines = Words(raw, offsets), Words(raw, offsets, _LINES)
    count, rows = words.counts, lines.counts
    long = np.zeros(n)
    some = np.flatnonzero(count)
    if len(some):
        long[some] = np.add.reduceat(words.end - words.start, words.first[some]) / count[some]
    dense = out[:, -DENSE:]
    dense[:, 0] = np.log1p(count) / 10
    dense[:, 1] = long / 20
    dense[:, 2] = np.log1p(rows) / 10
    dense[:, 3] = np.minimum(rows / np.maximum(count, 1), 1)
    dense[:, 4] = np.where(count > 0, 1 - _distinct(words) / np.maximum(count, 1), 0)
    dense[:, 5] = np.where(rows > 0, 1 - _distinct(lines) / np.maximum(rows, 1), 0)
    dense[:, 6] = (count == 0)
    dense[:, 7] = np.minimum(long / 200, 1)
    return out


def _distinct(words: Words) -> np.ndarray:
    """Different words per text."""
    text = np.repeat(np.arange(len(words.counts), dtype=np.uint64), words.counts)
    codes = np.sort(text << np.uint64(40) | words.hashes() >> np.uint64(24))
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    return np.bincount((codes[new] >> np.uint64(40)).astype(np.int64), minlength=len(words.counts))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    centre: np.ndarray
    spread: np.ndarray
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((rows - self.centre) / self.spread, -8, 8) @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _train(positive: np.ndarray, unlabelled: np.ndarray, slope, rounds: int, rate: float = 0.05, decay: float = 1e-3):
    """Adam over whole sets; ``slope`` gives the derivative of the risk by each row's margin."""
    weights, bias = np.zeros(positive.shape[1]), 0.0
    first, second = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    for step in range(1, rounds + 1):
        zp, zu = positive @ weights + bias, unlabelled @ weights + bias
        gp, gu = slope(zp, zu)
        grad = np.append(gp @ positive + gu @ unlabelled + decay * weights, gp.sum() + gu.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, bias


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = 200) -> float:
    """Share of positives among the unlabelled, from the scores at which positives are most outnumbered.

    A classifier tells positives from unlabelled rows on one half of each.  On the other half, the
    unlabelled mass above a threshold over the positive mass above it bounds the prior; the threshold
    with the least bound, with allowance for small counts, gives the estimate.
    """
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    n, m = len(positive[::2]), len(unlabelled[::2])

    def slope(zp, zu):
        return -_sigmoid(-zp) / n, _sigmoid(zu) / m

    weights, bias = _train(positive[::2], unlabelled[::2], slope, rounds)
    zp, zu = np.sort(positive[1::2] @ weights + bias), np.sort(unlabelled[1::2] @ weights + bias)
    above_p = 1 - np.arange(len(zp)) / len(zp)
    above_u = 1 - np.searchsorted(zu, zp) / len(zu)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(zp)) + 1 / np.sqrt(len(zu)))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, rounds: int = 600) -> Model:
    """Minimise ``prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])`` with the logistic loss.

    Where the estimated risk of the negatives falls below zero, its gradient is followed
    backwards, as the non-negative estimator does.
    """
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(WIDTH), 0.0, np.zeros(WIDTH), np.ones(WIDTH), 0.5)
    centre, spread = both.mean(axis=0), both.std(axis=0)
    spread[spread < 1e-6] = 1.0
    p, u = (np.clip((x - centre) / spread, -8, 8) for x in (positive, unlabelled))
    prior = estimate_prior(p, u) if prior is None else prior

    def slope(zp, zu):
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        down_p, down_u = -prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
        if negative >= 0:
            return -prior * _sigmoid(-zp) / len(zp) + down_p, down_u
        return -down_p, -down_u

    weights, bias = _train(p, u, slope, rounds)
    return Model(weights, float(bias), centre, spread, prior)


def sample_features(df: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Features of at most ``limit`` rows, drawn by a hash of the key."""
    count = df.count()
    part = min(1.0, 1.2 * limit / max(count, 1))
    drawn = df.where(F.pmod(F.xxhash64(key, F.lit("quality")), F.lit(1_000_000)) < part * 1_000_000).select(
        F.xxhash64(key, F.lit("order")).alias("turn"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                rows = features(*text_bytes(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("turn"), pa.array([r.tobytes() for r in rows], pa.binary())], ["turn", "row"])

    found = drawn.mapInArrow(work, "turn bigint, row binary").orderBy("turn", "row").limit(limit).collect()
    return np.array([np.frombuffer(r["row"], np.float32) for r in found], np.float32).reshape(-1, WIDTH)


def train(df: DataFrame, labels: DataFrame, learnable: Column, key: str = "doc_id", text: str = "text", quality: str = "quality",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on trusted positives and unlabelled rows, both among the ``learnable`` rows.  Negative labels are not read."""
    pool = df.where(learnable).select(key, text)
    trusted = labels.where(F.col(quality) == 1).select(F.col(key).alias("__trusted")).distinct()
    good = pool.join(trusted, F.col(key) == F.col("__trusted"), "left_semi")
    return fit(sample_features(good, positives, key, text), sample_features(pool, unlabelled, key, text))


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """The frame with the score of every whole text in ``into``: between 0 and 1, higher for likelier quality.

    Null texts score as empty ones, which have a score like others; repeated texts score alike; no rows give
    no rows.  A column named like ``into`` is replaced, others are carried along.
    """
    df = df.drop(into)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text, 4 << 20):
                found = model.score(features(*text_bytes(piece.column(text))))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(found.astype(np.float64))], [*piece.schema.names, into])

    return df.mapInArrow(work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{into}` double")
