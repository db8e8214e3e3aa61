"""Censored Weibull maximum likelihood per key.

The climb is written once, as a generator that asks for likelihood values at a batch of
points and decides where to go.  Two things can answer: numpy inside a grouped task, for
keys whose distinct values fit one task, or one Spark aggregate per round for the rest,
where every hot key's rows stay spread over the cluster and only two numbers per point
come back.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemora.operators.censored import sample_totals
from anemora.operators.grouped import hot_keys, spread
from anemora.session import checkpoint_ready

# Bounds of the search and its stopping rules.
SHAPE_BOUNDS = (0.3, 12.0)
SCALE_BOUNDS = (0.5, 40.0)
MAX_ITERATIONS = 200
TOLERANCE = 1e-6
FIRST_STEP = 0.05
SMALLEST_STEP = 1e-6
FLOOR = 1e-12
MESSAGES = {
    "support": "Insufficient in-range support for the parametric fit.",
    "gradient": "Gradient norm below tolerance.",
    "stalled": "Line search stalled; returning last iterate.",
    "limit": "Maximum iterations reached without convergence.",
}

MAX_VALUES_PER_TASK = 250_000
_STEPS = [FIRST_STEP * 0.5**i for i in range(64) if FIRST_STEP * 0.5**i >= SMALLEST_STEP]

FIT_FIELDS = (
    "weibull_shape double, weibull_scale double, weibull_log_likelihood double, weibull_success boolean, "
    "weibull_reliable boolean, weibull_iterations long, weibull_gradient_norm double, "
    "weibull_last_step_size double, weibull_message string"
)


@dataclass(frozen=True)
class Moments:
    weight: float
    first: float
    second: float

    def start(self) -> tuple[float, float]:
        """Shape from the coefficient of variation, scale from the mean."""
        if self.weight <= 0:
            return 2.0, 9.0
        mean = self.first / self.weight
        spread = max(self.second - self.weight * mean * mean, 0.0) / max(self.weight, 1.0)
        variation = math.sqrt(max(spread, FLOOR)) / mean
        shape = min(max(variation**-1.086 if variation > 0 else 3.0, 0.5), 6.0)
        return shape, max(mean / max(math.gamma(1.0 + 1.0 / shape), FLOOR), 1.0)


Point = tuple[float, float]  # log shape, log scale
Climb = Generator[list[Point], np.ndarray, tuple]


def climb(moments: Moments) -> Climb:
    """Gradient ascent in log space with step halving.

    Yields points, receives rows ``(value, d/dlog shape, d/dlog scale)``, returns the fit.
    """
    def inside(k: float, s: float) -> Point:
        return (min(max(k, math.log(SHAPE_BOUNDS[0])), math.log(SHAPE_BOUNDS[1])),
                min(max(s, math.log(SCALE_BOUNDS[0])), math.log(SCALE_BOUNDS[1])))

    shape, scale = moments.start()
    here = inside(math.log(shape), math.log(scale))
    value, gk, gs = (yield [here])[0]
    step_taken = 0.0

    def result(kind: str, iterations: int):
        converged = kind != "limit"
        return (math.exp(here[0]), math.exp(here[1]), float(value), converged, converged, iterations,
                float(math.hypot(gk, gs)), step_taken, MESSAGES[kind])

    for iteration in range(1, MAX_ITERATIONS + 1):
        if math.hypot(gk, gs) < TOLERANCE:
            return result("gradient", iteration)
        tries = [inside(here[0] + step * gk, here[1] + step * gs) for step in _STEPS]
        answers = yield tries
        better = np.flatnonzero(answers[:, 0] >= value)
        if better.size == 0:
            # Every later round would retry a subset of the same failed steps with half the
            # first step, until that step is too small as well.
            last = iteration + len(_STEPS) - 1
            return result("stalled", last) if last <= MAX_ITERATIONS else result("limit", MAX_ITERATIONS)
        pick = int(better[0])
        here, step_taken = tries[pick], _STEPS[pick]
        value, gk, gs = answers[pick]
    return result("limit", MAX_ITERATIONS)


# -- likelihood in numpy ---------------------------------------------------------
class Sample:
    """A sample in arrays.  A likelihood needs only two sums over the in-range values per shape."""

    def __init__(self, kind: np.ndarray, value: np.ndarray, weight: np.ndarray) -> None:
        inside = kind == "in"
        self.log, self.weight = np.log(value[inside]), weight[inside]
        self.weight_log = self.weight * self.log
        self.total, self.total_log = float(self.weight.sum()), float(self.weight_log.sum())
        self.moments = Moments(self.total, float(np.dot(self.weight, value[inside])),
                               float(np.dot(self.weight, value[inside] ** 2)))
        self.sides = {side: (np.log(value[kind == side]), weight[kind == side]) for side in ("left", "right")}

    def likelihood(self, points: Sequence[Point]) -> np.ndarray:
        """Weighted log-likelihood and log-space gradient at each point."""
        out = np.zeros((len(points), 3))
        for row, (log_k, log_s) in enumerate(points):
            k = math.exp(log_k)
            with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                u = np.exp(k * (self.log - log_s))
                mass, mass_log = float(np.dot(self.weight, u)), float(np.dot(self.weight_log, u))
                reach = self.total_log - self.total * log_s
                ll = self.total * (log_k - log_s) + (k - 1.0) * reach - mass
                dk = self.total + k * (reach - (mass_log - log_s * mass))
                ds = k * (mass - self.total)
                r, w = self.sides["left"][0] - log_s, self.sides["left"][1]
                u = np.exp(k * r)
                below = np.maximum(-np.expm1(-u), FLOOR)
                pull = np.exp(-u) * u / below
                ll += float(np.dot(w, np.log(below)))
                dk += float(np.dot(w, pull * k * r))
                ds -= float(np.dot(w, pull * k))
                r, w = self.sides["right"][0] - log_s, self.sides["right"][1]
                u = np.exp(k * r)
                ll -= float(np.dot(w, u))
                dk -= float(np.dot(w, u * k * r))
                ds += float(np.dot(w, u * k))
            out[row] = ll, dk, ds
        return out


def fit_arrays(kind: np.ndarray, value: np.ndarray, weight: np.ndarray, min_in_weight: float) -> tuple:
    """Fit one sample held in arrays."""
    sample = Sample(kind, value, weight)
    if sample.total < min_in_weight or sample.total <= 0:
        return (None, None, None, False, False, 0, 0.0, 0.0, MESSAGES["support"])
    steps = climb(sample.moments)
    points = next(steps)
    while True:
        try:
            points = steps.send(sample.likelihood(points))
        except StopIteration as done:
            return done.value


# -- likelihood in Spark ---------------------------------------------------------
def _likelihood_columns() -> dict[str, F.Column]:
    w, k, log_k, log_s = F.col("weight"), F.exp("log_k"), F.col("log_k"), F.col("log_s")
    r = F.ln("value") - log_s
    u = F.exp(k * r)
    below = F.greatest(-F.expm1(-u), F.lit(FLOOR))
    pull = F.exp(-u) * u / below
    kind = F.col("kind")
    return {
        "ll": F.when(kind == "in", log_k - log_s + (k - 1.0) * r - u).when(kind == "left", F.ln(below)).otherwise(-u) * w,
        "dk": F.when(kind == "in", 1.0 + k * r * (1.0 - u)).when(kind == "left", pull * k * r).otherwise(-u * k * r) * w,
        "ds": F.when(kind == "in", k * (u - 1.0)).when(kind == "left", -pull * k).otherwise(u * k) * w,
    }


def likelihood_at(sample: DataFrame, shape: float, scale: float, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    """Log-likelihood and log-space gradient of given parameters, per key."""
    if shape <= 0 or scale <= 0:
        raise ValueError("shape and scale must be positive")
    given = sample.where((F.col("weight") > 0) & (F.col("value") > 0)).withColumns(
        {"log_k": F.lit(math.log(shape)), "log_s": F.lit(math.log(scale))})
    names = {"ll": "log_likelihood", "dk": "gradient_log_shape", "ds": "gradient_log_scale"}
    return given.groupBy(*keys).agg(
        *[F.sum(c).alias(names[n]) for n, c in _likelihood_columns().items()], F.sum("weight").alias("total_weight"))


def _fit_spread(sample: DataFrame, keys: list[str], min_in_weight: float) -> DataFrame:
    """Fit keys too large for one task; all of them advance together, one aggregate per round."""
    spark = sample.sparkSession
    checkpoint_ready(spark)
    held = sample.checkpoint()
    inside = held.where((F.col("kind") == "in")).groupBy(*keys).agg(
        F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("value")).alias("v"),
        F.sum(F.col("weight") * F.col("value") * F.col("value")).alias("vv"))
    # One row per hot key: at most rows / MAX_VALUES_PER_TASK of them.
    climbs, requests, fits = {}, {}, {}
    for row in held.select(*keys).distinct().join(inside, keys, "left").collect():
        key = tuple(row[c] for c in keys)
        if row["w"] is None or row["w"] < min_in_weight:
            fits[key] = (None, None, None, False, False, 0, 0.0, 0.0, MESSAGES["support"])
            continue
        climbs[key] = climb(Moments(row["w"], row["v"], row["vv"]))
        requests[key] = next(climbs[key])
    key_schema = T.StructType([held.schema[c] for c in keys])
    point_schema = T.StructType([*key_schema.fields, T.StructField("point", T.IntegerType()),
                                 T.StructField("log_k", T.DoubleType()), T.StructField("log_s", T.DoubleType())])
    sums = [F.sum(c).alias(n) for n, c in _likelihood_columns().items()]
    while requests:
        points = spark.createDataFrame(
            [(*key, i, float(p[0]), float(p[1])) for key, asked in requests.items() for i, p in enumerate(asked)],
            point_schema)
        answers = {key: np.zeros((len(asked), 3)) for key, asked in requests.items()}
        for row in held.join(F.broadcast(points), keys).groupBy(*keys, "point").agg(*sums).collect():
            answers[tuple(row[c] for c in keys)][row["point"]] = row["ll"], row["dk"], row["ds"]
        asked_next = {}
        for key, answer in answers.items():
            try:
                asked_next[key] = climbs[key].send(answer)
            except StopIteration as done:
                fits[key] = done.value
        requests = asked_next
    schema = T.StructType([*key_schema.fields, *T._parse_datatype_string(FIT_FIELDS).fields])
    return spark.createDataFrame([(*key, *fit) for key, fit in fits.items()], schema)


def fit_weibull(sample: DataFrame, keys: Sequence[str] = ("node_id",), min_in_weight: float = 500.0,
                max_values: int | None = MAX_VALUES_PER_TASK) -> DataFrame:
    """One fit per key.

    Keys with more than ``max_values`` distinct values are counted first and fitted without
    ever gathering their rows.  ``max_values=None`` states that the caller has a bound.
    """
    keys = list(keys)
    key_fields = ", ".join(f"{c} {sample.schema[c].dataType.simpleString()}" for c in keys)
    width = len(keys)

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        answer = fit_arrays(rows["kind"].to_numpy(), rows["value"].to_numpy(float), rows["weight"].to_numpy(float),
                            min_in_weight)
        names = [f.strip().split(" ")[0] for f in f"{key_fields}, {FIT_FIELDS}".split(",")]
        return pd.DataFrame([(*key[:width], *answer)], columns=names)

    def gathered(rows: DataFrame) -> DataFrame:
        return spread(rows, *keys).groupBy(*keys).applyInPandas(fit, f"{key_fields}, {FIT_FIELDS}")

    hot = hot_keys(sample, keys, max_values)
    if hot is None:
        fits = gathered(sample)
    else:
        heavy = hot.select(*keys)
        fits = gathered(sample.join(heavy, keys, "left_anti")).unionByName(
            _fit_spread(sample.join(heavy, keys, "left_semi"), keys, min_in_weight))
    totals = sample_totals(sample, keys).select(
        *keys, F.col("in_weight").alias("weibull_in_weight"), F.col("left_weight").alias("weibull_left_weight"),
        F.col("right_weight").alias("weibull_right_weight"))
    return fits.join(totals, keys)
