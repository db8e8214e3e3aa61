"""Special functions Spark SQL lacks, as expressions; log-gamma also in numpy for code that already runs in a task."""

from __future__ import annotations

import math

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos coefficients (g = 7, n = 9).
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Γ(x) for x > 0; small arguments go through Γ(x) = Γ(x + 1) / x."""
    x = np.asarray(x, dtype=float)
    small = x < 0.5
    z = np.where(small, x + 1.0, x) - 1.0
    series = np.full_like(z, _LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], start=1):
        series = series + c / (z + i)
    t = z + 7.5
    out = 0.5 * math.log(2 * math.pi) + (z + 0.5) * np.log(t) - t + np.log(series)
    return np.where(small, out - np.log(np.where(small, x, 1.0)), out)


def log_gamma_of(x: Column) -> Column:
    """``log_gamma`` as an expression, so that it stays in the generated code."""
    small = x < 0.5
    z = F.when(small, x).otherwise(x - 1.0)
    series = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], start=1):
        series = series + F.lit(c) / (z + float(i))
    t = z + 7.5
    out = F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(series)
    return F.when(small, out - F.ln(x)).otherwise(out)


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def gamma_p_of(a: Column, x: Column) -> Column:
    """Regularised lower incomplete gamma for a > 0: power series below a + 1, continued fraction above; zero for x <= 0.

    Series and fraction are summed from their far end, whose distance grows with the root of ``a``, so
    they hold for any shape.
    """
    def value(p: Column) -> Column:
        a, x, root = p["a"], p["x"], F.sqrt(p["a"])
        front = F.exp(a * F.ln(x) - x - log_gamma_of(a))
        far = lambda n, slope: F.sequence((n + slope * root).cast("int"), F.lit(1), F.lit(-1))
        series = F.aggregate(far(30.0, 9.0), F.lit(1.0), lambda s, i: 1.0 + s * x / (a + i)) / a
        rest = F.aggregate(far(100.0, 10.0), F.lit(0.0), lambda s, i: i * (i - a) / (x + 2.0 * i + 1.0 - a - s))
        inside = F.when(x < a + 1.0, front * series).otherwise(1.0 - front / (x + 1.0 - a - rest))
        return F.when(x > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), inside))).when(x.isNotNull(), 0.0)

    return F.when(a.isNotNull(), _bound(F.struct(a.cast("double").alias("a"), x.cast("double").alias("x")), value))


def normal_cdf_of(z: Column) -> Column:
    """Distribution function of the normal law: a series within three deviations, a continued fraction beyond, so that tails keep their digits."""
    def value(z: Column) -> Column:
        x, square = F.abs(z), z * z
        series, fraction = F.lit(1.0), x
        for i in range(40, 0, -1):
            series = 1.0 + series * square / (2.0 * i + 1.0)
            fraction = x + float(i) / fraction
        density = F.exp(-0.5 * square) / math.sqrt(2 * math.pi)
        tail = density / fraction
        return F.when(x < 3.0, 0.5 + density * z * series).when(z > 0, 1.0 - tail).otherwise(tail)

    return _bound(z.cast("double"), value)


def gamma_cdf_of(x: Column, shape: Column, scale: Column) -> Column:
    return gamma_p_of(shape, x / scale)
