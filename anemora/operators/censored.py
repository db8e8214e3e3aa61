"""Weighted censored samples: in-range values, left and right limits, with weights.

A sample is ``(keys, kind, value, weight)`` with ``kind`` one of in/left/right and equal
values merged, which is all the estimators need and much smaller than the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.config import RangeThresholds
from anemora.functions.labels import hard_label, posterior, with_posteriors
from anemora.functions.scalars import is_finite, numeric, ratio

_SMALL = 1e-12


def record_weights(obs: DataFrame, min_confidence: float = 0.5, *, speed: str = "pred_wind_speed",
                   flag: str = "range_flag", confident: str = "range_flag_confident") -> DataFrame:
    """Add ``w_in, w_left, w_right``, the usable speed ``v`` and ``used``.

    A confident record counts fully for its class, any other splits by its posterior.  An
    in-range weight needs a positive speed; ``s_in`` is the same weight without that rule.
    Records whose posteriors vanish keep zero weights and ``used = 0``: dropping them with a
    filter would push the whole expression below every projection and evaluate it again.
    """
    usable = F.when(is_finite(F.col("v")) & (F.col("v") > 0), F.col("v"))
    rows = with_posteriors(obs.withColumn("v", numeric(obs, speed))).withColumns({
        "v": usable, "hard": hard_label(F.col(flag), F.col(confident), posterior(), min_confidence),
        "used": F.col("p_in").isNotNull().cast("double")})

    def weight(name, share):
        return F.when(F.col("used") == 0, 0.0).when(F.col("hard") == name, 1.0).when(
            F.col("hard").isNull(), F.col(share)).otherwise(0.0)

    return rows.withColumns({
        "s_in": weight("in", "p_in"), "w_left": weight("below", "p_below"), "w_right": weight("above", "p_above"),
    }).withColumn("w_in", F.when(F.col("v").isNotNull(), F.col("s_in")).otherwise(0.0)).drop("p_below", "p_in", "p_above")


def censored_sample(obs: DataFrame, bounds: RangeThresholds = RangeThresholds(), min_confidence: float = 0.5,
                    keys: Sequence[str] = ("node_id",), **columns) -> DataFrame:
    """Records to a sample.  Two aggregates with partial steps; the first merges equal speeds."""
    keys = list(keys)
    lower = max(bounds.lower, _SMALL)
    upper = max(bounds.upper, lower + _SMALL)
    by_value = record_weights(obs, min_confidence, **columns).groupBy(*keys, "v").agg(
        F.sum("w_in").alias("i"), F.sum("w_left").alias("l"), F.sum("w_right").alias("r"))
    part = F.array(
        F.struct(F.lit("in").alias("kind"), F.col("v").alias("value"), F.col("i").alias("weight")),
        F.struct(F.lit("left").alias("kind"), F.lit(lower).alias("value"), F.col("l").alias("weight")),
        F.struct(F.lit("right").alias("kind"), F.lit(upper).alias("value"), F.col("r").alias("weight")))
    return (
        by_value.select(*keys, F.explode(part).alias("p")).select(*keys, "p.*")
        .where((F.col("weight") > 0) & F.col("value").isNotNull())
        .groupBy(*keys, "kind", "value").agg(F.sum("weight").alias("weight"))
    )


def censored_by_speed(series: DataFrame, speed: str, bounds: RangeThresholds | None, keys: Sequence[str] = (),
                      weight: str | None = None) -> DataFrame:
    """Sample of a series without posteriors: strictly outside the bounds is censored at them.

    ``weight`` says how often a row counts, once without it.
    """
    v = F.col(speed)
    rows = series.where(is_finite(v) & (v > 0))
    if bounds is None:
        kind, value = F.lit("in"), v
    else:
        kind = F.when(v < bounds.lower, "left").when(v > bounds.upper, "right").otherwise("in")
        value = F.greatest(F.lit(bounds.lower), F.least(F.lit(bounds.upper), v))
    return rows.groupBy(*keys, kind.alias("kind"), value.alias("value")).agg(
        (F.count(F.lit(1)).cast("double") if weight is None else F.sum(weight)).alias("weight"))


def sample_totals(sample: DataFrame, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    def of(kind):
        return F.sum(F.when(F.col("kind") == kind, F.col("weight")).otherwise(0.0)).alias(f"{kind}_weight")

    return sample.groupBy(*keys).agg(of("in"), of("left"), of("right"), F.sum("weight").alias("total_weight"))


def selection_summary(obs: DataFrame, min_confidence: float = 0.5, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    """Label weights that decide on the non-parametric fallback.

    Unlike the sample, an in-range label without a speed still counts as in range.
    """
    rows = record_weights(obs, min_confidence)
    out = rows.groupBy(*keys).agg(
        F.sum("used").alias("total_observations"),
        F.sum("w_left").alias("__below"), F.sum("s_in").alias("__in"), F.sum("w_right").alias("__above"))
    total = F.col("total_observations")
    return out.select(
        *keys, "total_observations",
        ratio(F.col("__below") + F.col("__above"), total).alias("censored_ratio"),
        ratio(F.col("__below"), total).alias("below_ratio"), ratio(F.col("__in"), total).alias("in_ratio"))
