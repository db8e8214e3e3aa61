"""Weighted Kaplan-Meier estimate as running sums over the distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.config import KaplanMeierCriteria, PowerCurve
from anemora.functions.scalars import curve_kw, fixed
from anemora.operators.ordered import MAX_ROWS_PER_RANGE, order_rows

_EPS = 1e-12


def kaplan_meier(sample: DataFrame, keys: Sequence[str] = ("node_id",),
                 max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Step function ``(keys, t, cdf, survival, mass)`` at every event value.

    Left-censored weight is an event at the smallest left limit.  Right-censored weight
    leaves the risk set at its limit, after the events there.  The product of the survival
    factors is a running sum of logarithms; a factor of zero is tracked separately.
    """
    keys = list(keys)
    # Left-censored rows sit at a few limits per key; their weight moves to the smallest one.
    left = (
        sample.where(F.col("kind") == "left").groupBy(*keys)
        .agg(F.min("value").alias("value"), F.sum("weight").alias("weight")).withColumn("kind", F.lit("left"))
    )
    rows = sample.where(F.col("kind") != "left").select(*keys, "kind", "value", "weight").unionByName(
        left.select(*keys, "kind", "value", "weight"))
    censored = F.col("kind") == "right"
    timeline = rows.groupBy(*keys, "value").agg(
        F.sum(F.when(censored, 0.0).otherwise(F.col("weight"))).alias("ev"),
        F.sum(F.when(censored, F.col("weight")).otherwise(0.0)).alias("ce"))
    gone = F.col("ev") + F.col("ce")
    ordered = order_rows(timeline, keys, ["value"], max_rows=max_rows, hold=True)
    ordered = ordered.running_sum(__gone=gone).totals(__all_weight=F.sum(gone))
    at_risk = F.greatest(F.col("__all_weight") - (F.col("__gone") - gone), F.lit(0.0))
    hazard = F.when(at_risk > 0, F.least(F.lit(1.0), F.col("ev") / F.greatest(at_risk, F.lit(_EPS)))).otherwise(0.0)
    ordered = ordered.with_column("__hazard", hazard)
    # What remains at the end is zero up to rounding when everything has left the risk set.
    closes = F.col("__hazard") >= 1.0 - 1e-12
    log_factor = F.when(closes, 0.0).otherwise(F.log1p(-F.col("__hazard")))
    ordered = ordered.running_sum(__log=log_factor, __dead=F.when(closes, 1).otherwise(0))
    before = F.when(F.col("__dead") - F.when(closes, 1).otherwise(0) > 0, 0.0).otherwise(F.exp(F.col("__log") - log_factor))
    survival = F.when(F.col("__dead") > 0, 0.0).otherwise(F.exp("__log"))
    return ordered.dataframe().where(F.col("ev") > 0).select(
        *keys, F.col("value").alias("t"), (1.0 - survival).alias("cdf"), survival.alias("survival"),
        (before - survival).alias("mass"))


def km_quantile(p: float) -> Column:
    """Aggregate: left-most step reaching ``p``; null inside the unresolved right tail."""
    return F.min(F.when(F.col("cdf") + _EPS >= p, F.col("t")))


def km_summary(steps: DataFrame, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    return steps.groupBy(*keys).agg(
        km_quantile(0.5).alias("km_p50"), km_quantile(0.9).alias("km_p90"), km_quantile(0.99).alias("km_p99"),
        F.min("survival").alias("right_tail_probability"))


def km_power(steps: DataFrame, keys: Sequence[str] = ("node_id",), *, curve: PowerCurve = PowerCurve(),
             air_density: float = 1.225, tail_speed: float | None = None, scale: float = 1.0) -> DataFrame:
    """Power density and expected turbine output of the step distribution.

    The unresolved tail sits at ``tail_speed``, or contributes nothing without one.  Sums
    with a partial step, so one pass over the steps.
    """
    if air_density <= 0:
        raise ValueError("air_density must be positive")
    v = F.col("t") * scale
    moments = steps.groupBy(*keys).agg(
        F.sum(F.col("mass") * F.pow(v, F.lit(3))).alias("__cubes"),
        F.sum(F.col("mass") * curve_kw(v, curve, air_density)).alias("__kw"),
        F.min("survival").alias("tail_probability"))
    tail = F.greatest(F.col("tail_probability"), F.lit(0.0))
    if tail_speed is None:
        cubes, kw = F.col("__cubes"), F.col("__kw")
    else:
        far = F.lit(tail_speed * scale)
        cubes = F.col("__cubes") + tail * F.pow(far, F.lit(3))
        kw = F.col("__kw") + tail * curve_kw(far, curve, air_density)
    return moments.select(
        *keys, F.when(cubes > 0, 0.5 * air_density * cubes).alias("power_density_w_m2"),
        kw.alias("turbine_mean_power_kw"), (kw / curve.rated_kw).alias("capacity_factor"), "tail_probability")


def selection(table: DataFrame, criteria: KaplanMeierCriteria = KaplanMeierCriteria()) -> DataFrame:
    """Whether the fallback applies to a row of ratios, and why."""
    c = criteria
    total = F.coalesce("total_observations", F.lit(0)).cast("double")
    censored = F.coalesce("censored_ratio", F.lit(0.0))
    below = F.coalesce("below_ratio", F.lit(0.0))
    valid = F.coalesce("valid_count", F.lit(0)).cast("double")
    share = F.try_divide(valid, total)
    reasons = F.array_compact(F.array(
        F.when(censored >= c.min_total_censored_ratio,
               F.concat(F.lit("censored ratio "), fixed(censored, 3), F.lit(f" ≥ {c.min_total_censored_ratio:.2f}"))),
        F.when(below >= c.min_below_ratio,
               F.concat(F.lit("below ratio "), fixed(below, 3), F.lit(f" ≥ {c.min_below_ratio:.2f}"))),
        F.when(share <= c.max_valid_share,
               F.concat(F.lit("in-range share "), fixed(share, 3), F.lit(f" ≤ {c.max_valid_share:.2f}"))),
        F.when(valid <= c.min_uncensored_weight,
               F.concat(F.lit("uncensored weight "), fixed(valid, 0), F.lit(f" ≤ {c.min_uncensored_weight:.0f}"))),
    ))
    enough = total >= c.min_total_observations
    return table.withColumn(
        "selection_reasons", F.when(enough, reasons).otherwise(F.array().cast("array<string>"))
    ).withColumn("km_selected", F.size("selection_reasons") > 0)


def step_cdf_at(steps: DataFrame, grid: Sequence[float], keys: Sequence[str] = ("node_id",),
                max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """The step CDF on a fixed grid.

    Grid points are stacked among the steps and take the last step at or before them.
    """
    keys = list(keys)
    points = steps.select(*keys).distinct().select(
        *keys, F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("t"), F.lit(1).alias("side"),
        F.lit(None).cast("double").alias("cdf"))
    both = steps.select(*keys, "t", F.lit(0).alias("side"), "cdf").unionByName(points)
    filled = order_rows(both, keys, ["t", "side"], max_rows=max_rows).last_known(__cdf=F.col("cdf")).dataframe()
    return filled.where("side = 1").select(*keys, F.col("t").alias("speed"), F.coalesce("__cdf", F.lit(0.0)).alias("cdf"))


def category_curves(steps: DataFrame, categories: DataFrame, category: str, grid: Sequence[float]) -> DataFrame:
    """Mean step CDF per category on a grid, with the mean tail probability."""
    points = step_cdf_at(steps, grid).join(categories.select("node_id", category), "node_id")
    tails = steps.groupBy("node_id").agg(F.min("survival").alias("tail"))
    return points.join(tails, "node_id").groupBy(category, "speed").agg(
        F.avg("cdf").alias("mean_cdf"), F.avg("tail").alias("mean_tail_probability"), F.count(F.lit(1)).alias("nodes"))
