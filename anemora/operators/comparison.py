"""Model observations against a reference series, by dataset and scope.

Scopes are keys of one DataFrame, so each estimator runs once for all of them.  A scope
can hold every row, which the range-cut and spread routes of the estimators allow for.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.config import BootstrapConfig, Height, KaplanMeierCriteria, PowerCurve, RangeThresholds
from anemora.functions.scalars import is_finite, ratio
from anemora.operators.bootstrap import bootstrap_intervals
from anemora.operators.censored import censored_by_speed, censored_sample, sample_totals, selection_summary
from anemora.operators.kaplan_meier import kaplan_meier, km_summary
from anemora.operators.ordered import MAX_ROWS_PER_RANGE
from anemora.operators.power import power_estimates, weibull_mean, weibull_quantile
from anemora.operators.quantiles import linear_quantiles, weighted_step_quantiles
from anemora.session import held

KEYS = ["dataset", "scope"]
_P = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
METRICS = ("mean_speed", "p50", "p90", "p99", "power_density_model")


def observation_scopes(obs: DataFrame, matched: DataFrame) -> DataFrame:
    """Model rows: those matched to the reference, and all of them."""
    columns = ["timestamp", "pred_wind_speed", "prob_range_below", "prob_range_in", "prob_range_above", "range_flag", "range_flag_confident"]
    return (
        matched.select(F.lit("model").alias("dataset"), F.lit("paired").alias("scope"), *columns)
        .unionByName(obs.select(F.lit("model").alias("dataset"), F.lit("global").alias("scope"), *columns))
    )


def reference_scopes(reference: DataFrame, matched: DataFrame, speed: str = "wind_speed", matched_speed: str = "wind_speed_ref") -> DataFrame:
    rows = matched.select(F.lit("paired").alias("scope"), F.col("timestamp"), F.col(matched_speed).alias("speed")).unionByName(
        reference.select(F.lit("global").alias("scope"), "timestamp", F.col(speed).alias("speed")))
    return rows.select(F.lit("reference").alias("dataset"), "*").where(is_finite(F.col("speed")))


def model_rows(scopes: DataFrame, *, bounds: RangeThresholds = RangeThresholds(), min_confidence: float = 0.5,
               height: Height = Height(), min_in_weight: float = 500.0, criteria: KaplanMeierCriteria = KaplanMeierCriteria(),
               curve: PowerCurve = PowerCurve(), air_density: float = 1.225, max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Weighted in-range statistics and model power of the observation scopes."""
    sample = held(censored_sample(scopes, bounds, min_confidence, KEYS))
    summary = selection_summary(scopes, min_confidence, KEYS)
    inside = sample.where(F.col("kind") == "in").select(
        *KEYS, (F.col("value") * height.scale).alias("__value"), F.col("weight").alias("__weight"))
    means = inside.groupBy(*KEYS).agg((F.sum(F.col("__value") * F.col("__weight")) / F.sum("__weight")).alias("mean_speed"))
    quantiles = weighted_step_quantiles(inside, KEYS, _P, max_rows=max_rows)
    # The summary has no valid count: it counts as zero in the choice of method.
    power = power_estimates(sample, summary.withColumn("valid_count", F.lit(0.0)), KEYS, curve=curve, air_density=air_density,
                            tail_speed=bounds.upper, min_in_weight=min_in_weight, criteria=criteria, height=height, max_rows=max_rows)
    power = power.select(*KEYS, "method", F.col("power_density_w_m2").alias("power_density_model"), "kaplan_meier_selection_reasons")
    blank = F.lit(None).cast("double")
    return summary.join(means, KEYS, "left").join(quantiles, KEYS, "left").join(power, KEYS, "left").withColumns(
        {f"{m}_model": blank for m in ("mean_speed", *_P)})


def reference_rows(scopes: DataFrame, *, bounds: RangeThresholds = RangeThresholds(), height: Height = Height(),
                   min_in_weight: float = 500.0, criteria: KaplanMeierCriteria = KaplanMeierCriteria(),
                   curve: PowerCurve = PowerCurve(), air_density: float = 1.225,
                   max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Sample statistics and model statistics of the reference: paired, global, and global censored at the bounds."""
    scaled = scopes.withColumn("scaled", F.col("speed") * height.scale)
    stats = scaled.groupBy(*KEYS).agg(F.avg("scaled").alias("mean_speed")).join(
        linear_quantiles(scaled, KEYS, "scaled", _P, max_rows=max_rows), KEYS)
    stats = stats.unionByName(stats.where(F.col("scope") == "global").withColumn("scope", F.lit("global_censored")))
    # Both samples come from the distinct speeds, which are written down once.
    free = held(censored_by_speed(scopes, "speed", None, KEYS))
    everything = free.where(F.col("scope") == "global").drop("kind").withColumn("scope", F.lit("global_censored"))
    sample = free.unionByName(censored_by_speed(everything, "value", bounds, KEYS, "weight"))
    totals = sample_totals(sample, KEYS)
    total = F.col("total_weight")
    summary = totals.select(
        *KEYS, total.alias("total_observations"), ratio(F.col("left_weight") + F.col("right_weight"), total).alias("censored_ratio"),
        ratio(F.col("left_weight"), total).alias("below_ratio"), ratio(F.col("in_weight"), total).alias("in_ratio"),
        F.col("in_weight").alias("valid_count"))
    power = power_estimates(sample, summary, KEYS, curve=curve, air_density=air_density, tail_speed=bounds.upper,
                            min_in_weight=min_in_weight, criteria=criteria, height=height, max_rows=max_rows)
    steps = km_summary(kaplan_meier(sample, KEYS, max_rows), KEYS)
    inside = sample.where(F.col("kind") == "in").groupBy(*KEYS).agg(
        (F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("__inside_mean"))
    table = power.join(steps, KEYS, "left").join(inside, KEYS, "left").join(stats, KEYS, "left")
    weibull = F.col("method") == "weibull"
    k, s = F.col("weibull_shape"), F.col("weibull_scale") * height.scale
    modelled = {"mean_speed_model": F.when(weibull, weibull_mean(k, s)).otherwise(F.col("__inside_mean"))}
    for name, p in _P.items():
        modelled[f"{name}_model"] = F.when(weibull, weibull_quantile(k, s, p)).otherwise(F.coalesce(F.col(f"km_{name}"), F.col(name)))
    table = table.withColumns(modelled).join(summary.drop("valid_count"), KEYS)
    return table.select(*KEYS, "total_observations", "censored_ratio", "below_ratio", "in_ratio", "mean_speed", *_P, "method",
                        F.col("power_density_w_m2").alias("power_density_model"), "kaplan_meier_selection_reasons", *modelled)


def _reference_records(references: DataFrame, bounds: RangeThresholds | None = None) -> DataFrame:
    """The reference as observations: in range all of them, or labelled by where they lie; strictly outside the bounds is censored."""
    v = F.col("speed")
    label = F.lit("in") if bounds is None else F.when(v < bounds.lower, "below").when(v > bounds.upper, "above").otherwise("in")
    return references.select(
        *KEYS, "timestamp", v.alias("pred_wind_speed"), *[(label == k).cast("double").alias(f"prob_range_{k}") for k in ("below", "in", "above")],
        label.alias("range_flag"), F.lit(True).alias("range_flag_confident"))


def with_intervals(rows: DataFrame, observations: DataFrame, references: DataFrame, config: BootstrapConfig) -> DataFrame:
    """Add bootstrap bounds to the rows of all scopes.  The reference resamples its speeds without class noise or bounds.

    The censored scope has the global scope's sample statistics and so their bounds; those of its density come from draws of the
    speeds censored at ``config.thresholds``.  Rows without model statistics of their own state the sample's, as their bounds do.
    """
    def keyed(df):
        return df.withColumn("node_id", F.concat_ws("/", "dataset", "scope"))

    plain = replace(config, apply_rmse_noise=False, rmse_mode="none")
    free = bootstrap_intervals(keyed(_reference_records(references)), replace(plain, thresholds=RangeThresholds(1e-9, 1e9)))
    everything, density = F.col("node_id") == "reference/global", F.col("metric") == "power_density"
    free = free.withColumn("node_id", F.explode(F.when(
        everything & ~density, F.array("node_id", F.lit("reference/global_censored"))).otherwise(F.array("node_id"))))
    held_back = references.where(F.col("scope") == "global").withColumn("scope", F.lit("global_censored"))
    censored = bootstrap_intervals(keyed(_reference_records(held_back, config.thresholds)), plain).where(density)
    bounds = bootstrap_intervals(keyed(observations), config).unionByName(free).unionByName(censored)
    wide = bounds.groupBy("node_id").agg(*[
        F.max(F.when(F.col("metric") == source, F.col(part))).alias(f"{name}_{part}")
        for name, source in (("mean_speed", "mean_speed"), ("p50", "p50"), ("p90", "p90"), ("p99", "p99"), ("power_density_model", "power_density"))
        for part in ("lower", "upper")])
    rows = rows.withColumns({f"{m}_model": F.coalesce(f"{m}_model", m) for m in ("mean_speed", *_P)})
    return rows.withColumn("node_id", F.concat_ws("/", "dataset", "scope")).join(wide, "node_id", "left").drop("node_id")


def differences(rows: DataFrame) -> DataFrame:
    """Model minus reference on the paired scope, one row."""
    paired = rows.where(F.col("scope") == "paired")
    def of(dataset, metric):
        return F.max(F.when(F.col("dataset") == dataset, F.col(metric)))

    return paired.agg(*[(of("model", m) - of("reference", m)).alias(f"{m}_difference") for m in METRICS])
