"""Label counts, descriptive statistics of valid speeds, bias flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.config import BiasThresholds
from anemora.functions.labels import LABELS, label_untrimmed
from anemora.functions.scalars import fixed, ratio
from anemora.operators.ordered import MAX_ROWS_PER_RANGE
from anemora.operators.quantiles import discrete_quantile_grid, discrete_quantiles


def notes(separator: str, *parts: Column) -> Column:
    """Join the notes that apply; ``concat_ws`` leaves out the nulls."""
    return F.concat_ws(separator, *parts)


def require_columns(df: DataFrame, needed: Sequence[str]) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise KeyError(f"missing required columns: {missing}")


def label_counts(obs: DataFrame, keys: Sequence[str] = ("node_id",), label: str = "pred_range_label") -> DataFrame:
    """Totals and one count per canonical label (untrimmed spelling rules)."""
    require_columns(obs, [*keys, label])
    canonical = label_untrimmed(F.col(label))
    return (
        obs.select(*keys, canonical.alias("__label")).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total_observations"),
             *[F.count_if(F.col("__label") == name).alias(f"{name}_count") for name in ("in", "below", "above", "uncertain")])
    )


def label_pivot(obs: DataFrame, canonical: Column, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    """Counts with labels as columns, canonical order, zero where a label is absent."""
    return (
        obs.select(*keys, canonical.alias("__label")).groupBy(*keys)
        .pivot("__label", list(LABELS)).agg(F.count(F.lit(1))).na.fill(0, list(LABELS))
    )


def label_ratios(counts: DataFrame) -> DataFrame:
    out = counts
    for name in ("in", "below", "above", "uncertain"):
        out = out.withColumn(f"{name}_ratio", ratio(F.col(f"{name}_count"), F.col("total_observations")))
    zero = F.lit(0.0)
    return out.withColumn(
        "censored_ratio", F.coalesce(F.col("below_ratio"), zero) + F.coalesce(F.col("above_ratio"), zero))


def valid_speeds(obs: DataFrame, keys: Sequence[str] = ("node_id",), label: str = "pred_range_label",
                 speed: str = "pred_wind_speed") -> DataFrame:
    require_columns(obs, [*keys, label, speed])
    return obs.where(label_untrimmed(F.col(label)) == "in").where(F.col(speed).isNotNull()).select(*keys, speed)


def valid_metrics(obs: DataFrame, keys: Sequence[str] = ("node_id",), label: str = "pred_range_label",
                  speed: str = "pred_wind_speed", max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Moments and observed-value quantiles of in-range speeds."""
    valid = valid_speeds(obs, keys, label, speed)
    moments = valid.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("valid_count"), F.avg(speed).alias("mean_speed"),
        F.stddev_samp(speed).alias("std_speed"), F.min(speed).alias("min_speed"), F.max(speed).alias("max_speed"),
    )
    quantiles = discrete_quantiles(valid, keys, speed, {"p50": 0.5, "p90": 0.9, "p99": 0.99}, max_rows=max_rows)
    return moments.join(quantiles, list(keys), "left")


def cdf_grid(obs: DataFrame, keys: Sequence[str] = ("node_id",), label: str = "pred_range_label",
             speed: str = "pred_wind_speed", max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Observed-value quantile at each whole percent: ``(keys, percentile, wind_speed)``."""
    grid = discrete_quantile_grid(valid_speeds(obs, keys, label, speed), keys, speed, 100, max_rows=max_rows)
    return grid.select(*keys, (F.col("step") / F.lit(100.0)).alias("percentile"), F.col(speed).alias("wind_speed"))


def assemble_metrics(labels: DataFrame, metrics: DataFrame, taxonomy: DataFrame | None = None,
                     limits: BiasThresholds = BiasThresholds()) -> DataFrame:
    """Label ratios ⟕ metrics ⟕ taxonomy with bias flags; the label rows decide which nodes appear.

    The sides are one row per node, so join strategy is left to the size Spark measures.
    """
    out = label_ratios(labels).join(metrics, "node_id", "left")
    if taxonomy is not None:
        out = out.join(
            taxonomy.select("node_id", F.col("total_observations").alias("taxonomy_observations"),
                            "coverage_band", "continuity_band", "low_coverage"), "node_id", "left")
    else:
        out = out.withColumns({
            "taxonomy_observations": F.lit(None).cast("bigint"), "coverage_band": F.lit(None).cast("string"),
            "continuity_band": F.lit(None).cast("string"), "low_coverage": F.lit(False)})
    out = out.withColumns({
        "low_coverage": F.coalesce("low_coverage", F.lit(False)),
        "valid_count": F.coalesce("valid_count", F.lit(0).cast("bigint")),
    })
    zero = F.lit(0.0)
    censored, below = F.col("censored_ratio"), F.coalesce(F.col("below_ratio"), zero)
    inside, valid = F.coalesce(F.col("in_ratio"), zero), F.col("valid_count")
    too_censored = censored > limits.max_total_censored_ratio
    too_low = below > limits.max_below_ratio
    too_few_inside = inside < limits.min_valid_share
    sparse = F.coalesce(F.lower("coverage_band") == "sparse", F.lit(False))
    too_small = valid < limits.min_valid_samples
    out = out.withColumns({
        "censoring_bias": too_censored | too_low | too_few_inside,
        "coverage_bias": F.col("low_coverage") | sparse,
        "sample_bias": too_small,
        "bias_notes": notes(
            "; ",
            F.when(too_censored, F.concat(F.lit("High censoring ratio "), fixed(censored, 3),
                                          F.lit(f" exceeds {limits.max_total_censored_ratio:.2f}."))),
            F.when(too_low, F.concat(F.lit("Left-censored share "), fixed(below, 3),
                                     F.lit(f" above {limits.max_below_ratio:.2f}."))),
            F.when(too_few_inside, F.concat(F.lit("In-range share "), fixed(inside, 3),
                                            F.lit(f" below {limits.min_valid_share:.2f}."))),
            F.when(F.col("low_coverage"), "Marked as low coverage in taxonomy."),
            F.when(sparse, "Coverage band classified as sparse."),
            F.when(too_small, F.concat(F.lit("Valid sample count "), valid.cast("string"),
                                       F.lit(f" below minimum {limits.min_valid_samples}."))),
        ),
    })
    return out.withColumn("any_bias", F.col("censoring_bias") | F.col("coverage_bias") | F.col("sample_bias"))
