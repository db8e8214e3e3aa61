"""Directions: angular errors, circular statistics, scenarios, wind roses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemora.functions.scalars import circular_difference, is_finite, normalise_degrees, ratio, sector
from anemora.operators.ordered import MAX_ROWS_PER_RANGE
from anemora.operators.quantiles import linear_quantiles

SENTINEL = -9000.0


def pair_quality(predicted: Column, observed: Column, sentinel: float = SENTINEL) -> dict[str, Column]:
    """Masks of a direction pair.  They overlap except that non-finite excludes missing."""
    def absent(c: Column) -> Column:
        return c.isNull() | F.isnan(c)

    missing = absent(predicted) | absent(observed)
    marked = F.coalesce((predicted <= sentinel) & ~F.isnan(predicted), F.lit(False)) | F.coalesce(
        (observed <= sentinel) & ~F.isnan(observed), F.lit(False))
    finite = is_finite(predicted) & is_finite(observed)
    return {"missing": missing, "sentinel": marked, "nonfinite": ~finite & ~missing, "valid": ~missing & finite & ~marked}


def direction_errors(pairs: DataFrame, predicted: str, observed: str, keep: Sequence[str] = (),
                     sentinel: float = SENTINEL) -> DataFrame:
    """Signed and absolute error of each valid pair."""
    valid = pairs.where(pair_quality(F.col(predicted), F.col(observed), sentinel)["valid"])
    error = circular_difference(F.col("predicted_direction_deg"), F.col("observed_direction_deg"))
    return (
        valid.select(*keep, normalise_degrees(F.col(predicted)).alias("predicted_direction_deg"),
                     normalise_degrees(F.col(observed)).alias("observed_direction_deg"))
        .withColumn("angular_error_deg", error).withColumn("absolute_error_deg", F.abs("angular_error_deg"))
    )


def quality_summary(pairs: DataFrame, keys: Sequence[str], predicted: str, observed: str,
                    sentinel: float = SENTINEL) -> DataFrame:
    masks = pair_quality(F.col(predicted), F.col(observed), sentinel)
    return pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_pairs"),
        *[F.count_if(mask).alias(f"{name}_pairs") for name, mask in masks.items()])


def circular_mean(angle: Column) -> Column:
    """Aggregate: mean direction in degrees, zero when the resultant vanishes."""
    s, c = F.avg(F.sin(F.radians(angle))), F.avg(F.cos(F.radians(angle)))
    return F.when((F.abs(s) <= 1e-12) & (F.abs(c) <= 1e-12), F.lit(0.0)).otherwise(F.degrees(F.atan2(s, c)))


def error_metrics(errors: DataFrame, keys: Sequence[str], max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    error, size = F.col("angular_error_deg"), F.col("absolute_error_deg")
    keys = list(keys)
    if not keys:
        errors, keys = errors.withColumn("__one", F.lit(0)), ["__one"]
    moments = errors.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("valid_pairs"), F.avg(size).alias("mean_absolute_error_deg"),
        F.sqrt(F.avg(error * error)).alias("root_mean_square_error_deg"),
        circular_mean(error).alias("circular_bias_deg"), F.max(size).alias("max_absolute_error_deg"))
    quantiles = linear_quantiles(errors, keys, "absolute_error_deg", {
        "absolute_error_p50_deg": 0.5, "absolute_error_p90_deg": 0.9, "absolute_error_p99_deg": 0.99}, max_rows=max_rows)
    return moments.join(quantiles, keys).drop("__one")


def scenario_metrics(pairs: DataFrame, predicted: str, observed: str, label: str, confident: str,
                     max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Error metrics for all pairs, confident pairs, and confident in-range pairs.

    A row is tagged with the scenarios it belongs to (at most three), so one scan serves all.
    """
    sure = F.coalesce(F.col(confident), F.lit(False))
    inside = F.coalesce(F.lower(F.trim(label)) == "in", F.lit(False))
    names = F.array_compact(F.array(
        F.lit("all"), F.when(sure, "confident"), F.when(sure & inside, "confident_in_range")))
    tagged = pairs.withColumn("scenario", F.explode(names))
    quality = quality_summary(tagged, ["scenario"], predicted, observed).drop("valid_pairs")
    errors = error_metrics(direction_errors(tagged, predicted, observed, ["scenario"]), ["scenario"], max_rows)
    # Three rows from here on; the scenario "all" holds every matched pair.
    everything = Window.partitionBy(F.lit(0))
    matched = F.max(F.when(F.col("scenario") == "all", F.col("total_pairs"))).over(everything)
    out = quality.join(errors, "scenario", "left").withColumn("matched_pairs", matched)
    return out.withColumn("valid_pairs", F.coalesce("valid_pairs", F.lit(0))).withColumn(
        "coverage_ratio", ratio(F.col("valid_pairs"), F.col("matched_pairs")))


def wind_rose(obs: DataFrame, keys: Sequence[str] = ("node_id",), direction: str = "pred_wind_direction",
              weight: Column | None = None) -> DataFrame:
    """Weight and samples per 30-degree sector.  Null directions stay as their own group."""
    amount = F.coalesce(weight, F.lit(0.0)) if weight is not None else F.lit(1.0)
    return obs.groupBy(*keys, sector(F.col(direction)).alias("sector")).agg(
        F.sum(amount).alias("weight"), F.count(F.lit(1)).alias("samples"))


def reference_rose(ref: DataFrame, direction: str = "wind_dir") -> DataFrame:
    """Unweighted rose of a reference series; only directions in [0, 360] count."""
    return ref.where(F.col(direction).between(0, 360)).groupBy(sector(F.col(direction)).alias("sector")).agg(
        F.count(F.lit(1)).alias("samples"))
