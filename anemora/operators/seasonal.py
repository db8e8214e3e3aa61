"""Seasonal and annual slices, variation and trend per node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.functions.labels import LABELS, label
from anemora.functions.scalars import ratio, season, season_rank
from anemora.operators.empirical import require_columns
from anemora.operators.ordered import MAX_ROWS_PER_RANGE
from anemora.operators.quantiles import linear_quantiles, overall_medians

_QUANTILES = {"p50_speed": 0.5, "p90_speed": 0.9, "p99_speed": 0.99}


def _prepared(obs: DataFrame, node: str, ts: str, speed: str, label_column: str) -> DataFrame:
    require_columns(obs, [node, ts, speed, label_column])
    return obs.select(
        F.col(node).alias("node_id"), season(F.col(ts)).alias("season"), F.year(ts).cast("bigint").alias("year"),
        label(F.col(label_column)).alias("__label"), F.col(speed).cast("double").alias("__speed"),
    ).withColumn("__inside", F.when(F.col("__label") == "in", F.nanvl("__speed", F.lit(None).cast("double"))))


def seasonal_slices(obs: DataFrame, *, node: str = "node_id", ts: str = "timestamp", speed: str = "pred_wind_speed",
                    label_column: str = "pred_range_label", max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Statistics of in-range speeds and label ratios per node and season, all years pooled."""
    rows = _prepared(obs, node, ts, speed, label_column)
    keys = ["node_id", "season"]
    base = rows.groupBy(*keys).agg(
        F.count("__inside").alias("sample_count"), F.avg("__inside").alias("mean_speed"),
        F.stddev_pop("__inside").alias("std_speed"), F.count(F.lit(1)).alias("__total"),
        *[F.count_if(F.col("__label") == name).alias(f"__{name}") for name in LABELS])
    quantiles = linear_quantiles(rows, keys, "__inside", _QUANTILES, max_rows=max_rows)
    out = base.join(quantiles, keys, "left")
    return out.select(
        *keys, "sample_count", "mean_speed", "std_speed", *_QUANTILES,
        *[ratio(F.col(f"__{name}"), F.col("__total")).alias(f"{name}_ratio") for name in LABELS])


def annual_slices(obs: DataFrame, *, node: str = "node_id", ts: str = "timestamp", speed: str = "pred_wind_speed",
                  label_column: str = "pred_range_label", max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Statistics of in-range speeds per node and calendar year."""
    rows = _prepared(obs, node, ts, speed, label_column).where(F.col("__inside").isNotNull())
    keys = ["node_id", "year"]
    base = rows.groupBy(*keys).agg(
        F.count("__inside").alias("sample_count"), F.avg("__inside").alias("mean_speed"),
        F.stddev_pop("__inside").alias("std_speed"))
    return base.join(linear_quantiles(rows, keys, "__inside", _QUANTILES, max_rows=max_rows), keys, "left")


def trend(annual: DataFrame) -> DataFrame:
    """Least-squares slope of the annual means, with the reason where there is none."""
    n = F.count("mean_speed")
    slope = F.try_divide(F.covar_pop(F.col("year").cast("double"), F.col("mean_speed")),
                         F.var_pop(F.when(F.col("mean_speed").isNotNull(), F.col("year").cast("double"))))
    return annual.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("annual_samples"),
        F.when(n >= 2, slope).alias("annual_trend_slope"),
        F.when(F.count(F.lit(1)) == 1, "Only one year available.")
        .when(n < 2, "Insufficient annual mean values for regression.").alias("trend_note"),
    )


def variation(seasonal: DataFrame, annual: DataFrame) -> DataFrame:
    """Seasonal amplitude with its extreme seasons, and the annual trend, per node.

    At most four seasons and a calendar of years per node: the inputs are small per key.
    """
    mean = F.col("mean_speed")
    rank = season_rank(F.col("season"))
    spot = F.when(mean.isNotNull(), F.struct(mean, rank))
    seasons = seasonal.groupBy("node_id").agg(
        F.max_by("season", spot).alias("strongest_season"), F.min_by("season", spot).alias("weakest_season"),
        (F.max(mean) - F.min(mean)).alias("seasonal_amplitude"), F.stddev_pop(mean).alias("seasonal_mean_std"),
        F.count(F.lit(1)).alias("seasonal_coverage"))
    out = seasons.join(trend(annual), "node_id", "full")
    return out.withColumns({
        "seasonal_coverage": F.coalesce("seasonal_coverage", F.lit(0).cast("bigint")),
        "annual_trend_units": F.lit("m/s per year"),
        "trend_note": F.when(F.col("annual_samples").isNull(), "No annual samples available.").otherwise(F.col("trend_note")),
        "annual_samples": F.coalesce("annual_samples", F.lit(0).cast("bigint")),
    })


def variation_overview(table: DataFrame) -> DataFrame:
    """Number of nodes and medians over nodes of amplitude and trend."""
    count = table.agg(F.count(F.lit(1)).alias("nodes")).withColumn("__one", F.lit(0))
    medians = overall_medians(table, {"median_amplitude": "seasonal_amplitude", "median_trend": "annual_trend_slope"})
    return count.join(medians, "__one").drop("__one")
