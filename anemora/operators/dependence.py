"""Serial dependence: gaps, lag correlations, effective sample size, block length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.functions.scalars import boundary_seconds, is_close
from anemora.operators.empirical import require_columns
from anemora.operators.ordered import MAX_ROWS_PER_RANGE, order_rows
from anemora.operators.quantiles import overall_medians


def correlation(x: Column, y: Column) -> Column:
    """Aggregate: Pearson correlation over complete pairs, null for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def lag_metrics(obs: DataFrame, *, node: str = "node_id", ts: str = "timestamp", speed: str = "pred_wind_speed",
                lags: Sequence[int] = (1, 2, 3), min_pairs: int = 30, max_block_length: int | None = None,
                tie: Sequence[str] = (), max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """All lags from one ordered pass and one aggregate per node."""
    require_columns(obs, [node, ts, speed, *tie])
    base = obs.where(F.col(speed).isNotNull()).select(
        F.col(node).alias("node_id"), F.col(ts).cast("timestamp").alias("__ts"), F.col(speed).alias("__speed"), *tie)
    wanted = {f"__speed_{k}": (F.col("__speed"), k) for k in lags}
    rows = order_rows(base, ["node_id"], ["__ts", *tie], max_rows=max_rows, depth=max(lags)).lag(
        __before=(F.col("__ts"), 1), **wanted).dataframe()
    gap = boundary_seconds(F.col("__ts"), F.col("__before"))
    out = rows.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg(gap).alias("mean_gap_seconds"), F.stddev_samp(gap.cast("double")).alias("std_gap_seconds"),
        *[F.count(f"__speed_{k}").alias(f"pair_count_lag_{k}") for k in lags],
        *[correlation(F.col("__speed"), F.col(f"__speed_{k}")).alias(f"acf_lag_{k}") for k in lags],
    )
    for k in lags:
        out = out.withColumn(f"acf_lag_{k}", F.when(F.col(f"pair_count_lag_{k}") >= min_pairs, F.col(f"acf_lag_{k}")))
    return effective_size(out, f"acf_lag_{lags[0]}", max_block_length)


def effective_size(table: DataFrame, acf: str, max_block_length: int | None = None) -> DataFrame:
    """AR(1) effective sample size and the block length it suggests (rounded half to even)."""
    r, n = F.col(acf), F.col("sample_count")
    share = F.when(~is_close(r, F.lit(-1.0)), (1.0 - r) / F.nullif(1.0 + r, F.lit(0.0)))
    effective = F.when(share > 0, n * share)
    block = F.greatest(F.lit(1).cast("bigint"), F.bround(n / effective).cast("bigint"))
    if max_block_length is not None:
        block = F.least(block, F.lit(max_block_length))
    return table.withColumn("effective_sample_size", effective).withColumn(
        "suggested_block_length", F.when(effective.isNotNull(), F.least(block, n)))


def dependence_levels(table: DataFrame, thresholds: Sequence[float] = (0.3, 0.5, 0.7), acf: str = "acf_lag_1") -> DataFrame:
    """Number of nodes, share above each correlation, means and medians."""
    known = table.where(F.col(acf).isNotNull()).withColumn("__block", F.col("suggested_block_length").cast("double"))
    shares = known.agg(
        F.count(F.lit(1)).alias("nodes"),
        *[F.avg(F.when(F.col(acf) >= t, 1.0).otherwise(0.0)).alias(f"share_acf_ge_{int(t * 10)}") for t in thresholds],
        F.avg(acf).alias("mean_acf"), F.avg("__block").alias("mean_block_length")).withColumn("__one", F.lit(0))
    medians = overall_medians(known, {"median_acf": acf, "median_block_length": "__block"})
    return shares.join(medians, "__one").drop("__one")
