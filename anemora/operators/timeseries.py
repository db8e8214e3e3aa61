"""Monthly series: grid, gaps, segments, autocorrelation, optional models.

A node has at most one value per calendar month, so the rows per key are bounded by the
length of the record and windows per node need no cutting.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemora.config import SegmentConfig
from anemora.operators.empirical import require_columns


def monthly_series(rows: DataFrame, value: str, node: str = "node_id", period: str = "period_start") -> DataFrame:
    """One row per month between the first and last value of a node; months without one are null."""
    require_columns(rows, [node, period, value])
    month = F.date_trunc("MONTH", F.col(period)).cast("timestamp_ntz")
    known = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        F.col(node).alias("node_id"), month.alias("month"), F.col(value).cast("double").alias("value"))
    span = known.groupBy("node_id").agg(F.min("month").alias("a"), F.max("month").alias("b"))
    grid = span.select("node_id", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return grid.join(known, ["node_id", "month"], "left")


def segments(series: DataFrame, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Cut a monthly series at long gaps and fill short ones.

    Up to ``max_gap_months - 1`` months are filled from each side of a gap, linearly in time,
    so a gap is bridged up to twice that width.  What is filled of a longer gap belongs to no
    segment, because segments end at measured months.
    """
    limit = max(0, config.max_gap_months - 1)
    w = Window.partitionBy("node_id").orderBy("month")
    known = F.when(F.col("value").isNotNull(), F.struct("month", "value"))
    backwards = Window.partitionBy("node_id").orderBy(F.col("month").desc())
    rows = series.withColumns({
        "before": F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "after": F.last(known, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, 0))})

    def months(a, b):
        return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)

    width = months(F.col("before.month"), F.col("after.month")) - 1
    bridged = F.col("value").isNotNull() | (width <= 2 * limit)
    share = (F.unix_micros(F.col("month").cast("timestamp")) - F.unix_micros(F.col("before.month").cast("timestamp"))) / (
        F.unix_micros(F.col("after.month").cast("timestamp")) - F.unix_micros(F.col("before.month").cast("timestamp")))
    filled = F.col("before.value") + (F.col("after.value") - F.col("before.value")) * share
    rows = rows.withColumns({"filled": F.when(F.col("value").isNotNull(), F.col("value")).when(bridged, filled), "bridged": bridged})
    start = F.col("bridged") & ~F.coalesce(F.lag("bridged").over(w), F.lit(False))
    rows = rows.withColumn("island", F.sum(start.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    kept = rows.where("bridged")
    sizes = kept.groupBy("node_id", "island").agg(
        F.count(F.lit(1)).alias("months"), F.min("month").alias("segment_start"), F.max("month").alias("segment_end"),
        F.max(F.col("value").isNull()).alias("gap_filled")).where(F.col("months") >= config.min_segment_months)
    number = F.row_number().over(Window.partitionBy("node_id").orderBy("segment_start"))
    sizes = sizes.withColumn("segment_id", number)
    return kept.join(sizes, ["node_id", "island"]).select(
        "node_id", "segment_id", "month", F.col("filled").alias("value"), "months", "segment_start", "segment_end", "gap_filled")


def segment_table(parts: DataFrame) -> DataFrame:
    return parts.groupBy("node_id", "segment_id").agg(
        F.max("months").alias("months"), F.max("segment_start").alias("segment_start"),
        F.max("segment_end").alias("segment_end"), F.max("gap_filled").alias("gap_filled"), F.avg("value").alias("mean_value"))


def autocorrelation(parts: DataFrame, lags: int = 12, keys: Sequence[str] = ("node_id", "segment_id")) -> DataFrame:
    """Autocorrelation up to ``lags`` (and half the length), one row per key and lag."""
    keys = list(keys)
    whole, ordered = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("month")
    centred = parts.withColumn("x", F.col("value") - F.avg("value").over(whole))
    shifted = centred.withColumns({f"x{k}": F.lag("x", k).over(ordered) for k in range(1, lags + 1)})
    sums = shifted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x") * F.col("x")).alias("s0"),
        *[F.sum(F.col("x") * F.col(f"x{k}")).alias(f"s{k}") for k in range(1, lags + 1)])
    entries = F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(f"s{k}", "s0").alias("acf"),
                                 F.try_divide(F.col(f"s{k}") / (F.col("n") - k), F.col("s0") / F.col("n")).alias("adjusted"))
                        for k in range(1, lags + 1)])
    rows = sums.select(*keys, "n", F.explode(entries).alias("e")).select(*keys, "n", "e.*")
    return rows.where(F.col("lag") <= F.greatest(F.lit(1), F.floor((F.col("n") - 1) / 2)))


def partial_autocorrelation(acf: DataFrame, keys: Sequence[str] = ("node_id", "segment_id")) -> DataFrame:
    """Yule-Walker partial autocorrelation from the size-adjusted autocorrelations.

    A group is one row per lag.
    """
    keys = list(keys)
    fields = ", ".join(f"{c} {acf.schema[c].dataType.simpleString()}" for c in keys)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lag")
        return rows[keys + ["lag"]].assign(pacf=levinson(rows["adjusted"].to_numpy(float)))

    return acf.groupBy(*keys).applyInPandas(run, f"{fields}, lag int, pacf double")


def levinson(r: np.ndarray) -> np.ndarray:
    """Last coefficient of each autoregression of rising order (Durbin-Levinson)."""
    out = np.zeros(len(r))
    phi = np.zeros(0)
    for k in range(len(r)):
        error = 1.0 - np.dot(phi, r[:k])
        last = (r[k] - np.dot(phi, r[:k][::-1])) / error if error else np.nan
        phi = np.append(phi - last * phi[::-1], last)
        out[k] = last
    return out


def aicc(aic: float, observations: int, parameters: int) -> float:
    room = observations - parameters - 1
    return float("inf") if room <= 0 else aic + 2 * parameters * (parameters + 1) / room


def forecast_months(table: DataFrame, last: str, steps: int) -> DataFrame:
    """The ``steps`` months after ``last``."""
    return table.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).withColumn(
        "forecast_month", F.add_months(F.col(last), F.col("step")).cast("timestamp_ntz"))
