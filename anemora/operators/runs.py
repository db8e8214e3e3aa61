"""Runs of observations: stretches of a node without a longer gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.functions.scalars import from_micros, micros
from anemora.operators.empirical import require_columns
from anemora.operators.ordered import MAX_ROWS_PER_RANGE, order_rows


def observation_runs(df: DataFrame, gap_seconds: int = 3600, keys: Sequence[str] = ("node_id",), ts: str = "timestamp",
                     max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """``keys, run_start, run_end, observations``: a gap of ``gap_seconds`` or more ends a run.

    ``streaming.runs.run_stream`` closes the same runs on a stream.  Rows without time belong to none; equal times
    are one moment of a run.
    """
    require_columns(df, [*keys, ts])
    rows = df.where(F.col(ts).isNotNull()).select(*keys, micros(F.col(ts)).alias("us"))
    ordered = order_rows(rows, keys, ["us"], max_rows=max_rows, hold=True).lag(__previous=(F.col("us"), 1))
    apart = F.col("us") - F.col("__previous") >= gap_seconds * 1_000_000
    ordered = ordered.with_column("__first", F.coalesce(apart, F.lit(True)).cast("long")).running_sum(__run=F.col("__first"))
    return ordered.dataframe().groupBy(*keys, "__run").agg(
        from_micros(F.min("us")).alias("run_start"), from_micros(F.max("us")).alias("run_end"), F.count(F.lit(1)).alias("observations")).drop("__run")
