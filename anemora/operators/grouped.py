"""Helpers for numpy work on groups that are known to fit one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.session import checkpoint_ready

LEAST_ROW_BYTES = 16


def may_exceed(df: DataFrame, max_rows: int) -> bool:
    """False when Spark's own size estimate rules out ``max_rows`` rows, which saves a count."""
    try:
        estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # no JVM handle (Spark Connect): count
        return True
    return estimate > max_rows * LEAST_ROW_BYTES


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int | None) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows (at most ``rows / max_rows`` of them), or None.

    The count runs only where the size estimate leaves the possibility open.  The keys stay a table, written down once;
    the driver learns only whether there are any.
    """
    if max_rows is None or not may_exceed(df, max_rows):
        return None
    checkpoint_ready(df.sparkSession)
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > max_rows).checkpoint()
    return None if found.isEmpty() else found


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash the keys over all cores before CPU-heavy group work.

    Groups of few bytes can cost seconds of numpy; without a partition count AQE would merge
    them into one task by size.
    """
    session = df.sparkSession
    width = int(session.conf.get("spark.sql.shuffle.partitions"))
    try:
        width = max(width, session.sparkContext.defaultParallelism)
    except Exception:  # Spark Connect
        pass
    return df.repartition(width, *keys)
