"""Runs of observations and first arrivals of a slot on streams, by event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from anemora.config import CadenceConfig
from anemora.functions.scalars import from_micros, micros, round_micros

_AT = "__at"


def run_stream(stream: DataFrame, gap_seconds: int = 3600, lateness: str = "1 hour", keys: Sequence[str] = ("node_id",), ts: str = "timestamp") -> DataFrame:
    """``keys, run_start, run_end, observations`` of every run that ended before the watermark.

    Session windows grow until a gap of ``gap_seconds``; a run leaves the state, once, when no row that is at most
    ``lateness`` late can extend it.  Write it in append mode.  What is still open when the stream stops is in the state: ``open_runs``.
    """
    timed = stream.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).cast("timestamp").alias(_AT)).withWatermark(_AT, lateness)
    session = F.session_window(_AT, f"{gap_seconds} seconds").alias("run")
    runs = timed.groupBy(*keys, session).agg(F.count(F.lit(1)).alias("observations"))
    return runs.select(*keys, *_bounds(gap_seconds), "observations")


def _bounds(gap_seconds: int) -> list[Column]:
    """A session window ends a gap after its last row."""
    last = micros(F.col("run.end").cast("timestamp_ntz")) - gap_seconds * 1_000_000
    return [F.col("run.start").cast("timestamp_ntz").alias("run_start"), from_micros(last).alias("run_end")]


def open_runs(spark: SparkSession, checkpoint: str, gap_seconds: int = 3600, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    """The runs that a stopped ``run_stream`` still holds, read from its state."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(*[F.col(f"value.{k}").alias(k) for k in keys], F.col("value.session_window").alias("run"), F.col("value.count").alias("observations")).select(
        *keys, *_bounds(gap_seconds), "observations")


def first_arrivals(stream: DataFrame, config: CadenceConfig = CadenceConfig(), lateness: str = "1 hour", node: str = "node_id", ts: str = "timestamp") -> DataFrame:
    """The record of each (node, slot) of the grid that arrives first, with its slot as ``ts``; written at once, in append mode.

    A slot stays known until the watermark is ``lateness`` past it, so copies up to that late are dropped and the state
    holds the slots of that stretch only.  Rows later than the watermark are dropped too; ``late_rows`` counts them.
    ``streaming.rollup`` keeps the first by sequence instead, however late a copy comes.
    """
    slot = round_micros(micros(F.col(ts)), config.expected_seconds * 1_000_000, config.rounding)
    timed = stream.where(F.col(ts).isNotNull()).withColumn(ts, from_micros(slot).cast("timestamp")).withWatermark(ts, lateness)
    return timed.dropDuplicatesWithinWatermark([node, ts]).withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators dropped for being later than the watermark.

    Summed over the batches that the query remembers (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    return sum(operator["numRowsDroppedByWatermark"] for batch in query.recentProgress for operator in batch["stateOperators"])
