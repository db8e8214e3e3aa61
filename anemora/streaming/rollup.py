"""Partial aggregates that merge: each batch adds its own, and a batch that is run again replaces it.

A table of partials is a folder with one sub-folder per batch.  Sums, counts, least and greatest
values and first records merge whatever the order of batches, so late batches, repeated batches and
rows in any order give what one pass over all rows gives.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.config import CadenceConfig
from anemora.functions.scalars import micros, month_start, round_micros, season, season_year
from anemora.sources import files


@dataclass(frozen=True)
class Partials:
    """Keys, and per column how rows make it and how partials of it merge."""

    keys: tuple[str, ...]
    make: Mapping[str, Column]
    merge: Mapping[str, Callable[[str], Column]]

    def of(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[c.alias(n) for n, c in self.make.items()])

    def merged(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*self.keys).agg(*[m(n).alias(n) for n, m in self.merge.items()])

    # -- stored ---------------------------------------------------------------------
    def sink(self, path: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
        """Handler for ``foreachBatch``: a batch writes its own folder, so running it again after a failure changes nothing."""
        def handle(batch: DataFrame, number: int) -> None:
            self.of(prepare(batch)).write.mode("overwrite").parquet(files.join(path, f"batch={number}"))

        return handle

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """The merged table."""
        return self.merged(spark.read.parquet(path).drop("batch"))

    def compact(self, spark: SparkSession, path: str, target: str) -> None:
        """Merge all batches into one table of partials elsewhere; a reader merges it with later batches as one of them."""
        self.read(spark, path).write.mode("overwrite").parquet(files.join(target, "batch=-1"))


def value_counts(keys: Sequence[str], value: str, weights: Mapping[str, Column] | None = None) -> Partials:
    """``keys, value, n`` and sums of weights: enough for counts, moments, quantiles and survival curves."""
    made = {"n": F.count(F.lit(1)), **{name: F.sum(w) for name, w in (weights or {}).items()}}
    return Partials((*keys, value), made, {name: F.sum for name in made})


def first_in_slot(columns: Sequence[str], sequence: str, node: str = "node_id") -> Partials:
    """``node, us, copies`` and the columns of each slot's first record by ``sequence``; make ``us`` by ``with_slot``."""
    kept = F.struct(F.col(sequence).alias("__sequence"), *columns)
    return Partials((node, "us"), {"copies": F.count(F.lit(1)), "kept": F.min(kept)}, {"copies": F.sum, "kept": F.min})


def with_slot(df: DataFrame, config: CadenceConfig = CadenceConfig(), ts: str = "timestamp") -> DataFrame:
    """Add ``us``, the grid slot of a row's time."""
    return df.withColumn("us", round_micros(micros(F.col(ts)), config.expected_seconds * 1_000_000, config.rounding))


def with_period(df: DataFrame, kind: str, ts: str = "timestamp") -> DataFrame:
    """Add ``period``: the month's first day, or season and season-year."""
    if kind == "month":
        return df.withColumn("period", F.date_format(month_start(F.col(ts)), "yyyy-MM-dd"))
    if kind == "season":
        return df.withColumn("period", F.concat_ws(" ", season(F.col(ts)), season_year(F.col(ts)).cast("string")))
    raise ValueError(f"unknown period {kind!r}; choose month or season")


def moments(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """``observations, mean, std, least, greatest`` from value counts; ``std`` of the population."""
    x, w = F.col(value), F.col(n)
    mean = F.sum(x * w) / F.sum(w)
    spread = F.sum(x * x * w) / F.sum(w) - mean * mean
    return counts.where(x.isNotNull()).groupBy(*keys).agg(
        F.sum(w).alias("observations"), mean.alias("mean"), F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std"), F.min(x).alias("least"), F.max(x).alias("greatest"))
