"""Lookups in small dimension tables: validity intervals, per-node settings with defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.config import RmseRecord


def effective_record(rows: DataFrame, records: Sequence[RmseRecord], ts: str = "timestamp") -> DataFrame:
    """Add the newest record valid at each row's time.

    The registry is a configuration of a few versions, so it becomes an expression: no join.
    """
    when = F.col(ts)
    version: Column | None = None
    value: Column | None = None
    for record in sorted(records, key=lambda r: r.effective_from, reverse=True):
        valid = when >= F.lit(record.effective_from.replace(tzinfo=None))
        if record.effective_until is not None:
            valid = valid & (when < F.lit(record.effective_until.replace(tzinfo=None)))
        version = F.when(valid, record.version) if version is None else version.when(valid, record.version)
        value = F.when(valid, record.value) if value is None else value.when(valid, record.value)
    return rows.withColumns({"version": version, "rmse": value})


def with_default(rows: DataFrame, settings: DataFrame, column: str, default, key: str = "node_id") -> DataFrame:
    """Join a per-node setting and fill in the default for nodes that have none."""
    return rows.join(settings.select(key, column), key, "left").withColumn(
        column, F.coalesce(F.col(column), F.lit(default)))


def error_assessments(taxonomy: DataFrame, records: Sequence[RmseRecord], at: str = "as_of") -> DataFrame:
    """What is known of each node's error: no value of its own, and the record that holds at its time ``at``.

    One row per row of ``taxonomy`` with its bands, the record's version, value, unit and source, and the reason in words.  A node at a
    time without a record keeps its row and says so.
    """
    records = list(records)
    held = effective_record(taxonomy, records, at)
    of = {name: _by_version(records, name) for name in ("unit", "source")}
    reason = F.when(F.col("version").isNull(), "No error of this node is known, and no global RMSE holds at its time.").otherwise(F.concat(
        F.lit("No error of this node is known; the global RMSE "), F.format_string("%.6f", F.col("rmse")), F.lit(" "), of["unit"], F.lit(" (source "), of["source"], F.lit(") stands in.")))
    return held.select(
        "node_id", F.lit(None).cast("double").alias("node_rmse"), F.col("version").alias("global_version"), F.col("rmse").alias("global_rmse"),
        of["unit"].alias("unit"), of["source"].alias("source"), reason.alias("limitation"), "coverage_band", "continuity_band", "low_coverage")


def _by_version(records: Sequence[RmseRecord], field: str) -> Column:
    found = F.lit(None).cast("string")
    for record in records:
        found = F.when(F.col("version") == record.version, F.lit(getattr(record, field))).otherwise(found)
    return found
