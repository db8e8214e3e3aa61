"""Readers and adapters that bring every input onto the observation shape."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.config import Height
from anemora.functions.scalars import is_finite, number
from anemora.operators.empirical import require_columns

SENTINEL = -9000.0


@dataclass(frozen=True)
class ObservationFilter:
    """Which observations to read.  Every part becomes a predicate Spark can push down."""

    include: Sequence[str] | None = None
    exclude: Sequence[str] = ()
    start: datetime | None = None
    end: datetime | None = None
    require_in_range: bool = False
    min_confidence: float | None = None

    def apply(self, df: DataFrame, default_confidence: float = 0.5) -> DataFrame:
        if self.include is not None:
            df = df.where(F.col("node_id").isin(list(self.include)))
        if self.exclude:
            df = df.where(~F.col("node_id").isin(list(self.exclude)))
        if self.start is not None:
            df = df.where(F.col("timestamp") >= F.lit(self.start))
        if self.end is not None:
            df = df.where(F.col("timestamp") <= F.lit(self.end))
        if self.require_in_range:
            confidence = default_confidence if self.min_confidence is None else self.min_confidence
            df = df.where((F.col("range_flag") == "in") & (F.col("prob_range_in") >= confidence))
        elif self.min_confidence is not None:
            df = df.where(F.col("pred_range_confidence") >= self.min_confidence)
        return df


def read_observations(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                      keep: ObservationFilter | None = None, schema=None) -> DataFrame:
    """Parquet scan with pruned columns and pushed filters."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if keep is not None:
        df = keep.apply(df)
    if columns is not None:
        require_columns(df, columns)
        df = df.select(*columns)
    return df


def clean_reference(df: DataFrame, speed: str = "wind_speed", direction: str = "wind_dir",
                    sentinel: float = SENTINEL) -> DataFrame:
    """Drop rows whose speed is a sentinel; null out sentinel directions but keep the row."""
    require_columns(df, [speed, direction])
    return df.where(F.col(speed) > sentinel).withColumn(direction, F.when(F.col(direction) > sentinel, F.col(direction)))


def reference_quality(df: DataFrame, speed: str = "wind_speed", direction: str = "wind_dir",
                      sentinel: float = SENTINEL) -> DataFrame:
    """Row counts of the sentinel rules."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(speed) <= sentinel).alias("speed_sentinels"),
        F.count_if((F.col(speed) > sentinel) & (F.col(direction) <= sentinel)).alias("direction_sentinels"),
        F.count_if(F.col(speed) > sentinel).alias("kept_rows"))


def with_height(df: DataFrame, height: Height, speed: str = "wind_speed") -> DataFrame:
    """Scale speeds to the target height and keep the measured value."""
    return df.withColumn(f"{speed}_original", F.col(speed)).withColumn(speed, F.col(speed) * height.scale)


def read_reference(spark: SparkSession, path: str, height: Height | None = None) -> DataFrame:
    """Reference series: required columns, sentinels removed, height corrected."""
    df = spark.read.parquet(path)
    require_columns(df, ["timestamp", "wind_speed", "wind_dir"])
    df = clean_reference(df)
    return df if height is None else with_height(df, height)


def as_observations(df: DataFrame, *, node: str | Column, speed: str, timestamp: str = "timestamp",
                    direction: str | None = None) -> DataFrame:
    """A series without posteriors on the observation shape: everything is in range for sure."""
    node_id = F.lit(node) if isinstance(node, str) and node not in df.columns else (
        F.col(node) if isinstance(node, str) else node)
    return df.select(
        node_id.cast("string").alias("node_id"), F.col(timestamp).alias("timestamp"),
        F.col(speed).cast("double").alias("pred_wind_speed"),
        (F.col(direction).cast("double") if direction else F.lit(None).cast("double")).alias("pred_wind_direction"),
        F.lit("in").alias("pred_range_label"), F.lit("in_range").alias("range_flag"),
        F.lit(True).alias("range_flag_confident"), F.lit(0.0).alias("prob_range_below"),
        F.lit(1.0).alias("prob_range_in"), F.lit(0.0).alias("prob_range_above"))


def node_series(df: DataFrame, node_id: str, ts: str = "timestamp") -> DataFrame:
    """The rows of one node in order of time; a node without rows is an error, found by reading one row."""
    if "node_id" not in df.columns:
        raise KeyError("the table has no node_id column")
    rows = df.where(F.col("node_id") == node_id)
    if rows.isEmpty():
        raise ValueError(f"no records of node {node_id!r}")
    return rows.orderBy(ts)


def uncensored_records(df: DataFrame, *, node: str | None = None, node_name: str = "series", speed: str = "wind_speed",
                       timestamp: str = "timestamp") -> DataFrame:
    """Coerced, finite, positive speeds on the observation shape; unreadable rows go."""
    value = number(F.col(speed))
    stamp = F.col(timestamp).cast("string").try_cast("timestamp_ntz")
    rows = df.withColumns({"__v": value, "__t": stamp}).where(
        is_finite(F.col("__v")) & (F.col("__v") > 0) & F.col("__t").isNotNull())
    return as_observations(rows, node=F.col(node) if node else F.lit(node_name), speed="__v", timestamp="__t")


def read_csv_tables(spark: SparkSession, paths: Sequence[str], schema=None) -> DataFrame:
    """CSV files with headers, united by column name; columns a file lacks are null."""
    out = None
    for path in paths:
        reader = spark.read.option("header", True)
        part = (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no CSV paths given")
    return out


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Node taxonomy from its JSON document, one row per node."""
    document = spark.read.option("multiLine", True).json(path)
    if "nodes" not in document.columns:
        raise ValueError(f"No taxonomy nodes found in {path}")
    return document.select(F.explode("nodes").alias("n")).select("n.*").where(F.col("node_id").isNotNull())


def interval_columns(df: DataFrame, metric: str) -> dict[str, Column]:
    """Interval of a metric from flat ``metric_lower`` or nested ``metrics.metric.lower`` fields."""
    nested = {f.name for f in df.schema["metrics"].dataType.fields} if "metrics" in df.columns else set()
    out = {}
    for part in ("estimate", "lower", "upper", "replicates"):
        choices = []
        if f"{metric}_{part}" in df.columns:
            choices.append(number(F.col(f"{metric}_{part}")))
        if metric in nested and part in {f.name for f in df.schema["metrics"].dataType[metric].dataType.fields}:
            choices.append(F.col(f"metrics.{metric}.{part}").cast("double"))
        out[part] = F.coalesce(*choices) if choices else F.lit(None).cast("double")
    return out


def read_intervals(spark: SparkSession, path: str, metric: str, key: str = "node_id") -> DataFrame:
    """Per-node interval of a metric from CSV, JSON lines or a JSON array."""
    if path.endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
    elif path.endswith(".jsonl"):
        df = spark.read.json(path)
    else:
        df = spark.read.option("multiLine", True).json(path)
        if "nodes" in df.columns and key not in df.columns:
            df = df.select(F.explode("nodes").alias("n")).select("n.*")
    columns = interval_columns(df, metric)
    return df.select(F.col(key).cast("string").alias(key), *[c.alias(f"{metric}_{p}") for p, c in columns.items()])


def read_records(spark: SparkSession, path: str, key: str = "node_id", records: str = "records") -> DataFrame:
    """JSON lines with one array of records per node, flattened to rows."""
    return spark.read.json(path).select(key, F.explode(records).alias("r")).select(key, "r.*")


# --- records whose fields are known by path only ---


def records(spark: SparkSession, path: str) -> DataFrame:
    """``place, record`` of a JSON document's records as VARIANT: lines, a list, or an object of objects.

    ``place`` orders the records of a file; what is no object is no record.  Lines are read in parts; a document is one value.
    """
    if path.endswith(".jsonl"):
        lines = spark.read.text(path).where(F.trim("value") != "")
        found = lines.select(F.monotonically_increasing_id().alias("place"), F.parse_json("value").alias("record"))
    else:
        document = spark.read.option("wholetext", True).text(path).select(F.parse_json("value").alias("document"))
        found = document.lateralJoin(spark.tvf.variant_explode(F.col("document").outer())).select(F.col("pos").cast("long").alias("place"), F.col("value").alias("record"))
    return found.where(F.schema_of_variant("record").startswith("OBJECT"))


def variant_text(record: Column, path: Column | str) -> Column:
    """The value at a JSON path, fixed or from a column, as text; null where there is none, or it is empty or a null."""
    return F.nullif(F.try_variant_get(record, path, "string"), F.lit(""))


def _quoted(names: Sequence[str]) -> str:
    return "$" + "".join("['" + n.replace("\\", "\\\\").replace("'", "\\'") + "']" for n in names)


def metric_of(fields: Sequence[str | None]) -> str | None:
    """The metric that field names speak of: the last but one part of a dotted name, or what stands before the last underscore."""
    for name in fields:
        if name and "." in name:
            return name.split(".")[-2]
        if name and "_" in name and name.rsplit("_", 1)[0]:
            return name.rsplit("_", 1)[0]
    return None


def interval_fields(record: Column, fields: dict[str, str | None]) -> dict[str, Column]:
    """Numbers of a record by part (``estimate, lower, upper, bootstrap_estimate, replicates, confidence``), each from the first that holds a value:

    the field of that very name, the dotted path, the metric's object under ``metrics`` by the rest of the name, and there by the part's own name.
    """
    metric, out = metric_of(list(fields.values())), {}
    for part, name in fields.items():
        choices = []
        if name:
            choices.append(variant_text(record, _quoted([name])))
            if "." in name:
                choices.append(variant_text(record, _quoted(name.split("."))))
            if metric:
                choices.append(variant_text(record, _quoted(["metrics", metric, name.removeprefix(f"{metric}_")])))
        if metric:
            choices.append(variant_text(record, _quoted(["metrics", metric, part])))
        value = number(F.coalesce(*choices)) if choices else F.lit(None).cast("double")
        out[part] = value.cast("long") if part == "replicates" else value
    return out


def read_interval_fields(spark: SparkSession, path: str, fields: dict[str, str | None], key: str = "node_id") -> DataFrame:
    """``key`` and the chosen parts of every record of a CSV, JSON or JSON-lines file; of a repeated key the last record counts.

    Records without key are left out.
    """
    if path.endswith(".csv"):
        rows = spark.read.option("header", True).csv(path)
        rows = rows.select(F.monotonically_increasing_id().alias("place"), F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("record"))
    else:
        rows = records(spark, path)
    named = rows.select("place", variant_text(F.col("record"), _quoted([key])).alias(key), *[c.alias(n) for n, c in interval_fields(F.col("record"), fields).items()])
    parts = F.struct(*fields)
    return named.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(parts, "place").alias("p")).select(key, "p.*")
