"""The given tables as observation and reference series, in Spark and in SQL.

The toolkit works on node observations.  These views map ``events``, ``lineitem`` and
``supplier`` onto that shape, row by row, so every query reads its table whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> F.Column:
    """The JSON field, parsed once per row.

    Predicates on columns derived from it would otherwise be pushed down with a copy of the
    parse for every mention; they stop at a generator.
    """
    return F.explode(F.array(F.get_json_object("props", "$.k").cast("int")))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_of(table(spark, sf_dir, "events"))


def obs_of(events: DataFrame) -> DataFrame:
    """Observations from events, a table or a stream."""
    k = F.col("k")
    kind = F.col("event_type")
    label = (
        F.when(kind == "click", "in").when(kind == "view", "IN_RANGE").when(kind == "signup", "inside")
        .when(kind == "purchase", "above")
        .otherwise(F.when(k < 50, "below").when(k < 80, "left").when(k < 90, " in "))
    )
    return events.withColumn("k", _k()).select(
        F.concat(F.lit("NODE_"), F.lpad((F.col("user_id") % 20).cast("string"), 2, "0")).alias("node_id"),
        "event_id", F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 97 != 0, F.col("value") / 5).alias("pred_wind_speed"),
        label.alias("pred_range_label"), label.alias("range_flag"), (k >= 30).alias("range_flag_confident"),
        ((100 - k) / F.lit(300.0)).alias("prob_range_below"), ((100 + k) / F.lit(300.0)).alias("prob_range_in"),
        F.lit(100.0 / 300.0).alias("prob_range_above"),
        ((F.col("user_id") * 37 + F.col("event_id") * 11) % 360).cast("double").alias("pred_wind_direction"),
        "event_type",
    )


OBS = """
obs AS (
  SELECT 'NODE_' || lpad(CAST(user_id % 20 AS VARCHAR), 2, '0') AS node_id, event_id, ts AS "timestamp",
         CASE WHEN event_id % 97 <> 0 THEN value / 5e0 END AS pred_wind_speed,
         CASE event_type WHEN 'click' THEN 'in' WHEN 'view' THEN 'IN_RANGE' WHEN 'signup' THEN 'inside'
              WHEN 'purchase' THEN 'above'
              ELSE CASE WHEN k < 50 THEN 'below' WHEN k < 80 THEN 'left' WHEN k < 90 THEN ' in ' END
         END AS pred_range_label,
         k >= 30 AS range_flag_confident,
         (100 - k) / 300e0 AS prob_range_below, (100 + k) / 300e0 AS prob_range_in, 100e0 / 300e0 AS prob_range_above,
         CAST((user_id * 37 + event_id * 11) % 360 AS DOUBLE) AS pred_wind_direction, event_type
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

# Canonical label, untrimmed and trimmed spelling rules.
_CASE = """CASE WHEN {x} IN ('in', 'inside', 'within', 'in_range') THEN 'in'
     WHEN {x} IN ('below', 'below_range', 'under', 'left') THEN 'below'
     WHEN {x} IN ('above', 'over', 'upper', 'right') THEN 'above' ELSE 'uncertain' END"""
LABEL_UNTRIMMED = _CASE.format(x="lower(pred_range_label)")
LABEL_TRIMMED = _CASE.format(x="lower(trim(pred_range_label))")


def ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference series with sentinels: the orders, dealt over the month of the events, one clock, no node."""
    key = F.col("o_orderkey")
    minutes = ((key * 7919) % 43200).cast("double")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select(
        key.alias("event_id"), (start + F.make_dt_interval(mins=minutes.cast("int"))).alias("timestamp"),
        F.when(key % 53 == 0, F.lit(-9999.9)).otherwise((F.col("o_custkey") % 1000) / 50).alias("wind_speed"),
        F.when(key % 41 == 0, F.lit(-10000.0)).otherwise(((key * 7) % 360).cast("double")).alias("wind_dir"),
    )


REF = """
ref AS (
  SELECT o_orderkey AS event_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((o_orderkey * 7919) % 43200 AS BIGINT)) AS "timestamp",
         CASE WHEN o_orderkey % 53 = 0 THEN -9999.9e0 ELSE (o_custkey % 1000) / 50e0 END AS wind_speed,
         CASE WHEN o_orderkey % 41 = 0 THEN -10000e0 ELSE CAST((o_orderkey * 7) % 360 AS DOUBLE) END AS wind_dir
  FROM orders
)"""


def obs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of observations from lineitem, for seasonal and annual work."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    label = F.when(flag == "A", "in").when(flag == "N", "within").when(status == "F", "below").otherwise("above")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("NODE_"), F.lpad((F.col("l_suppkey") % 20).cast("string"), 2, "0")).alias("node_id"),
        F.col("l_shipdate").alias("timestamp"), (F.col("l_quantity") / 2).alias("pred_wind_speed"),
        label.alias("pred_range_label"), "l_orderkey", "l_linenumber",
    )


OBS_LONG = """
obs_long AS (
  SELECT 'NODE_' || lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0') AS node_id, l_shipdate AS "timestamp",
         l_quantity / 2e0 AS pred_wind_speed,
         CASE WHEN l_returnflag = 'A' THEN 'in' WHEN l_returnflag = 'N' THEN 'within'
              WHEN l_linestatus = 'F' THEN 'below' ELSE 'above' END AS pred_range_label, l_orderkey, l_linenumber
  FROM lineitem
)"""


def obs_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of observations with posteriors, from lineitem."""
    rows = obs_long(spark, sf_dir)
    return rows.select(
        "node_id", "timestamp", "pred_wind_speed", "pred_range_label", F.col("pred_range_label").alias("range_flag"),
        (F.col("l_linenumber") % 3 != 0).alias("range_flag_confident"), ((F.col("l_linenumber") % 7) / F.lit(20.0)).alias("prob_range_below"),
        F.lit(0.5).alias("prob_range_in"), ((F.col("l_orderkey") % 5) / F.lit(20.0)).alias("prob_range_above"))


OBS_YEARS = """
obs AS (
  SELECT 'NODE_' || lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0') || '/' || {period} AS node_id, l_orderkey * 8 + l_linenumber AS event_id, l_shipdate AS "timestamp",
         l_quantity / 2e0 AS pred_wind_speed,
         CASE WHEN l_returnflag = 'A' THEN 'in' WHEN l_returnflag = 'N' THEN 'within'
              WHEN l_linestatus = 'F' THEN 'below' ELSE 'above' END AS pred_range_label, l_linenumber % 3 <> 0 AS range_flag_confident,
         (l_linenumber % 7) / 20e0 AS prob_range_below, 0.5e0 AS prob_range_in, (l_orderkey % 5) / 20e0 AS prob_range_above
  FROM lineitem
)"""
