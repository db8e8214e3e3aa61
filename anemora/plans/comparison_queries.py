"""Monthly series, model comparison and the composed stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.config import BootstrapConfig, SegmentConfig
from anemora.functions.scalars import month_start
from anemora.operators import asof, comparison, timeseries
from anemora.plans import stages
from anemora.plans.registry import query
from anemora.plans.tables import OBS, OBS_LONG, REF, obs, obs_long, ref
from anemora.session import held
from anemora.sources.readers import clean_reference, uncensored_records

_MONTHS = """
grouped AS (
  SELECT node_id, date_trunc('month', "timestamp") AS month, avg(CASE WHEN NOT (month("timestamp") IN (5, 6) AND year("timestamp") % 2 = 0)
    AND NOT (year("timestamp") = 1998 AND month("timestamp") BETWEEN 2 AND 8) THEN pred_wind_speed END) AS value FROM obs_long
  GROUP BY 1, 2
),
grid AS (
  SELECT node_id, unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS month FROM (SELECT node_id, min(month) AS a, max(month) AS b FROM grouped GROUP BY 1)
),
series AS (SELECT g.node_id, CAST(g.month AS TIMESTAMP) AS month, value FROM grid g LEFT JOIN grouped v ON v.node_id = g.node_id AND v.month = g.month)"""


def _series(spark, sf_dir):
    """Monthly means with gaps of two and seven months."""
    ts = F.col("timestamp")
    rows = obs_long(spark, sf_dir)
    there = ~(F.month(ts).isin(5, 6) & (F.year(ts) % 2 == 0)) & ~((F.year(ts) == 1998) & F.month(ts).between(2, 8))
    months = rows.groupBy("node_id", month_start(ts).alias("period_start")).agg(F.avg(F.when(there, F.col("pred_wind_speed"))).alias("value"))
    return timeseries.monthly_series(months, "value")


@query("monthly_gaps", f"WITH {OBS_LONG}, {_MONTHS} SELECT * FROM series", "value")
def monthly_gaps(spark, sf_dir):
    return _series(spark, sf_dir)


_SEGMENTS = """
near AS (
  SELECT *, last_value(CASE WHEN value IS NOT NULL THEN month END IGNORE NULLS) OVER w AS m0, last_value(value IGNORE NULLS) OVER w AS v0,
         first_value(CASE WHEN value IS NOT NULL THEN month END IGNORE NULLS) OVER f AS m1, first_value(value IGNORE NULLS) OVER f AS v1
  FROM series WINDOW w AS (PARTITION BY node_id ORDER BY month ROWS UNBOUNDED PRECEDING),
                     f AS (PARTITION BY node_id ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
filled AS (
  SELECT node_id, month, value AS measured, CASE WHEN value IS NOT NULL THEN value
           WHEN date_diff('month', m0, m1) - 1 <= 4 THEN v0 + (v1 - v0) * ((epoch(month) - epoch(m0)) / (epoch(m1) - epoch(m0))) END AS value,
         value IS NOT NULL OR date_diff('month', m0, m1) - 1 <= 4 AS bridged FROM near
),
islands AS (SELECT *, sum(CASE WHEN bridged AND NOT coalesce(before, FALSE) THEN 1 ELSE 0 END) OVER (PARTITION BY node_id ORDER BY month) AS island
            FROM (SELECT *, lag(bridged) OVER (PARTITION BY node_id ORDER BY month) AS before FROM filled)),
parts AS (
  SELECT *, dense_rank() OVER (PARTITION BY node_id ORDER BY island) AS segment_id FROM (
    SELECT *, count(*) OVER (PARTITION BY node_id, island) AS n FROM islands WHERE bridged) WHERE n >= 12
)"""
_CONFIG = SegmentConfig(max_gap_months=3, min_segment_months=12)


@query("timeseries_segments", f"""WITH {OBS_LONG}, {_MONTHS}, {_SEGMENTS} SELECT node_id, CAST(segment_id AS INTEGER) AS segment_id, count(*) AS months, min(month) AS segment_start,
  max(month) AS segment_end, bool_or(measured IS NULL) AS gap_filled, avg(value) AS mean_value FROM parts GROUP BY 1, 2""", "mean_value")
def timeseries_segments(spark, sf_dir):
    return timeseries.segment_table(timeseries.segments(_series(spark, sf_dir), _CONFIG))


@query("monthly_acf", f"""WITH {OBS_LONG}, {_MONTHS}, {_SEGMENTS},
  centred AS (SELECT node_id, segment_id, month, value - avg(value) OVER (PARTITION BY node_id, segment_id) AS x FROM parts),
  pairs AS (SELECT c.node_id, c.segment_id, k AS lag, c.x, lag(c.x, CAST(k AS INTEGER)) OVER (PARTITION BY c.node_id, c.segment_id, k ORDER BY c.month) AS y
            FROM (SELECT *, unnest(generate_series(1, 6)) AS k FROM centred) c)
  SELECT node_id, CAST(segment_id AS INTEGER) AS segment_id, CAST(lag AS INTEGER) AS lag, count(*) AS n, sum(x * y) / sum(x * x) AS acf,
         (sum(x * y) / (count(*) - lag)) / (sum(x * x) / count(*)) AS adjusted FROM pairs GROUP BY 1, 2, pairs.lag HAVING pairs.lag <= greatest(1, floor((count(*) - 1) / 2))""",
       "acf adjusted")
def monthly_acf(spark, sf_dir):
    return timeseries.autocorrelation(timeseries.segments(_series(spark, sf_dir), _CONFIG), 6)


_ACF = """
centred AS (SELECT node_id, segment_id, month, value - avg(value) OVER (PARTITION BY node_id, segment_id) AS x FROM parts),
pairs AS (SELECT c.node_id, c.segment_id, k AS lag, c.x, lag(c.x, CAST(k AS INTEGER)) OVER (PARTITION BY c.node_id, c.segment_id, k ORDER BY c.month) AS y
          FROM (SELECT *, unnest(generate_series(1, 3)) AS k FROM centred) c),
r AS (SELECT node_id, segment_id, lag AS k, (sum(x * y) / (count(*) - lag)) / (sum(x * x) / count(*)) AS r FROM pairs GROUP BY 1, 2, pairs.lag),
w AS (SELECT node_id, segment_id, max(r) FILTER (k = 1) AS a, max(r) FILTER (k = 2) AS b, max(r) FILTER (k = 3) AS c FROM r GROUP BY 1, 2)"""


@query("monthly_pacf_first", f"""WITH {OBS_LONG}, {_MONTHS}, {_SEGMENTS}, {_ACF}
  SELECT node_id, CAST(segment_id AS INTEGER) AS segment_id, a AS pacf_1, (b - a * a) / (1 - a * a) AS pacf_2,
         (c - 2 * a * b + a ** 3 + a * b * b - a * a * c) / (1 - 2 * a * a + 2 * a * a * b - b * b) AS pacf_3 FROM w""", "pacf_1 pacf_2 pacf_3")
def monthly_pacf_first(spark, sf_dir):
    """The first three partial autocorrelations, which have closed forms."""
    found = timeseries.partial_autocorrelation(timeseries.autocorrelation(timeseries.segments(_series(spark, sf_dir), _CONFIG), 3))
    lag = F.col("lag")
    return found.groupBy("node_id", "segment_id").agg(*[F.max(F.when(lag == k, F.col("pacf"))).alias(f"pacf_{k}") for k in (1, 2, 3)])


@query("monthly_pacf")
def monthly_pacf(spark, sf_dir):
    return timeseries.partial_autocorrelation(timeseries.autocorrelation(timeseries.segments(_series(spark, sf_dir), _CONFIG), 6))


@query("forecast_months", f"""WITH {OBS_LONG}, l AS (SELECT node_id, CAST(date_trunc('month', max("timestamp")) AS TIMESTAMP) AS last_month FROM obs_long GROUP BY 1)
  SELECT node_id, last_month, CAST(step AS INTEGER) AS step, CAST(last_month + to_months(CAST(step AS INTEGER)) AS TIMESTAMP) AS forecast_month
  FROM (SELECT *, unnest(generate_series(1, 12)) AS step FROM l)""")
def forecast_months(spark, sf_dir):
    last = obs_long(spark, sf_dir).groupBy("node_id").agg(month_start(F.max("timestamp")).alias("last_month"))
    return timeseries.forecast_months(last, "last_month", 12)


def _matched(spark, sf_dir):
    reference = clean_reference(ref(spark, sf_dir)).select("event_id", "timestamp", "wind_speed", "wind_dir")
    node = obs(spark, sf_dir)
    # Every statistic of the paired scope reads the matched rows, so they are aligned once.
    return node, reference, held(asof.synchronise(node, reference, right_sequence="event_id"))


def _compared(observations, references):
    return comparison.model_rows(observations, min_in_weight=100.0).unionByName(
        comparison.reference_rows(references, min_in_weight=100.0), allowMissingColumns=True)


@query("comparison_rows")
def comparison_rows(spark, sf_dir):
    """Model and reference by scope: statistics, label mix, model power."""
    node, reference, matched = _matched(spark, sf_dir)
    return _compared(comparison.observation_scopes(node, matched), comparison.reference_scopes(reference, matched))


@query("comparison_intervals")
def comparison_intervals(spark, sf_dir):
    """The comparison rows with bootstrap bounds."""
    node, reference, matched = _matched(spark, sf_dir)
    observations = comparison.observation_scopes(node, matched)
    references = comparison.reference_scopes(reference, matched)
    return comparison.with_intervals(_compared(observations, references), observations, references, BootstrapConfig(replicas=40, seed=5))


@query("reference_statistics", f"""WITH {REF} SELECT 'reference' AS dataset, 'global' AS scope, avg(wind_speed) AS mean_speed, quantile_cont(wind_speed, 0.5) AS p50,
  quantile_cont(wind_speed, 0.9) AS p90, quantile_cont(wind_speed, 0.99) AS p99 FROM ref WHERE wind_speed > -9000""", "mean_speed p50 p90 p99")
def reference_statistics(spark, sf_dir):
    node, reference, matched = _matched(spark, sf_dir)
    rows = comparison.reference_rows(comparison.reference_scopes(reference, matched), min_in_weight=100.0)
    return rows.where(F.col("scope") == "global").select("dataset", "scope", "mean_speed", "p50", "p90", "p99")


@query("uncensored_ingest", f"""WITH {OBS} SELECT node_id, count(*) AS kept, avg(pred_wind_speed) AS mean_speed FROM obs WHERE pred_wind_speed > 0 GROUP BY 1""", "mean_speed")
def uncensored_ingest(spark, sf_dir):
    """Speeds arrive as text; unreadable and non-positive ones go."""
    raw = obs(spark, sf_dir).withColumn("wind_speed", F.coalesce(F.col("pred_wind_speed").cast("string"), F.lit("n/a")))
    return uncensored_records(raw, node="node_id").groupBy("node_id").agg(
        F.count(F.lit(1)).alias("kept"), F.avg("pred_wind_speed").alias("mean_speed"))


@query("uncensored_resource")
def uncensored_resource(spark, sf_dir):
    """Bootstrap of a series without posteriors under a user-given error."""
    return stages.uncensored_resource(obs(spark, sf_dir), node="node_id", speed="pred_wind_speed", rmse=1.5, replicas=50)


@query("resource_summary")
def resource_summary(spark, sf_dir):
    """The resource stages in one plan, down to the node summary."""
    # Stages the summary does not read are not built: parts of the bootstrap would run for nothing.
    options = stages.ResourceOptions(min_in_weight=100.0, tie="event_id")
    return stages.compute_resource(obs(spark, sf_dir), options, include=["node_summary"])["node_summary"].drop("geometry")
