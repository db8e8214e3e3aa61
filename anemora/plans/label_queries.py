"""Labels, counts, descriptive statistics, quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.config import RangeThresholds, TaxonomyBands
from anemora.functions.labels import label
from anemora.operators import cadence, empirical, nodes, quantiles, ranges
from anemora.plans.registry import query
from anemora.plans.tables import LABEL_TRIMMED, LABEL_UNTRIMMED, OBS, obs

_COUNTS = f"""
counts AS (
  SELECT node_id, count(*) AS total_observations,
         count(*) FILTER (WHERE lab = 'in') AS in_count, count(*) FILTER (WHERE lab = 'below') AS below_count,
         count(*) FILTER (WHERE lab = 'above') AS above_count, count(*) FILTER (WHERE lab = 'uncertain') AS uncertain_count
  FROM (SELECT node_id, {LABEL_UNTRIMMED} AS lab FROM obs) GROUP BY node_id
)"""
_RATIOS = """
ratios AS (
  SELECT *, in_count / total_observations AS in_ratio, below_count / total_observations AS below_ratio,
         above_count / total_observations AS above_ratio, uncertain_count / total_observations AS uncertain_ratio,
         below_count / total_observations + above_count / total_observations AS censored_ratio
  FROM counts
)"""
_VALID = f"""
valid AS (
  SELECT node_id, count(*) AS valid_count, avg(pred_wind_speed) AS mean_speed, stddev_samp(pred_wind_speed) AS std_speed,
         min(pred_wind_speed) AS min_speed, max(pred_wind_speed) AS max_speed,
         quantile_disc(pred_wind_speed, 0.5) AS p50, quantile_disc(pred_wind_speed, 0.9) AS p90,
         quantile_disc(pred_wind_speed, 0.99) AS p99
  FROM obs WHERE {LABEL_UNTRIMMED} = 'in' AND pred_wind_speed IS NOT NULL GROUP BY node_id
)"""
_TAXONOMY = """
diffs AS (
  SELECT node_id, CAST(epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (PARTITION BY node_id ORDER BY "timestamp") AS DOUBLE) / 1e6 AS s
  FROM obs
),
dts AS (SELECT node_id, CAST(s AS BIGINT) AS dt FROM diffs),
gaps AS (
  SELECT node_id, count(*) AS total_observations,
         count(*) FILTER (WHERE dt IS NULL OR dt = 1800) AS on_cadence_transitions,
         count(*) FILTER (WHERE dt > 1800 AND dt <= 7200) AS short_gaps, count(*) FILTER (WHERE dt > 7200) AS long_gaps,
         count(*) AS total_intervals, max(coalesce(dt, 0)) / 86400e0 AS max_gap_days
  FROM dts GROUP BY node_id
),
taxonomy AS (
  SELECT *, total_observations < 505 AND max_gap_days > 0.2 AS low_coverage,
         CASE WHEN total_observations < 490 THEN 'sparse' WHEN total_observations < 510 THEN 'moderate' ELSE 'dense' END AS coverage_band,
         CASE WHEN max_gap_days IS NULL THEN 'unknown' WHEN max_gap_days >= 0.45 THEN 'extreme_gaps'
              WHEN max_gap_days >= 0.4 THEN 'long_gaps' ELSE 'regular' END AS continuity_band
  FROM gaps
)"""
# Bands that split the nodes of these tables; the defaults are for a decade of half-hours.
BANDS = TaxonomyBands(sparse_below=490, moderate_below=510, long_gap_days=0.4, extreme_gap_days=0.45,
                      low_coverage_observations=505, low_coverage_gap_days=0.2)
_FLAGS = """
flags AS (
  SELECT r.node_id, r.total_observations, r.in_count, r.below_count, r.above_count, r.uncertain_count,
         r.in_ratio, r.below_ratio, r.above_ratio, r.uncertain_ratio, r.censored_ratio,
         coalesce(v.valid_count, 0) AS valid_count, v.mean_speed, v.std_speed, v.min_speed, v.max_speed, v.p50, v.p90, v.p99,
         t.total_observations AS taxonomy_observations, t.coverage_band, t.continuity_band,
         coalesce(t.low_coverage, FALSE) AS low_coverage,
         r.censored_ratio > 0.20 OR r.below_ratio > 0.15 OR r.in_ratio < 0.40 AS censoring_bias,
         coalesce(t.low_coverage, FALSE) OR coalesce(t.coverage_band = 'sparse', FALSE) AS coverage_bias,
         coalesce(v.valid_count, 0) < 500 AS sample_bias,
         concat_ws('; ',
           CASE WHEN r.censored_ratio > 0.20 THEN 'High censoring ratio ' || printf('%.3f', r.censored_ratio) || ' exceeds 0.20.' END,
           CASE WHEN r.below_ratio > 0.15 THEN 'Left-censored share ' || printf('%.3f', r.below_ratio) || ' above 0.15.' END,
           CASE WHEN r.in_ratio < 0.40 THEN 'In-range share ' || printf('%.3f', r.in_ratio) || ' below 0.40.' END,
           CASE WHEN t.low_coverage THEN 'Marked as low coverage in taxonomy.' END,
           CASE WHEN t.coverage_band = 'sparse' THEN 'Coverage band classified as sparse.' END,
           CASE WHEN coalesce(v.valid_count, 0) < 500 THEN 'Valid sample count ' || coalesce(v.valid_count, 0) || ' below minimum 500.' END
         ) AS bias_notes
  FROM ratios r LEFT JOIN valid v USING (node_id) LEFT JOIN taxonomy t USING (node_id)
)"""


@query("label_counts", f"WITH {OBS}, {_COUNTS} SELECT * FROM counts")
def label_counts(spark, sf_dir):
    return empirical.label_counts(obs(spark, sf_dir))


@query("label_ratios", f"WITH {OBS}, {_COUNTS}, {_RATIOS} SELECT * FROM ratios",
       "in_ratio below_ratio above_ratio uncertain_ratio censored_ratio")
def label_ratios(spark, sf_dir):
    return empirical.label_ratios(empirical.label_counts(obs(spark, sf_dir)))


@query("label_pivot", f"""WITH {OBS} SELECT node_id,
  count(*) FILTER (WHERE lab = 'below') AS below, count(*) FILTER (WHERE lab = 'in') AS "in",
  count(*) FILTER (WHERE lab = 'above') AS above, count(*) FILTER (WHERE lab = 'uncertain') AS uncertain
  FROM (SELECT node_id, {LABEL_TRIMMED} AS lab FROM obs) GROUP BY node_id""")
def label_pivot(spark, sf_dir):
    return empirical.label_pivot(obs(spark, sf_dir), label(F.col("pred_range_label")))


@query("range_counts", f"""WITH {OBS} SELECT node_id, count(*) AS total_observations,
  count(*) FILTER (WHERE lab = 'below') AS below_count, count(*) FILTER (WHERE lab = 'in') AS in_count,
  count(*) FILTER (WHERE lab = 'above') AS above_count, count(*) FILTER (WHERE lab = 'uncertain') AS uncertain_count,
  count(*) FILTER (WHERE lab = 'uncertain' AND (raw IS NULL OR lower(raw) NOT IN ('in', 'inside', 'within', 'in_range', 'below',
    'below_range', 'under', 'left', 'above', 'over', 'upper', 'right', 'uncertain', 'unknown', 'nan'))) AS unrecognised_count
  FROM (SELECT node_id, pred_range_label AS raw, {LABEL_UNTRIMMED} AS lab FROM obs) GROUP BY node_id""")
def range_counts(spark, sf_dir):
    return ranges.relational_range_counts(obs(spark, sf_dir))


@query("valid_stats", f"WITH {OBS}, {_VALID} SELECT * FROM valid",
       "mean_speed std_speed min_speed max_speed p50 p90 p99")
def valid_stats(spark, sf_dir):
    return empirical.valid_metrics(obs(spark, sf_dir))


@query("cdf_grid", f"""WITH {OBS}, q AS (
  SELECT node_id, quantile_disc(pred_wind_speed, [{', '.join(f'{i / 100:.2f}' for i in range(101))}]) AS qs
  FROM obs WHERE {LABEL_UNTRIMMED} = 'in' AND pred_wind_speed IS NOT NULL GROUP BY node_id)
  SELECT node_id, (ord - 1) / 100e0 AS percentile, wind_speed
  FROM (SELECT node_id, unnest(qs) AS wind_speed, generate_subscripts(qs, 1) AS ord FROM q)""", "percentile wind_speed")
def cdf_grid(spark, sf_dir):
    return empirical.cdf_grid(obs(spark, sf_dir))


@query("quantile_cont", f"""WITH {OBS} SELECT node_id, quantile_cont(pred_wind_speed, 0.5) AS q50,
  quantile_cont(pred_wind_speed, 0.9) AS q90, quantile_cont(pred_wind_speed, 0.99) AS q99 FROM obs
  WHERE pred_wind_speed IS NOT NULL GROUP BY node_id""", "q50 q90 q99")
def quantile_cont(spark, sf_dir):
    return quantiles.linear_quantiles(obs(spark, sf_dir), ["node_id"], "pred_wind_speed", {"q50": 0.5, "q90": 0.9, "q99": 0.99})


@query("taxonomy", f"WITH {OBS}, {_TAXONOMY} SELECT * FROM taxonomy", "max_gap_days")
def taxonomy(spark, sf_dir):
    return cadence.taxonomy(obs(spark, sf_dir), bands=BANDS)


@query("bias_flags", f"WITH {OBS}, {_COUNTS}, {_RATIOS}, {_VALID}, {_TAXONOMY}, {_FLAGS} "
       "SELECT *, censoring_bias OR coverage_bias OR sample_bias AS any_bias FROM flags",
       "in_ratio below_ratio above_ratio uncertain_ratio censored_ratio mean_speed std_speed min_speed max_speed p50 p90 p99")
def bias_flags(spark, sf_dir):
    """The empirical stage end to end: counts, ratios, statistics, taxonomy, flags and notes."""
    rows = obs(spark, sf_dir)
    return empirical.assemble_metrics(
        empirical.label_counts(rows), empirical.valid_metrics(rows), cadence.taxonomy(rows, bands=BANDS))


_LABELLED = f"""
labelled AS (
  SELECT node_id, event_id, "timestamp", pred_range_label, {LABEL_TRIMMED} AS lab, pred_wind_speed AS v,
         CASE WHEN pred_wind_speed IS NULL THEN 'uncertain' WHEN pred_wind_speed <= 5.7 THEN 'below'
              WHEN pred_wind_speed >= 17.8 THEN 'above' ELSE 'in' END AS expected,
         CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'in' WHEN event_type = 'purchase' THEN 'above' ELSE 'below' END AS det
  FROM obs
),
found AS (
  SELECT node_id, event_id, "timestamp", 'missing_speed_value' AS issue, lab AS reported_label, NULL AS expected_label,
         det AS deterministic_label, v AS wind_speed FROM labelled WHERE v IS NULL AND lab <> 'uncertain'
  UNION ALL SELECT node_id, event_id, "timestamp", 'classifier_vs_threshold', lab, expected, det, v FROM labelled
         WHERE lab <> 'uncertain' AND lab <> expected
  UNION ALL SELECT node_id, event_id, "timestamp", 'uncertain_vs_threshold', lab, expected, det, v FROM labelled
         WHERE lab = 'uncertain' AND expected IN ('below', 'above')
  UNION ALL SELECT node_id, event_id, "timestamp", 'deterministic_vs_threshold', lab, expected, det, v FROM labelled
         WHERE det <> expected
)"""


def _labelled(spark, sf_dir):
    kind = F.col("event_type")
    rows = obs(spark, sf_dir).withColumn(
        "pred_speed_range_label",
        F.when(kind.isin("click", "view", "signup"), "in").when(kind == "purchase", "above").otherwise("below"))
    return ranges.labelled(rows, RangeThresholds(), deterministic="pred_speed_range_label")


@query("discrepancies", f"WITH {OBS}, {_LABELLED} SELECT * FROM found", "wind_speed")
def discrepancies(spark, sf_dir):
    return ranges.discrepancies(_labelled(spark, sf_dir), ("node_id", "event_id", "timestamp"))


@query("label_partition", f"""WITH {OBS}, {_LABELLED} SELECT lab AS range_label, count(*) AS samples, count(v) AS speeds,
  avg(v) AS mean_speed FROM labelled GROUP BY lab""", "mean_speed")
def label_partition(spark, sf_dir):
    """All parts in one pass, since they are told apart by a column."""
    return ranges.labelled(obs(spark, sf_dir)).groupBy("range_label").agg(
        F.count(F.lit(1)).alias("samples"), F.count("speed_value").alias("speeds"), F.avg("speed_value").alias("mean_speed"))


_SUMMARY = """
issues AS (SELECT node_id, count(*) AS n FROM found GROUP BY node_id),
summary AS (
  SELECT l.node_id, count(*) AS total_observations,
         count(*) FILTER (WHERE lab = 'below') AS below_count, count(*) FILTER (WHERE lab = 'in') AS in_count,
         count(*) FILTER (WHERE lab = 'above') AS above_count, count(*) FILTER (WHERE lab = 'uncertain') AS uncertain_count,
         coalesce(max(n), 0) AS discrepancy_count,
         count(*) FILTER (WHERE lab = 'uncertain' AND lower(trim(pred_range_label)) <> 'uncertain') AS vague,
         count(*) FILTER (WHERE v IS NULL) AS speedless
  FROM labelled l LEFT JOIN issues i ON i.node_id = l.node_id GROUP BY l.node_id
),
noted AS (
  SELECT node_id, total_observations, below_count, in_count, above_count, uncertain_count, discrepancy_count,
         below_count / total_observations AS below_ratio, in_count / total_observations AS in_ratio,
         above_count / total_observations AS above_ratio, uncertain_count / total_observations AS uncertain_ratio,
         list_sort([x FOR x IN [
           CASE WHEN vague > 0 THEN vague || ' samples lack a definitive range label.' END,
           CASE WHEN speedless > 0 THEN speedless || ' samples have missing wind_speed values.' END,
           CASE WHEN uncertain_count > 0 THEN uncertain_count || ' samples marked as uncertain.' END,
           CASE WHEN discrepancy_count > 0 THEN discrepancy_count || ' threshold discrepancies detected.' END
         ] IF x IS NOT NULL]) AS notes
  FROM summary
)"""


@query("range_summary", f"""WITH {OBS}, {_LABELLED}, {_SUMMARY}
  SELECT * REPLACE (array_to_string(notes, ' | ') AS notes) FROM noted""",
       "below_ratio in_ratio above_ratio uncertain_ratio")
def range_summary(spark, sf_dir):
    return ranges.range_summary(_labelled(spark, sf_dir)).withColumn("notes", F.concat_ws(" | ", "notes"))


_COVERAGE = """
coverage AS (
  SELECT c.*, coalesce(g.m, 0) AS max_missing_seconds FROM (
    SELECT node_id, count(*) AS total_observations, count(DISTINCT "timestamp") AS distinct_observations,
           count(*) - count(DISTINCT "timestamp") AS duplicate_records,
           CAST(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1800e6) AS BIGINT) + 1 AS expected_observations,
           count(DISTINCT "timestamp") / (CAST(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1800e6) AS BIGINT) + 1) AS coverage_ratio
    FROM obs GROUP BY node_id) c
  LEFT JOIN (SELECT node_id, max(greatest(s - 1800, 0)) AS m FROM (
    SELECT node_id, CAST(epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (PARTITION BY node_id ORDER BY "timestamp") AS DOUBLE) / 1e6 AS s
    FROM obs) GROUP BY node_id) g ON g.node_id = c.node_id
)"""


@query("coverage", f"WITH {OBS}, {_COVERAGE} SELECT * FROM coverage", "coverage_ratio max_missing_seconds")
def coverage(spark, sf_dir):
    return cadence.temporal_metrics(obs(spark, sf_dir))


@query("range_quality", f"""WITH {OBS}, {_LABELLED}, {_SUMMARY}, {_COVERAGE}, joined AS (
  SELECT n.*, c.coverage_ratio, c.expected_observations, c.distinct_observations, c.duplicate_records,
         c.max_missing_seconds / 3600e0 AS max_gap_hours, (below_count + above_count) / n.total_observations AS total_censored_ratio
  FROM noted n LEFT JOIN coverage c USING (node_id))
  SELECT * REPLACE (array_to_string(list_concat(notes, [x FOR x IN [
      CASE WHEN duplicate_records > 0 THEN duplicate_records || ' duplicate timestamps detected.' END,
      CASE WHEN expected_observations > distinct_observations THEN (expected_observations - distinct_observations) || ' expected timestamps missing from the nominal cadence.' END
    ] IF x IS NOT NULL]), ' | ') AS notes),
    concat_ws(';', CASE WHEN total_censored_ratio > 0.8 THEN 'excessive_total_censoring' END,
      CASE WHEN below_ratio > 0.75 THEN 'excessive_left_censoring' END,
      CASE WHEN above_ratio > 0.25 THEN 'excessive_right_censoring' END, CASE WHEN in_ratio < 0.2 THEN 'low_in_range_share' END,
      CASE WHEN uncertain_ratio > 0.1 THEN 'excessive_uncertain_share' END,
      CASE WHEN coverage_ratio < 0.65 THEN 'insufficient_temporal_coverage' END,
      CASE WHEN max_gap_hours > 720 THEN 'temporal_gap_exceeds_threshold' END,
      CASE WHEN duplicate_records > 0 THEN 'duplicate_timestamps_detected' END) AS flags,
    NOT (in_count < 500 OR in_ratio < 0.2 OR coverage_ratio < 0.65) AS parametric_reliable,
    concat_ws(';', CASE WHEN in_count < 500 THEN 'in-range sample count ' || in_count || ' below minimum 500' END,
      CASE WHEN in_ratio < 0.2 THEN 'in-range ratio ' || printf('%.3f', in_ratio) || ' below minimum 0.2' END,
      CASE WHEN coverage_ratio < 0.65 THEN 'temporal coverage ' || printf('%.3f', coverage_ratio) || ' below minimum 0.65' END) AS reliability_reasons
  FROM joined""", "below_ratio in_ratio above_ratio uncertain_ratio coverage_ratio max_gap_hours total_censored_ratio")
def range_quality(spark, sf_dir):
    temporal = cadence.temporal_metrics(obs(spark, sf_dir)).withColumn("max_gap_hours", F.col("max_missing_seconds") / 3600.0)
    return ranges.quality_records(ranges.range_quality(ranges.range_summary(_labelled(spark, sf_dir)), temporal))


@query("simplex_check", f"""WITH {OBS} SELECT node_id, event_id,
  prob_range_below + prob_range_in * (1 + (event_id % 10) / 100e0) + prob_range_above AS posterior_sum FROM obs
  WHERE abs(prob_range_below + prob_range_in * (1 + (event_id % 10) / 100e0) + prob_range_above - 1) > 1e-6""", "posterior_sum")
def simplex_check(spark, sf_dir):
    bent = obs(spark, sf_dir).withColumn("prob_range_in", F.col("prob_range_in") * (1 + (F.col("event_id") % 10) / F.lit(100.0)))
    broken = ranges.broken_simplex(bent)
    return broken.select("node_id", "event_id", (
        F.col("prob_range_below") + F.col("prob_range_in") + F.col("prob_range_above")).alias("posterior_sum"))


@query("anomalies", f"""WITH {OBS}, g AS (
    SELECT *, epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (PARTITION BY node_id ORDER BY "timestamp") AS gap,
           prob_range_below + prob_range_in * (1 + (event_id % 3) / 100e0) + prob_range_above AS total FROM obs)
  SELECT node_id, event_id, gap / 1e6 AS gap_seconds, concat_ws(';', CASE WHEN gap > 5400000000 THEN 'gap' END, CASE WHEN abs(total - 1) > 1e-6 THEN 'posterior' END) AS anomaly
  FROM g WHERE gap > 5400000000 OR abs(total - 1) > 1e-6""", "gap_seconds")
def anomalies(spark, sf_dir):
    """Both rules: long gaps, and posteriors that were bent off the simplex."""
    bent = obs(spark, sf_dir).withColumn("prob_range_in", F.col("prob_range_in") * (1 + (F.col("event_id") % 3) / F.lit(100.0)))
    found = ranges.anomalies(cadence.with_gaps(bent))
    return found.select("node_id", "event_id", (F.col("gap_us") / F.lit(1e6)).alias("gap_seconds"), "anomaly")


@query("top_mean_speed", f"WITH {OBS}, {_VALID} SELECT node_id, mean_speed FROM valid ORDER BY mean_speed DESC NULLS LAST, node_id LIMIT 5",
       "mean_speed")
def top_mean_speed(spark, sf_dir):
    return nodes.top_nodes(empirical.valid_metrics(obs(spark, sf_dir)), "mean_speed", 5).select("node_id", "mean_speed")


@query("representative_nodes", f"""WITH {OBS}, {_COUNTS}, {_RATIOS}, {_VALID}, t AS (
    SELECT node_id, mean_speed, std_speed, censored_ratio FROM ratios JOIN valid USING (node_id)),
  lists AS (
    SELECT * FROM (SELECT node_id, 0 AS priority, 'power' AS list, row_number() OVER (ORDER BY mean_speed DESC, node_id) AS rank FROM t) WHERE rank <= 6
    UNION ALL SELECT * FROM (SELECT node_id, 1, 'uncertainty', row_number() OVER (ORDER BY std_speed DESC, node_id) AS rank FROM t) WHERE rank <= 6
    UNION ALL SELECT * FROM (SELECT node_id, 2, 'censoring', row_number() OVER (ORDER BY censored_ratio DESC, node_id) AS rank FROM t) WHERE rank <= 6),
  firsts AS (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY priority, rank) AS n FROM lists)
  SELECT node_id, CAST(priority AS INTEGER) AS priority, CAST(rank AS INTEGER) AS rank, list FROM firsts WHERE n = 1 ORDER BY priority, rank LIMIT 6""")
def representative_nodes(spark, sf_dir):
    rows = obs(spark, sf_dir)
    table = empirical.label_ratios(empirical.label_counts(rows)).join(empirical.valid_metrics(rows), "node_id")
    return nodes.representative_nodes(table, 6, [
        ("power", "mean_speed", False), ("uncertainty", "std_speed", False), ("censoring", "censored_ratio", False)])
