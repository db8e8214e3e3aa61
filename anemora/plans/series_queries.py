"""Time grids, alignment, directions, seasons, dependence, joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.config import PowerCurve
from anemora.functions.scalars import curve_kw, month_start, season, season_start, season_year
from anemora.operators import asof, cadence, dependence, direction, nodes, seasonal
from anemora.plans.registry import query
from anemora.plans.tables import LABEL_TRIMMED, OBS, OBS_LONG, REF, obs, obs_long, ref, table

_SLOTS = """
slots AS (
  SELECT node_id, us, copies, event_id FROM (
    SELECT node_id, us, event_id, count(*) OVER (PARTITION BY node_id, us) AS copies,
           row_number() OVER (PARTITION BY node_id, us ORDER BY event_id) AS rn
    FROM (SELECT node_id, event_id,
            CASE WHEN 2 * r > 1800000000 OR (2 * r = 1800000000 AND q % 2 = 1) THEN (q + 1) * 1800000000 ELSE q * 1800000000 END AS us
          FROM (SELECT node_id, event_id, epoch_us("timestamp") % 1800000000 AS r, epoch_us("timestamp") // 1800000000 AS q FROM obs)))
  WHERE rn = 1
),
deltas AS (SELECT node_id, us, us - lag(us) OVER (PARTITION BY node_id ORDER BY us) AS d FROM slots),
windows AS (
  SELECT node_id, make_timestamp(us - d + 1800000000) AS gap_start, make_timestamp(us - d + 1800000000 * (CAST(ceil(d / 1800e6) AS BIGINT) - 1)) AS gap_end,
         CAST(ceil(d / 1800e6) AS BIGINT) - 1 AS missing_steps
  FROM deltas WHERE d > 2100000000
)"""


def _slots(spark, sf_dir):
    return cadence.normalise(obs(spark, sf_dir).select("node_id", "timestamp", "event_id"), sequence="event_id")


@query("dedup_cadence", f'WITH {OBS}, {_SLOTS} SELECT node_id, make_timestamp(us) AS "timestamp", copies, event_id FROM slots')
def dedup_cadence(spark, sf_dir):
    return _slots(spark, sf_dir).select("node_id", "timestamp", "copies", "event_id")


@query("gap_windows", f"WITH {OBS}, {_SLOTS} SELECT * FROM windows")
def gap_windows(spark, sf_dir):
    return cadence.gap_windows(_slots(spark, sf_dir))


@query("temporal_summary", f"""WITH {OBS}, {_SLOTS}, w AS (
    SELECT node_id, sum(missing_steps) AS missing, count(*) AS n FROM windows GROUP BY node_id),
  s AS (SELECT node_id, count(*) AS total_observations, sum(copies - 1) AS duplicate_records, min(us) AS a, max(us) AS b FROM slots GROUP BY node_id),
  d AS (SELECT node_id, count(d) AS sample_count, min(d) / 1e6 AS min_gap_seconds, max(d) / 1e6 AS max_gap_seconds, avg(d / 1e6) AS mean_gap_seconds,
          stddev_pop(d / 1e6) AS std_gap_seconds, quantile_cont(d / 1e6, 0.5) AS median_gap_seconds,
          coalesce(bool_or(abs(d - 1800000000) > 300000000), FALSE) AS irregular_cadence FROM deltas GROUP BY node_id),
  j AS (SELECT node_id, total_observations, CAST(duplicate_records AS BIGINT) AS duplicate_records, (b - a) // 1800000000 + 1 AS expected_observations,
          CAST(greatest(coalesce(missing, 0), (b - a) // 1800000000 + 1 - total_observations, 0) AS BIGINT) AS missing_observations,
          make_timestamp(a) AS sampling_start, make_timestamp(b) AS sampling_end, sample_count, min_gap_seconds, max_gap_seconds,
          mean_gap_seconds, std_gap_seconds, median_gap_seconds, irregular_cadence, duplicate_records > 0 AS has_duplicates,
          coalesce(n, 0) > 0 AS has_gaps
        FROM s JOIN d USING (node_id) LEFT JOIN w USING (node_id)),
  c AS (SELECT *, total_observations / (total_observations + missing_observations) AS coverage_ratio FROM j)
  SELECT *, coverage_ratio < 0.8 AS insufficient_coverage, concat_ws('; ',
    CASE WHEN duplicate_records > 0 THEN 'Removed ' || duplicate_records || ' duplicate records after temporal normalisation' END,
    CASE WHEN missing_observations > 0 THEN 'Identified ' || missing_observations || ' missing observations' END,
    CASE WHEN irregular_cadence THEN 'Observed cadence deviates from expected interval beyond configured tolerance' END,
    CASE WHEN coverage_ratio < 0.8 THEN 'Coverage ratio ' || printf('%.3f', coverage_ratio) || ' below threshold 0.800' END) AS notes
  FROM c""", "min_gap_seconds max_gap_seconds mean_gap_seconds std_gap_seconds median_gap_seconds coverage_ratio")
def temporal_summary(spark, sf_dir):
    out = cadence.temporal_summary(_slots(spark, sf_dir)).withColumn("notes", F.concat_ws("; ", "notes"))
    return out.drop("gap_distribution", "gap_window_count")


@query("gap_distribution", f"""WITH {OBS}, {_SLOTS} SELECT node_id, CAST(d // 1000000 AS BIGINT) AS gap_seconds, count(*) AS gap_count
  FROM deltas WHERE d IS NOT NULL GROUP BY node_id, d""")
def gap_distribution(spark, sf_dir):
    summary = cadence.temporal_summary(_slots(spark, sf_dir))
    return summary.select("node_id", F.explode("gap_distribution").alias("gap_seconds", "gap_count"))


@query("cadence_mode", f"""WITH {REF}, d AS (
    SELECT CAST(floor((epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (ORDER BY "timestamp")) / 1e6) AS BIGINT) AS s FROM ref),
  h AS (SELECT s, count(*) AS n FROM d WHERE s IS NOT NULL GROUP BY s)
  SELECT (SELECT min(s) FROM h WHERE n = (SELECT max(n) FROM h)) AS nominal_seconds, string_agg(s, ',' ORDER BY s) AS intervals,
         CAST(sum(n) AS BIGINT) AS sample_count FROM h""")
def cadence_mode(spark, sf_dir):
    out = cadence.cadence_mode(ref(spark, sf_dir))
    return out.select("nominal_seconds", F.array_join(F.col("unique_intervals").cast("array<string>"), ",").alias("intervals"), "sample_count")


@query("sentinel_filter", f"""WITH {REF} SELECT event_id, "timestamp", wind_speed, CASE WHEN wind_dir > -9000 THEN wind_dir END AS wind_dir
  FROM ref WHERE wind_speed > -9000""", "wind_speed wind_dir")
def sentinel_filter(spark, sf_dir):
    from anemora.sources.readers import clean_reference

    return clean_reference(ref(spark, sf_dir))


@query("sentinel_counts", f"""WITH {REF} SELECT count(*) AS total_rows, count(*) FILTER (WHERE wind_speed <= -9000) AS speed_sentinels,
  count(*) FILTER (WHERE wind_speed > -9000 AND wind_dir <= -9000) AS direction_sentinels,
  count(*) FILTER (WHERE wind_speed > -9000) AS kept_rows FROM ref""")
def sentinel_counts(spark, sf_dir):
    from anemora.sources.readers import reference_quality

    return reference_quality(ref(spark, sf_dir))


# -- as-of ----------------------------------------------------------------------
def _sides(spark, sf_dir):
    left = obs(spark, sf_dir).select("node_id", "event_id", "timestamp", "pred_wind_speed")
    right = ref(spark, sf_dir)
    return left, right


def _minute(df):
    """Whole minutes, so that exact and duplicate times occur."""
    return df.withColumn("timestamp", F.date_trunc("MINUTE", "timestamp").cast("timestamp_ntz"))


_MINUTES = """
lefts AS (SELECT node_id, event_id, date_trunc('minute', "timestamp") AS ts, pred_wind_speed FROM obs),
rights AS (SELECT event_id, date_trunc('minute', "timestamp") AS ts, wind_speed FROM ref)"""
_BACK = """
back AS (
  SELECT event_id, max(r_pos) AS pos FROM (
    SELECT event_id, side, max(CASE WHEN side = 0 THEN (epoch_us(ts) // 1000000) * 1000000 + rid END) OVER (ORDER BY ts, side, rid ROWS UNBOUNDED PRECEDING) AS r_pos
    FROM (SELECT ts, 0 AS side, event_id AS rid, NULL AS event_id FROM rights UNION ALL SELECT ts, 1, 0, event_id FROM lefts))
  WHERE side = 1 GROUP BY event_id
)"""
_AHEAD = """
ahead AS (
  SELECT event_id, max(r_pos) AS pos FROM (
    SELECT event_id, side, min(CASE WHEN side = 0 THEN (epoch_us(ts) // 1000000) * 1000000 + rid END) OVER (ORDER BY ts, side, rid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r_pos
    FROM (SELECT ts, 0 AS side, event_id AS rid, NULL AS event_id FROM rights UNION ALL SELECT ts, 1, 0, event_id FROM lefts))
  WHERE side = 1 GROUP BY event_id
)"""
_RIGHT_KEYED = "keyed AS (SELECT (epoch_us(ts) // 1000000) * 1000000 + event_id AS pos, * FROM rights)"
_ASOF_COLUMNS = ("time_offset_seconds pred_wind_speed wind_speed_ref")


@query("asof_exact", f"""WITH {OBS}, {REF}, {_MINUTES}, last AS (
    SELECT ts, max(event_id) AS event_id FROM rights GROUP BY ts)
  SELECT l.node_id, l.event_id, l.ts AS "timestamp", l.pred_wind_speed, r.event_id AS event_id_ref, r.wind_speed AS wind_speed_ref, 0e0 AS time_offset_seconds, TRUE AS is_exact_match
  FROM lefts l JOIN last USING (ts) JOIN rights r ON r.event_id = last.event_id""", _ASOF_COLUMNS)
def asof_exact(spark, sf_dir):
    left, right = map(_minute, _sides(spark, sf_dir))
    return asof.synchronise(left, right.select("event_id", "timestamp", "wind_speed"), prefer_nearest=False,
                            right_sequence="event_id").drop("timestamp_ref")


@query("asof_backward", f"""WITH {OBS}, {REF}, {_MINUTES}, {_BACK}, {_RIGHT_KEYED}
  SELECT l.node_id, l.event_id, l.ts AS "timestamp", l.pred_wind_speed, k.event_id AS event_id_ref, k.wind_speed AS wind_speed_ref,
         epoch(l.ts) - epoch(k.ts) AS time_offset_seconds, l.ts = k.ts AS is_exact_match
  FROM lefts l JOIN back b ON b.event_id = l.event_id LEFT JOIN keyed k ON k.pos = b.pos AND epoch(l.ts) - epoch(k.ts) <= 1800""", _ASOF_COLUMNS)
def asof_backward(spark, sf_dir):
    left, right = map(_minute, _sides(spark, sf_dir))
    return asof.asof_join(left, right.select("event_id", "timestamp", "wind_speed"), direction="backward",
                          right_sequence="event_id").drop("timestamp_ref")


_NEAREST = f"""WITH {OBS}, {REF}, {_MINUTES}, {_BACK}, {_AHEAD}, {_RIGHT_KEYED}, near AS (
  SELECT l.node_id, l.event_id, l.ts AS "timestamp", l.pred_wind_speed,
         CASE WHEN p.ts IS NOT NULL AND (f.ts IS NULL OR epoch(l.ts) - epoch(p.ts) <= epoch(f.ts) - epoch(l.ts)) THEN p.event_id ELSE f.event_id END AS event_id_ref
  FROM lefts l JOIN back b ON b.event_id = l.event_id JOIN ahead a ON a.event_id = l.event_id
  LEFT JOIN keyed p ON p.pos = b.pos AND epoch(l.ts) - epoch(p.ts) <= 1800
  LEFT JOIN keyed f ON f.pos = a.pos AND epoch(f.ts) - epoch(l.ts) <= 1800),
matched AS (
  SELECT n.*, r.wind_speed AS wind_speed_ref, epoch(n."timestamp") - epoch(r.ts) AS time_offset_seconds, n."timestamp" = r.ts AS is_exact_match
  FROM near n JOIN rights r ON r.event_id = n.event_id_ref)"""


@query("asof_nearest", f"{_NEAREST} SELECT * FROM matched", _ASOF_COLUMNS)
def asof_nearest(spark, sf_dir):
    left, right = map(_minute, _sides(spark, sf_dir))
    return asof.synchronise(left, right.select("event_id", "timestamp", "wind_speed"),
                            right_sequence="event_id").drop("timestamp_ref")


@query("sync_summary", f"""{_NEAREST}, n AS (SELECT count(*) AS m, count(*) FILTER (WHERE is_exact_match) AS e FROM matched),
  t AS (SELECT (SELECT count(*) FROM lefts) AS l, (SELECT count(*) FROM rights) AS r)
  SELECT m AS matched_rows, l - m AS unmatched_rows, greatest(r - m, 0) AS unmatched_reference_rows, e AS exact_matches,
         m - e AS nearest_matches, m / l AS match_ratio, m / r AS match_ratio_reference FROM n, t""", "match_ratio match_ratio_reference")
def sync_summary(spark, sf_dir):
    left, right = map(_minute, _sides(spark, sf_dir))
    right = right.select("event_id", "timestamp", "wind_speed")
    return asof.synchronisation_summary(asof.synchronise(left, right, right_sequence="event_id"), left, right)


# -- directions -------------------------------------------------------------------
def _pairs(spark, sf_dir):
    """Modelled and observed direction of each event, with sentinels and gaps."""
    e, d = F.col("event_id"), F.col("pred_wind_direction")
    return obs(spark, sf_dir).withColumns({
        "predicted": F.when(e % 31 != 0, d),
        "observed": F.when(e % 41 == 0, F.lit(-10000.0)).otherwise((e * 7 % 360).cast("double")),
    })


_PAIRS = """
pairs AS (
  SELECT *, CASE WHEN event_id % 31 <> 0 THEN pred_wind_direction END AS predicted,
         CASE WHEN event_id % 41 = 0 THEN -10000e0 ELSE CAST(event_id * 7 % 360 AS DOUBLE) END AS observed FROM obs
),
errors AS (
  SELECT *, ((predicted - observed + 180e0) % 360 + 360) % 360 - 180 AS err FROM pairs
  WHERE predicted IS NOT NULL AND observed > -9000 AND predicted > -9000
)"""
_METRICS = """count(*) AS valid_pairs, avg(abs(err)) AS mean_absolute_error_deg, sqrt(avg(err * err)) AS root_mean_square_error_deg,
  CASE WHEN abs(avg(sin(radians(err)))) <= 1e-12 AND abs(avg(cos(radians(err)))) <= 1e-12 THEN 0e0
       ELSE degrees(atan2(avg(sin(radians(err))), avg(cos(radians(err))))) END AS circular_bias_deg,
  max(abs(err)) AS max_absolute_error_deg, quantile_cont(abs(err), 0.5) AS absolute_error_p50_deg,
  quantile_cont(abs(err), 0.9) AS absolute_error_p90_deg, quantile_cont(abs(err), 0.99) AS absolute_error_p99_deg"""
_METRIC_COLUMNS = ("mean_absolute_error_deg root_mean_square_error_deg circular_bias_deg max_absolute_error_deg "
                   "absolute_error_p50_deg absolute_error_p90_deg absolute_error_p99_deg")


@query("direction_errors", f"WITH {OBS}, {_PAIRS} SELECT event_id, predicted AS predicted_direction_deg, observed AS observed_direction_deg, "
       "err AS angular_error_deg, abs(err) AS absolute_error_deg FROM errors",
       "predicted_direction_deg observed_direction_deg angular_error_deg absolute_error_deg")
def direction_errors(spark, sf_dir):
    return direction.direction_errors(_pairs(spark, sf_dir), "predicted", "observed", ["event_id"])


@query("direction_quality", f"""WITH {OBS}, {_PAIRS} SELECT node_id, count(*) AS total_pairs,
  count(*) FILTER (WHERE predicted IS NULL OR observed IS NULL) AS missing_pairs,
  count(*) FILTER (WHERE predicted <= -9000 OR observed <= -9000) AS sentinel_pairs, count(*) FILTER (WHERE FALSE) AS nonfinite_pairs,
  count(*) FILTER (WHERE predicted IS NOT NULL AND observed > -9000) AS valid_pairs FROM pairs GROUP BY node_id""")
def direction_quality(spark, sf_dir):
    return direction.quality_summary(_pairs(spark, sf_dir), ["node_id"], "predicted", "observed")


@query("circular_mean", f"WITH {OBS}, {_PAIRS} SELECT node_id, {_METRICS} FROM errors GROUP BY node_id", _METRIC_COLUMNS)
def circular_mean(spark, sf_dir):
    errors = direction.direction_errors(_pairs(spark, sf_dir), "predicted", "observed", ["node_id"])
    return direction.error_metrics(errors, ["node_id"])


@query("direction_scenarios", f"""WITH {OBS}, {_PAIRS}, tagged AS (
    SELECT 'all' AS scenario, * FROM errors UNION ALL SELECT 'confident', * FROM errors WHERE range_flag_confident
    UNION ALL SELECT 'confident_in_range', * FROM errors WHERE range_flag_confident AND lower(trim(pred_range_label)) = 'in'),
  tagged_pairs AS (
    SELECT 'all' AS scenario, * FROM pairs UNION ALL SELECT 'confident', * FROM pairs WHERE range_flag_confident
    UNION ALL SELECT 'confident_in_range', * FROM pairs WHERE range_flag_confident AND lower(trim(pred_range_label)) = 'in'),
  q AS (SELECT scenario, count(*) AS total_pairs, count(*) FILTER (WHERE predicted IS NULL OR observed IS NULL) AS missing_pairs,
          count(*) FILTER (WHERE predicted <= -9000 OR observed <= -9000) AS sentinel_pairs,
          count(*) FILTER (WHERE FALSE) AS nonfinite_pairs FROM tagged_pairs GROUP BY scenario)
  SELECT q.*, m.* EXCLUDE (scenario), (SELECT count(*) FROM pairs) AS matched_pairs, m.valid_pairs / (SELECT count(*) FROM pairs) AS coverage_ratio
  FROM q JOIN (SELECT scenario, {_METRICS} FROM tagged GROUP BY scenario) m USING (scenario)""", _METRIC_COLUMNS + " coverage_ratio")
def direction_scenarios(spark, sf_dir):
    return direction.scenario_metrics(_pairs(spark, sf_dir), "predicted", "observed", "pred_range_label", "range_flag_confident")


@query("wind_rose", f"""WITH {OBS} SELECT node_id, CAST(floor(pred_wind_direction / 30) AS INTEGER) % 12 AS sector,
  sum(coalesce(pred_wind_speed, 0)) AS weight, count(*) AS samples FROM obs GROUP BY 1, 2""", "weight")
def wind_rose(spark, sf_dir):
    return direction.wind_rose(obs(spark, sf_dir), weight=F.col("pred_wind_speed"))


@query("reference_rose", f"""WITH {REF} SELECT CAST(floor(wind_dir / 30) AS INTEGER) % 12 AS sector, count(*) AS samples
  FROM ref WHERE wind_dir BETWEEN 0 AND 360 GROUP BY 1""")
def reference_rose(spark, sf_dir):
    return direction.reference_rose(ref(spark, sf_dir))


# -- seasons ----------------------------------------------------------------------
_SEASON = """CASE WHEN month("timestamp") IN (12, 1, 2) THEN 'DJF' WHEN month("timestamp") IN (3, 4, 5) THEN 'MAM'
  WHEN month("timestamp") IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END"""
_STATS = """count(v) AS sample_count, avg(v) AS mean_speed, stddev_pop(v) AS std_speed, quantile_cont(v, 0.5) AS p50_speed,
  quantile_cont(v, 0.9) AS p90_speed, quantile_cont(v, 0.99) AS p99_speed"""
_SLICES = f"""
labelled AS (SELECT *, {LABEL_TRIMMED} AS lab, {_SEASON} AS season, year("timestamp") AS y FROM obs_long),
inside AS (SELECT *, CASE WHEN lab = 'in' THEN pred_wind_speed END AS v FROM labelled),
seasonal AS (
  SELECT node_id, season, {_STATS}, count(*) FILTER (WHERE lab = 'below') / count(*) AS below_ratio,
         count(*) FILTER (WHERE lab = 'in') / count(*) AS in_ratio, count(*) FILTER (WHERE lab = 'above') / count(*) AS above_ratio,
         count(*) FILTER (WHERE lab = 'uncertain') / count(*) AS uncertain_ratio
  FROM inside GROUP BY node_id, season
),
annual AS (SELECT node_id, y AS year, {_STATS} FROM inside WHERE v IS NOT NULL GROUP BY node_id, y),
trends AS (SELECT node_id, count(*) AS annual_samples, regr_slope(mean_speed, year) AS annual_trend_slope, CAST(NULL AS VARCHAR) AS trend_note FROM annual GROUP BY node_id),
variation AS (
  SELECT s.*, 'm/s per year' AS annual_trend_units, annual_samples, annual_trend_slope, trend_note
  FROM (SELECT node_id, arg_max(season, mean_speed) AS strongest_season, arg_min(season, mean_speed) AS weakest_season,
               max(mean_speed) - min(mean_speed) AS seasonal_amplitude, stddev_pop(mean_speed) AS seasonal_mean_std, count(*) AS seasonal_coverage
        FROM seasonal GROUP BY node_id) s JOIN trends USING (node_id)
)"""
_STAT_COLUMNS = "mean_speed std_speed p50_speed p90_speed p99_speed"


@query("seasonal_slices", f"WITH {OBS_LONG}, {_SLICES} SELECT * FROM seasonal",
       _STAT_COLUMNS + " below_ratio in_ratio above_ratio uncertain_ratio")
def seasonal_slices(spark, sf_dir):
    return seasonal.seasonal_slices(obs_long(spark, sf_dir))


@query("annual_slices", f"WITH {OBS_LONG}, {_SLICES} SELECT * FROM annual", _STAT_COLUMNS)
def annual_slices(spark, sf_dir):
    return seasonal.annual_slices(obs_long(spark, sf_dir))


@query("trend_slope", f"WITH {OBS_LONG}, {_SLICES} SELECT * FROM trends", "annual_trend_slope")
def trend_slope(spark, sf_dir):
    return seasonal.trend(seasonal.annual_slices(obs_long(spark, sf_dir)))


def _variation(spark, sf_dir):
    rows = obs_long(spark, sf_dir)
    return seasonal.variation(seasonal.seasonal_slices(rows), seasonal.annual_slices(rows))


@query("variation", f"WITH {OBS_LONG}, {_SLICES} SELECT * FROM variation", "seasonal_amplitude seasonal_mean_std annual_trend_slope")
def variation(spark, sf_dir):
    return _variation(spark, sf_dir)


@query("variation_overview", f"""WITH {OBS_LONG}, {_SLICES} SELECT count(*) AS nodes, quantile_cont(seasonal_amplitude, 0.5) AS median_amplitude,
  quantile_cont(annual_trend_slope, 0.5) AS median_trend FROM variation""", "median_amplitude median_trend")
def variation_overview(spark, sf_dir):
    return seasonal.variation_overview(_variation(spark, sf_dir))


@query("variation_leaders", f"""WITH {OBS_LONG}, {_SLICES}
  (SELECT 'amplitude' AS list, node_id, seasonal_amplitude AS value FROM variation ORDER BY seasonal_amplitude DESC, node_id LIMIT 5)
  UNION ALL (SELECT 'positive_trend', node_id, annual_trend_slope FROM variation ORDER BY annual_trend_slope DESC, node_id LIMIT 5)
  UNION ALL (SELECT 'negative_trend', node_id, annual_trend_slope FROM variation ORDER BY annual_trend_slope, node_id LIMIT 5)""", "value")
def variation_leaders(spark, sf_dir):
    return nodes.variation_leaders(_variation(spark, sf_dir))


@query("month_rollup", f"""WITH {OBS_LONG} SELECT node_id, CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS period_start, count(*) AS total_observations,
  avg(pred_wind_speed) AS mean_speed FROM obs_long GROUP BY 1, 2""", "mean_speed")
def month_rollup(spark, sf_dir):
    return obs_long(spark, sf_dir).groupBy("node_id", month_start(F.col("timestamp")).alias("period_start")).agg(
        F.count(F.lit(1)).alias("total_observations"), F.avg("pred_wind_speed").alias("mean_speed"))


@query("season_rollup", f"""WITH {OBS_LONG}, s AS (SELECT *, {_SEASON} AS season,
    year("timestamp") + CASE WHEN month("timestamp") = 12 THEN 1 ELSE 0 END AS season_year FROM obs_long)
  SELECT node_id, season, season_year, make_timestamp(CASE season WHEN 'DJF' THEN season_year - 1 ELSE season_year END,
           CASE season WHEN 'DJF' THEN 12 WHEN 'MAM' THEN 3 WHEN 'JJA' THEN 6 ELSE 9 END, 1, 0, 0, 0) AS period_start,
         count(*) AS total_observations, avg(pred_wind_speed) AS mean_speed FROM s GROUP BY ALL""", "mean_speed")
def season_rollup(spark, sf_dir):
    rows = obs_long(spark, sf_dir).withColumns({"season": season(F.col("timestamp")), "season_year": season_year(F.col("timestamp"))})
    return rows.groupBy("node_id", "season", "season_year").agg(
        F.count(F.lit(1)).alias("total_observations"), F.avg("pred_wind_speed").alias("mean_speed"),
    ).withColumn("period_start", season_start(F.col("season"), F.col("season_year")))


# -- dependence -------------------------------------------------------------------
_LAGS = """
base AS (SELECT node_id, "timestamp" AS ts, pred_wind_speed AS v FROM obs WHERE pred_wind_speed IS NOT NULL),
lagged AS (
  SELECT node_id, v, date_diff('second', lag(ts) OVER w, ts) AS gap, lag(v, 1) OVER w AS v1, lag(v, 2) OVER w AS v2, lag(v, 3) OVER w AS v3
  FROM base WINDOW w AS (PARTITION BY node_id ORDER BY ts)
),
dep AS (
  SELECT node_id, count(*) AS sample_count, avg(gap) AS mean_gap_seconds, stddev_samp(gap) AS std_gap_seconds,
         count(v1) AS pair_count_lag_1, count(v2) AS pair_count_lag_2, count(v3) AS pair_count_lag_3,
         CASE WHEN count(v1) >= 30 THEN corr(v, v1) END AS acf_lag_1, CASE WHEN count(v2) >= 30 THEN corr(v, v2) END AS acf_lag_2,
         CASE WHEN count(v3) >= 30 THEN corr(v, v3) END AS acf_lag_3
  FROM lagged GROUP BY node_id
),
sized AS (
  SELECT *, sample_count * ((1 - acf_lag_1) / (1 + acf_lag_1)) AS effective_sample_size,
         least(greatest(1, CAST(round_even(sample_count / (sample_count * ((1 - acf_lag_1) / (1 + acf_lag_1))), 0) AS BIGINT)), sample_count) AS suggested_block_length
  FROM dep
)"""


@query("lag_correlations", f"WITH {OBS}, {_LAGS} SELECT * FROM sized",
       "mean_gap_seconds std_gap_seconds acf_lag_1 acf_lag_2 acf_lag_3 effective_sample_size")
def lag_correlations(spark, sf_dir):
    return dependence.lag_metrics(obs(spark, sf_dir))


@query("dependence_levels", f"""WITH {OBS}, {_LAGS} SELECT count(*) AS nodes,
  avg(CASE WHEN acf_lag_1 >= 0.0 THEN 1e0 ELSE 0e0 END) AS share_acf_ge_0, avg(CASE WHEN acf_lag_1 >= 0.1 THEN 1e0 ELSE 0e0 END) AS share_acf_ge_1,
  avg(acf_lag_1) AS mean_acf, quantile_cont(acf_lag_1, 0.5) AS median_acf, avg(suggested_block_length) AS mean_block_length,
  quantile_cont(CAST(suggested_block_length AS DOUBLE), 0.5) AS median_block_length FROM sized""",
       "share_acf_ge_0 share_acf_ge_1 mean_acf median_acf mean_block_length median_block_length")
def dependence_levels(spark, sf_dir):
    return dependence.dependence_levels(dependence.lag_metrics(obs(spark, sf_dir)), (0.0, 0.1))


# -- lookups ----------------------------------------------------------------------
CURVE = PowerCurve()
_CURVE_SQL = "CASE WHEN x IS NULL THEN NULL " + " ".join(
    f"WHEN x < {v1}e0 THEN {p0}e0 + (x - {v0}e0) * ({p1}e0 - {p0}e0) / ({v1}e0 - {v0}e0)"
    for v0, p0, v1, p1 in zip(CURVE.speeds, CURVE.power_kw, CURVE.speeds[1:], CURVE.power_kw[1:])
) + f" ELSE {CURVE.power_kw[-1]}e0 END"


@query("power_curve_lookup", f"WITH {OBS}, p AS (SELECT node_id, event_id, pred_wind_speed AS x FROM obs) "
       f"SELECT node_id, event_id, x AS pred_wind_speed, {_CURVE_SQL} AS power_kw FROM p", "pred_wind_speed power_kw")
def power_curve_lookup(spark, sf_dir):
    rows = obs(spark, sf_dir)
    return rows.select("node_id", "event_id", "pred_wind_speed", curve_kw(F.col("pred_wind_speed"), CURVE).alias("power_kw"))


_VERSIONS = "VALUES ('first', 2.5e0, TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-12'), ('second', 2.9e0, TIMESTAMP '2024-01-10', NULL)"


@query("rmse_interval", f"""WITH {OBS}, recs(version, rmse, a, b) AS ({_VERSIONS}), hit AS (
    SELECT event_id, version, rmse, row_number() OVER (PARTITION BY event_id ORDER BY a DESC) AS n
    FROM obs LEFT JOIN recs ON a <= "timestamp" AND (b IS NULL OR "timestamp" < b))
  SELECT event_id, version, rmse FROM hit WHERE n = 1""", "rmse")
def rmse_interval(spark, sf_dir):
    from datetime import datetime, timezone

    from anemora.config import RmseRecord
    from anemora.operators.lookup import effective_record

    day = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    records = [RmseRecord("first", 2.5, day(5), day(12)), RmseRecord("second", 2.9, day(10))]
    rows = obs(spark, sf_dir).select("event_id", "timestamp")
    return effective_record(rows, records).select("event_id", "version", "rmse")


# -- node tables ------------------------------------------------------------------
def _suppliers(spark, sf_dir):
    """Three per-supplier tables whose keys overlap in part, shaped like the stage outputs."""
    items = table(spark, sf_dir, "lineitem")
    def shifted(by):
        return (F.col("l_suppkey") + by).cast("string").alias("node_id")

    power = items.groupBy(shifted(30)).agg(
        F.avg("l_extendedprice").alias("power_density_w_m2"),
        F.when(F.count(F.lit(1)) % 2 == 0, "weibull").otherwise("kaplan_meier").alias("method"),
        F.when(F.max("l_linenumber") % 2 == 1, F.count(F.lit(1)) % 4 != 0).alias("weibull_reliable"),
        (F.count(F.lit(1)) % 5 == 0).alias("weibull_success"))
    empirical = items.groupBy(shifted(0)).agg(
        F.count(F.lit(1)).alias("valid_count"), F.avg("l_quantity").alias("mean_speed"), F.min("l_quantity").alias("min_speed"),
        F.max("l_quantity").alias("max_speed"), F.min("l_discount").alias("p50"), F.max("l_discount").alias("p90"),
        F.when(F.count(F.lit(1)) % 7 != 0, F.count(F.lit(1)) % 3 == 0).alias("any_bias"))
    km = items.groupBy(shifted(60)).agg(
        F.min("l_tax").alias("km_p50"), F.max("l_tax").alias("km_p90"))
    geometry = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("node_id"), F.col("s_name").alias("geometry"))
    return power, empirical, km, geometry


_STAR = """
power AS (SELECT CAST(l_suppkey + 30 AS VARCHAR) AS node_id, avg(l_extendedprice) AS power_density_w_m2,
    CASE WHEN count(*) % 2 = 0 THEN 'weibull' ELSE 'kaplan_meier' END AS method,
    CASE WHEN max(l_linenumber) % 2 = 1 THEN count(*) % 4 <> 0 END AS weibull_reliable, count(*) % 5 = 0 AS weibull_success
  FROM lineitem GROUP BY 1),
empirical AS (SELECT CAST(l_suppkey AS VARCHAR) AS node_id, count(*) AS valid_count, avg(l_quantity) AS mean_speed, min(l_quantity) AS min_speed,
    max(l_quantity) AS max_speed, min(l_discount) AS p50, max(l_discount) AS p90, CASE WHEN count(*) % 7 <> 0 THEN count(*) % 3 = 0 END AS any_bias
  FROM lineitem GROUP BY 1),
km AS (SELECT CAST(l_suppkey + 60 AS VARCHAR) AS node_id, min(l_tax) AS km_p50, max(l_tax) AS km_p90 FROM lineitem GROUP BY 1),
geometry AS (SELECT CAST(s_suppkey AS VARCHAR) AS node_id, s_name AS geometry FROM supplier),
spine AS (SELECT node_id FROM power UNION SELECT node_id FROM empirical UNION SELECT node_id FROM km)"""


@query("node_spine", f"WITH {_STAR} SELECT * FROM spine")
def node_spine(spark, sf_dir):
    power, empirical, km, _ = _suppliers(spark, sf_dir)
    return nodes.node_spine(power, empirical, km)


@query("node_summary", f"""WITH {_STAR} SELECT n.node_id, g.geometry, p.method AS selected_method,
    CASE WHEN p.method = 'weibull' AND k.km_p50 IS NOT NULL THEN 'kaplan_meier'
         WHEN p.method = 'kaplan_meier' AND (p.weibull_reliable IS TRUE OR p.weibull_success IS TRUE) THEN 'weibull' END AS alternate_method,
    CASE WHEN p.method = 'weibull' THEN (p.weibull_reliable IS TRUE) AND (e.any_bias IS FALSE OR e.any_bias IS NULL)
         WHEN p.method = 'kaplan_meier' THEN (e.any_bias IS FALSE OR e.any_bias IS NULL) END AS reliable_estimate,
    p.power_density_w_m2, p.weibull_reliable, p.weibull_success, e.valid_count, e.mean_speed AS mean_speed_m_s,
    e.min_speed AS min_speed_m_s, e.max_speed AS max_speed_m_s, e.p50 AS speed_p50_m_s, e.p90 AS speed_p90_m_s, e.any_bias,
    e.max_speed - e.min_speed AS in_range_span_m_s, e.p90 - e.p50 AS p90_minus_p50_m_s, k.km_p50 AS km_p50_m_s, k.km_p90 AS km_p90_m_s,
    k.km_p90 - k.km_p50 AS km_interval_width_m_s
  FROM spine n LEFT JOIN power p ON p.node_id = n.node_id LEFT JOIN empirical e ON e.node_id = n.node_id
  LEFT JOIN km k ON k.node_id = n.node_id LEFT JOIN geometry g ON g.node_id = n.node_id""",
       "power_density_w_m2 mean_speed_m_s min_speed_m_s max_speed_m_s speed_p50_m_s speed_p90_m_s in_range_span_m_s "
       "p90_minus_p50_m_s km_p50_m_s km_p90_m_s km_interval_width_m_s")
def node_summary(spark, sf_dir):
    return nodes.node_summary(*_suppliers(spark, sf_dir))


@query("publish_join", f"WITH {_STAR} SELECT p.*, g.geometry, e.* EXCLUDE (node_id) FROM power p JOIN geometry g USING (node_id) LEFT JOIN empirical e USING (node_id)",
       "power_density_w_m2 mean_speed min_speed max_speed p50 p90")
def publish_join(spark, sf_dir):
    power, empirical, _, geometry = _suppliers(spark, sf_dir)
    return nodes.publish_join(power, geometry, empirical)


@query("resume_pending", "SELECT CAST(s_suppkey AS VARCHAR) AS node_id FROM supplier WHERE CAST(s_suppkey AS VARCHAR) NOT IN "
       "(SELECT CAST(l_suppkey + 30 AS VARCHAR) FROM lineitem)")
def resume_pending(spark, sf_dir):
    power, _, _, geometry = _suppliers(spark, sf_dir)
    return nodes.pending(geometry.select("node_id"), power)


@query("latest_row", f"""WITH {OBS} SELECT node_id, event_id, "timestamp", pred_wind_speed FROM (
  SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY event_id DESC) AS n FROM obs) WHERE n = 1""", "pred_wind_speed")
def latest_row(spark, sf_dir):
    return nodes.latest_per_key(obs(spark, sf_dir).select("node_id", "event_id", "timestamp", "pred_wind_speed"), "node_id", "event_id")


@query("nested_records", f"""WITH {OBS}, n AS (SELECT *, (row_number() OVER (PARTITION BY node_id ORDER BY "timestamp", event_id) - 1) // 200 AS part FROM obs)
  SELECT node_id, part, count(*) AS records, min("timestamp") AS first_ts, max("timestamp") AS last_ts, sum(pred_wind_speed) AS total_speed
  FROM n GROUP BY 1, 2""", "total_speed")
def nested_records(spark, sf_dir):
    lists = nodes.nested_records(obs(spark, sf_dir), "node_id", ["timestamp", "event_id"], ["pred_wind_speed"], max_per_list=200)
    speeds = F.filter("records.pred_wind_speed", lambda v: v.isNotNull())
    return lists.select(
        "node_id", "part", F.size("records").cast("bigint").alias("records"),
        F.element_at("records.timestamp", 1).alias("first_ts"), F.element_at("records.timestamp", -1).alias("last_ts"),
        F.aggregate(speeds, F.lit(0.0), lambda a, v: a + v).alias("total_speed"))
