"""Runs, merged partials, keyed state, counter-based draws, and values known by path."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from anemora.config import RmseRecord
from anemora.functions.geometry import from_hex
from anemora.functions.scalars import iso_instant, month_start
from anemora.operators import cadence, kaplan_meier as km, nodes, power, resample, runs
from anemora.operators.censored import censored_sample, record_weights
from anemora.operators.lookup import error_assessments
from anemora.operators.quantiles import linear_quantiles_of_counts
from anemora.plans.estimator_queries import _KM, _KM_POWER, _RECORDS, HUB
from anemora.plans.label_queries import BANDS, _COUNTS, _FLAGS, _RATIOS, _TAXONOMY, _VALID, bias_flags
from anemora.plans.registry import SQL, query
from anemora.plans.series_queries import _SLOTS, _VERSIONS
from anemora.plans.tables import OBS, OBS_LONG, obs, obs_long, obs_of, table
from anemora.session import checkpoint_ready
from anemora.sources.readers import variant_text
from anemora.streaming import counters, rollup, runs as run_streams

_GAP = 7200
_RUNS = f"""
stamped AS (SELECT node_id, epoch_us("timestamp") AS us FROM obs),
opened AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY node_id ORDER BY us) < {_GAP}000000 THEN 0 ELSE 1 END AS opens FROM stamped),
numbered AS (SELECT node_id, us, sum(opens) OVER (PARTITION BY node_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS run FROM opened)
SELECT node_id, make_timestamp(min(us)) AS run_start, make_timestamp(max(us)) AS run_end, count(*) AS observations FROM numbered GROUP BY node_id, run"""


@query("observation_runs", f"WITH {OBS}, {_RUNS}")
def observation_runs(spark, sf_dir):
    return runs.observation_runs(obs(spark, sf_dir), _GAP)


def _folder(spark) -> str:
    checkpoint_ready(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"


def _stream(spark, sf_dir):
    """The observations as a file stream; a pattern, since the table may be one file, which a stream does not take as its folder."""
    schema = table(spark, sf_dir, "events").schema
    return obs_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*"))


@query("observation_runs_stream", f"WITH {OBS}, {_RUNS}")
def observation_runs_stream(spark, sf_dir):
    """The same runs from a stream: those it closed, and those its state still holds."""
    folder = _folder(spark)
    stream = run_streams.run_stream(_stream(spark, sf_dir), _GAP)
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/runs").option("checkpointLocation", f"{folder}/state")
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    closed = spark.read.schema(stream.schema).parquet(f"{folder}/runs")
    return closed.unionByName(run_streams.open_runs(spark, f"{folder}/state", _GAP))


# -- partials that merge -----------------------------------------------------------
_CHUNKS = 5


def _merged(partials, df, turn):
    """Partials of the chunks a table might have come in, then merged; a hash of the rows spreads nodes and times over all chunks."""
    by_chunk = rollup.Partials(("__chunk", *partials.keys), partials.make, partials.merge)
    return partials.merged(by_chunk.of(df.withColumn("__chunk", _chunk(turn))))


def _chunk(turn):
    return F.pmod(F.xxhash64(*turn), F.lit(_CHUNKS))


@query("slot_merge", f'WITH {OBS}, {_SLOTS} SELECT node_id, make_timestamp(us) AS "timestamp", copies, event_id FROM slots')
def slot_merge(spark, sf_dir):
    """Deduplicated slots from the partials of chunks in any order."""
    partials = rollup.first_in_slot(["event_id"], "event_id")
    found = _merged(partials, rollup.with_slot(obs(spark, sf_dir)), ["event_id"])
    return found.select("node_id", F.timestamp_micros("us").cast("timestamp_ntz").alias("timestamp"), "copies", "kept.event_id")


_MONTHS = """SELECT node_id, strftime("timestamp", '%Y-%m-01') AS period, count(*) AS observations, avg(pred_wind_speed) AS mean, stddev_pop(pred_wind_speed) AS std,
  min(pred_wind_speed) AS least, max(pred_wind_speed) AS greatest, quantile_cont(pred_wind_speed, 0.5) AS p50, quantile_cont(pred_wind_speed, 0.9) AS p90
  FROM obs_long GROUP BY 1, 2"""
_SEASONS = """SELECT node_id, CASE month("timestamp") // 3 WHEN 1 THEN 'MAM' WHEN 2 THEN 'JJA' WHEN 3 THEN 'SON' ELSE 'DJF' END || ' ' || year("timestamp" + INTERVAL 1 MONTH) AS period,
  count(*) AS observations, avg(pred_wind_speed) AS mean, stddev_pop(pred_wind_speed) AS std, min(pred_wind_speed) AS least, max(pred_wind_speed) AS greatest,
  quantile_cont(pred_wind_speed, 0.5) AS p50, quantile_cont(pred_wind_speed, 0.9) AS p90 FROM obs_long GROUP BY 1, 2"""


def _period_statistics(spark, sf_dir, kind):
    partials = rollup.value_counts(["node_id", "period"], "pred_wind_speed")
    rows = rollup.with_period(obs_long(spark, sf_dir), kind)
    counts = _merged(partials, rows, ["l_orderkey", "l_linenumber"])
    keys = ["node_id", "period"]
    counted = counts.select(*keys, F.col("pred_wind_speed").alias("__value"), F.col("n").alias("__weight"))
    return rollup.moments(counts, keys, "pred_wind_speed").join(linear_quantiles_of_counts(counted, keys, {"p50": 0.5, "p90": 0.9}), keys)


@query("rollup_merge", f"WITH {OBS_LONG} {_MONTHS}", "mean std least greatest p50 p90")
def rollup_merge(spark, sf_dir):
    """Monthly statistics and quantiles from merged value counts."""
    return _period_statistics(spark, sf_dir, "month")


@query("rollup_merge_seasons", f"WITH {OBS_LONG} {_SEASONS}", "mean std least greatest p50 p90")
def rollup_merge_seasons(spark, sf_dir):
    """Seasonal statistics and quantiles from merged value counts."""
    return _period_statistics(spark, sf_dir, "season")


@query("km_merge", f"WITH {OBS}, {_RECORDS}, {_KM} SELECT * FROM steps", "t cdf survival mass")
def km_merge(spark, sf_dir):
    """Kaplan-Meier curves from the merged censored samples of chunks."""
    chunks = censored_sample(obs(spark, sf_dir).withColumn("__chunk", _chunk(["event_id"])), keys=["node_id", "__chunk"])
    return km.kaplan_meier(rollup.Partials(("node_id", "kind", "value"), {}, {"weight": F.sum}).merged(chunks))


@query("taxonomy_stream", f"WITH {OBS}, {_TAXONOMY} SELECT * FROM taxonomy", "max_gap_days")
def taxonomy_stream(spark, sf_dir):
    """Taxonomy of every node from the keyed state of a stream."""
    folder, name = _folder(spark), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, counters.STATE_STORE)
    try:
        stream = counters.taxonomy_stream(_stream(spark, sf_dir))

        def keep(batch, number):
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/counters/chunk={number}")

        stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before)
    rows = spark.read.parquet(f"{folder}/counters").drop("chunk")
    last = rows.groupBy("node_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("node_id", "batch")]), "batch").alias("r")).select("node_id", "r.*")
    return counters.with_bands(last, BANDS)


# -- counter-based draws -------------------------------------------------------------
_REPLICATES = 80
_DRAWN = f"""
used AS (SELECT node_id, event_id, v, s_in AS w FROM rec WHERE v IS NOT NULL AND s_in > 0),
digests AS (SELECT node_id, v, w, b, md5('poisson|' || event_id || '|' || b) AS d FROM used, (SELECT unnest(range({_REPLICATES // 4})) AS b)),
drawn AS (SELECT node_id, v, w, b * 4 + i AS replicate, CAST(('0x' || substr(d, CAST(1 + 8 * i AS BIGINT), 8)) AS BIGINT) AS u FROM digests, (SELECT unnest(range(4)) AS i)),
counted AS (SELECT node_id, replicate, v, w, {' + '.join(f'CAST(u >= {b} AS INTEGER)' for b in resample.BOUNDS)} AS k FROM drawn),
means AS (SELECT node_id, replicate, sum(k * w * v) / nullif(sum(k * w), 0) AS mean FROM counted GROUP BY 1, 2),
plain AS (SELECT node_id, sum(w * v) / sum(w) AS estimate FROM used GROUP BY 1),
spread AS (SELECT node_id, count(*) AS replicates, avg(mean) AS replicate_mean, stddev_samp(mean) AS replicate_std, quantile_cont(mean, 0.025) AS "lower",
  quantile_cont(mean, 0.975) AS "upper" FROM means WHERE mean IS NOT NULL GROUP BY 1)"""


@query("bootstrap_poisson", f'WITH {OBS}, {_RECORDS}, {_DRAWN} SELECT node_id, estimate, replicates, replicate_mean, replicate_std, "lower", "upper" FROM plain LEFT JOIN spread USING (node_id)',
       'estimate replicate_mean replicate_std "lower" "upper"')
def bootstrap_poisson(spark, sf_dir):
    """Percentile interval of the mean in-range speed, by Poisson draws that SQL repeats."""
    return resample.poisson_interval(record_weights(obs(spark, sf_dir)), ["node_id"], "event_id", "v", "s_in", _REPLICATES)


# -- nodes -----------------------------------------------------------------------------
_EMPTY = ("NODE_03", "NODE_11")
_SILENT = OBS.replace("obs AS (", "all_obs AS (") + f""",
obs AS (SELECT * REPLACE ({', '.join(f"CASE WHEN node_id IN {_EMPTY} THEN 0e0 ELSE {c} END AS {c}" for c in ('prob_range_below', 'prob_range_in', 'prob_range_above'))}) FROM all_obs)"""


@query("node_power_empty", f"""WITH {_SILENT}, {_RECORDS}, {_KM}, {_KM_POWER} SELECT node_id, CASE WHEN power_density_w_m2 IS NULL THEN 'none' ELSE 'kaplan_meier' END AS method,
  power_density_w_m2, turbine_mean_power_kw, capacity_factor, CASE WHEN power_density_w_m2 IS NULL THEN 'No data available.' END AS note
  FROM (SELECT DISTINCT node_id FROM obs) LEFT JOIN densities USING (node_id)""", "power_density_w_m2 turbine_mean_power_kw capacity_factor")
def node_power_empty(spark, sf_dir):
    """The report where two nodes have rows but no usable sample: they keep their row."""
    silent = F.col("node_id").isin(*_EMPTY)
    rows = obs(spark, sf_dir)
    rows = rows.withColumns({c: F.when(silent, 0.0).otherwise(F.col(c)) for c in rows.columns if c.startswith("prob_range_")})
    report = power.node_power(rows, height=HUB)
    return report.select("node_id", "method", "power_density_w_m2", "turbine_mean_power_kw", "capacity_factor", F.when(F.col("method") == "none", F.col("power_density_notes")).alias("note"))


@query("node_assessment", f"""WITH {OBS}, {_TAXONOMY}, recs(version, rmse, a, b) AS ({_VERSIONS}),
  seen AS (SELECT node_id, min("timestamp") AS as_of FROM obs GROUP BY 1),
  hit AS (SELECT node_id, version, rmse, row_number() OVER (PARTITION BY node_id ORDER BY a DESC) AS n FROM seen LEFT JOIN recs ON a <= as_of + INTERVAL 5 DAY AND (b IS NULL OR as_of + INTERVAL 5 DAY < b))
  SELECT node_id, CAST(NULL AS DOUBLE) AS node_rmse, version AS global_version, rmse AS global_rmse, CASE WHEN version IS NOT NULL THEN 'm/s' END AS unit, CASE WHEN version IS NOT NULL THEN 'buoy' END AS source,
    CASE WHEN version IS NULL THEN 'No error of this node is known, and no global RMSE holds at its time.'
         ELSE 'No error of this node is known; the global RMSE ' || printf('%.6f', rmse) || ' m/s (source buoy) stands in.' END AS limitation, coverage_band, continuity_band, low_coverage
  FROM hit JOIN taxonomy USING (node_id) WHERE n = 1""", "node_rmse global_rmse")
def node_assessment(spark, sf_dir):
    """What is known of each node's error at a time of its own."""
    from datetime import datetime, timezone

    day = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    records = [RmseRecord("first", 2.5, day(5), day(12), source="buoy"), RmseRecord("second", 2.9, day(10), source="buoy")]
    rows = obs(spark, sf_dir)
    seen = rows.groupBy("node_id").agg((F.min("timestamp") + F.expr("INTERVAL 5 DAY")).alias("as_of"))
    return error_assessments(cadence.taxonomy(rows, bands=BANDS).join(seen, "node_id"), records)


_FLAG_NAMES = ("censoring_bias", "coverage_bias", "sample_bias", "any_bias")


@query("flag_counts", f"""WITH {OBS}, {_COUNTS}, {_RATIOS}, {_VALID}, {_TAXONOMY}, {_FLAGS}, f AS (SELECT *, censoring_bias OR coverage_bias OR sample_bias AS any_bias FROM flags)
  """ + " UNION ALL ".join(f"SELECT '{n}' AS flag, count(*) FILTER (WHERE {n}) AS nodes, count(*) FILTER (WHERE {n}) / count(*) * 100e0 AS percentage FROM f" for n in _FLAG_NAMES), "percentage")
def flag_counts(spark, sf_dir):
    return nodes.flag_counts(bias_flags(spark, sf_dir), _FLAG_NAMES)


# -- text, bytes and paths ---------------------------------------------------------------
@query("iso_output", f"""WITH {OBS} SELECT event_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us("timestamp") % 1000000 <> 0 THEN '.' || lpad(CAST(epoch_us("timestamp") % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+00:00' AS seen,
  strftime("timestamp", '%Y-%m-01T00:00:00+00:00') AS period_start FROM obs""")
def iso_output(spark, sf_dir):
    return obs(spark, sf_dir).select("event_id", iso_instant(F.col("timestamp")).alias("seen"), iso_instant(month_start(F.col("timestamp"))).alias("period_start"))


@query("hex_decoding", "SELECT s_suppkey, s_name AS decoded, strlen(s_name) AS size FROM supplier")
def hex_decoding(spark, sf_dir):
    """Bytes from hexadecimal text, as geometry columns of text files hold them."""
    raw = from_hex(F.concat(F.lit(" "), F.lower(F.hex(F.col("s_name").cast("binary"))), F.lit(" ")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", raw.cast("string").alias("decoded"), F.octet_length(raw).cast("long").alias("size"))


@query("variant_paths", """SELECT event_id, CASE WHEN event_id % 3 < 2 THEN json_extract_string(props, '$.k') END AS found,
  CASE WHEN event_id % 3 = 1 THEN '$.nested.k' WHEN event_id % 3 = 0 THEN '$.k' ELSE '$.none' END AS path FROM events""")
def variant_paths(spark, sf_dir):
    """A value by a JSON path that each row names itself."""
    turn = F.col("event_id") % 3
    rows = table(spark, sf_dir, "events").withColumn("path", F.when(turn == 1, "$.nested.k").when(turn == 0, "$.k").otherwise("$.none"))
    nested = F.when(turn == 1, F.concat(F.lit('{"nested": '), F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    return rows.select("event_id", variant_text(F.parse_json(nested), F.col("path")).alias("found"), "path")
