"""Hand-computed expectations for time grids, labels, quality rules, alignment, directions, seasons, dependence."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from anemora.config import (
    CadenceConfig, Height, RangeQaThresholds, RangeThresholds, RmseRecord, SegmentConfig, effective_rmse, load, read_rmse_records,
)
from anemora.functions import scalars
from anemora.operators import asof, cadence, dependence, direction, empirical, nodes, ranges, seasonal, timeseries
from anemora.sources.readers import clean_reference, with_height

DAY = datetime(2024, 1, 1)


def at(hours=0, minutes=0):
    return DAY + timedelta(hours=hours, minutes=minutes)


def observed(spark, *moments, node="a"):
    return spark.createDataFrame([(node, t, i) for i, t in enumerate(moments)], "node_id string, timestamp timestamp_ntz, seq long")


def test_duplicates_keep_the_first(spark):
    slots = cadence.normalise(observed(spark, at(), at(0, 1), at(0, 30)), sequence="seq")
    got = rows(slots, "timestamp")
    assert [(r["timestamp"], r["copies"], r["seq"]) for r in got] == [(at(), 2, 0), (at(0, 30), 1, 2)]
    summary = cadence.temporal_summary(slots).first()
    assert summary["duplicate_records"] == 1 and summary["has_duplicates"]
    assert summary["notes"] == ["Removed 1 duplicate records after temporal normalisation"]


def test_gaps(spark):
    slots = cadence.normalise(observed(spark, at(), at(0, 30), at(2), at(2, 30)), sequence="seq")
    summary = cadence.temporal_summary(slots).first()
    assert summary["missing_observations"] == 2 and summary["has_gaps"] and summary["irregular_cadence"]
    assert summary["coverage_ratio"] == pytest.approx(4 / 6)
    assert summary["median_gap_seconds"] == 1800 and summary["gap_distribution"] == {1800: 2, 5400: 1}
    window = cadence.gap_windows(slots).first()
    assert (window["gap_start"], window["gap_end"], window["missing_steps"]) == (at(1), at(1, 30), 2)


@pytest.mark.parametrize("mode, want", [("nearest", [at(), at(1)]), ("floor", [at(), at(0, 30)]), ("ceiling", [at(0, 30), at(1)])])
def test_rounding(spark, mode, want):
    slots = cadence.normalise(observed(spark, at(0, 14), at(0, 45)), CadenceConfig(rounding=mode), sequence="seq")
    assert [r["timestamp"] for r in rows(slots, "timestamp")] == want
    tie = cadence.normalise(observed(spark, at(0, 15)), sequence="seq").first()
    assert tie["timestamp"] == at()


def test_low_coverage_and_modes(spark):
    slots = cadence.normalise(observed(spark, at(), at(2, 30)), sequence="seq")
    summary = cadence.temporal_summary(slots).first()
    assert summary["insufficient_coverage"] and any("below threshold" in n for n in summary["notes"])
    mode = cadence.cadence_mode(observed(spark, at(), at(1), at(2), at(2, 30), at(3))).first()
    assert (mode["nominal_seconds"], list(mode["unique_intervals"]), mode["sample_count"]) == (1800, [1800, 3600], 4)


def test_taxonomy_counts_first_row_on_cadence(spark):
    got = cadence.taxonomy(observed(spark, at(), at(0, 30), at(0, 40), at(2), at(9))).first()
    assert (got["on_cadence_transitions"], got["short_gaps"], got["long_gaps"], got["total_intervals"]) == (2, 1, 1, 5)
    assert got["max_gap_days"] == pytest.approx(7 / 24) and got["coverage_band"] == "sparse"


def test_discrepancies(spark):
    data = [("n", at(), 18.2, "in", "in"), ("n", at(1), 4.9, "uncertain", "below"), ("n", at(2), None, "above", "above"), ("n", at(3), 6.6, " In ", "in")]
    obs = spark.createDataFrame(data, "node_id string, timestamp timestamp_ntz, pred_wind_speed double, pred_range_label string, det string")
    labelled = ranges.labelled(obs, RangeThresholds(), deterministic="det")
    found = [r["issue"] for r in rows(ranges.discrepancies(labelled), "issue")]
    assert found == ["classifier_vs_threshold"] * 2 + ["deterministic_vs_threshold"] * 2 + ["missing_speed_value", "uncertain_vs_threshold"]
    summary = ranges.range_summary(labelled).first()
    assert (summary["discrepancy_count"], summary["in_count"], summary["above_count"], summary["uncertain_count"]) == (6, 2, 1, 1)
    assert "1 samples have missing wind_speed values." in summary["notes"]
    assert {k: v.count() for k, v in ranges.partition(obs).items()} == {"below": 0, "in": 2, "above": 1, "uncertain": 1}


def test_quality_flags(spark):
    summary = spark.createDataFrame([("n", 1000, 520, 160, 250, 70, 0.52, 0.16, 0.25, 0.07)],
                                    "node_id string, total_observations long, below_count long, in_count long, above_count long, uncertain_count long, "
                                    "below_ratio double, in_ratio double, above_ratio double, uncertain_ratio double")
    temporal = spark.createDataFrame([("n", 0.8, 1200, 990, 10, 36.0)],
                                     "node_id string, coverage_ratio double, expected_observations long, distinct_observations long, duplicate_records long, max_gap_hours double")
    limits = RangeQaThresholds(max_total_censored_ratio=0.7, max_left_censored_ratio=0.5, max_right_censored_ratio=0.2, max_uncertain_ratio=0.05,
                               min_temporal_coverage=0.9, max_gap_hours=24)
    got = ranges.range_quality(summary, temporal, limits).first()
    assert len(got["flags"]) == 8 and not got["parametric_reliable"]
    assert "210 expected timestamps missing from the nominal cadence." in got["notes"]
    assert ranges.quality_records(ranges.range_quality(summary)).first()["parametric_reliable"] is False


def test_bias_flags(spark):
    labels = spark.createDataFrame([("n", 10, 4, 5, 1, 0)], "node_id string, total_observations long, in_count long, below_count long, above_count long, uncertain_count long")
    metrics = spark.createDataFrame([("n", 4)], "node_id string, valid_count long")
    taxonomy = spark.createDataFrame([("n", 10, "sparse", "regular", True)],
                                     "node_id string, total_observations long, coverage_band string, continuity_band string, low_coverage boolean")
    got = empirical.assemble_metrics(labels, metrics, taxonomy).first()
    assert got["censoring_bias"] and got["coverage_bias"] and got["sample_bias"] and got["any_bias"]
    assert got["bias_notes"].startswith("High censoring ratio 0.600 exceeds 0.20.; Left-censored share 0.500 above 0.15.")
    with pytest.raises(KeyError):
        empirical.label_counts(labels)


def _sides(spark):
    left = spark.createDataFrame([(t,) for t in (at(), at(0, 45), at(2), at(3, 5))], "timestamp timestamp_ntz")
    right = spark.createDataFrame([(at(h), float(h), h) for h in range(3)] + [(at(2), 9.0, 7)], "timestamp timestamp_ntz, wind_speed double, seq long")
    return left, right


@pytest.mark.parametrize("limit", [None, 2])
def test_alignment(spark, limit):
    left, right = _sides(spark)
    exact = asof.synchronise(left, right, prefer_nearest=False, right_sequence="seq")
    assert [(r["timestamp"], r["wind_speed_ref"]) for r in rows(exact, "timestamp")] == [(at(), 0.0), (at(2), 9.0)]
    near = asof.synchronise(left, right, right_sequence="seq", max_rows=limit)
    assert [(r["timestamp"], r["wind_speed_ref"], r["time_offset_seconds"]) for r in rows(near, "timestamp")] == [
        (at(), 0.0, 0.0), (at(0, 45), 1.0, -900.0), (at(2), 9.0, 0.0)]
    summary = asof.synchronisation_summary(near, left, right).first()
    assert (summary["matched_rows"], summary["exact_matches"], summary["nearest_matches"], summary["match_ratio"]) == (3, 2, 1, 0.75)
    back = asof.asof_join(left, right, direction="backward", tolerance_seconds=3600, right_sequence="seq", max_rows=limit)
    assert [r["wind_speed_ref"] for r in rows(back, "timestamp")] == [0.0, 0.0, 9.0, None]
    empty = asof.synchronise(left, right.where("false"), right_sequence="seq")
    assert empty.count() == 0 and "is_exact_match" in empty.columns


def test_alignment_tie_goes_back(spark):
    left = spark.createDataFrame([(at(0, 30),)], "timestamp timestamp_ntz")
    right = spark.createDataFrame([(at(), 1.0), (at(1), 2.0)], "timestamp timestamp_ntz, wind_speed double")
    assert asof.asof_join(left, right).first()["wind_speed_ref"] == 1.0


def test_reference_cleaning(spark):
    raw = spark.createDataFrame([(5.0, 90.0), (-9999.9, 10.0), (6.0, -10000.0)], "wind_speed double, wind_dir double")
    clean = rows(clean_reference(raw), "wind_speed")
    assert [(r["wind_speed"], r["wind_dir"]) for r in clean] == [(5.0, 90.0), (6.0, None)]
    scaled = with_height(raw, Height("log", 3.0, 10.0)).first()
    assert scaled["wind_speed"] == pytest.approx(5 * math.log(10 / 2e-4) / math.log(3 / 2e-4)) and scaled["wind_speed_original"] == 5.0
    assert Height("power", 10, 110).scale == pytest.approx(11**0.11)
    with pytest.raises(ValueError):
        Height("log", 10, 110, roughness_m=0).scale


def test_direction_errors(spark):
    pairs = spark.createDataFrame([(359.0, 1.0), (1.0, 359.0), (180.0, 190.0)], "p double, o double")
    errors = direction.direction_errors(pairs, "p", "o")
    assert sorted(r["angular_error_deg"] for r in errors.collect()) == [-10.0, -2.0, 2.0]
    metrics = direction.error_metrics(errors, []).first()
    assert metrics["mean_absolute_error_deg"] == pytest.approx(14 / 3)
    assert metrics["root_mean_square_error_deg"] == pytest.approx(math.sqrt(108 / 3))
    bad = spark.createDataFrame([(10.0, -10000.0), (10.0, 20.0), (None, 5.0), (float("inf"), 5.0), (0.0, 180.0)], "p double, o double")
    quality = direction.quality_summary(bad, [], "p", "o").first()
    assert (quality["total_pairs"], quality["valid_pairs"], quality["sentinel_pairs"], quality["missing_pairs"], quality["nonfinite_pairs"]) == (5, 2, 1, 1, 1)
    assert direction.direction_errors(bad, "p", "o").agg(F.min("angular_error_deg")).first()[0] == -180.0


def test_seasons(spark):
    data = []
    for node, year, month, speed, label in [("a", 2023, 1, 7.0, "in"), ("a", 2023, 2, 8.0, " In "), ("a", 2023, 7, 10.0, "inside"), ("a", 2024, 7, 14.0, "within"),
                                            ("a", 2024, 10, 12.0, "in"), ("a", 2024, 10, 30.0, "over"), ("b", 2023, 12, 5.0, "in")]:
        data.append((node, datetime(year, month, 3), speed, label))
    obs = spark.createDataFrame(data, "node_id string, timestamp timestamp_ntz, pred_wind_speed double, pred_range_label string")
    slices = {(r["node_id"], r["season"]): r for r in seasonal.seasonal_slices(obs).collect()}
    assert slices[("a", "DJF")]["mean_speed"] == 7.5 and slices[("a", "SON")]["above_ratio"] == 0.5
    annual = seasonal.annual_slices(obs)
    by_year = {(r["node_id"], r["year"]): r for r in annual.collect()}
    assert by_year[("a", 2024)]["p90_speed"] == pytest.approx(13.8)
    table = {r["node_id"]: r for r in seasonal.variation(seasonal.seasonal_slices(obs), annual).collect()}
    assert (table["a"]["weakest_season"], table["a"]["strongest_season"]) == ("DJF", "SON")
    assert table["a"]["annual_trend_slope"] == pytest.approx(13 - 25 / 3)
    assert table["b"]["annual_trend_slope"] is None and table["b"]["trend_note"] == "Only one year available."
    start = obs.select(scalars.season_start(scalars.season(F.col("timestamp")), scalars.season_year(F.col("timestamp"))).alias("s"))
    assert {r["s"] for r in start.collect()} >= {datetime(2022, 12, 1), datetime(2023, 12, 1), datetime(2024, 9, 1)}


def test_dependence(spark):
    rng = np.random.default_rng(1234)
    noise = rng.normal(size=(2, 200))
    ar = [0.0]
    for e in noise[0]:
        ar.append(0.8 * ar[-1] + e)
    data = [("A", DAY + timedelta(hours=i), float(v)) for i, v in enumerate(ar[1:])] + [("B", DAY + timedelta(hours=i), float(v)) for i, v in enumerate(noise[1])]
    data += [("C", DAY + timedelta(hours=i), 5.0) for i in range(60)]
    obs = spark.createDataFrame(data, "node_id string, timestamp timestamp_ntz, pred_wind_speed double")
    got = {r["node_id"]: r for r in dependence.lag_metrics(obs).collect()}
    hot = {r["node_id"]: r for r in dependence.lag_metrics(obs, max_rows=40).collect()}
    assert got["A"]["acf_lag_1"] > 0.7 and got["A"]["suggested_block_length"] > 1
    assert abs(got["B"]["acf_lag_1"]) < 0.2 and got["B"]["suggested_block_length"] == 1
    assert got["C"]["acf_lag_1"] is None and got["A"]["mean_gap_seconds"] == 3600.0
    for node in "ABC":
        for c in ("acf_lag_1", "acf_lag_3", "pair_count_lag_2", "std_gap_seconds"):
            assert hot[node][c] == (None if got[node][c] is None else pytest.approx(got[node][c]))
    assert dependence.lag_metrics(obs, min_pairs=500).where("acf_lag_1 is not null").count() == 0


def _months(spark, values):
    data = [("n", datetime(2020 + i // 12, i % 12 + 1, 1), v) for i, v in enumerate(values) if v is not None]
    return timeseries.monthly_series(spark.createDataFrame(data, "node_id string, period_start timestamp_ntz, v double"), "v")


def test_segments(spark):
    values = [float(i) for i in range(10)] + [None] * 2 + [float(i) for i in range(12, 20)] + [None] * 5 + [float(i) for i in range(25, 40)]
    parts = timeseries.segments(_months(spark, values), SegmentConfig(max_gap_months=3, min_segment_months=12))
    got = rows(timeseries.segment_table(parts), "segment_id")
    assert [(r["months"], r["gap_filled"]) for r in got] == [(20, True), (15, False)]
    filled = {r["month"]: r["value"] for r in parts.where("segment_id = 1").collect()}
    assert filled[datetime(2020, 11, 1)] == pytest.approx(10.0, abs=0.1)


def test_autocorrelation(spark):
    x = np.cumsum(np.random.default_rng(2).normal(size=60))
    parts = _months(spark, [float(v) for v in x]).withColumn("segment_id", F.lit(1))
    acf = timeseries.autocorrelation(parts, 6)
    got = [r["acf"] for r in rows(acf, "lag")]
    c = x - x.mean()
    want = [np.dot(c[k:], c[:-k]) / np.dot(c, c) for k in range(1, 7)]
    assert got == pytest.approx(want)
    pacf = [r["pacf"] for r in rows(timeseries.partial_autocorrelation(acf), "lag")]
    r = [np.dot(c[k:], c[:-k]) / (60 - k) / (np.dot(c, c) / 60) for k in range(1, 7)]
    for k in range(1, 7):
        full = [1.0, *r]
        matrix = np.array([[full[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pacf[k - 1] == pytest.approx(np.linalg.solve(matrix, r[:k])[-1])


def test_representatives_and_resume(spark):
    table = spark.createDataFrame([("a", 3.0, 1.0), ("b", 2.0, 9.0), ("c", 1.0, 5.0), ("d", None, 7.0)], "node_id string, p double, u double")
    picked = nodes.representative_nodes(table, 2, [("power", "p", False), ("spread", "u", False)])
    assert [r["node_id"] for r in rows(picked, "priority", "rank")] == ["a", "b"]
    assert [r["node_id"] for r in nodes.top_nodes(table, "p", 4).collect()] == ["a", "b", "c", "d"]
    assert {r["node_id"] for r in nodes.pending(table, table.where("p > 1")).collect()} == {"c", "d"}


def test_nested_records_are_bounded(spark):
    obs = observed(spark, *[at(0, m) for m in range(25)])
    lists = rows(nodes.nested_records(obs, "node_id", ["timestamp"], ["seq"], max_per_list=10, max_rows=6), "part")
    assert [len(r["records"]) for r in lists] == [10, 10, 5]
    assert [x["seq"] for r in lists for x in r["records"]] == list(range(25))


def test_configuration(tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"lower": 4.0, "note": "x"}')
    assert load(RangeThresholds, path) == RangeThresholds(4.0, 17.8)
    assert load(RangeThresholds, tmp_path / "none.json") == RangeThresholds()
    path.write_text("{")
    with pytest.raises(ValueError):
        load(RangeThresholds, path)
    with pytest.raises(ValueError):
        RangeThresholds(5, 5)
    from datetime import timezone
    day = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    records = [RmseRecord("v1", 2.0, day(1), day(10)), RmseRecord("v2", 3.0, day(5))]
    assert effective_rmse(records, day(3)).version == "v1" and effective_rmse(records, day(7)).version == "v2"
    with pytest.raises(LookupError):
        effective_rmse(records[1:], day(1))
    path.write_text('{"records": [{"version": 3, "value": "2.5", "effective_from": "2024-01-02T00:00:00Z", "source": "buoy"}]}')
    assert read_rmse_records(path) == [RmseRecord("3", 2.5, day(2), source="buoy")]
    path.write_text("{}")
    with pytest.raises(ValueError):
        read_rmse_records(path)
