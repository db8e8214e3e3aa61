"""The comparison of model and reference: every row with its bounds."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from anemora.config import BootstrapConfig
from anemora.operators import comparison
from anemora.plans import load_queries

SCOPES = [("model", "global"), ("model", "paired"), ("reference", "global"), ("reference", "global_censored"), ("reference", "paired")]
BOUNDED = comparison.METRICS
START = datetime(2024, 1, 1)


def _tables(spark, folder):
    """Ten days of events, the last of which have no reference within reach, and four orders an hour, a few without a speed."""
    kinds = ("click", "view", "signup", "purchase", "error")
    spark.createDataFrame(
        [(i, START + timedelta(hours=i), i % 7, kinds[i % 5], (i * 37 % 101) * 1.0, f'{{"k": {i * 13 % 100}}}') for i in range(240)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    orders = [(k, k * 31 % 997) for k in range(960) if (k * 7919) % 43200 < 9000]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_intervals_hold_every_comparison_row(spark, tmp_path):
    folder, queries = _tables(spark, tmp_path), load_queries()[0]
    plain = rows(queries["comparison_rows"](spark, folder), "dataset", "scope")
    found = rows(queries["comparison_intervals"](spark, folder), "dataset", "scope")
    assert [(r["dataset"], r["scope"]) for r in found] == [(r["dataset"], r["scope"]) for r in plain] == SCOPES
    for bounded, row in zip(found, plain):
        assert {c: bounded[c] for c, v in row.items() if v is not None} == {c: v for c, v in row.items() if v is not None}
        for metric in BOUNDED:
            assert bounded[f"{metric}_lower"] <= bounded[f"{metric}_upper"]
    for row in found[:2]:
        assert all(row[f"{m}_model"] == row[m] is not None for m in ("mean_speed", "p50", "p90", "p99"))
    for row in found[2:]:
        assert all(row[f"{m}_lower"] <= row[m] <= row[f"{m}_upper"] for m in ("mean_speed", "p50", "p90"))


def test_bounds_of_the_censored_reference(spark):
    """Speeds of two, all below the bounds: the density lies at the lower bound where they are censored, at two where not."""
    at = lambda i: START + timedelta(hours=i)
    obs = spark.createDataFrame(
        [(at(i), 8.0, 0.1, 0.8, 0.1, "in", True) for i in range(6)],
        "timestamp timestamp_ntz, pred_wind_speed double, prob_range_below double, prob_range_in double, prob_range_above double, "
        "range_flag string, range_flag_confident boolean")
    reference = spark.createDataFrame([(at(i), None if i == 9 else 2.0) for i in range(10)], "timestamp timestamp_ntz, wind_speed double")
    matched = obs.withColumn("wind_speed_ref", F.lit(2.0))
    observations, references = comparison.observation_scopes(obs, matched), comparison.reference_scopes(reference, matched)
    table = comparison.model_rows(observations).unionByName(comparison.reference_rows(references), allowMissingColumns=True)
    found = rows(comparison.with_intervals(table, observations, references, BootstrapConfig(replicas=6)), "dataset", "scope")
    assert [(r["dataset"], r["scope"]) for r in found] == SCOPES
    for row in found[2:]:
        speed = 5.7 if row["scope"] == "global_censored" else 2.0
        assert row["power_density_model_lower"] == row["power_density_model_upper"] == pytest.approx(0.5 * 1.225 * speed**3)
        assert all(row[f"{m}_{end}"] == pytest.approx(2.0) for m in ("mean_speed", "p50", "p90", "p99") for end in ("lower", "upper"))
