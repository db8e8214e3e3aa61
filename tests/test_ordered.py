"""Hot keys: range-cut results equal a plain window, and numpy, on skewed data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from anemora.operators import quantiles
from anemora.operators.ordered import order_rows


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(5)
    size = 1500
    key = np.where(rng.random(size) < 0.6, "hot", rng.choice(["a", "b", "c", "d"], size))
    value = np.round(rng.gamma(2.0, 4.0, size), 1)
    held = np.where(rng.random(size) < 0.1, value, np.nan)
    return pd.DataFrame({"k": key, "t": rng.integers(0, 400, size), "id": np.arange(size), "v": value, "h": held})


def frame(spark, skewed):
    return spark.createDataFrame(skewed).withColumn("h", F.when(~F.isnan("h"), F.col("h")))


@pytest.mark.parametrize("limit", [None, 40, 200])
def test_running_lag_fill(spark, skewed, limit):
    ordered = order_rows(frame(spark, skewed), ["k"], ["t", "id"], max_rows=limit, depth=3)
    assert (ordered.hot is None) == (limit is None)
    got = (
        ordered.running_sum(s=F.col("v")).lag(l1=(F.col("v"), 1), l3=(F.col("v"), 3))
        .last_known(b=F.col("h")).next_known(a=F.col("h")).totals(n=F.count("v"), top=F.max("v"))
        .dataframe().toPandas().sort_values(["k", "t", "id"]).reset_index(drop=True)
    )
    want = skewed.sort_values(["k", "t", "id"]).reset_index(drop=True)
    g = want.groupby("k")
    assert len(got) == len(want)
    np.testing.assert_allclose(got["s"], g["v"].cumsum())
    for name, k in (("l1", 1), ("l3", 3)):
        pd.testing.assert_series_equal(got[name].astype(float), g["v"].shift(k), check_names=False)
    pd.testing.assert_series_equal(got["b"].astype(float), g["h"].ffill(), check_names=False)
    pd.testing.assert_series_equal(got["a"].astype(float), g["h"].bfill(), check_names=False)
    pd.testing.assert_series_equal(got["n"], g["v"].transform("count"), check_names=False)
    np.testing.assert_allclose(got["top"], g["v"].transform("max"))


@pytest.mark.parametrize("limit", [40, 4_000_000])
def test_keyless_and_many_cuts(spark, skewed, limit):
    got = order_rows(frame(spark, skewed), [], ["t", "id"], max_rows=limit).running_sum(n=F.lit(1)).dataframe().toPandas()
    got = got.sort_values(["t", "id"])
    assert list(got["n"]) == list(range(1, len(skewed) + 1))
    assert "__all" not in got and "__range" not in got


@pytest.mark.parametrize("limit", [None, 25])
def test_quantile_definitions(spark, skewed, limit):
    df = frame(spark, skewed)
    probs = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.9, "q10": 1.0}
    disc = quantiles.discrete_quantiles(df, ["k"], "v", probs, max_rows=limit).toPandas().set_index("k")
    lin = quantiles.linear_quantiles(df, ["k"], "v", probs, max_rows=limit).toPandas().set_index("k")
    grid = quantiles.discrete_quantile_grid(df, ["k"], "v", 100, max_rows=limit).toPandas()
    for k, g in skewed.groupby("k"):
        ordered = np.sort(g["v"].to_numpy())
        for name, p in probs.items():
            index = max(1, int(np.ceil(round(p * len(ordered), 9)))) - 1
            assert disc.loc[k, name] == ordered[index]
            assert lin.loc[k, name] == pytest.approx(np.quantile(ordered, p))
        mine = grid[grid["k"] == k].sort_values("step")
        assert list(mine["step"]) == list(range(101))
        want = [ordered[max(1, -(-i * len(ordered) // 100)) - 1] for i in range(101)]
        assert list(mine["v"]) == want


@pytest.mark.parametrize("limit", [None, 25])
def test_weighted_quantiles(spark, skewed, limit):
    weighted = frame(spark, skewed).select("k", F.col("v").alias("__value"), (F.col("t") % 7 / 10).alias("__weight"), "id")
    probs = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    got = quantiles.weighted_quantiles(weighted, ["k"], probs, tie_order=["id"], max_rows=limit).toPandas().set_index("k")
    step = quantiles.weighted_step_quantiles(
        weighted.groupBy("k", "__value").agg(F.sum("__weight").alias("__weight")), ["k"], probs, max_rows=limit
    ).toPandas().set_index("k")
    for k, g in skewed.assign(w=skewed["t"] % 7 / 10).query("w > 0").groupby("k"):
        g = g.sort_values(["v", "id"])
        share = g["w"].cumsum().to_numpy() / g["w"].sum()
        v = g["v"].to_numpy()
        for name, p in probs.items():
            i = int(np.searchsorted(share, p, side="left"))
            want = v[0] if i == 0 else v[i - 1] + (p - share[i - 1]) / (share[i] - share[i - 1]) * (v[i] - v[i - 1])
            assert got.loc[k, name] == pytest.approx(want)
            at = min(int(np.searchsorted(g["w"].cumsum().to_numpy(), p * g["w"].sum(), side="right")), len(v) - 1)
            assert step.loc[k, name] == v[at]


def test_ranges_of_a_hot_key_lie_in_several_tasks(spark):
    """Windows run per range: rows of one key (or of no key) must not meet in one partition before them."""
    rows = spark.range(400).select(F.lit("hot").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    for keys in ([], ["k"]):
        ordered = order_rows(rows, keys, ["t"], max_rows=40).last_known(b=F.col("v"))
        placed = ordered.dataframe().groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in placed) == 400
        assert len(placed) > 2 and max(r["count"] for r in placed) < 300
