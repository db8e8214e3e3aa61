"""Censored estimators against hand results, recovery of known parameters, and both execution routes."""

import math
from statistics import NormalDist
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from anemora.config import BootstrapConfig, KaplanMeierCriteria, PowerCurve, RangeThresholds
from anemora.functions import special
from anemora.operators import bootstrap, censored, parametric, power, weibull
from anemora.operators import kaplan_meier as km

KEY = ["node_id"]


def sample_of(spark, entries):
    return spark.createDataFrame(entries, "node_id string, kind string, value double, weight double")


SMALL = [("n", "in", 6.0, 1.0), ("n", "in", 8.0, 1.0), ("n", "in", 10.0, 1.0), ("n", "left", 5.7, 2.0), ("n", "right", 17.8, 1.0)]


def test_special_functions():
    for x in (0.01, 0.3, 1.0, 4.5, 60.0):
        assert special.log_gamma(np.array([x]))[0] == pytest.approx(math.lgamma(x), abs=1e-12)


def _gamma_p(a, x):
    """All terms of the power series, whatever their number."""
    if x <= 0:
        return 0.0
    n = np.arange(1, int(30 * math.sqrt(max(a, x)) + max(0.0, x - a) + 200))
    logs = np.concatenate([[0.0], np.cumsum(np.log(x) - np.log(a + n))]) - math.log(a)
    return math.fsum(np.exp(logs + a * math.log(x) - x - math.lgamma(a)))


def test_special_functions_as_expressions(spark):
    z = [-12.0, -6.0, -3.0, -2.999, -0.2, 0.0, 1.7, 3.0, 6.0, 40.0]
    rows = spark.createDataFrame([(v,) for v in z] + [(None,)], "z double").select("z", special.normal_cdf_of(F.col("z")).alias("p")).collect()
    for r in rows:
        assert r.p is None if r.z is None else r.p == pytest.approx(0.5 * math.erfc(-r.z / math.sqrt(2)), rel=1e-12)
    pairs = [(a, a * f) for a in (0.05, 0.5, 1.0, 3.7, 40.0, 900.0, 1e5) for f in (0.01, 0.5, 0.97, 1.0, 1.02, 1.5, 30.0)] + [(2.0, 0.0), (2.0, -1.0), (None, 1.0), (1.0, None)]
    frame = spark.createDataFrame(pairs, "a double, x double")
    for r in frame.select("a", "x", special.gamma_p_of(F.col("a"), F.col("x")).alias("p"), special.log_gamma_of(F.col("a")).alias("g")).collect():
        if r.a is None or r.x is None:
            assert r.p is None
        else:
            assert r.p == pytest.approx(_gamma_p(r.a, r.x), rel=1e-8 if r.a < 1e3 else 2e-7, abs=1e-10)
            assert r.g == pytest.approx(math.lgamma(r.a), rel=1e-11, abs=1e-11)


@pytest.mark.parametrize("limit", [None, 2])
def test_kaplan_meier_by_hand(spark, limit):
    steps = km.kaplan_meier(sample_of(spark, SMALL), max_rows=limit).orderBy("t").collect()
    assert [r["t"] for r in steps] == [5.7, 6.0, 8.0, 10.0]
    assert [r["cdf"] for r in steps] == pytest.approx([1 / 3, 1 / 2, 2 / 3, 5 / 6])
    assert sum(r["mass"] for r in steps) == pytest.approx(5 / 6)
    frame = km.kaplan_meier(sample_of(spark, SMALL))
    out = frame.groupBy("node_id").agg(*[km.km_quantile(p).alias(n) for n, p in (("a", 0.5), ("b", 0.7), ("c", 0.95))]).first()
    assert (out["a"], out["b"], out["c"]) == (6.0, 10.0, None)
    assert km.km_summary(frame).first()["right_tail_probability"] == pytest.approx(1 / 6)
    at = {r["speed"]: r["cdf"] for r in km.step_cdf_at(frame, [1.0, 6.0, 9.0, 50.0]).collect()}
    assert at[1.0] == 0.0 and at[6.0] == pytest.approx(0.5) and at[9.0] == pytest.approx(2 / 3) and at[50.0] == pytest.approx(5 / 6)


def test_kaplan_meier_early_censoring_and_complete_exit(spark):
    entries = [("n", "in", 2.0, 1.0), ("n", "right", 3.0, 1.0), ("n", "in", 4.0, 1.0)]
    steps = km.kaplan_meier(sample_of(spark, entries)).orderBy("t").collect()
    assert [r["survival"] for r in steps] == pytest.approx([2 / 3, 0.0])
    only_left = km.kaplan_meier(sample_of(spark, [("n", "left", 5.7, 3.0)])).collect()
    assert [(r["t"], r["cdf"]) for r in only_left] == [(5.7, 1.0)]


def test_kaplan_meier_power(spark):
    steps = km.kaplan_meier(sample_of(spark, SMALL))
    out = km.km_power(steps, tail_speed=17.8, scale=1.0).first()
    cubes = (5.7**3 / 3 + (6**3 + 8**3 + 10**3) / 6) + 17.8**3 / 6
    assert out["power_density_w_m2"] == pytest.approx(0.5 * 1.225 * cubes)
    assert km.km_power(steps).first()["power_density_w_m2"] == pytest.approx(0.5 * 1.225 * (cubes - 17.8**3 / 6))
    with pytest.raises(ValueError):
        km.km_power(steps, air_density=0)


def test_selection_reasons(spark):
    table = spark.createDataFrame([("a", 1000.0, 0.3, 0.2, 400.0), ("b", 150.0, 0.9, 0.9, 0.0), ("c", 1000.0, 0.1, 0.05, 800.0)],
                                  "node_id string, total_observations double, censored_ratio double, below_ratio double, valid_count double")
    got = {r["node_id"]: r for r in km.selection(table).collect()}
    assert got["a"]["selection_reasons"] == ["censored ratio 0.300 ≥ 0.20", "below ratio 0.200 ≥ 0.15", "in-range share 0.400 ≤ 0.55"]
    assert not got["b"]["km_selected"] and not got["c"]["km_selected"]


def censored_draws(seed=20251021, size=1600, shape=2.4, scale=11.5, node="n"):
    v = scale * np.random.default_rng(seed).weibull(shape, size)
    inside = v[(v >= 5.7) & (v <= 17.8)]
    return [(node, "in", float(x), 1.0) for x in inside] + [
        (node, "left", 5.7, float((v < 5.7).sum())), (node, "right", 17.8, float((v > 17.8).sum()))]


def test_weibull_recovery_and_routes(spark):
    sample = sample_of(spark, censored_draws() + censored_draws(3, 900, 1.8, 8.0, "m"))
    fit = {r["node_id"]: r for r in weibull.fit_weibull(sample, max_values=None).collect()}
    assert fit["n"]["weibull_shape"] == pytest.approx(2.4, rel=0.15)
    assert fit["n"]["weibull_scale"] == pytest.approx(11.5, rel=0.10)
    assert fit["n"]["weibull_reliable"]
    spread = {r["node_id"]: r for r in weibull.fit_weibull(sample, max_values=700).collect()}
    for node in ("n", "m"):
        for name in ("weibull_shape", "weibull_scale", "weibull_log_likelihood"):
            assert spread[node][name] == pytest.approx(fit[node][name], rel=1e-5)


def test_weibull_likelihood_matches_numpy(spark):
    entries = censored_draws(size=300)
    kind, value, weight = (np.array([e[i] for e in entries]) for i in (1, 2, 3))
    want = weibull.Sample(kind, value, weight).likelihood([(math.log(2.1), math.log(10.0))])[0]
    got = weibull.likelihood_at(sample_of(spark, entries), 2.1, 10.0).first()
    assert got["log_likelihood"] == pytest.approx(want[0])
    assert got["gradient_log_shape"] == pytest.approx(want[1])
    assert got["gradient_log_scale"] == pytest.approx(want[2])


def test_weibull_without_support(spark):
    entries = [("n", "in", 6.0 + i, 1.0) for i in range(10)] + [("n", "left", 5.7, 120.0), ("n", "right", 17.8, 60.0)]
    fit = weibull.fit_weibull(sample_of(spark, entries), min_in_weight=50.0).first()
    assert not fit["weibull_reliable"] and fit["weibull_message"].startswith("Insufficient in-range support")
    assert fit["weibull_left_weight"] == 120.0


def test_sample_from_records(spark):
    schema = ("node_id string, pred_wind_speed double, prob_range_below double, prob_range_in double, prob_range_above double, "
              "range_flag string, range_flag_confident boolean")
    obs = spark.createDataFrame([
        ("n", 8.0, 0.1, 0.8, 0.1, "in", True), ("n", 8.0, 0.2, 0.6, 0.2, "in", False), ("n", None, 0.0, 1.0, 0.0, "in", True),
        ("n", 4.0, 0.9, 0.1, 0.0, "below", True), ("n", 9.0, 0.0, 0.0, 0.0, "in", True), ("n", 20.0, 0.0, 0.1, 1.9, "ABOVE ", True),
    ], schema)
    got = {(r["kind"], r["value"]): r["weight"] for r in censored.censored_sample(obs).collect()}
    assert got[("in", 8.0)] == pytest.approx(1.6)
    assert got[("left", 5.7)] == pytest.approx(1.2) and got[("right", 17.8)] == pytest.approx(1.2)
    assert ("in", 4.0) not in got and ("in", 9.0) not in got
    summary = censored.selection_summary(obs).first()
    assert summary["total_observations"] == 5.0
    assert summary["in_ratio"] == pytest.approx((1 + 0.6 + 1) / 5)


def test_model_comparison(spark):
    rng = np.random.default_rng(11)
    v = rng.gamma(9.0, 1.2, 1500)
    entries = [("n", "in", float(x), 1.0) for x in v]
    sample = sample_of(spark, entries)
    table = parametric.compare_models(sample, weibull.fit_weibull(sample)).first()
    assert table["parametric_preferred_model"] == "gamma"
    k, s = table["gamma_shape"], table["gamma_scale"]
    want = np.sum((k - 1) * np.log(v) - v / s - k * math.log(s) - math.lgamma(k))
    assert table["gamma_log_likelihood"] == pytest.approx(want)
    assert table["gamma_bic"] == pytest.approx(2 * math.log(1500) - 2 * want)
    ordered = np.sort(v)
    mu, sd = np.log(v).mean(), np.log(v).std()
    cdf = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in (np.log(ordered) - mu) / sd])
    assert table["lognormal_ks_statistic"] == pytest.approx(np.max(np.abs(np.arange(1, 1501) / 1500 - cdf)))
    few = sample_of(spark, entries[:100])
    skipped = parametric.compare_models(few, weibull.fit_weibull(few)).first()
    assert skipped["parametric_preferred_model"] is None and "Alternative fits skipped" in skipped["parametric_notes"]


def test_turbine_integral_and_curve(spark):
    curve = PowerCurve(speeds=(0, 5, 10, 15, 25), power_kw=(0, 200, 900, 2000, 2000))
    k, s = 2.0, 9.0
    v = np.linspace(0, 45, 400_001)
    pdf = k / s * (v / s) ** (k - 1) * np.exp(-((v / s) ** k))
    want = np.trapezoid(np.interp(v, curve.speeds, curve.power_kw) * pdf, v)
    assert power.turbine_under_weibull(np.array([k]), np.array([s]), curve)[0] == pytest.approx(want, rel=1e-4)
    df = spark.createDataFrame([(2.5,), (12.0,), (40.0,), (-1.0,)], "v double")
    from anemora.functions.scalars import curve_kw
    assert [r[0] for r in df.select(curve_kw(F.col("v"), curve)).collect()] == pytest.approx([100.0, 1340.0, 2000.0, 0.0])
    density = df.limit(1).select(power.weibull_power_density(F.lit(2.4), F.lit(11.5))).first()[0]
    assert density == pytest.approx(0.5 * 1.225 * 11.5**3 * math.gamma(1 + 3 / 2.4))


OBS_SCHEMA = ("node_id string, timestamp timestamp_ntz, seq long, pred_wind_speed double, prob_range_below double, prob_range_in double, "
              "prob_range_above double, range_flag string, range_flag_confident boolean")


def observations(spark, nodes=("a", "b"), size=300, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for node in nodes:
        for i in range(size):
            v = float(10 * rng.weibull(2.2))
            p = rng.dirichlet([1, 3, 1])
            flag = ["below", "in", "above"][int(np.argmax(p))]
            out.append((node, datetime(2024, 1, 1) + timedelta(minutes=30 * i), i, v if i % 40 else None,
                        float(p[0]), float(p[1]), float(p[2]), flag, bool(rng.random() < 0.7)))
    return spark.createDataFrame(out, OBS_SCHEMA)


CONFIGS = {
    "iid": dict(),
    "noise_power": dict(rmse_mode="power"),
    "labels": dict(label_strategy="label_resample", apply_rmse_noise=False, rmse_mode="none"),
    "moving": dict(resampling="moving_block", block_length=7),
    "stationary": dict(resampling="stationary", block_length=5, label_strategy="label_resample"),
}


def _parts(prepared, config, size):
    """The parts of each node as the operator cuts them, with the records that blocks may run into."""
    for node, group in prepared.toPandas().groupby("node_id"):
        group = group.sort_values(["us", "tie"]).reset_index(drop=True)
        pieces = [group.iloc[i:i + size] for i in range(0, len(group), size)]
        cells = np.array([[int((p["stratum"] == s).sum()) for s in bootstrap.STRATA] for p in pieces])
        length = config.block_length if config.resampling != "iid" else 1
        room = 0 if length == 1 else length * (bootstrap.RUN_ROOM if config.resampling == "stationary" else 1)
        out = []
        for i, piece in enumerate(pieces):
            after = pieces[(i + 1) % len(pieces)].iloc[:room].assign(after=True)
            records = bootstrap._Records(pd.concat([piece.assign(after=False), after]) if len(pieces) > 1 else piece.assign(after=False), config)
            out.append((records, records.draws(cells if len(pieces) > 1 else None, i)))
        yield node, group, out


@pytest.mark.parametrize("name, criteria", [*((name, "usual") for name in CONFIGS), ("labels", "fit")])
def test_bootstrap_parts_agree_with_one_sample(spark, name, criteria):
    """Replicates of nodes cut into parts equal the evaluation of all parts' draws together."""
    fit = dict(criteria=KaplanMeierCriteria(min_total_observations=1_000_000), min_in_range_weight=20.0) if criteria == "fit" else {}
    config = BootstrapConfig(replicas=4, seed=3, **{**CONFIGS[name], **fit})
    obs = observations(spark)
    want = {}
    for node, group, parts in _parts(bootstrap._prepared(obs, config, "seq"), config, 90):
        for replica in range(-1, 4):
            samples = [records.sample(draws, replica) for records, draws in parts]
            whole = [np.concatenate(x) for x in zip(*samples)]
            assert len(whole[0]) == len(group)
            want[node, replica] = (*bootstrap._sums(tuple(whole), config, 1.0), *bootstrap.evaluate(*whole, config, 1.0))
    got = bootstrap.replicate_table(obs, config, "seq", max_records=90).collect()
    assert len(got) == 10 and ("weibull" in {r["method"] for r in got}) == (criteria == "fit")
    for r in got:
        wi, wv, *_, p50, p90, p99, density, method = want[r["node_id"], r["replica"]]
        assert (r["mean_speed"], r["p50"], r["p90"], r["p99"]) == pytest.approx((wv / wi, p50, p90, p99), rel=1e-9)
        assert r["method"] == method
        if config.rmse_mode != "power" or r["replica"] < 0:
            assert r["power_density"] == pytest.approx(density, rel=1e-3 if criteria == "fit" else 1e-9)
        assert config.rmse == 0 or r["sigma"] > 0


@pytest.mark.parametrize("name", CONFIGS)
def test_bootstrap_draws_follow_the_multinomial_law(spark, name):
    """Every stratum (or the node) is drawn as often as it has records, whatever the parts; each record once on average."""
    config = BootstrapConfig(replicas=300, seed=5, **CONFIGS[name])
    stratified = config.resampling == "iid" and config.label_strategy == "fixed"
    for size in (1000, 70):
        for _, group, parts in _parts(bootstrap._prepared(observations(spark, ("a",), 200), config, "seq"), config, size):
            offsets = np.cumsum([0, *[r.own for r, _ in parts]])
            count = np.zeros((300, len(group)), int)
            for i, (records, draws) in enumerate(parts):
                for replica in range(300):
                    np.add.at(count[replica], (draws.at(replica)[0] + offsets[i]) % len(group), 1)
            groups = [np.flatnonzero(group["stratum"] == s) for s in bootstrap.STRATA] if stratified else [np.arange(len(group))]
            for members in groups:
                assert (count[:, members].sum(axis=1) == len(members)).all()
            assert abs(count.mean(axis=0) - 1).max() < (0.35 if config.resampling == "iid" else 0.9)
            assert count.mean() == 1 and (0.7 < count.var(axis=0).mean() if config.resampling == "iid" else True)


def test_bootstrap_without_replicas_on_large_nodes(spark):
    obs = observations(spark)
    config = BootstrapConfig(replicas=0)
    one = {r["node_id"]: r for r in bootstrap.replicate_table(obs, config, "seq").collect()}
    many = bootstrap.replicate_table(obs, config, "seq", max_records=10).collect()
    assert len(many) == 2
    for r in many:
        assert all(r[m] == pytest.approx(one[r["node_id"]][m], rel=1e-9) for m in bootstrap.METRICS)


def test_records_of_large_nodes_carry_numbers_only(spark):
    """What a part's draws need goes to the part once, not with each of its records."""
    rows = bootstrap._prepared(observations(spark), BootstrapConfig(replicas=2), "seq").drop("v")
    dealt, facts = bootstrap._dealt(rows, BootstrapConfig(replicas=2), 10)
    assert not any(kind.startswith(("array", "struct", "map")) for _, kind in dealt.dtypes)
    assert facts.count() == dealt.select("node_id", "part").distinct().count() and {"cells", "edges"} <= set(facts.columns)


@pytest.mark.parametrize("resampling", ["iid", "stationary"])
def test_draws_of_large_nodes_are_not_repeated(spark, resampling):
    """The plan of a large node's replicates draws once more, for the values around the quantiles; the first pass is written down."""
    config = BootstrapConfig(replicas=3, resampling=resampling, block_length=4, criteria=KaplanMeierCriteria(min_total_observations=1))
    for table in (bootstrap.replicate_table(observations(spark), config, "seq", max_records=60),
                  bootstrap.bootstrap_intervals(observations(spark), config, "seq", max_records=60)):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("FlatMapCoGroupsInPandas") == 2  # the second pass, and the quantiles from its values


def test_values_and_weights_are_counted_like_numpy():
    rng = np.random.default_rng(8)
    v, w = rng.integers(0, 5, 60) / 4.0, rng.integers(1, 3, 60) / 2.0
    pair, count = np.unique(np.stack([v, w]), axis=1, return_counts=True)
    for got, want in zip(bootstrap._counted(v, w), (pair[0], pair[1], count)):
        assert got.tolist() == want.tolist()
    assert [x.size for x in bootstrap._counted(np.zeros(0), np.zeros(0))] == [0, 0, 0]


def test_bootstrap_is_independent_of_partitioning(spark):
    config = BootstrapConfig(replicas=20, seed=9)
    obs = observations(spark, size=120).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    for tie in ("seq", None):
        one = bootstrap.bootstrap_intervals(obs.coalesce(1), config, tie).orderBy("node_id", "metric").collect()
        many = bootstrap.bootstrap_intervals(obs.orderBy(F.rand(1)).repartition(7), config, tie).orderBy("node_id", "metric").collect()
        for a, b in zip(one, many):
            assert a["lower"] == pytest.approx(b["lower"]) and a["upper"] == pytest.approx(b["upper"])
            assert a["lower"] <= a["upper"] and a["replicates"] == 20


def test_bootstrap_settings_per_node(spark):
    config = BootstrapConfig(replicas=5, seed=2, resampling="moving_block", block_length=3)
    obs = observations(spark)
    settings = spark.createDataFrame([("a", 9, 2.0)], "node_id string, block_length int, speed_scale double")
    got = {(r["node_id"], r["replica"]): r for r in bootstrap.replicate_table(obs, config, "seq", settings=settings).collect()}
    other = BootstrapConfig(replicas=5, seed=2, resampling="moving_block", block_length=9, speed_scale=2.0)
    for node, setup in (("a", other), ("b", config)):
        for r in bootstrap.replicate_table(obs.where(F.col("node_id") == node), setup, "seq").collect():
            assert all(got[node, r["replica"]][m] == pytest.approx(r[m]) for m in bootstrap.METRICS)


def test_jackknife_against_leaving_out_each_record(spark, monkeypatch):
    monkeypatch.setattr(bootstrap, "MAX_RECORDS_PER_TASK", 40)
    config = BootstrapConfig(replicas=0)
    obs = observations(spark, ("n",), 150)
    prepared = bootstrap._prepared(obs, config, "seq")
    group = prepared.toPandas().assign(after=False)
    records = bootstrap._Records(group, config)
    full = records.sample(None)

    def all_metrics(sample):
        sums = bootstrap._sums(tuple(sample), config, 1.0)
        p50, p90, p99, density, _ = bootstrap.evaluate(*sample, config, 1.0)
        return dict(zip(bootstrap.METRICS, (sums[1] / sums[0], p50, p90, p99, density)))

    base = all_metrics(full)
    apart = {m: [] for m in bootstrap.METRICS}
    for i in range(len(group)):
        for m, x in all_metrics([np.delete(a, i) for a in full]).items():
            apart[m].append(x - base[m])
    for r in bootstrap.jackknife(obs, config, "seq").collect():
        d = np.array(apart[r["metric"]])
        assert r["n"] == 150
        assert (r["d1"], r["d2"]) == pytest.approx((d.sum(), (d**2).sum()), rel=1e-6, abs=1e-9)
        assert r["d3"] == pytest.approx((d**3).sum(), rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("method", ["bca", "percentile_t"])
def test_bootstrap_refined_intervals(spark, method):
    config = BootstrapConfig(replicas=60, seed=9, ci_method=method, apply_rmse_noise=False, rmse_mode="none")
    small, large = observations(spark, ("small",), 90), observations(spark, ("large",), 400)
    got = bootstrap.bootstrap_intervals(small.unionByName(large), config, "seq").collect()
    # The highest quantile is the upper bound in every draw, and so has no spread.
    assert len(got) == 10 and {r["ci_method"] for r in got if r["metric"] != "p99"} == {method}
    for r in got:
        assert r["lower"] < r["upper"] or r["metric"] == "p99"
        assert r["lower"] <= r["estimate"] * 1.1 and r["upper"] >= r["estimate"] * 0.9


FITTED = dict(apply_rmse_noise=False, rmse_mode="none", min_in_range_weight=20.0, criteria=KaplanMeierCriteria(
    min_total_censored_ratio=1.1, min_below_ratio=1.1, max_valid_share=-1.0, min_uncensored_weight=-1.0))


def _best_fit(kind, value, weight):
    """The maximum itself, by Newton steps on numerical derivatives of the library's gradient."""
    sample, here = weibull.Sample(kind, value, weight), np.array([math.log(2.0), math.log(9.0)])
    for _ in range(30):
        slope = sample.likelihood([tuple(here)])[0, 1:]
        h = 1e-5
        bend = np.array([(sample.likelihood([tuple(here + e)])[0, 1:] - sample.likelihood([tuple(here - e)])[0, 1:]) / (2 * h) for e in np.eye(2) * h])
        here = here - np.clip(np.linalg.solve(bend, slope), -0.5, 0.5)
    return np.exp(here)


def test_weibull_jackknife_against_refits(spark):
    config = BootstrapConfig(replicas=0, speed_scale=1.3, **FITTED)
    obs = observations(spark, ("n",), 150)
    group = bootstrap._prepared(obs, config, "seq").toPandas().assign(after=False)
    speed, w_in, w_left, w_right, *_ = bootstrap._Records(group, config).sample(None)

    def density(keep):
        inside = keep & (w_in > 0)
        kind = np.array(["in"] * int(inside.sum()) + ["left", "right"])
        value = np.concatenate([speed[inside], [config.thresholds.lower, config.thresholds.upper]])
        shape, scale = _best_fit(kind, value, np.concatenate([w_in[inside], [w_left[keep].sum(), w_right[keep].sum()]]))
        return 0.5 * config.air_density * power.weibull_third_moment(shape, scale * config.speed_scale)

    every = np.ones(len(group), bool)
    full = density(every)
    d = np.array([density(np.arange(len(group)) != i) - full for i in range(len(group))])
    got = [r for r in bootstrap.jackknife(obs, config, "seq").collect() if r["metric"] == "power_density"]
    assert [(r["n"], r["estimator"]) for r in got] == [(150, "weibull")]
    n, (s1, s2, s3) = 150, (got[0][c] for c in ("d1", "d2", "d3"))
    m, true = s1 / n, d - d.mean()
    error, third = s2 - n * m * m, s3 - 3 * m * s2 + 2 * n * m**3
    assert error == pytest.approx((true**2).sum(), rel=3e-3)
    assert third / error**1.5 == pytest.approx((true**3).sum() / (true**2).sum() ** 1.5, rel=1e-2)


@pytest.mark.parametrize("method", ["bca", "percentile_t"])
def test_refined_intervals_of_fitted_densities(spark, method):
    config = BootstrapConfig(replicas=40, seed=4, ci_method=method, **FITTED)
    few = observations(spark, ("few",), 12)  # below the fit's weight: Kaplan-Meier, with values of its own
    got = {r["node_id"]: r for r in bootstrap.bootstrap_intervals(observations(spark, ("n",), 200).unionByName(few), config, "seq").collect()
           if r["metric"] == "power_density"}
    assert {k: r["ci_method"] for k, r in got.items()} == {"n": method, "few": method}
    for r in got.values():
        assert r["lower"] < r["estimate"] < r["upper"]


def test_weibull_jackknife_without_admitted_nodes(spark):
    obs = observations(spark, ("n",), 60)
    assert bootstrap.weibull_jackknife(obs, BootstrapConfig(), "seq") is None
    none = BootstrapConfig(**{**FITTED, "min_in_range_weight": 1e6})
    assert bootstrap.weibull_jackknife(obs, none, "seq").collect() == []
    one = spark.createDataFrame([("n", datetime(2024, 1, 1), 1, 8.0, 0.0, 1.0, 0.0, "in", True)], OBS_SCHEMA)
    sole = BootstrapConfig(**{**FITTED, "min_in_range_weight": 0.5})
    r = bootstrap.weibull_jackknife(one, sole, "seq").first()
    assert r is None or r["d2"] != r["d2"]  # nothing is left without the only record


def test_refined_bounds_by_formula(spark):
    normal, rng = NormalDist(), np.random.default_rng(6)
    draws, jack, estimate = np.sort(rng.gamma(4, 1, 200)), rng.gamma(3, 0.01, 80), 3.7
    d = jack - 3.7
    frame = spark.createDataFrame([(estimate, draws.tolist(), 80, float(d.sum()), float((d**2).sum()), float((d**3).sum()))],
                                  "e double, x array<double>, n long, a double, b double, c double")
    low, high = frame.select(bootstrap.refined_levels("bca", 0.1)("e", "x", "n", "a", "b", "c").alias("r")).first().r
    z0 = normal.inv_cdf((draws < estimate).mean())
    pull = jack.mean() - jack
    a = (pull**3).sum() / (6 * (pull**2).sum() ** 1.5)
    for level, z in ((low, normal.inv_cdf(0.05)), (high, normal.inv_cdf(0.95))):
        assert level == pytest.approx(normal.cdf(z0 + (z0 + z) / (1 - a * (z0 + z))), rel=1e-6)
    low, high = frame.select(bootstrap.refined_levels("percentile_t", 0.1)("e", "x", "n", "a", "b", "c").alias("r")).first().r
    assert low == pytest.approx(2 * estimate - np.quantile(draws, 0.95)) and high == pytest.approx(2 * estimate - np.quantile(draws, 0.05))


def test_bootstrap_clamps_noise(spark):
    config = BootstrapConfig(replicas=10, rmse=5.0, thresholds=RangeThresholds(3.0, 12.0))
    obs = observations(spark, ("n",), 50).withColumn("pred_wind_speed", F.lit(8.0))
    group = bootstrap._prepared(obs, config, "seq").toPandas().assign(after=False)
    records = bootstrap._Records(group, config)
    draws = records.draws(None, 0)
    for replica in range(10):
        speed = records.sample(draws, replica)[0]
        assert speed.min() >= 3.0 and speed.max() <= 12.0 and speed.std() > 0


def test_config_rejects_bad_values():
    for bad in (dict(replicas=-1), dict(confidence=1.0), dict(rmse_mode="none"), dict(ci_method="x"), dict(block_length=0)):
        with pytest.raises(ValueError):
            BootstrapConfig(**bad)
