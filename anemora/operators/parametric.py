"""Weibull, lognormal and gamma candidates compared on one censored sample.

Lognormal and gamma likelihoods of the in-range part depend only on a few weighted sums,
so they are aggregates; distribution functions that SQL lacks are expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.config import ParametricConfig
from anemora.functions.special import gamma_cdf_of, log_gamma_of, normal_cdf_of
from anemora.operators.ordered import MAX_ROWS_PER_RANGE, order_rows

_EPS = 1e-15
FAMILIES = ("weibull", "lognormal", "gamma")


def weighted_moments(sample: DataFrame, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    """Weighted mean and variance of in-range values and of their logarithms."""
    v, w = F.col("value"), F.col("weight")
    rows = sample.where((F.col("kind") == "in") & (v > 0) & (w > 0))
    sums = rows.groupBy(*keys).agg(
        F.sum(w).alias("w"), F.sum(w * v).alias("wv"), F.sum(w * v * v).alias("wvv"),
        F.sum(w * F.ln(v)).alias("wl"), F.sum(w * F.ln(v) * F.ln(v)).alias("wll"))
    mean, log_mean = F.col("wv") / F.col("w"), F.col("wl") / F.col("w")
    return sums.select(
        *keys, F.col("w").alias("in_weight"), mean.alias("mean_value"), (F.col("wvv") / F.col("w") - mean * mean).alias("var_value"),
        log_mean.alias("mean_log"), (F.col("wll") / F.col("w") - log_mean * log_mean).alias("var_log"))


def candidate_parameters(moments: DataFrame) -> DataFrame:
    """Moment-matched lognormal and gamma parameters; null where the spread vanishes."""
    good_log = F.col("var_log") > 1e-15
    good = (F.col("mean_value") > 0) & (F.col("var_value") > 1e-15)
    return moments.withColumns({
        "lognormal_mu": F.col("mean_log"),
        "lognormal_sigma": F.when(good_log, F.sqrt(F.greatest(F.col("var_log"), F.lit(1e-9)))),
        "gamma_shape": F.when(good, F.greatest(F.col("mean_value") * F.col("mean_value") / F.col("var_value"), F.lit(1e-6))),
        "gamma_scale": F.when(good, F.col("var_value") / F.col("mean_value")),
    })


def family_cdf(family: str, value: Column) -> Column:
    """Distribution function of a family at ``value``, parameters taken from the row."""
    if family == "weibull":
        return F.when(F.col("weibull_shape").isNotNull(),
                      1.0 - F.exp(-F.pow(value / F.col("weibull_scale"), F.col("weibull_shape"))))
    if family == "lognormal":
        z = (F.ln(value) - F.col("lognormal_mu")) / F.col("lognormal_sigma")
        return F.when(F.col("lognormal_sigma").isNotNull(), normal_cdf_of(z))
    return F.when(F.col("gamma_shape").isNotNull(), gamma_cdf_of(value, F.col("gamma_shape"), F.col("gamma_scale")))


def _open(p: Column) -> Column:
    return F.greatest(F.lit(_EPS), F.least(p, F.lit(1.0 - _EPS)))


def log_likelihoods(sample: DataFrame, parameters: DataFrame, keys: Sequence[str] = ("node_id",)) -> DataFrame:
    """Censored log-likelihood of lognormal and gamma."""
    keys = list(keys)
    limits = sample.where(F.col("kind") != "in").join(parameters, keys)
    parts = []
    for family in ("lognormal", "gamma"):
        p = _open(family_cdf(family, F.col("value")))
        side = F.when(F.col("kind") == "left", F.ln(p)).otherwise(F.ln(_open(1.0 - p)))
        parts.append(F.sum(F.col("weight") * side).alias(f"__limits_{family}"))
    censored = limits.groupBy(*keys).agg(*parts)
    w, mean_log, var_log = F.col("in_weight"), F.col("mean_log"), F.col("var_log")
    sigma, shape, scale = F.col("lognormal_sigma"), F.col("gamma_shape"), F.col("gamma_scale")
    lognormal = w * (-mean_log - F.ln(sigma) - 0.5 * math.log(2 * math.pi) - 0.5 * var_log / (sigma * sigma))
    gamma = w * ((shape - 1.0) * mean_log - F.col("mean_value") / scale - shape * F.ln(scale) - log_gamma_of(shape))
    zero = F.lit(0.0)
    return parameters.join(censored, keys, "left").withColumns({
        "lognormal_log_likelihood": lognormal + F.coalesce("__limits_lognormal", zero),
        "gamma_log_likelihood": F.when(shape.isNotNull(), gamma + F.coalesce("__limits_gamma", zero)),
    }).drop("__limits_lognormal", "__limits_gamma")


def information_criteria(log_likelihood: Column, weight: Column, parameters: int = 2) -> tuple[Column, Column]:
    known = log_likelihood.isNotNull() & (weight > 0)
    return (F.when(known, 2.0 * parameters - 2.0 * log_likelihood),
            F.when(known, F.ln(weight) * parameters - 2.0 * log_likelihood))


def kolmogorov_pvalue(statistic: Column, weight: Column) -> Column:
    """Alternating series, ended by the first term below 1e-8 (at most 199 terms)."""
    root = F.sqrt(weight)
    lam = (root + 0.12 + 0.11 / root) * statistic
    def term(i):
        return F.exp(-2.0 * lam * lam * i * i)

    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(199)), F.lit(0.0),
        lambda acc, i: acc + F.when((i == 1) | (term(i.cast("double") - 1.0) >= 1e-8),
                                    F.when(i % 2 == 1, 1.0).otherwise(-1.0) * term(i.cast("double"))).otherwise(0.0))
    return F.when(weight > 0, F.when(statistic <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * total))))


def weighted_ks(sample: DataFrame, parameters: DataFrame, keys: Sequence[str] = ("node_id",),
                families: Sequence[str] = FAMILIES, max_rows: int | None = MAX_ROWS_PER_RANGE,
                tie_order: Sequence[str] = ()) -> DataFrame:
    """Largest distance between the weighted empirical step and each family's distribution.

    ``sample`` may hold one row per distinct value or, with ``tie_order``, one per record.
    """
    keys = list(keys)
    inside = sample.where((F.col("kind") == "in") & (F.col("weight") > 0)).select(*keys, "value", "weight", *tie_order)
    rows = (
        order_rows(inside, keys, ["value", *tie_order], max_rows=max_rows, hold=True)
        .running_sum(__upto=F.col("weight")).totals(ks_weight=F.sum("weight")).dataframe()
        .join(parameters, keys)
    )
    share = F.col("__upto") / F.col("ks_weight")
    out = rows.groupBy(*keys).agg(
        F.max("ks_weight").alias("ks_weight"),
        *[F.max(F.abs(share - _open(family_cdf(f, F.col("value"))))).alias(f"{f}_ks_statistic") for f in families])
    return out.withColumns({f"{f}_ks_pvalue": kolmogorov_pvalue(F.col(f"{f}_ks_statistic"), F.col("ks_weight")) for f in families})


def compare_models(sample: DataFrame, fits: DataFrame, keys: Sequence[str] = ("node_id",),
                   config: ParametricConfig = ParametricConfig(), max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """All candidates per key with likelihood, AIC, BIC, KS, and the preferred one."""
    keys = list(keys)
    weibull = fits.select(*keys, "weibull_shape", "weibull_scale", "weibull_log_likelihood", "weibull_reliable", "weibull_message",
                          (F.col("weibull_in_weight") + F.col("weibull_left_weight") + F.col("weibull_right_weight")).alias("total_weight"))
    parameters = weibull.join(candidate_parameters(weighted_moments(sample, keys)), keys, "left")
    parameters = parameters.withColumn("in_weight", F.coalesce("in_weight", F.lit(0.0)))
    enough = F.col("in_weight") >= config.min_in_weight
    for name in ("lognormal_mu", "lognormal_sigma", "gamma_shape", "gamma_scale"):
        allowed = enough & F.lit(config.enable_gamma or not name.startswith("gamma"))
        parameters = parameters.withColumn(name, F.when(allowed, F.col(name)))
    table = log_likelihoods(sample, parameters, keys)
    table = table.join(weighted_ks(sample, parameters, keys, max_rows=max_rows), keys, "left")
    for f in FAMILIES:
        aic, bic = information_criteria(F.col(f"{f}_log_likelihood"), F.col("total_weight"))
        tested = F.col("in_weight") >= config.ks_min_weight
        success = (F.col("weibull_shape").isNotNull() & F.col("weibull_reliable")) if f == "weibull" else (
            F.col(f"{f}_log_likelihood").isNotNull())
        table = table.withColumns({
            f"{f}_aic": aic, f"{f}_bic": bic,
            f"{f}_ks_statistic": F.when(tested, F.col(f"{f}_ks_statistic")),
            f"{f}_ks_pvalue": F.when(tested, F.col(f"{f}_ks_pvalue")), f"{f}_parametric_success": success})
    metric = config.selection_metric
    ranked = F.array_compact(F.array(*[
        F.when(F.col(f"{f}_parametric_success") & F.col(f"{f}_{metric}").isNotNull(),
               F.struct(F.col(f"{f}_{metric}").alias("m"), F.lit(i).alias("i"), F.lit(f).alias("name")))
        for i, f in enumerate(FAMILIES)]))
    best = F.array_min(ranked)
    skipped = F.concat(F.lit("Alternative fits skipped: in-range weight "), F.format_string("%.1f", "in_weight"),
                       F.lit(f" < minimum {config.min_in_weight:.1f}."))
    return table.withColumns({
        "parametric_selection_metric": F.lit(metric), "parametric_preferred_model": best["name"],
        "parametric_preferred_metric_value": best["m"],
        "parametric_notes": F.when(~enough, skipped).otherwise(""),
    }).drop("mean_value", "var_value", "mean_log", "var_log", "ks_weight")
