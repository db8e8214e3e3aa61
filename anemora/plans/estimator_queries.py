"""Censored samples, Kaplan-Meier, Weibull, model comparison, power, bootstrap."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.config import BootstrapConfig, Height, KaplanMeierCriteria, RangeThresholds
from anemora.operators import bootstrap, censored, kaplan_meier as km, parametric, power, quantiles, weibull
from anemora.plans.registry import query
from anemora.plans.series_queries import _CURVE_SQL
from anemora.functions import special
from anemora.operators import nodes
from anemora.plans.tables import OBS, OBS_YEARS, REF, obs, obs_years, ref, table
from anemora.sources.readers import clean_reference

LO, UP = RangeThresholds().lower, RangeThresholds().upper

_RECORDS = """
posterior AS (
  SELECT node_id, event_id, "timestamp", lower(trim(pred_range_label)) AS flag, range_flag_confident AS sure,
         CASE WHEN pred_wind_speed > 0 THEN pred_wind_speed END AS v,
         prob_range_below / t AS pb, prob_range_in / t AS pi, prob_range_above / t AS pa
  FROM (SELECT *, prob_range_below + prob_range_in + prob_range_above AS t FROM obs) WHERE t > 0
),
held AS (
  SELECT *, CASE WHEN sure AND flag = 'in' AND pi >= 0.5 THEN 'in' WHEN sure AND flag = 'below' AND pb >= 0.5 THEN 'below'
                 WHEN sure AND flag = 'above' AND pa >= 0.5 THEN 'above' END AS hard FROM posterior
),
rec AS (
  SELECT *, CASE WHEN hard = 'in' THEN 1e0 WHEN hard IS NULL THEN pi ELSE 0e0 END AS s_in,
         CASE WHEN hard = 'below' THEN 1e0 WHEN hard IS NULL THEN pb ELSE 0e0 END AS w_left,
         CASE WHEN hard = 'above' THEN 1e0 WHEN hard IS NULL THEN pa ELSE 0e0 END AS w_right FROM held
),
sample AS (
  SELECT node_id, 'in' AS kind, v AS value, sum(s_in) AS weight FROM rec WHERE v IS NOT NULL GROUP BY node_id, v HAVING sum(s_in) > 0
  UNION ALL SELECT node_id, 'left', 5.7e0, sum(w_left) FROM rec GROUP BY node_id HAVING sum(w_left) > 0
  UNION ALL SELECT node_id, 'right', 17.8e0, sum(w_right) FROM rec GROUP BY node_id HAVING sum(w_right) > 0
)"""
_TOTALS = """
totals AS (
  SELECT node_id, coalesce(sum(weight) FILTER (WHERE kind = 'in'), 0) AS in_weight, coalesce(sum(weight) FILTER (WHERE kind = 'left'), 0) AS left_weight,
         coalesce(sum(weight) FILTER (WHERE kind = 'right'), 0) AS right_weight, sum(weight) AS total_weight
  FROM sample GROUP BY node_id
)"""
_KM = """
timeline AS (
  SELECT node_id, value, sum(CASE WHEN kind <> 'right' THEN weight ELSE 0 END) AS ev, sum(CASE WHEN kind = 'right' THEN weight ELSE 0 END) AS ce
  FROM sample GROUP BY node_id, value
),
risk AS (
  SELECT *, sum(ev + ce) OVER (PARTITION BY node_id)
       - coalesce(sum(ev + ce) OVER (PARTITION BY node_id ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_risk FROM timeline
),
hazards AS (SELECT *, least(1e0, ev / greatest(at_risk, 1e-12)) AS h FROM risk),
product AS (
  SELECT *, CASE WHEN max(h) OVER w >= 1 - 1e-12 THEN 0e0 ELSE exp(sum(CASE WHEN h >= 1 - 1e-12 THEN 0e0 ELSE ln(1 - h) END) OVER w) END AS survival
  FROM hazards WINDOW w AS (PARTITION BY node_id ORDER BY value)
),
steps AS (
  SELECT node_id, value AS t, 1 - survival AS cdf, survival,
         coalesce(lag(survival) OVER (PARTITION BY node_id ORDER BY value), 1) - survival AS mass
  FROM product WHERE ev > 0
)"""


def _sample(spark, sf_dir):
    return censored.censored_sample(obs(spark, sf_dir))


@query("censored_weights", f"WITH {OBS}, {_RECORDS} SELECT * FROM sample", "value weight")
def censored_weights(spark, sf_dir):
    return _sample(spark, sf_dir)


@query("censored_totals", f"WITH {OBS}, {_RECORDS}, {_TOTALS} SELECT * FROM totals", "in_weight left_weight right_weight total_weight")
def censored_totals(spark, sf_dir):
    return censored.sample_totals(_sample(spark, sf_dir))


_SELECTION = """
picked AS (
  SELECT node_id, CAST(count(*) AS DOUBLE) AS total_observations, (sum(w_left) + sum(w_right)) / count(*) AS censored_ratio,
         sum(w_left) / count(*) AS below_ratio, sum(s_in) / count(*) AS in_ratio FROM rec GROUP BY node_id
)"""


@query("selection_weights", f"WITH {OBS}, {_RECORDS}, {_SELECTION} SELECT * FROM picked",
       "total_observations censored_ratio below_ratio in_ratio")
def selection_weights(spark, sf_dir):
    return censored.selection_summary(obs(spark, sf_dir))


@query("km_selection", f"""WITH {OBS}, {_RECORDS}, {_TOTALS}, {_SELECTION}, j AS (
    SELECT p.*, t.in_weight AS valid_count FROM picked p LEFT JOIN totals t USING (node_id)),
  r AS (SELECT node_id, total_observations, valid_count, concat_ws(' | ',
    CASE WHEN censored_ratio >= 0.20 THEN 'censored ratio ' || printf('%.3f', censored_ratio) || ' ≥ 0.20' END,
    CASE WHEN below_ratio >= 0.15 THEN 'below ratio ' || printf('%.3f', below_ratio) || ' ≥ 0.15' END,
    CASE WHEN valid_count / total_observations <= 0.55 THEN 'in-range share ' || printf('%.3f', valid_count / total_observations) || ' ≤ 0.55' END,
    CASE WHEN valid_count <= 150 THEN 'uncensored weight ' || printf('%.0f', valid_count) || ' ≤ 150' END) AS reasons FROM j)
  SELECT node_id, CASE WHEN total_observations >= 200 THEN reasons ELSE '' END AS reasons, total_observations >= 200 AND reasons <> '' AS km_selected FROM r""")
def km_selection(spark, sf_dir):
    rows = obs(spark, sf_dir)
    valid = censored.sample_totals(censored.censored_sample(rows)).select("node_id", F.col("in_weight").alias("valid_count"))
    out = km.selection(censored.selection_summary(rows).join(valid, "node_id", "left"))
    return out.select("node_id", F.concat_ws(" | ", "selection_reasons").alias("reasons"), "km_selected")


@query("kaplan_meier", f"WITH {OBS}, {_RECORDS}, {_KM} SELECT * FROM steps", "t cdf survival mass")
def kaplan_meier(spark, sf_dir):
    return km.kaplan_meier(_sample(spark, sf_dir))


@query("km_quantile", f"""WITH {OBS}, {_RECORDS}, {_KM} SELECT node_id, min(t) FILTER (WHERE cdf + 1e-12 >= 0.5) AS km_p50,
  min(t) FILTER (WHERE cdf + 1e-12 >= 0.9) AS km_p90, min(t) FILTER (WHERE cdf + 1e-12 >= 0.99) AS km_p99,
  min(survival) AS right_tail_probability FROM steps GROUP BY node_id""", "km_p50 km_p90 km_p99 right_tail_probability")
def km_quantile(spark, sf_dir):
    return km.km_summary(km.kaplan_meier(_sample(spark, sf_dir)))


HUB = Height("log", 10.0, 110.0)


_KM_POWER = f"""
x AS (SELECT *, t * {HUB.scale!r}e0 AS x FROM steps),
s AS (SELECT node_id, sum(mass * x * x * x) AS m3, sum(mass * {_CURVE_SQL}) AS kw, min(survival) AS tail_probability FROM x GROUP BY node_id),
y AS (SELECT *, {UP}e0 * {HUB.scale!r}e0 AS x FROM s),
densities AS (
  SELECT node_id, 0.5 * 1.225 * (m3 + tail_probability * x * x * x) AS power_density_w_m2,
         kw + tail_probability * {_CURVE_SQL} AS turbine_mean_power_kw, (kw + tail_probability * {_CURVE_SQL}) / 6000 AS capacity_factor, tail_probability
  FROM y
)"""


@query("km_power", f"WITH {OBS}, {_RECORDS}, {_KM}, {_KM_POWER} SELECT * FROM densities",
       "power_density_w_m2 turbine_mean_power_kw capacity_factor tail_probability")
def km_power(spark, sf_dir):
    return km.km_power(km.kaplan_meier(_sample(spark, sf_dir)), tail_speed=UP, scale=HUB.scale)


@query("km_category_curves", f"""WITH {OBS}, {_RECORDS}, {_KM}, g AS (SELECT DISTINCT node_id, unnest([3e0, 6e0, 9e0, 12e0, 15e0, 18e0]) AS speed FROM steps),
  grid AS (SELECT g.node_id, g.speed, coalesce(max(cdf), 0) AS cdf FROM g LEFT JOIN steps s ON s.node_id = g.node_id AND s.t <= g.speed GROUP BY 1, 2),
  tails AS (SELECT node_id, min(survival) AS tail FROM steps GROUP BY 1)
  SELECT CASE WHEN CAST(right(node_id, 2) AS INTEGER) < 10 THEN 'first' ELSE 'second' END AS category, speed, avg(cdf) AS mean_cdf,
         avg(tail) AS mean_tail_probability, count(*) AS nodes FROM grid JOIN tails USING (node_id) GROUP BY 1, 2""", "speed mean_cdf mean_tail_probability")
def km_category_curves(spark, sf_dir):
    steps = km.kaplan_meier(_sample(spark, sf_dir))
    categories = steps.select("node_id").distinct().withColumn(
        "category", F.when(F.substring("node_id", -2, 2).cast("int") < 10, "first").otherwise("second"))
    return km.category_curves(steps, categories, "category", [3.0, 6.0, 9.0, 12.0, 15.0, 18.0])


# -- weighted quantiles ------------------------------------------------------------
def _weighted(spark, sf_dir):
    rows = censored.record_weights(obs(spark, sf_dir)).where(F.col("w_in") > 0)
    return rows.select("node_id", F.col("v").alias("__value"), F.col("w_in").alias("__weight"), "event_id")


_WEIGHTED = """
weighted AS (SELECT node_id, event_id, v, s_in AS w FROM rec WHERE v IS NOT NULL AND s_in > 0),
running AS (SELECT *, sum(w) OVER o AS c, lag(v) OVER o AS v0, sum(w) OVER (PARTITION BY node_id) AS total FROM weighted
            WINDOW o AS (PARTITION BY node_id ORDER BY v, event_id))"""


def _interpolated_sql(p: float, name: str) -> str:
    return f"""coalesce(min(CASE WHEN c / total >= {p} AND ((c - w) / total < {p} OR v0 IS NULL) THEN
      CASE WHEN v0 IS NULL THEN v ELSE v0 + ({p} - (c - w) / total) / (c / total - (c - w) / total) * (v - v0) END END), max(v)) AS {name}"""


@query("weighted_quantile", f"""WITH {OBS}, {_RECORDS}, {_WEIGHTED} SELECT node_id, {_interpolated_sql(0.5, 'p50')}, {_interpolated_sql(0.9, 'p90')},
  {_interpolated_sql(0.99, 'p99')} FROM running GROUP BY node_id""", "p50 p90 p99")
def weighted_quantile(spark, sf_dir):
    return quantiles.weighted_quantiles(_weighted(spark, sf_dir), ["node_id"], {"p50": 0.5, "p90": 0.9, "p99": 0.99}, tie_order=["event_id"])


@query("weighted_step_quantile", f"""WITH {OBS}, {_RECORDS}, {_WEIGHTED} SELECT node_id, coalesce(min(v) FILTER (WHERE c > 0.5 * total), max(v)) AS p50,
  coalesce(min(v) FILTER (WHERE c > 0.9 * total), max(v)) AS p90 FROM running GROUP BY node_id""", "p50 p90")
def weighted_step_quantile(spark, sf_dir):
    rows = _weighted(spark, sf_dir)
    merged = rows.groupBy("node_id", "__value").agg(F.sum("__weight").alias("__weight"))
    return quantiles.weighted_step_quantiles(merged, ["node_id"], {"p50": 0.5, "p90": 0.9})


# -- parametric models -------------------------------------------------------------
_LL = """
ll AS (
  SELECT node_id, sum(weight * CASE kind
      WHEN 'in' THEN ln(2e0) + ln(value) - 2 * ln(9e0) - (value / 9e0) * (value / 9e0)
      WHEN 'left' THEN ln(greatest(1 - exp(-(value / 9e0) * (value / 9e0)), 1e-12))
      ELSE -(value / 9e0) * (value / 9e0) END) AS log_likelihood, sum(weight) AS total_weight
  FROM sample GROUP BY node_id
)"""


@query("weibull_likelihood", f"""WITH {OBS}, {_RECORDS}, {_LL} SELECT node_id, log_likelihood, 4 - 2 * log_likelihood AS aic,
  2 * ln(total_weight) - 2 * log_likelihood AS bic FROM ll""", "log_likelihood aic bic", digits=4)
def weibull_likelihood(spark, sf_dir):
    """Censored log-likelihood of a given Weibull (shape 2, scale 9) with AIC and BIC."""
    ll = weibull.likelihood_at(_sample(spark, sf_dir), 2.0, 9.0)
    aic, bic = parametric.information_criteria(F.col("log_likelihood"), F.col("total_weight"))
    return ll.select("node_id", "log_likelihood", aic.alias("aic"), bic.alias("bic"))


@query("lognormal_moments", f"""WITH {OBS}, {_RECORDS} SELECT node_id, sum(weight) AS in_weight, sum(weight * value) / sum(weight) AS mean_value,
  sum(weight * value * value) / sum(weight) - (sum(weight * value) / sum(weight)) ** 2 AS var_value, sum(weight * ln(value)) / sum(weight) AS mean_log,
  sum(weight * ln(value) * ln(value)) / sum(weight) - (sum(weight * ln(value)) / sum(weight)) ** 2 AS var_log
  FROM sample WHERE kind = 'in' GROUP BY node_id""", "in_weight mean_value var_value mean_log var_log")
def lognormal_moments(spark, sf_dir):
    return parametric.weighted_moments(_sample(spark, sf_dir))


def _pvalue_sql(d: str, w: str) -> str:
    lam = f"((sqrt({w}) + 0.12 + 0.11 / sqrt({w})) * {d})"
    return (f"greatest(0e0, least(1e0, 2 * (SELECT sum(CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2 * {lam} * {lam} * k * k)) "
            f"FROM (SELECT unnest(generate_series(1, 199)) AS k) WHERE k = 1 OR exp(-2 * {lam} * {lam} * (k - 1) * (k - 1)) >= 1e-8)))")


@query("ks_statistic", f"""WITH {OBS}, {_RECORDS}, c AS (
    SELECT node_id, value, sum(weight) OVER (PARTITION BY node_id ORDER BY value) AS upto, sum(weight) OVER (PARTITION BY node_id) AS total FROM sample WHERE kind = 'in'),
  d AS (SELECT node_id, max(total) AS w, max(abs(upto / total - greatest(1e-15, least(1 - exp(-(value / 9e0) * (value / 9e0)), 1 - 1e-15)))) AS d FROM c GROUP BY node_id)
  SELECT node_id, d AS weibull_ks_statistic, {_pvalue_sql('d', 'w')} AS weibull_ks_pvalue FROM d""", "weibull_ks_statistic weibull_ks_pvalue")
def ks_statistic(spark, sf_dir):
    sample = _sample(spark, sf_dir)
    given = sample.select("node_id").distinct().withColumns({"weibull_shape": F.lit(2.0), "weibull_scale": F.lit(9.0)})
    return parametric.weighted_ks(sample, given, families=["weibull"]).drop("ks_weight")


# Newton's method on the censored likelihood in the logarithms of shape (a) and scale (b), all nodes at once.
_NEWTON = """
newton(step, node_id, a, b) AS (
  SELECT 0, node_id, ln(1.2e0), ln(12e0) FROM (SELECT DISTINCT node_id FROM sample)
  UNION ALL
  SELECT step + 1, node_id, a + CASE WHEN aa < 0 AND aa * bb > ab * ab THEN greatest(-0.5, least(0.5, (gb * ab - ga * bb) / (aa * bb - ab * ab))) ELSE 0.1 * sign(ga) END,
         b + CASE WHEN aa < 0 AND aa * bb > ab * ab THEN greatest(-0.5, least(0.5, (ga * ab - gb * aa) / (aa * bb - ab * ab))) ELSE 0.1 * sign(gb) END
  FROM (
    SELECT step, node_id, a, b,
           sum(w * CASE kind WHEN 'in' THEN 1 + k * r * (1 - u) WHEN 'left' THEN g * k * r ELSE -u * k * r END) AS ga,
           sum(w * CASE kind WHEN 'in' THEN k * (u - 1) WHEN 'left' THEN -g * k ELSE u * k END) AS gb,
           sum(w * CASE kind WHEN 'in' THEN k * r * (1 - u) - k * k * r * r * u WHEN 'left' THEN g * k * r + k * k * r * r * u * d ELSE -u * k * r - u * k * k * r * r END) AS aa,
           sum(w * CASE kind WHEN 'in' THEN k * k * r * u - k * (1 - u) WHEN 'left' THEN -g * k - k * k * r * u * d ELSE u * k * k * r + u * k END) AS ab,
           sum(w * CASE kind WHEN 'in' THEN -k * k * u WHEN 'left' THEN k * k * u * d ELSE -u * k * k END) AS bb
    FROM (
      SELECT *, u / (exp(u) - 1) AS g, (exp(u) - 1 - u * exp(u)) / ((exp(u) - 1) * (exp(u) - 1)) AS d FROM (
        SELECT *, least(exp(k * r), 600e0) AS u FROM (
          SELECT n.step, n.node_id, n.a, n.b, s.kind, s.weight AS w, exp(n.a) AS k, ln(s.value) - n.b AS r FROM newton n JOIN sample s USING (node_id) WHERE n.step < 40)))
    GROUP BY step, node_id, a, b)
),
fitted AS (SELECT node_id, exp(a) AS shape, exp(b) AS scale FROM newton WHERE step = 40)"""


@query("weibull_mle_values", f"WITH RECURSIVE {OBS}, {_RECORDS}, {_NEWTON} SELECT * FROM fitted", "shape scale", digits=3)
def weibull_mle_values(spark, sf_dir):
    """Shape and scale of every node."""
    return weibull.fit_weibull(_sample(spark, sf_dir), min_in_weight=1.0).select(
        "node_id", F.col("weibull_shape").alias("shape"), F.col("weibull_scale").alias("scale"))


_ADMIT = KaplanMeierCriteria(min_total_censored_ratio=1.1, min_below_ratio=1.1, max_valid_share=-1.0, min_uncensored_weight=-1.0)


@query("node_power_weibull", f"""WITH RECURSIVE {OBS}, {_RECORDS}, {_NEWTON},
  grid AS (SELECT *, 1e-6 + (greatest(25e0, 5 * scale) - 1e-6) * i / 1999e0 AS x, (greatest(25e0, 5 * scale) - 1e-6) / 1999e0 * CASE WHEN i IN (0, 1999) THEN 0.5 ELSE 1 END AS dx
           FROM fitted, (SELECT unnest(range(2000)) AS i)),
  output AS (SELECT node_id, sum(dx * {_CURVE_SQL} * shape / scale * (x / scale) ** (shape - 1) * exp(-((x / scale) ** shape))) AS kw FROM grid GROUP BY 1)
  SELECT node_id, 'weibull' AS method, 0.5 * 1.225 * scale ** 3 * gamma(1 + 3 / shape) AS power_density_w_m2, kw AS turbine_mean_power_kw FROM fitted JOIN output USING (node_id)""",
       "power_density_w_m2 turbine_mean_power_kw", digits=0)
def node_power_weibull(spark, sf_dir):
    """The power stage with criteria that let the fit decide."""
    return power.node_power(obs(spark, sf_dir), min_in_weight=1.0, criteria=_ADMIT).select(
        "node_id", "method", "power_density_w_m2", "turbine_mean_power_kw")


_ERF = "2 / sqrt(pi()) * list_sum(list_transform(range(0, 60), lambda n: (CASE WHEN n % 2 = 0 THEN 1e0 ELSE -1e0 END) * x ** (2 * n + 1) / (gamma(n + 1e0) * (2 * n + 1))))"


@query("special_values", f"""WITH q AS (SELECT DISTINCT l_quantity / 20e0 AS x FROM lineitem)
  SELECT x, lgamma(x) AS log_gamma, gamma(x) AS gamma, 1 - exp(-x) * (1 + x + x * x / 2) AS lower_gamma_3, {_ERF} AS erf FROM q""", "x log_gamma gamma lower_gamma_3 erf")
def special_values(spark, sf_dir):
    """The special functions of the estimators over the quantities."""
    x = F.col("x")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 20).alias("x")).distinct()
    return rows.select("x", special.log_gamma_of(x).alias("log_gamma"), F.exp(special.log_gamma_of(x)).alias("gamma"),
                       special.gamma_cdf_of(x, F.lit(3.0), F.lit(1.0)).alias("lower_gamma_3"), (2 * special.normal_cdf_of(x * 2**0.5) - 1).alias("erf"))


@query("bootstrap_labels", f"""WITH {OBS}, {_RECORDS}, n AS (
    SELECT node_id, coalesce(hard, CASE WHEN greatest(pb, pi, pa) < 0.5 THEN 'uncertain' WHEN pb = greatest(pb, pi, pa) THEN 'below'
      WHEN pi = greatest(pb, pi, pa) THEN 'in' ELSE 'above' END) AS s FROM rec)
  SELECT node_id, count(*) AS total_samples, count(*) FILTER (s = 'below') AS label_count_below, count(*) FILTER (s = 'in') AS label_count_in,
         count(*) FILTER (s = 'above') AS label_count_above, count(*) FILTER (s = 'uncertain') AS label_count_uncertain,
         count(*) FILTER (s = 'in') / count(*) AS label_ratio_in, CAST(20 AS BIGINT) AS mean_speed_replicates, 'kaplan_meier' AS power_method
  FROM n GROUP BY 1""", "label_ratio_in")
def bootstrap_labels(spark, sf_dir):
    """What the bootstrap's summary says of labels, replicates and methods."""
    config = BootstrapConfig(replicas=20, seed=7)
    return bootstrap.bootstrap_summary(obs(spark, sf_dir), config, tie="event_id").select(
        "node_id", "total_samples", *[f"label_count_{s}" for s in bootstrap.STRATA], "label_ratio_in", "mean_speed_replicates", "power_method")


@query("bootstrap_bca")
def bootstrap_bca(spark, sf_dir):
    config = BootstrapConfig(replicas=60, seed=7, ci_method="bca", apply_rmse_noise=False, rmse_mode="none")
    return bootstrap.bootstrap_intervals(obs(spark, sf_dir), config, tie="event_id")


@query("bootstrap_percentile_t")
def bootstrap_percentile_t(spark, sf_dir):
    config = BootstrapConfig(replicas=60, seed=7, ci_method="percentile_t", apply_rmse_noise=False, rmse_mode="none")
    return bootstrap.bootstrap_intervals(obs(spark, sf_dir), config, tie="event_id")


@query("jackknife_mean", f"""WITH {OBS}, {_RECORDS}, v AS (
    SELECT node_id, coalesce(least(greatest(s, {LO}e0), {UP}e0), 0) AS v, CASE WHEN s IS NULL THEN 0 ELSE s_in END AS w FROM rec JOIN (SELECT event_id, pred_wind_speed AS s FROM obs) USING (event_id)),
  t AS (SELECT *, sum(w) OVER p AS ws, sum(w * v) OVER p AS wv FROM v WINDOW p AS (PARTITION BY node_id))
  SELECT node_id, count(*) AS n, sum((wv - w * v) / (ws - w) - wv / ws) AS d1, 1e6 * sum(((wv - w * v) / (ws - w) - wv / ws) ** 2) AS d2 FROM t GROUP BY 1""", "d1 d2")
def jackknife_mean(spark, sf_dir):
    """Delete-one values of the weighted mean."""
    found = bootstrap.jackknife(obs(spark, sf_dir), BootstrapConfig(replicas=0), tie="event_id")
    return found.where("metric = 'mean_speed'").select("node_id", "n", "d1", (F.col("d2") * 1e6).alias("d2"))


@query("node_geometry", "SELECT 'NODE_' || lpad(CAST(s_suppkey % 20 AS VARCHAR), 2, '0') AS node_id, min(s_name) AS geometry FROM supplier GROUP BY 1")
def node_geometry(spark, sf_dir):
    """One geometry per node, whichever row comes first by value."""
    rows = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("NODE_"), F.lpad((F.col("s_suppkey") % 20).cast("string"), 2, "0")).alias("node_id"), F.col("s_name").alias("geometry"))
    return nodes.any_row(rows, "node_id", "geometry")


@query("interval_coverage", """WITH t AS (SELECT l_suppkey, CASE WHEN count(*) % 3 > 0 THEN min(l_tax) END AS lo, CASE WHEN count(*) % 4 > 0 THEN max(l_tax) END AS hi, count(*) AS n FROM lineitem GROUP BY 1)
  SELECT count(*) AS nodes, count(*) FILTER (lo IS NOT NULL AND hi IS NOT NULL) AS nodes_with_interval, min(n) AS min_replicates, max(n) AS max_replicates, avg(n) AS mean_replicates FROM t""",
       "mean_replicates")
def interval_coverage(spark, sf_dir):
    n = F.count(F.lit(1))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.when(n % 3 > 0, F.min("l_tax")).alias("lo"), F.when(n % 4 > 0, F.max("l_tax")).alias("hi"), n.alias("n"))
    return nodes.uncertainty_coverage(rows, "lo", "hi", "n")


@query("weibull_mle")
def weibull_mle(spark, sf_dir):
    return weibull.fit_weibull(_sample(spark, sf_dir), min_in_weight=100.0)


@query("parametric_select")
def parametric_select(spark, sf_dir):
    sample = _sample(spark, sf_dir)
    return parametric.compare_models(sample, weibull.fit_weibull(sample, min_in_weight=100.0))


def _gamma_p_sql(a: str, x: str) -> str:
    """The lower incomplete gamma by its power series, 400 terms from the far end; enough for the shapes and speeds at hand."""
    return (f"exp({a}*ln({x}) - {x} - lgamma({a})) / {a} * list_reduce(list_prepend(1e0, list_transform(range(400, 0, -1), lambda i: CAST(i AS DOUBLE))), lambda s, i: 1 + s*{x}/({a} + i))")


def _normal_sql(z: str) -> str:
    """The normal law by its series in odd double factorials, 200 terms from the far end."""
    return (f"0.5 + exp(-0.5*{z}*{z})/sqrt(2*pi())*{z} * "
            f"list_reduce(list_prepend(1e0, list_transform(range(200, 0, -1), lambda i: CAST(i AS DOUBLE))), lambda s, i: 1 + s*{z}*{z}/(2*i + 1))")


_CANDIDATES = f"""
mo AS (SELECT node_id, sum(weight) AS w, sum(weight*value)/sum(weight) AS m, sum(weight*ln(value))/sum(weight) AS ml, sum(weight*value*value)/sum(weight) AS mm,
              sum(weight*ln(value)*ln(value))/sum(weight) AS mll FROM sample WHERE kind = 'in' GROUP BY 1),
par AS (SELECT *, sqrt(mll - ml*ml) AS sd, m*m/(mm - m*m) AS shape, (mm - m*m)/m AS scale FROM mo WHERE w >= 20),
pts AS (SELECT s.*, w, sd, ml, shape, scale, (ln(value) - ml)/sd AS z, value/scale AS y FROM sample s JOIN par USING (node_id)),
cdf AS (SELECT *, greatest(1e-15, least({_normal_sql("z")}, 1 - 1e-15)) AS pl, greatest(1e-15, least({_gamma_p_sql("shape", "y")}, 1 - 1e-15)) AS pg FROM pts),
lim AS (SELECT node_id, sum(weight * CASE kind WHEN 'left' THEN ln(pl) ELSE ln(1 - pl) END) AS ll, sum(weight * CASE kind WHEN 'left' THEN ln(pg) ELSE ln(1 - pg) END) AS lg
        FROM cdf WHERE kind <> 'in' GROUP BY 1),
upto AS (SELECT node_id, w, pl, pg, sum(weight) OVER (PARTITION BY node_id ORDER BY value) / w AS share FROM cdf WHERE kind = 'in'),
ks AS (SELECT node_id, max(abs(share - pl)) AS lognormal_ks_statistic, max(abs(share - pg)) AS gamma_ks_statistic FROM upto GROUP BY 1),
fam AS (SELECT p.node_id, w, total_weight, w*(-ml - ln(sd) - 0.5*ln(2*pi()) - 0.5*(mll - ml*ml)/(sd*sd)) + coalesce(ll, 0) AS lognormal_log_likelihood,
               w*((shape - 1)*ml - m/scale - shape*ln(scale) - lgamma(shape)) + coalesce(lg, 0) AS gamma_log_likelihood, lognormal_ks_statistic, gamma_ks_statistic
        FROM par p JOIN totals USING (node_id) JOIN ks USING (node_id) LEFT JOIN lim USING (node_id))"""


@query("parametric_candidates", f"""WITH {OBS}, {_RECORDS}, {_TOTALS}, {_CANDIDATES} SELECT node_id, lognormal_log_likelihood, gamma_log_likelihood,
  4 - 2*lognormal_log_likelihood AS lognormal_aic, 2*ln(total_weight) - 2*gamma_log_likelihood AS gamma_bic, lognormal_ks_statistic, gamma_ks_statistic,
  {_pvalue_sql("lognormal_ks_statistic", "w")} AS lognormal_ks_pvalue, {_pvalue_sql("gamma_ks_statistic", "w")} AS gamma_ks_pvalue FROM fam""",
       "lognormal_log_likelihood gamma_log_likelihood lognormal_aic gamma_bic lognormal_ks_statistic gamma_ks_statistic lognormal_ks_pvalue gamma_ks_pvalue")
def parametric_candidates(spark, sf_dir):
    """The candidates beside Weibull: likelihood, criteria and distance of every node."""
    sample = _sample(spark, sf_dir)
    config = parametric.ParametricConfig(min_in_weight=20.0, ks_min_weight=20.0)
    out = parametric.compare_models(sample, weibull.fit_weibull(sample, min_in_weight=1.0), config=config).where("in_weight >= 20")
    return out.select("node_id", "lognormal_log_likelihood", "gamma_log_likelihood", "lognormal_aic", "gamma_bic", "lognormal_ks_statistic",
                      "gamma_ks_statistic", "lognormal_ks_pvalue", "gamma_ks_pvalue")


@query("node_power")
def node_power(spark, sf_dir):
    """The power stage: sample, both estimators, method choice, report row."""
    return power.node_power(obs(spark, sf_dir), min_in_weight=100.0, height=HUB)


@query("node_power_report", f"""WITH {OBS}, {_RECORDS}, {_TOTALS}, {_KM}, {_KM_POWER} SELECT node_id, 'kaplan_meier' AS method, power_density_w_m2,
  turbine_mean_power_kw, capacity_factor, tail_probability AS kaplan_meier_tail_probability, in_weight AS weibull_in_weight,
  left_weight AS weibull_left_weight, right_weight AS weibull_right_weight FROM densities JOIN totals USING (node_id)""",
       "power_density_w_m2 turbine_mean_power_kw capacity_factor kaplan_meier_tail_probability weibull_in_weight weibull_left_weight weibull_right_weight")
def node_power_report(spark, sf_dir):
    """The power stage where the label mix decides for Kaplan-Meier, as it does for every node here."""
    return power.node_power(obs(spark, sf_dir), height=HUB).select(
        "node_id", "method", "power_density_w_m2", "turbine_mean_power_kw", "capacity_factor", "kaplan_meier_tail_probability",
        "weibull_in_weight", "weibull_left_weight", "weibull_right_weight")


def _period_sql(period: str) -> str:
    """The node report's SQL with the period made part of the node."""
    return f"""WITH {OBS_YEARS.format(period=period)}, {_RECORDS}, {_TOTALS}, {_KM}, {_KM_POWER.replace(repr(HUB.scale), "1.0")}
      SELECT node_id AS node_period, 'kaplan_meier' AS method, power_density_w_m2, turbine_mean_power_kw, in_weight AS weibull_in_weight
      FROM densities JOIN totals USING (node_id)"""


_PERIOD_DOUBLES = "power_density_w_m2 turbine_mean_power_kw weibull_in_weight"


@query("power_monthly", _period_sql("strftime(l_shipdate, '%Y-%m')"), _PERIOD_DOUBLES)
def power_monthly(spark, sf_dir):
    """The estimate per node and month over seven years; months are too short for a fit."""
    out = power.temporal_power(obs_years(spark, sf_dir), "monthly", min_in_weight=1e6)
    name = F.concat_ws("/", "node_id", F.date_format("period_start", "yyyy-MM"))
    return out.select(name.alias("node_period"), "method", "power_density_w_m2", "turbine_mean_power_kw", "weibull_in_weight")


_SEASON = """CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'DJF' WHEN month(l_shipdate) < 6 THEN 'MAM' WHEN month(l_shipdate) < 9 THEN 'JJA' ELSE 'SON' END
  || (year(l_shipdate) + CASE WHEN month(l_shipdate) = 12 THEN 1 ELSE 0 END)"""


@query("power_seasonal", _period_sql(_SEASON), _PERIOD_DOUBLES)
def power_seasonal(spark, sf_dir):
    """The estimate per node, season and year."""
    out = power.temporal_power(obs_years(spark, sf_dir), "seasonal", min_in_weight=1e6)
    name = F.concat(F.col("node_id"), F.lit("/"), F.col("season"), F.col("season_year").cast("string"))
    return out.select(name.alias("node_period"), "method", "power_density_w_m2", "turbine_mean_power_kw", "weibull_in_weight")


# -- reference series ---------------------------------------------------------------
@query("reference_censoring", f"""WITH {REF} SELECT CASE WHEN wind_speed < 5.7 THEN 'left' WHEN wind_speed > 17.8 THEN 'right' ELSE 'in' END AS kind,
  least(greatest(wind_speed, 5.7e0), 17.8e0) AS value, CAST(count(*) AS DOUBLE) AS weight FROM ref WHERE wind_speed > 0 GROUP BY 1, 2""", "value weight")
def reference_censoring(spark, sf_dir):
    return censored.censored_by_speed(clean_reference(ref(spark, sf_dir)), "wind_speed", RangeThresholds())


# -- bootstrap ----------------------------------------------------------------------
_BASE = f"""
clamped AS (SELECT node_id, event_id, CASE WHEN s IS NOT NULL THEN least(greatest(s, {LO}e0), {UP}e0) END AS v, s_in, w_left, w_right
            FROM rec JOIN (SELECT event_id, pred_wind_speed AS s FROM obs) USING (event_id)),
weighted AS (SELECT node_id, event_id, v, s_in AS w FROM clamped WHERE v IS NOT NULL AND s_in > 0),
running AS (SELECT *, sum(w) OVER o AS c, lag(v) OVER o AS v0, sum(w) OVER (PARTITION BY node_id) AS total FROM weighted
            WINDOW o AS (PARTITION BY node_id ORDER BY v, w, event_id)),
speeds AS (SELECT node_id, sum(w * v) / sum(w) AS mean_speed, sum(w) AS wi, sum(w * v * v * v) AS m3, {_interpolated_sql(0.5, 'p50')},
                  {_interpolated_sql(0.9, 'p90')}, {_interpolated_sql(0.99, 'p99')} FROM running GROUP BY node_id),
sides AS (SELECT node_id, sum(w_left) AS l, sum(w_right) AS r FROM clamped GROUP BY node_id)"""


@query("bootstrap_baseline", f"""WITH {OBS}, {_RECORDS}, {_BASE} SELECT node_id, mean_speed, p50, p90, p99,
  0.5 * 1.225 * (m3 + l * {LO}e0 ** 3 + r * {UP}e0 ** 3) / (wi + l + r) AS power_density FROM speeds JOIN sides USING (node_id)""",
       "mean_speed p50 p90 p99 power_density")
def bootstrap_baseline(spark, sf_dir):
    """The estimates the intervals are built around."""
    table = bootstrap.replicate_table(obs(spark, sf_dir), BootstrapConfig(replicas=0), tie="event_id")
    return table.where(F.col("replica") == bootstrap.BASELINE).select("node_id", *bootstrap.METRICS)


def _derivatives_sql(kind: str) -> dict[str, str]:
    """Derivatives in log shape and log scale of one observation at ``x``: ``e = k ln(x / scale)``, ``u = exp(e)``, ``g`` and its logarithmic derivatives ``g1, g2``."""
    if kind == "left":
        return {"ga": "g*e", "gb": "-g*k", "haa": "g*e + e*e*g1", "hab": "-k*(g + e*g1)", "hbb": "k*k*g1",
                "aaa": "g*e + 3*e*e*g1 + e*e*e*g2", "aab": "-k*(g + 3*e*g1 + e*e*g2)", "abb": "k*k*(2*g1 + e*g2)", "bbb": "-k*k*k*g2"}
    seen = 1 if kind == "in" else 0
    return {"ga": f"{seen}*(1 + e) - u*e", "gb": f"k*(u - {seen})", "haa": f"{seen}*e - u*e*(1 + e)", "hab": f"k*(u + u*e - {seen})", "hbb": "-k*k*u",
            "aaa": f"{seen}*e - u*e*(1 + 3*e + e*e)", "aab": f"k*(u*(1 + 3*e + e*e) - {seen})", "abb": "-k*k*u*(2 + e)", "bbb": "k*k*k*u"}


def _deleted_sql(rest: str, name: str) -> str:
    """The logarithm of the density at the maximum next to (a, b), from sums named ``{rest}ga`` and so on and the node's third derivatives."""
    h = {n: f"{rest}{n}" for n in ("ga", "gb", "haa", "hab", "hbb")}
    det = f"({h['haa']}*{h['hbb']} - {h['hab']}*{h['hab']})"
    solve = lambda p, q: (f"({h['hab']}*{q} - {h['hbb']}*{p})/{det}", f"({h['hab']}*{p} - {h['haa']}*{q})/{det}")
    x, y = solve(h["ga"], h["gb"])
    cx, cy = solve("ca", "cb")
    return (f"(SELECT 3*(b + y + {cy}) + lgamma(1 + 3*exp(-(a + x + {cx}))) FROM (SELECT *, (aaa*x*x + 2*aab*x*y + abb*y*y)/2 AS ca, (aab*x*x + 2*abb*x*y + bbb*y*y)/2 AS cb "
            f"FROM (SELECT {x} AS x, {y} AS y))) AS {name}")


_SUMMED = ("ga", "gb", "haa", "hab", "hbb", "aaa", "aab", "abb", "bbb")
_LEFT_OUT = f"""
cs AS (
  SELECT node_id, 'in' AS kind, v AS value, sum(s_in) AS weight FROM clamped WHERE v IS NOT NULL GROUP BY node_id, v HAVING sum(s_in) > 0
  UNION ALL SELECT node_id, 'left', {LO}e0, sum(w_left) FROM clamped GROUP BY node_id HAVING sum(w_left) > 0
  UNION ALL SELECT node_id, 'right', {UP}e0, sum(w_right) FROM clamped GROUP BY node_id HAVING sum(w_right) > 0
),
{_NEWTON.replace("sample", "cs")},
pieces AS (
  SELECT event_id, node_id, 'in' AS kind, v AS value, s_in AS w FROM clamped WHERE v IS NOT NULL
  UNION ALL SELECT event_id, node_id, 'left', {LO}e0, w_left FROM clamped UNION ALL SELECT event_id, node_id, 'right', {UP}e0, w_right FROM clamped
),
curve AS (
  SELECT *, g*(1 - u - g) AS g1, g*(1 - u - g)*(1 - u - g) - g*(u + g*(1 - u - g)) AS g2 FROM (
    SELECT *, u/(exp(least(u, 600e0)) - 1) AS g FROM (SELECT *, exp(e) AS u FROM (
      SELECT p.*, shape AS k, shape*ln(value/scale) AS e FROM pieces p JOIN fitted USING (node_id))))
),
own AS (SELECT event_id, node_id, {", ".join(f"sum(w * CASE kind WHEN 'in' THEN {_derivatives_sql('in')[n]} WHEN 'left' THEN {_derivatives_sql('left')[n]} ELSE {_derivatives_sql('right')[n]} END) AS own_{n}" for n in _SUMMED)}
        FROM curve GROUP BY event_id, node_id),
summed AS (SELECT *, {", ".join(f"sum(own_{n}) OVER w AS {n}" for n in _SUMMED)} FROM own WINDOW w AS (PARTITION BY node_id)),
rest AS (SELECT s.*, ln(f.shape) AS a, ln(f.scale) AS b, {", ".join(f"{n} - own_{n} AS r_{n}" for n in _SUMMED[:5])} FROM summed s JOIN fitted f USING (node_id)),
gone AS (SELECT node_id, 0.5*1.225*(exp(without) - exp(every)) AS d FROM (SELECT *, {_deleted_sql("r_", "without")}, {_deleted_sql("", "every")} FROM rest))"""


@query("jackknife_weibull", f"""WITH RECURSIVE {OBS}, {_RECORDS}, {_BASE.split("weighted AS")[0].rstrip().rstrip(",")}, {_LEFT_OUT},
  m AS (SELECT *, count(*) OVER p AS n, avg(d) OVER p AS mean FROM gone WINDOW p AS (PARTITION BY node_id)),
  s AS (SELECT node_id, n, sum((d - mean)**2) AS m2, sum((d - mean)**3) AS m3 FROM m GROUP BY 1, 2)
  SELECT node_id, n, sqrt((n - 1) / n * m2) AS standard_error, -m3 / (6 * m2 ** 1.5) AS acceleration FROM s""", "standard_error acceleration", digits=4)
def jackknife_weibull(spark, sf_dir):
    """Standard error and BCa acceleration of every node's fitted power density, from the fits without each record."""
    config = BootstrapConfig(replicas=0, min_in_range_weight=1.0, criteria=_ADMIT)
    found = bootstrap.weibull_jackknife(obs(spark, sf_dir), config, tie="event_id", reliable=False)
    n, mean = F.col("n"), F.col("d1") / F.col("n")
    m2, m3 = F.col("d2") - n * mean * mean, F.col("d3") - 3 * mean * F.col("d2") + 2 * n * mean * mean * mean
    return found.select("node_id", "n", F.sqrt((n - 1) / n * m2).alias("standard_error"), (-m3 / (6 * F.pow(m2, F.lit(1.5)))).alias("acceleration"))


@query("bootstrap_ci")
def bootstrap_ci(spark, sf_dir):
    return bootstrap.bootstrap_intervals(obs(spark, sf_dir), BootstrapConfig(replicas=200, seed=7), tie="event_id")


@query("bootstrap_block")
def bootstrap_block(spark, sf_dir):
    config = BootstrapConfig(replicas=100, seed=7, resampling="moving_block", block_length=6, label_strategy="label_resample",
                             apply_rmse_noise=False, rmse_mode="none")
    return bootstrap.bootstrap_intervals(obs(spark, sf_dir), config, tie="event_id")


@query("bootstrap_stationary")
def bootstrap_stationary(spark, sf_dir):
    config = BootstrapConfig(replicas=100, seed=7, resampling="stationary", block_length=6, rmse_mode="power")
    return bootstrap.bootstrap_intervals(obs(spark, sf_dir), config, tie="event_id")


@query("bootstrap_summary")
def bootstrap_summary(spark, sf_dir):
    return bootstrap.bootstrap_summary(obs(spark, sf_dir), BootstrapConfig(replicas=50, seed=7), tie="event_id")
