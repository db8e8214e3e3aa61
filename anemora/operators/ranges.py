"""Range partitioning, label discrepancies, range quality rules, anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.config import RangeQaThresholds, RangeThresholds
from anemora.functions.labels import LABELS, expected_label, is_unrecognised, label, label_untrimmed
from anemora.functions.scalars import fixed, numeric, ratio
from anemora.operators.empirical import require_columns


def labelled(obs: DataFrame, bounds: RangeThresholds = RangeThresholds(), *, label_column: str = "pred_range_label",
             speed: str = "pred_wind_speed", deterministic: str | None = None) -> DataFrame:
    """Add canonical, expected and (if given) deterministic labels."""
    require_columns(obs, [label_column, speed])
    value = numeric(obs, speed)
    out = obs.withColumns({
        "range_label": label(F.col(label_column)), "expected_label": expected_label(value, bounds), "speed_value": value})
    other = label(F.col(deterministic)) if deterministic else F.lit(None).cast("string")
    return out.withColumn("deterministic_label", other)


def partition(obs: DataFrame, **options) -> dict[str, DataFrame]:
    """One DataFrame per label; each is a filter on the same plan."""
    rows = labelled(obs, **options)
    return {name: rows.where(F.col("range_label") == name) for name in LABELS}


def discrepancies(rows: DataFrame, keep: tuple[str, ...] = ("node_id", "timestamp")) -> DataFrame:
    """Every rule a labelled row breaks, one output row each."""
    informative = F.col("range_label").isin("below", "in", "above")
    missing = F.col("speed_value").isNull() | F.isnan("speed_value")
    nothing = F.lit(None).cast("string")

    def issue(broken, name, expected):
        return F.when(broken, F.struct(F.lit(name).alias("issue"), expected.alias("expected_label")))

    expected = F.col("expected_label")
    found = F.array_compact(F.array(
        issue(missing & informative, "missing_speed_value", nothing),
        issue(informative & (F.col("range_label") != expected), "classifier_vs_threshold", expected),
        issue((F.col("range_label") == "uncertain") & expected.isin("below", "above"), "uncertain_vs_threshold", expected),
        issue(F.col("deterministic_label").isin("below", "in", "above") & (F.col("deterministic_label") != expected),
              "deterministic_vs_threshold", expected),
    ))
    return rows.select(
        *keep, F.explode(found).alias("__found"), F.col("range_label").alias("reported_label"),
        "deterministic_label", F.col("speed_value").alias("wind_speed"),
    ).select(*keep, "__found.issue", "reported_label", "__found.expected_label", "deterministic_label", "wind_speed")


def range_summary(rows: DataFrame, *, label_column: str = "pred_range_label") -> DataFrame:
    """Per-node label counts and ratios, discrepancy count and notes."""
    text = F.lower(F.trim(label_column))
    missing = F.col("speed_value").isNull() | F.isnan("speed_value")
    informative = F.col("range_label").isin("below", "in", "above")
    expected = F.col("expected_label")
    broken = (
        (missing & informative).cast("int")
        + (informative & (F.col("range_label") != expected)).cast("int")
        + ((F.col("range_label") == "uncertain") & expected.isin("below", "above")).cast("int")
        + F.coalesce((F.col("deterministic_label").isin("below", "in", "above")
                      & (F.col("deterministic_label") != expected)).cast("int"), F.lit(0))
    )
    out = rows.groupBy(F.coalesce("node_id", F.lit("")).alias("node_id")).agg(
        F.count(F.lit(1)).alias("total_observations"),
        *[F.count_if(F.col("range_label") == name).alias(f"{name}_count") for name in LABELS],
        F.sum(broken.cast("bigint")).alias("discrepancy_count"),
        F.count_if((F.col("range_label") == "uncertain") & (text != "uncertain")).alias("__vague"),
        F.count_if(missing).alias("__speedless"),
    )
    for name in LABELS:
        out = out.withColumn(f"{name}_ratio", ratio(F.col(f"{name}_count"), F.col("total_observations")))
    remarks = F.array_compact(F.array(
        F.when(F.col("__vague") > 0, F.format_string("%d samples lack a definitive range label.", "__vague")),
        F.when(F.col("__speedless") > 0, F.format_string("%d samples have missing wind_speed values.", "__speedless")),
        F.when(F.col("uncertain_count") > 0, F.format_string("%d samples marked as uncertain.", "uncertain_count")),
        F.when(F.col("discrepancy_count") > 0,
               F.format_string("%d threshold discrepancies detected.", "discrepancy_count")),
    ))
    return out.withColumn("notes", F.array_sort(F.array_distinct(remarks))).drop("__vague", "__speedless")


def relational_range_counts(obs: DataFrame, label_column: str = "pred_range_label") -> DataFrame:
    """Label counts plus how many uncertain ones come from unrecognised text."""
    canonical = label_untrimmed(F.col(label_column))
    return obs.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("total_observations"),
        *[F.count_if(canonical == name).alias(f"{name}_count") for name in LABELS],
        F.count_if((canonical == "uncertain") & is_unrecognised(F.col(label_column))).alias("unrecognised_count"),
    )


def range_quality(summary: DataFrame, temporal: DataFrame | None = None,
                  limits: RangeQaThresholds = RangeQaThresholds()) -> DataFrame:
    """Flags, reliability with reasons, notes.  Both inputs hold one row per node."""
    out = summary
    if temporal is not None:
        out = out.join(temporal.select("node_id", "coverage_ratio", "expected_observations", "distinct_observations",
                                       "duplicate_records", "max_gap_hours"), "node_id", "left")
    else:
        out = out.withColumns({
            "coverage_ratio": F.lit(None).cast("double"), "expected_observations": F.lit(None).cast("bigint"),
            "distinct_observations": F.lit(None).cast("bigint"), "duplicate_records": F.lit(0).cast("bigint"),
            "max_gap_hours": F.lit(None).cast("double")})
    out = out.withColumn("duplicate_records", F.coalesce("duplicate_records", F.lit(0).cast("bigint")))
    if "notes" not in out.columns:
        out = out.withColumn("notes", F.array().cast("array<string>"))
    out = out.withColumn("total_censored_ratio",
                         ratio(F.col("below_count") + F.col("above_count"), F.col("total_observations")))
    inside = F.col("in_ratio")
    few_inside = inside.isNull() | (inside < limits.min_in_range_ratio)
    thin = F.col("coverage_ratio") < limits.min_temporal_coverage
    small = F.col("in_count") < limits.min_in_range_count
    absent = F.col("expected_observations") - F.col("distinct_observations")
    flags = F.array_compact(F.array(
        F.when(F.col("total_censored_ratio") > limits.max_total_censored_ratio, "excessive_total_censoring"),
        F.when(F.col("below_ratio") > limits.max_left_censored_ratio, "excessive_left_censoring"),
        F.when(F.col("above_ratio") > limits.max_right_censored_ratio, "excessive_right_censoring"),
        F.when(few_inside, "low_in_range_share"),
        F.when(F.col("uncertain_ratio") > limits.max_uncertain_ratio, "excessive_uncertain_share"),
        F.when(thin, "insufficient_temporal_coverage"),
        F.when(F.col("max_gap_hours") > limits.max_gap_hours, "temporal_gap_exceeds_threshold"),
        F.when(F.col("duplicate_records") > 0, "duplicate_timestamps_detected"),
    ))
    reasons = F.array_compact(F.array(
        F.when(small, F.concat(F.lit("in-range sample count "), F.col("in_count").cast("string"),
                               F.lit(f" below minimum {limits.min_in_range_count}"))),
        F.when(few_inside, F.concat(F.lit("in-range ratio "), F.coalesce(fixed(inside, 3), F.lit("undefined")),
                                    F.lit(f" below minimum {limits.min_in_range_ratio}"))),
        F.when(thin, F.concat(F.lit("temporal coverage "), fixed(F.col("coverage_ratio"), 3),
                              F.lit(f" below minimum {limits.min_temporal_coverage}"))),
    ))
    more = F.array_compact(F.array(
        F.when(F.col("duplicate_records") > 0,
               F.format_string("%d duplicate timestamps detected.", "duplicate_records")),
        F.when(absent > 0, F.format_string("%d expected timestamps missing from the nominal cadence.", absent)),
    ))
    return out.withColumns({
        "flags": flags,
        "parametric_reliable": ~(small | few_inside | F.coalesce(thin, F.lit(False))),
        "reliability_reasons": reasons,
        "notes": F.array_distinct(F.concat("notes", more)),
    })


def quality_records(quality: DataFrame) -> DataFrame:
    """Flat text form of the list columns, for tables and CSV."""
    return quality.withColumns({
        "flags": F.concat_ws(";", "flags"), "reliability_reasons": F.concat_ws(";", "reliability_reasons"),
        "notes": F.concat_ws(" | ", "notes")})


def broken_simplex(obs: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Rows whose three posteriors do not add up to one."""
    total = F.col("prob_range_below") + F.col("prob_range_in") + F.col("prob_range_above")
    return obs.where(F.abs(total - 1.0) > tolerance)


def anomalies(gapped: DataFrame, max_gap_seconds: int = 5400, tolerance: float = 1e-6) -> DataFrame:
    """Rows after a long gap or with posteriors off the simplex; ``gapped`` carries ``gap_us``."""
    total = F.col("prob_range_below") + F.col("prob_range_in") + F.col("prob_range_above")
    late = F.col("gap_us") > max_gap_seconds * 1_000_000
    off = F.abs(total - 1.0) > tolerance
    return (
        gapped.withColumn("anomaly", F.concat_ws(";", F.when(late, "gap"), F.when(off, "posterior")))
        .where(F.col("anomaly") != "")
    )
