"""Time grids: gaps, duplicates, coverage, cadence, node taxonomy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.config import CadenceConfig, TaxonomyBands
from anemora.functions.scalars import continuity_band, coverage_band, fixed, floor_div, from_micros, micros, round_micros
from anemora.operators.empirical import require_columns
from anemora.operators.ordered import MAX_ROWS_PER_RANGE, order_rows
from anemora.operators.quantiles import linear_quantiles_of_counts


def with_gaps(df: DataFrame, keys: Sequence[str] = ("node_id",), ts: str = "timestamp",
              tie: Sequence[str] = (), max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Add ``us`` (epoch micros) and ``gap_us`` (micros since the previous row of the key)."""
    require_columns(df, [*keys, ts])
    stamped = df.where(F.col(ts).isNotNull()).withColumn("us", micros(F.col(ts)))
    ordered = order_rows(stamped, keys, ["us", *tie], max_rows=max_rows).lag(__previous=(F.col("us"), 1))
    return ordered.dataframe().withColumn("gap_us", F.col("us") - F.col("__previous")).drop("__previous")


def taxonomy(obs: DataFrame, ts: str = "timestamp", bands: TaxonomyBands = TaxonomyBands(),
             max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Per-node counts, gap classes and bands.

    The first row of a node counts as on cadence; gaps shorter than the cadence fall in no
    class; ``total_intervals`` equals the number of rows.
    """
    gaps = with_gaps(obs.select("node_id", ts), ["node_id"], ts, max_rows=max_rows)
    seconds = F.bround(F.col("gap_us") / F.lit(1e6)).cast("bigint")
    per_node = gaps.withColumn("dt", seconds).groupBy("node_id").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_if(F.col("dt").isNull() | (F.col("dt") == 1800)).alias("on_cadence_transitions"),
        F.count_if((F.col("dt") > 1800) & (F.col("dt") <= 7200)).alias("short_gaps"),
        F.count_if(F.col("dt") > 7200).alias("long_gaps"),
        F.count(F.lit(1)).alias("total_intervals"),
        (F.max(F.coalesce("dt", F.lit(0))) / F.lit(86400.0)).alias("max_gap_days"),
    )
    low = (F.col("total_observations") < bands.low_coverage_observations) & (
        F.col("max_gap_days") > bands.low_coverage_gap_days)
    return per_node.withColumns({
        "low_coverage": low,
        "coverage_band": coverage_band(F.col("total_observations"), bands),
        "continuity_band": continuity_band(F.col("max_gap_days"), bands),
    })


def temporal_metrics(obs: DataFrame, ts: str = "timestamp", cadence_seconds: int = 1800,
                     max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Distinct and duplicate timestamps, expected count, coverage, longest missing stretch; one pass."""
    gaps = with_gaps(obs.select("node_id", ts), ["node_id"], ts, max_rows=max_rows)
    step = cadence_seconds * 1_000_000
    base = gaps.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_if(F.col("gap_us").isNull() | (F.col("gap_us") > 0)).alias("distinct_observations"),
        F.min("us").alias("__first"), F.max("us").alias("__last"),
        F.max(F.greatest((F.col("gap_us") - step) / F.lit(1e6), F.lit(0.0))).alias("__missing"),
    )
    expected = floor_div(F.col("__last") - F.col("__first"), step) + 1
    return base.select(
        "node_id", "total_observations", "distinct_observations",
        (F.col("total_observations") - F.col("distinct_observations")).alias("duplicate_records"),
        expected.alias("expected_observations"),
        (F.col("distinct_observations") / expected).alias("coverage_ratio"),
        F.coalesce("__missing", F.lit(0.0)).alias("max_missing_seconds"),
    )


def normalise(df: DataFrame, config: CadenceConfig = CadenceConfig(), *, node: str = "node_id",
              ts: str = "timestamp", sequence: str) -> DataFrame:
    """Snap timestamps to the grid and keep the first record of each (node, slot).

    ``sequence`` orders records by arrival.  The pick is an aggregate with a partial step,
    so copies of one slot are reduced before the shuffle.  ``copies`` counts them.
    """
    require_columns(df, [node, ts, sequence])
    slot = round_micros(micros(F.col(ts)), config.expected_seconds * 1_000_000, config.rounding)
    others = [c for c in df.columns if c not in (node, ts)]
    picked = df.withColumn("us", slot).groupBy(node, "us").agg(
        F.count(F.lit(1)).alias("copies"), F.min_by(F.struct(*others), F.col(sequence)).alias("__kept"))
    return picked.select(node, from_micros(F.col("us")).alias(ts), "us", "copies", "__kept.*")


def gap_windows(slots: DataFrame, config: CadenceConfig = CadenceConfig(), *, node: str = "node_id",
                max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Missing stretches longer than cadence plus tolerance, with first and last missing slot."""
    step, slack = config.expected_seconds * 1_000_000, config.tolerance_seconds * 1_000_000
    gaps = order_rows(slots.select(node, "us"), [node], ["us"], max_rows=max_rows).lag(__previous=(F.col("us"), 1))
    delta = F.col("us") - F.col("__previous")
    missing = (F.ceil(delta / F.lit(step)) - 1).cast("bigint")
    return (
        gaps.dataframe().where(delta > step + slack).withColumn("missing_steps", missing).where("missing_steps > 0")
        .select(node, from_micros(F.col("__previous") + step).alias("gap_start"),
                from_micros(F.col("__previous") + F.lit(step) * F.col("missing_steps")).alias("gap_end"),
                "missing_steps")
    )


def gap_histogram(slots: DataFrame, keys: Sequence[str], max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """``(keys, gap_us, count)``.

    Distinct gaps of a key add up to at most its time span, so a span of n grid steps has at
    most sqrt(2n) of them: the histogram of a key is small however many rows it has.
    """
    gaps = order_rows(slots.select(*keys, "us"), keys, ["us"], max_rows=max_rows).lag(__previous=(F.col("us"), 1))
    delta = F.col("us") - F.col("__previous")
    return (
        gaps.dataframe().select(*keys, delta.alias("gap_us")).where(F.col("gap_us").isNotNull())
        .groupBy(*keys, "gap_us").agg(F.count(F.lit(1)).alias("gap_count"))
    )


def temporal_summary(slots: DataFrame, config: CadenceConfig = CadenceConfig(), *, node: str = "node_id",
                     max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Per-node coverage, cadence statistics, quality flags and notes of normalised records."""
    step, slack = config.expected_seconds * 1_000_000, config.tolerance_seconds * 1_000_000
    histogram = gap_histogram(slots, [node], max_rows)
    seconds, n = F.col("gap_us") / F.lit(1e6), F.col("gap_count")
    is_gap = (F.col("gap_us") > step + slack) & (F.ceil(F.col("gap_us") / F.lit(step)) > 1)
    steps = (F.ceil(F.col("gap_us") / F.lit(step)) - 1).cast("bigint")
    cadence = histogram.groupBy(node).agg(
        F.sum(n).alias("sample_count"),
        F.min(seconds).alias("min_gap_seconds"), F.max(seconds).alias("max_gap_seconds"),
        (F.sum(seconds * n) / F.sum(n)).alias("mean_gap_seconds"),
        (F.sum(seconds * seconds * n) / F.sum(n)).alias("__square"),
        F.sum(F.when(is_gap, steps * n).otherwise(0)).alias("__gap_missing"),
        F.sum(F.when(is_gap, n).otherwise(0)).alias("gap_window_count"),
        F.max(F.abs(F.col("gap_us") - step) > slack).alias("__irregular"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(seconds.cast("bigint").alias("k"), n.alias("v"))))
                           ).alias("gap_distribution"),
    )
    medians = linear_quantiles_of_counts(
        histogram.select(node, seconds.alias("__value"), n.alias("__weight")), [node],
        {"median_gap_seconds": 0.5}, max_rows=None)
    base = slots.groupBy(node).agg(
        F.count(F.lit(1)).alias("total_observations"), F.sum(F.col("copies") - 1).alias("duplicate_records"),
        F.min("us").alias("__first"), F.max("us").alias("__last"))
    out = base.join(cadence, node, "left").join(medians, node, "left")
    expected = F.greatest(floor_div(F.col("__last") - F.col("__first"), step) + 1, F.lit(1))
    out = out.withColumn("expected_observations", expected)
    missing = F.greatest(F.coalesce("__gap_missing", F.lit(0)),
                         F.greatest(F.col("expected_observations") - F.col("total_observations"), F.lit(0)))
    out = out.withColumn("missing_observations", missing)
    out = out.withColumn("coverage_ratio", F.col("total_observations")
                         / (F.col("total_observations") + F.col("missing_observations")))
    irregular = F.coalesce("__irregular", F.lit(False))
    short = F.col("coverage_ratio") < config.coverage_threshold
    out = out.withColumns({
        "sampling_start": from_micros(F.col("__first")), "sampling_end": from_micros(F.col("__last")),
        "std_gap_seconds": F.sqrt(F.greatest(F.col("__square") - F.pow("mean_gap_seconds", F.lit(2)), F.lit(0.0))),
        "sample_count": F.coalesce("sample_count", F.lit(0)),
        "has_duplicates": F.col("duplicate_records") > 0,
        "has_gaps": F.coalesce(F.col("gap_window_count") > 0, F.lit(False)),
        "irregular_cadence": irregular,
        "insufficient_coverage": short,
        "notes": F.array_compact(F.array(
            F.when(F.col("duplicate_records") > 0, F.format_string(
                "Removed %d duplicate records after temporal normalisation", "duplicate_records")),
            F.when(F.col("missing_observations") > 0, F.format_string(
                "Identified %d missing observations", "missing_observations")),
            F.when(irregular, "Observed cadence deviates from expected interval beyond configured tolerance"),
            F.when(short, F.concat(F.lit("Coverage ratio "), fixed(F.col("coverage_ratio"), 3),
                                   F.lit(f" below threshold {config.coverage_threshold:.3f}"))),
        )),
    })
    return out.drop("__first", "__last", "__square", "__gap_missing", "__irregular")


def cadence_mode(df: DataFrame, keys: Sequence[str] = (), ts: str = "timestamp",
                 max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Most frequent gap in whole seconds (smallest on ties), all distinct gaps, sample count.

    Distinct whole-second gaps are bounded by the square root of twice the span in seconds.
    """
    stamped = df.where(F.col(ts).isNotNull()).select(*keys, micros(F.col(ts)).alias("us"))
    histogram = (
        gap_histogram(stamped, list(keys), max_rows)
        .groupBy(*keys, floor_div(F.col("gap_us"), 1_000_000).alias("gap_seconds"))
        .agg(F.sum("gap_count").alias("gap_count"))
    )
    return histogram.groupBy(*keys).agg(
        F.min(F.struct((-F.col("gap_count")).alias("n"), F.col("gap_seconds").alias("s")))["s"].alias("nominal_seconds"),
        F.sort_array(F.collect_list("gap_seconds")).alias("unique_intervals"),
        F.sum("gap_count").alias("sample_count"),
    )
