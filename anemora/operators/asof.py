"""Time alignment of two series: exact, backward and nearest within a tolerance.

Both sides are stacked on one time axis and each left row takes the last (or next) right
row it sees.  The work is linear in the rows; no pairs are formed, and a series without
a key is cut into time ranges like any hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.functions.scalars import micros, ratio
from anemora.operators.ordered import order_rows

#: Rows of a time range; a stacked row holds both sides and both matches, 150 to 250 bytes of a task's memory.
MAX_ROWS_PER_RANGE = 1_000_000


def asof_join(left: DataFrame, right: DataFrame, *, ts: str = "timestamp", by: Sequence[str] = (),
              direction: str = "nearest", tolerance_seconds: float = 1800, right_sequence: str | None = None,
              suffix: str = "_ref", max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Left rows with the matching right row's columns (``suffix`` appended), nulls outside the tolerance.

    Equal times match; of right rows sharing a time the last by ``right_sequence`` counts
    looking back and the first looking ahead; equal distances favour the earlier row.
    """
    if direction not in {"exact", "backward", "nearest"}:
        raise ValueError(f"unknown direction {direction!r}")
    if right_sequence is not None and right_sequence not in right.columns:
        raise KeyError(right_sequence)
    by = list(by)
    carried = [c for c in right.columns if c not in by]
    sequence = F.col(right_sequence).cast("bigint") if right_sequence else F.lit(0).cast("bigint")
    clock = micros(F.col(ts))
    record = F.struct(clock.alias("us"), F.struct(*carried).alias("row"))
    lefts = left.where(F.col(ts).isNotNull()).withColumn("__us", clock)
    rights = right.where(F.col(ts).isNotNull()).withColumn("__us", clock)

    if direction == "exact":
        last = rights.groupBy(*by, "__us").agg(F.max_by(record, sequence).alias("__match"))
        out = lefts.join(last, [*by, "__us"], "left")
    else:
        stacked_right = rights.select(*by, "__us", F.lit(0).alias("__side"), sequence.alias("__sequence"),
                                      record.alias("__record"))
        stacked_left = lefts.select(*by, "__us", F.lit(1).alias("__side"), F.lit(0).cast("bigint").alias("__sequence"),
                                    F.struct(*left.columns).alias("__left"))
        both = stacked_right.unionByName(stacked_left, allowMissingColumns=True)
        ordered = order_rows(both, by, ["__us", "__side", "__sequence"], max_rows=max_rows)
        ordered = ordered.last_known(__back=F.col("__record"))
        if direction == "nearest":
            ordered = ordered.next_known(__ahead=F.col("__record"))
        out = ordered.dataframe().where("__side = 1")
        limit = F.lit(int(round(tolerance_seconds * 1_000_000)))
        past = F.when(F.col("__us") - F.col("__back.us") <= limit, F.col("__back"))
        match = past
        if direction == "nearest":
            future = F.when(F.col("__ahead.us") - F.col("__us") <= limit, F.col("__ahead"))
            to_past, to_future = F.col("__us") - past["us"], future["us"] - F.col("__us")
            match = F.when(past.isNull(), future).when(future.isNull(), past).when(
                to_past <= to_future, past).otherwise(future)
        out = out.withColumn("__match", match).select("__us", "__match", "__left.*")
    offset = (F.col("__us") - F.col("__match.us")) / F.lit(1e6)
    return out.select(
        *left.columns,
        *[F.col(f"__match.row.{c}").alias(f"{c}{suffix}") for c in carried],
        offset.alias("time_offset_seconds"), (offset == 0).alias("is_exact_match"),
    )


def synchronise(left: DataFrame, right: DataFrame, *, prefer_nearest: bool = True, tolerance_seconds: float = 1800,
                value: str = "wind_speed", suffix: str = "_ref", **options) -> DataFrame:
    """Matched rows only: the reference value is present; exact matches only unless nearest is preferred."""
    direction = "nearest" if prefer_nearest else "exact"
    joined = asof_join(left, right, direction=direction, tolerance_seconds=tolerance_seconds, suffix=suffix, **options)
    return joined.where(F.col(f"{value}{suffix}").isNotNull())


def synchronisation_summary(matched: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts and ratios of a synchronisation, one row."""
    sides = matched.select(F.lit("m").alias("side"), F.col("is_exact_match").alias("exact")).unionByName(
        left.select(F.lit("l").alias("side"), F.lit(False).alias("exact"))
    ).unionByName(right.select(F.lit("r").alias("side"), F.lit(False).alias("exact")))
    counts = sides.agg(
        F.count_if(F.col("side") == "m").alias("matched_rows"),
        F.count_if((F.col("side") == "m") & F.col("exact")).alias("exact_matches"),
        F.count_if(F.col("side") == "l").alias("__left"), F.count_if(F.col("side") == "r").alias("__right"),
    )
    matched_rows = F.col("matched_rows")
    return counts.select(
        "matched_rows",
        (F.col("__left") - matched_rows).alias("unmatched_rows"),
        F.greatest(F.col("__right") - matched_rows, F.lit(0)).alias("unmatched_reference_rows"),
        "exact_matches", (matched_rows - F.col("exact_matches")).alias("nearest_matches"),
        ratio(matched_rows, F.col("__left")).alias("match_ratio"),
        ratio(matched_rows, F.col("__right")).alias("match_ratio_reference"),
    )
