"""Exact quantiles per key by counting, never by gathering a group's values.

Values are first reduced to ``(key, value, weight)``.  A cumulative weight over that
table (range-cut for hot keys) then decides which value answers which quantile.  The
toolkit uses several quantile definitions side by side; each has its own function.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.operators.ordered import MAX_ROWS_PER_RANGE, order_rows


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: Column | None = None) -> DataFrame:
    """One row per distinct non-null value, with its count or summed weight."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("__value"))
        .agg(amount.alias("__weight"))
    )


def cumulative(counts: DataFrame, keys: Sequence[str], max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Add ``__upto`` (cumulative weight with the row) and ``__total`` (weight of the key)."""
    ordered = order_rows(counts, list(keys), ["__value"], max_rows=max_rows, hold=True)
    return ordered.running_sum(__upto=F.col("__weight")).totals(__total=F.sum("__weight")).dataframe()


def _fraction(p: float) -> tuple[int, int]:
    exact = Fraction(str(p))
    return exact.numerator, exact.denominator


def discrete_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], *,
                       max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Smallest value whose count share reaches ``p`` (an observed value, no interpolation)."""
    table = cumulative(value_counts(df, keys, value), keys, max_rows)
    picks = []
    for name, p in probabilities.items():
        num, den = _fraction(p)
        picks.append(F.min(F.when(F.col("__upto") * den >= F.col("__total") * num, F.col("__value"))).alias(name))
    return table.groupBy(*keys).agg(*picks)


def discrete_quantile_grid(df: DataFrame, keys: Sequence[str], value: str, steps: int = 100, *,
                           max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """The discrete quantile at every ``i / steps``: rows ``(keys, step, value)``.

    A value answers all steps in ``(share before, share with]``; the first also answers 0.
    """
    table = cumulative(value_counts(df, keys, value), keys, max_rows)
    before = F.expr(f"(__upto - __weight) * {steps} div __total")
    first = F.when(F.col("__upto") == F.col("__weight"), F.lit(0)).otherwise(before + 1)
    last = F.expr(f"__upto * {steps} div __total")
    return (
        table.withColumn("__first", first.cast("int")).withColumn("__last", last.cast("int"))
        .where(F.col("__last") >= F.col("__first"))
        .select(*keys, F.explode(F.sequence("__first", "__last")).alias("step"), F.col("__value").alias(value))
    )


def linear_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], *,
                     max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Linear interpolation between the two order statistics around ``p * (n - 1)``."""
    return linear_quantiles_of_counts(value_counts(df, keys, value), keys, probabilities, max_rows=max_rows)


def linear_quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probabilities: dict[str, float], *,
                               max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    table = cumulative(counts, keys, max_rows)
    picks, results = [], []
    for i, (name, p) in enumerate(probabilities.items()):
        rank = F.lit(float(p)) * (F.col("__total") - 1)
        picks += [
            F.min(F.when(F.col("__upto") > F.floor(rank), F.col("__value"))).alias(f"__low{i}"),
            F.min(F.when(F.col("__upto") > F.ceil(rank), F.col("__value"))).alias(f"__high{i}"),
        ]
        place = F.lit(float(p)) * (F.col("__n") - 1)
        low, high = F.col(f"__low{i}"), F.col(f"__high{i}")
        results.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return table.groupBy(*keys).agg(F.max("__total").alias("__n"), *picks).select(*keys, *results)


def weighted_quantiles(weights: DataFrame, keys: Sequence[str], probabilities: dict[str, float], *,
                       tie_order: Sequence[str] = (), max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Interpolate on the normalised cumulative weight.

    ``weights`` holds ``__value`` and ``__weight``, one row per sample.  Between two
    neighbouring samples the quantile moves linearly with the cumulative share; below the
    first share it is the first value, above the last the last one.  Equal values are not
    merged, since that would stretch the step that leads up to them; ``tie_order`` names
    the columns that order them.
    """
    keys = list(keys)
    positive = weights.where(F.col("__weight") > 0)
    table = (
        order_rows(positive, keys, ["__value", *tie_order], max_rows=max_rows, hold=True)
        .running_sum(__upto=F.col("__weight"))
        .lag(__before_value=(F.col("__value"), 1))
        .totals(__total=F.sum("__weight"), __top=F.max("__value"))
        .dataframe()
    )
    share = F.col("__upto") / F.col("__total")
    share_before = (F.col("__upto") - F.col("__weight")) / F.col("__total")
    picks = []
    for name, p in probabilities.items():
        moved = F.col("__before_value") + (F.lit(p) - share_before) / (share - share_before) * (
            F.col("__value") - F.col("__before_value"))
        answer = F.when(F.col("__before_value").isNull(), F.col("__value")).otherwise(moved)
        reached = (share >= p) & ((share_before < p) | F.col("__before_value").isNull())
        picks.append(F.coalesce(F.min(F.when(reached, answer)), F.max("__top")).alias(name))
    return table.groupBy(*keys).agg(*picks)


def weighted_step_quantiles(weights: DataFrame, keys: Sequence[str], probabilities: dict[str, float], *,
                            max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """First value whose cumulative weight exceeds ``p`` of the total (the last value at p = 1)."""
    positive = weights.where(F.col("__weight") > 0)
    table = cumulative(positive, keys, max_rows)
    picks = [
        F.coalesce(F.min(F.when(F.col("__upto") > F.col("__total") * p, F.col("__value"))),
                   F.max("__value")).alias(name)
        for name, p in probabilities.items()
    ]
    return table.groupBy(*keys).agg(*picks)


def overall_medians(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Median of several columns over all rows, one row, by counting like every other quantile."""
    one = df.withColumn("__one", F.lit(0))
    out = df.sparkSession.createDataFrame([(0,)], "__one int")
    for name, column in columns.items():
        out = out.join(linear_quantiles(one, ["__one"], column, {name: 0.5}), "__one", "left")
    return out
