"""Ordered computations per key that survive hot keys.

A plain ``Window.partitionBy(node)`` puts every row of a node into one task.  That is the
cheapest plan (one shuffle, which a following aggregate by node reuses) as long as no key
holds more than ``max_rows`` rows, so the size is checked first.  A key beyond the limit
is cut into contiguous ranges of its order columns.  Windows then run inside a range; what
a range needs from others (a running total, the last known value, the last few rows) is
computed from one small row per range and joined back.

At most ``rows / max_rows`` keys are hot, and all their cuts together number at most as many again.  The cuts
are broadcast: joined by a shuffle of the keys, the rows of a hot key would meet in one task, and the windows over its
ranges would keep that partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from anemora.operators.grouped import hot_keys
from anemora.session import checkpoint_ready

MAX_ROWS_PER_RANGE = 4_000_000
_SAMPLES_PER_RANGE = 32
_BLOCK = 32

_RANGE = "__range"
_ALL = "__all"


@dataclass(frozen=True)
class OrderedRows:
    """Rows ready for ordered work; ``hot`` is None, or the rows of hot keys once more."""

    rows: DataFrame
    hot: DataFrame | None
    keys: tuple[str, ...]
    order: tuple[str, ...]

    # -- plumbing ---------------------------------------------------------------
    @property
    def _group(self) -> list[str]:
        return [*self.keys] if self.hot is None else [*self.keys, _RANGE]

    def _window(self, descending: bool = False) -> WindowSpec:
        order = [F.col(c).desc() if descending else F.col(c) for c in self.order]
        return Window.partitionBy(*self._group).orderBy(*order)

    def transform(self, change: Callable[[DataFrame], DataFrame]) -> "OrderedRows":
        """Apply a row-wise change that keeps keys and order columns."""
        return replace(self, rows=change(self.rows), hot=None if self.hot is None else change(self.hot))

    def with_column(self, name: str, value: Column) -> "OrderedRows":
        return self.transform(lambda df: df.withColumn(name, value))

    def dataframe(self) -> DataFrame:
        return self.rows.drop(_RANGE, _ALL)

    def _combine(self, inner: dict[str, Column], carry: Callable[[DataFrame], DataFrame],
                 merge: Callable[[Column, Column], Column]) -> "OrderedRows":
        """Window columns inside a range, merged with what the other ranges contribute."""
        if self.hot is None:
            return self.transform(lambda df: df.withColumns(inner))
        carried = carry(self.hot)

        def apply(df: DataFrame) -> DataFrame:
            out = df.withColumns(inner).join(carried, self._group, "left")
            out = out.withColumns({n: merge(F.col(n), F.col(f"__carry_{n}")) for n in inner})
            return out.drop(*[f"__carry_{n}" for n in inner])

        return self.transform(apply)

    def _other_ranges(self, hot: DataFrame, per_range: dict[str, Column], across: Callable[[Column], Column],
                      after: bool = False) -> DataFrame:
        """One row per range, then a window over the ranges of a key that lie before (or after)."""
        edge = hot.groupBy(*self._group).agg(*[c.alias(n) for n, c in per_range.items()])
        ranges = Window.partitionBy(*self.keys).orderBy(F.col(_RANGE).desc() if after else F.col(_RANGE))
        frame = ranges.rowsBetween(Window.unboundedPreceding, -1)
        return edge.select(*self._group, *[across(F.col(n)).over(frame).alias(f"__carry_{n}") for n in per_range])

    # -- operators --------------------------------------------------------------
    def running_sum(self, **columns: Column) -> "OrderedRows":
        """Cumulative sums along the order, current row included."""
        frame = self._window().rowsBetween(Window.unboundedPreceding, 0)
        return self._combine(
            {n: F.sum(c).over(frame) for n, c in columns.items()},
            lambda hot: self._other_ranges(hot, {n: F.sum(c) for n, c in columns.items()}, F.sum),
            lambda own, carry: own + F.coalesce(carry, F.lit(0)))

    def last_known(self, **columns: Column) -> "OrderedRows":
        """Latest non-null value at or before the row."""
        return self._known(columns, ahead=False)

    def next_known(self, **columns: Column) -> "OrderedRows":
        """Earliest non-null value at or after the row.

        Runs as "last known" over the reversed order: a frame up to UNBOUNDED FOLLOWING
        would be evaluated anew for every row.
        """
        return self._known(columns, ahead=True)

    def _known(self, columns: dict[str, Column], ahead: bool) -> "OrderedRows":
        frame = self._window(descending=ahead).rowsBetween(Window.unboundedPreceding, 0)
        position, pick = F.struct(*self.order), F.min_by if ahead else F.max_by
        return self._combine(
            {n: F.last(c, ignorenulls=True).over(frame) for n, c in columns.items()},
            lambda hot: self._other_ranges(
                hot, {n: pick(c, F.when(c.isNotNull(), position)) for n, c in columns.items()},
                lambda c: F.last(c, ignorenulls=True), after=ahead),
            F.coalesce)

    def lag(self, **columns: tuple[Column, int]) -> "OrderedRows":
        """Value ``k`` rows earlier; ``columns`` maps a name to ``(column, k)``."""
        shifted = {n: F.lag(c, k).over(self._window()) for n, (c, k) in columns.items()}
        if self.hot is None:
            return self.transform(lambda df: df.withColumns(shifted))
        # The last rows of a range also take part, unseen, in the next range.
        depth = max(k for _, k in columns.values())
        tails = (
            self.hot.withColumn("__back", F.row_number().over(self._window(descending=True)))
            .where(F.col("__back") <= depth).drop("__back")
            .withColumn(_RANGE, F.col(_RANGE) + 1).withColumn("__guest", F.lit(True))
        )

        def apply(df: DataFrame) -> DataFrame:
            joined = df.withColumn("__guest", F.lit(False)).unionByName(tails)
            return joined.withColumns(shifted).where(~F.col("__guest")).drop("__guest")

        return self.transform(apply)

    def totals(self, **aggregates: Column) -> "OrderedRows":
        """Aggregates over all rows of the key, added to each row.

        A key below the limit is one range, so the window over its range is already the
        total; hot keys take theirs from a row per hot key.
        """
        own = Window.partitionBy(*self._group)
        inner = {n: a.over(own) for n, a in aggregates.items()}
        if self.hot is None:
            return self.transform(lambda df: df.withColumns(inner))
        per_key = self.hot.groupBy(*self.keys).agg(*[a.alias(f"__whole_{n}") for n, a in aggregates.items()])

        def apply(df: DataFrame) -> DataFrame:
            out = df.withColumns(inner).join(per_key, list(self.keys), "left")
            out = out.withColumns({n: F.coalesce(F.col(f"__whole_{n}"), F.col(n)) for n in inner})
            return out.drop(*[f"__whole_{n}" for n in inner])

        return self.transform(apply)


def order_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
               max_rows: int | None = MAX_ROWS_PER_RANGE, depth: int = 1, hold: bool = False) -> OrderedRows:
    """Prepare ``df`` for ordered computations.

    ``max_rows=None`` states that the caller has a bound on the rows per key (months of a
    calendar, sectors of a compass).  ``depth`` is the largest lag that will be asked for.
    ``hold`` checkpoints a computed input when hot keys make it needed several times.  Rows
    with equal order values stay in one range, so give a tie-breaking id where many rows may
    share a position.
    """
    keys, order = list(keys), list(order)
    if not keys:
        df, keys = df.withColumn(_ALL, F.lit(0)), [_ALL]
    plain = OrderedRows(df, None, tuple(keys), tuple(order))
    heavy = hot_keys(df, keys, max_rows)
    if heavy is None:
        return plain
    if hold:
        checkpoint_ready(df.sparkSession)
        df = df.checkpoint()
    cuts = _range_cuts(df, heavy, keys, order, max_rows, depth)
    # Twice as many partitions as ranges, so that few tasks hold several; a given number is not merged by size.
    session = df.sparkSession
    ranges = cuts.agg(F.sum(F.size("__cuts") + 1)).first()[0] or 0
    width = max(int(session.conf.get("spark.sql.shuffle.partitions")), 2 * ranges)
    cuts = F.broadcast(cuts)
    rows = _tag(df.join(cuts, keys, "left"), order).repartition(width, *keys, _RANGE)
    hot = _tag(df.join(cuts, keys, "inner"), order).repartition(width, *keys, _RANGE)
    return OrderedRows(rows, hot, tuple(keys), tuple(order))


def _range_cuts(df: DataFrame, hot: DataFrame, keys: list[str], order: list[str], max_rows: int, depth: int) -> DataFrame:
    """Cut points per hot key from a content-hashed sample, fixed once for all uses.

    The sample holds about ``_SAMPLES_PER_RANGE`` positions per range.
    """
    position = F.struct(*order)
    stride = F.lit(max(1, max_rows // _SAMPLES_PER_RANGE)).cast("bigint")
    sampled = (
        df.select(*keys, position.alias("__position")).join(hot, keys)
        .where(F.pmod(F.xxhash64("__position"), stride) == 0)
        .groupBy(*keys)
        .agg(F.max("__rows").alias("__rows"), F.sort_array(F.collect_set("__position")).alias("__sample"))
    )
    wanted = F.greatest(F.lit(1), F.least(
        F.ceil(F.col("__rows") / max_rows).cast("int"),
        F.expr(f"cast(size(__sample) div {max(1, depth)} as int)")))
    cut = F.expr("transform(sequence(0, __wanted - 1), i -> "
                 "element_at(__sample, greatest(1, cast(cast(i as bigint) * size(__sample) div __wanted as int))))")
    table = sampled.withColumn("__wanted", wanted).withColumn("__cuts", F.slice(cut, F.lit(2), F.col("__wanted")))
    table = table.withColumn("__coarse", F.expr(f"filter(__cuts, (c, i) -> i % {_BLOCK} = {_BLOCK - 1})"))
    table = table.select(*keys, "__cuts", "__coarse")
    return table.checkpoint()


def _tag(df: DataFrame, order: list[str]) -> DataFrame:
    """Range number by a two-step search among the cuts."""
    position = F.struct(*order)
    block = F.size(F.filter("__coarse", lambda c: c < position))
    inside = F.size(F.filter(F.slice("__cuts", F.col("__block") * _BLOCK + 1, _BLOCK), lambda c: c < position))
    return (
        df.withColumn("__block", F.when(F.col("__cuts").isNull(), 0).otherwise(block))
        .withColumn(_RANGE, F.when(F.col("__cuts").isNull(), 0).otherwise(F.col("__block") * _BLOCK + inside))
        .drop("__block", "__cuts", "__coarse")
    )
