"""Per-node tables: spines, star joins, top lists, representatives, resumption."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemora.operators.ordered import MAX_ROWS_PER_RANGE, order_rows


def node_spine(*tables: DataFrame, key: str = "node_id") -> DataFrame:
    """Distinct keys that occur in any table."""
    out = tables[0].select(key)
    for table in tables[1:]:
        out = out.union(table.select(key))
    return out.distinct()


def any_row(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key of a column that is constant per key; smallest on the odd mismatch."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def alternate_method(method: Column, km_p50: Column, reliable: Column, success: Column) -> Column:
    yes = F.lit(True)
    return F.when((method == "weibull") & km_p50.isNotNull(), "kaplan_meier").when(
        (method == "kaplan_meier") & (reliable.eqNullSafe(yes) | success.eqNullSafe(yes)), "weibull")


def reliable_estimate(method: Column, reliable: Column, any_bias: Column) -> Column:
    unbiased = ~any_bias.eqNullSafe(F.lit(True))
    return F.when(method == "weibull", reliable.eqNullSafe(F.lit(True)) & unbiased).when(
        method == "kaplan_meier", unbiased)


def node_summary(power: DataFrame, empirical: DataFrame, km: DataFrame, geometry: DataFrame) -> DataFrame:
    """Star of left joins on the union of all node ids.

    Every side has one row per node.  No broadcast is forced: AQE picks it when the measured
    side is small and shuffles on the node otherwise, and all sides share that key.
    """
    p = power.select("node_id", *[F.col(c).alias(f"p__{c}") for c in power.columns if c != "node_id"])
    e = empirical.select("node_id", *[F.col(c).alias(f"e__{c}") for c in empirical.columns if c != "node_id"])
    k = km.select("node_id", *[F.col(c).alias(f"k__{c}") for c in km.columns if c != "node_id"])
    wide = node_spine(power, empirical, km)
    for side in (p, e, k, geometry.select("node_id", "geometry")):
        wide = wide.join(side, "node_id", "left")
    method, reliable = F.col("p__method"), F.col("p__weibull_reliable")
    renamed = {"mean_speed": "mean_speed_m_s", "std_speed": "std_speed_m_s", "min_speed": "min_speed_m_s",
               "max_speed": "max_speed_m_s", "p50": "speed_p50_m_s", "p90": "speed_p90_m_s", "p99": "speed_p99_m_s"}
    power_columns = [F.col(f"p__{c}").alias(c) for c in power.columns if c not in ("node_id", "method")]
    empirical_columns = [F.col(f"e__{c}").alias(renamed.get(c, c)) for c in empirical.columns if c != "node_id"]
    km_names = {"km_p50": "km_p50_m_s", "km_p90": "km_p90_m_s", "km_p99": "km_p99_m_s",
                "left_mass_ratio": "km_left_mass_ratio", "right_tail_probability": "km_right_tail_probability",
                "reasons": "km_activation_reasons"}
    km_columns = [F.col(f"k__{c}").alias(name) for c, name in km_names.items() if c in km.columns]
    return wide.select(
        "node_id", "geometry", method.alias("selected_method"),
        alternate_method(method, F.col("k__km_p50"), reliable, F.col("p__weibull_success")).alias("alternate_method"),
        reliable_estimate(method, reliable, F.col("e__any_bias")).alias("reliable_estimate"),
        *power_columns, *empirical_columns,
        (F.col("e__max_speed") - F.col("e__min_speed")).alias("in_range_span_m_s"),
        (F.col("e__p90") - F.col("e__p50")).alias("p90_minus_p50_m_s"),
        *km_columns, (F.col("k__km_p90") - F.col("k__km_p50")).alias("km_interval_width_m_s"))


def publish_join(power: DataFrame, geometry: DataFrame, empirical: DataFrame) -> DataFrame:
    """Power rows that have a geometry, with the empirical columns they lack."""
    extra = [c for c in empirical.columns if c == "node_id" or c not in power.columns]
    return power.join(geometry, "node_id", "inner").join(empirical.select(*extra), "node_id", "left")


def top_nodes(table: DataFrame, by: str, count: int, ascending: bool = False) -> DataFrame:
    """The ``count`` best rows; nulls last, ties by node."""
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return table.orderBy(order, "node_id").limit(count)


def variation_leaders(table: DataFrame, count: int = 5) -> DataFrame:
    """Largest amplitudes, steepest rises and steepest falls, tagged by list."""
    def leaders(name, column, ascending, condition=None):
        rows = table.where(F.col(column).isNotNull())
        if condition is not None:
            rows = rows.where(condition)
        return top_nodes(rows, column, count, ascending).select(F.lit(name).alias("list"), "node_id", F.col(column).alias("value"))

    return (
        leaders("amplitude", "seasonal_amplitude", False)
        .unionByName(leaders("positive_trend", "annual_trend_slope", False))
        .unionByName(leaders("negative_trend", "annual_trend_slope", True))
    )


def representative_nodes(table: DataFrame, count: int, rankings: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """Nodes for display: go through ranked lists in turn and keep each node once.

    ``rankings`` holds ``(list name, column, ascending)``.  Each list contributes at most
    ``count`` rows before the merge, so everything after the top-k steps is a handful of rows.
    """
    merged = None
    for priority, (name, column, ascending) in enumerate(rankings):
        rows = top_nodes(table.where(F.col(column).isNotNull()), column, count, ascending)
        order = F.col(column).asc() if ascending else F.col(column).desc()
        ranked = rows.select(
            "node_id", F.lit(priority).alias("priority"), F.lit(name).alias("list"),
            F.row_number().over(Window.partitionBy(F.lit(priority)).orderBy(order, "node_id")).alias("rank"))
        merged = ranked if merged is None else merged.unionByName(ranked)
    first = merged.groupBy("node_id").agg(F.min(F.struct("priority", "rank", "list")).alias("f")).select("node_id", "f.*")
    return first.orderBy("priority", "rank").limit(count)


def pending(nodes: DataFrame, done: DataFrame, key: str = "node_id") -> DataFrame:
    """Keys without a finished result."""
    return nodes.join(done.select(key).distinct(), key, "left_anti")


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row per key by ``order``; an aggregate, so copies shrink before the shuffle."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("r")).select(key, "r.*")


def uncertainty_coverage(table: DataFrame, lower: str, upper: str, replicates: str) -> DataFrame:
    """How many nodes carry an interval, and the spread of replicate counts."""
    return table.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col(lower).isNotNull() & F.col(upper).isNotNull()).alias("nodes_with_interval"),
        F.min(replicates).alias("min_replicates"), F.max(replicates).alias("max_replicates"),
        F.avg(replicates).alias("mean_replicates"))


def nested_records(obs: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], *,
                   max_per_list: int, max_rows: int | None = MAX_ROWS_PER_RANGE) -> DataFrame:
    """Time-ordered lists of records per node, in numbered parts of at most ``max_per_list``.

    A running count numbers the records of a node, so no list (and no task) holds an
    unbounded group; the parts in order are the node's full history.
    """
    counted = order_rows(obs.select(key, *order, *columns), [key], list(order), max_rows=max_rows).running_sum(
        __n=F.lit(1)).dataframe()
    part = F.expr(f"(__n - 1) div {max_per_list}")
    return counted.groupBy(key, part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct(*order, *columns))).alias("records"))


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """``flag, nodes, percentage``: on how many rows each flag is raised, and of how many in a hundred; zero of no rows.

    One aggregate over all flags; a null flag is not raised.
    """
    counted = df.agg(F.count(F.lit(1)).alias("__all"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("nodes")) for f in flags])).alias("e")
    return counted.select("__all", each).select(
        "e.flag", "e.nodes", F.when(F.col("__all") > 0, F.col("e.nodes") / F.col("__all") * 100.0).otherwise(0.0).alias("percentage"))
