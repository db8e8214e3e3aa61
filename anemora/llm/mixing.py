"""Mixing sources to target weights by whole repetitions and hash-seeded Bernoulli copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemora.llm.common import free_name, unit_hash, word_count

#: Weights in order of the sources' names, repeating.
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Add ``target`` to the table ``(source, source_size)``, one row per source.

    Targets follow the weights, sum to ``share`` times all sizes and stop at ``cap`` times a source's
    size; the excess goes to the others by weight.  In order of ``cap * size / weight`` the
    stopped sources are a prefix: source k is stopped if its own limit is at most its weight's
    part of what the sources before it leave.  Sources are ordered by code point, null last.
    Both windows run over the table of sources, not of documents.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("__rank", F.row_number().over(by_name) - 1).withColumn("__weight", weight)
    limit = (F.col("source_size") * cap).alias("__limit")
    ranked = ranked.select("*", limit)
    by_ratio = Window.orderBy(F.col("__limit") / F.col("__weight"), "__rank")
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("__limit").over(earlier), F.lit(0.0))
    level = ranked.withColumn("__level", left / F.sum("__weight").over(later))
    # The first source that is not stopped sets the level for all after it.
    free = F.min(F.when(F.col("__limit") > F.col("__level") * F.col("__weight"), F.struct(F.col("__limit") / F.col("__weight"), "__rank", "__level"))).over(whole)
    return (
        level.withColumn("__first", free["__level"])
        .withColumn("target", F.when(F.col("__first").isNull(), F.col("__limit")).otherwise(F.least(F.col("__limit"), F.col("__first") * F.col("__weight"))))
        .select("source", "source_size", "target")
    )


def mix(df: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: str = "mix",
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The frame with ``size, source_size, target, copies``: how often the mix takes each document.

    ``rate`` is the source's target over its size; a document is taken ``floor(rate)`` times,
    and once more if its key's hash falls below the fraction, so reruns and partitions agree.
    Sizes are summed per source before the shuffle and joined back as one row per
    source.  Null texts have size 0 and rate and target follow their source; a source of size 0 has
    target and rate 0; rows with equal keys are taken equally often; null sources are one source, the
    last; an empty table gives no rows.  Existing columns of those four names are replaced.
    """
    names = [n for n in ("size", "source_size", "target", "copies") if n in df.columns]
    sized = df.drop(*names).withColumn("size", word_count(F.col(text)))
    of = free_name(sized, "__of")
    sizes = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    goals = source_targets(sizes, weights, share, cap).withColumnRenamed("source", of)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    draw = unit_hash(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))
    copies = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    return sized.join(goals, F.col(source).eqNullSafe(F.col(of)), "left").drop(of).withColumn("copies", copies)


def repeat(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as its ``copies`` say, without the mixing columns."""
    kept = mixed.where(F.col("copies") > 0)
    return kept.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("__copy", "size", "source_size", "target", "copies")
