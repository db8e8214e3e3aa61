"""Bootstrap by counter-based draws: how often a record counts in a replicate is a function of seed, record and replicate.

No generator has a state, so draws are column expressions: tasks, partitions and
retries do not matter, and another engine can repeat them digit by digit.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Replicates that one digest serves: 32 bits each.
PER_DIGEST = 4
#: Bounds of the cumulative Poisson law of mean one, in units of 2^-32; a draw counts the bounds at or below it.
BOUNDS = tuple(int(sum(exp(-1) / factorial(j) for j in range(k + 1)) * 2**32) for k in range(13))


def digest(seed: str, record: Column, block: Column) -> Column:
    """What the draws of a record in a block of replicates are cut from."""
    return F.md5(F.concat_ws("|", F.lit(seed), record.cast("string"), block.cast("string")).cast("binary"))


def poisson_counts(drawn: Column) -> list[Column]:
    """How often a record counts in the ``PER_DIGEST`` replicates of a digest: independent, Poisson with mean one.

    Hexadecimal digits of one length compare like the numbers they write.
    """
    out = []
    for i in range(PER_DIGEST):
        u = F.substring(drawn, 1 + 8 * i, 8)
        # Small counts are likely, so the first bounds decide most draws.
        count = F.when(u < f"{BOUNDS[0]:08x}", 0)
        for k, bound in enumerate(BOUNDS[1:], 1):
            count = count.when(u < f"{bound:08x}", k)
        out.append(count.otherwise(len(BOUNDS)))
    return out


def poisson_replicates(rows: DataFrame, keys: Sequence[str], record: str, value: str, weight: str, replicates: int = 200, seed: str = "poisson") -> DataFrame:
    """``keys, replicate, mean, weight``: the weighted mean of every replicate.

    A record meets every block of replicates in the task that read it and is summed there, so
    keys times replicates rows are shuffled from each task, whatever the number of records.
    """
    blocks = -(-replicates // PER_DIGEST)
    dealt = rows.select(*keys, F.col(record).alias("__record"), F.col(value).alias("__x"), F.col(weight).alias("__w"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__block"))
    # Generators keep the digest and the counts from being evaluated once per use.
    drawn = dealt.select(*keys, "__block", "__x", "__w", F.explode(F.array(digest(seed, F.col("__record"), F.col("__block")))).alias("__digest"))
    drawn = drawn.select(*keys, "__block", "__x", "__w", F.explode(F.array(F.array(*poisson_counts(F.col("__digest"))))).alias("__k"))
    sums = [F.struct(F.sum(F.col("__k")[i] * F.col("__w") * F.col("__x")).alias("s"), F.sum(F.col("__k")[i] * F.col("__w")).alias("w")) for i in range(PER_DIGEST)]
    each = drawn.groupBy(*keys, "__block").agg(F.array(*sums).alias("__sums"))
    out = each.select(*keys, "__block", F.posexplode("__sums").alias("__i", "__sum"))
    return out.select(*keys, (F.col("__block") * PER_DIGEST + F.col("__i")).alias("replicate"), F.try_divide("__sum.s", "__sum.w").alias("mean"), F.col("__sum.w").alias("weight")).where(
        F.col("replicate") < replicates)


def poisson_interval(rows: DataFrame, keys: Sequence[str], record: str, value: str, weight: str, replicates: int = 200, confidence: float = 0.95, seed: str = "poisson") -> DataFrame:
    """``keys, estimate, replicates, replicate_mean, replicate_std, lower, upper`` of the weighted mean, by the percentiles of the replicates.

    Rows without value or of weight zero do not count; a replicate that draws nothing has no mean and is left out, and ``replicates`` counts the others.
    """
    used = rows.where(F.col(value).isNotNull() & (F.col(weight) > 0))
    plain = used.groupBy(*keys).agg((F.sum(F.col(weight) * F.col(value)) / F.sum(weight)).alias("estimate"))
    tail = (1.0 - confidence) / 2.0
    # A key has as many rows here as replicates.
    spread = poisson_replicates(used, keys, record, value, weight, replicates, seed).where(F.col("mean").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("replicates"), F.avg("mean").alias("replicate_mean"), F.stddev_samp("mean").alias("replicate_std"),
        F.percentile("mean", F.lit(tail)).alias("lower"), F.percentile("mean", F.lit(1.0 - tail)).alias("upper"))
    return plain.join(spread, list(keys), "left")
