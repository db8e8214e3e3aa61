"""Packing into length buckets that minimise padding, and token-budget batches inside each bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import number_rows, word_count

#: Bins per octave of the length histogram; lengths up to this number have a bin each.
RESOLUTION = 64


def length_bin(length: Column, resolution: int = RESOLUTION) -> Column:
    """Bin of a length: exact up to ``resolution``, then ``resolution`` bins per octave.

    Lengths of 63 bits fall into fewer than 58 * resolution bins, so the histogram is small however
    long texts are.
    """
    octave = F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)) / F.lit(resolution) + F.lit(2.0 ** -40))), F.lit(0))
    step = F.floor(length / F.pow(F.lit(2.0), octave)) - resolution
    return F.when(length < resolution, length).otherwise((octave + 1) * resolution + step).cast("long")


def best_buckets(longest: np.ndarray, count: np.ndarray, total: np.ndarray, buckets: int) -> list[int]:
    """Last bins of the at most ``buckets`` runs of bins with the least padding.

    ``longest``, ``count`` and ``total`` hold each bin's greatest length, rows and summed lengths.
    A run is padded to its greatest length.  One row of the table per number of runs, each from the row before.
    """
    n = len(longest)
    if n == 0:
        return []
    rows, sums = np.concatenate([[0], np.cumsum(count, dtype=np.float64)]), np.concatenate([[0], np.cumsum(total, dtype=np.float64)])
    best = longest * rows[1:] - sums[1:]
    back: list[np.ndarray] = []
    for _ in range(min(buckets, n) - 1):
        nxt, choice = best.copy(), np.full(n, -1)
        for j in range(1, n):
            cost = best[:j] + longest[j] * (rows[j + 1] - rows[1:j + 1]) - (sums[j + 1] - sums[1:j + 1])
            i = int(np.argmin(cost))
            if cost[i] < nxt[j]:
                nxt[j], choice[j] = cost[i], i
        back.append(choice)
        best = nxt
    ends, j = [n - 1], n - 1
    for choice in reversed(back):
        if choice[j] >= 0:
            j = int(choice[j])
            ends.append(j)
    return sorted(ends)


def pack(df: DataFrame, buckets: int = 16, budget: int = 65_536, max_rows: int = 1_024, key: str = "doc_id", text: str = "text",
         length: Column | None = None, order: Column | None = None) -> DataFrame:
    """Each row's ``doc_id, n_tokens, bucket, padded_length, batch, position``.

    ``bucket`` counts from 0 by length; ``padded_length`` is the greatest length in it.  A
    batch holds as many rows as fit into ``budget`` padded tokens, at most ``max_rows`` and at least one (a text longer than
    the budget is a batch of its own); ``batch`` counts from 0 inside its bucket, ``position``
    inside its batch.  Rows come in the order of a digest.  Lengths are words unless given.

    The histogram is one partial aggregate of at most a few thousand bins, and only that reaches the
    driver.  Boundaries are the best among bin edges; with lengths up to ``RESOLUTION`` each
    length is a bin.  Null and empty texts have no tokens and fill batches of ``max_rows`` where they have a bucket alone; null keys are
    rows like others; repeated rows are packed as often as they come; no rows give no rows.
    Only the key is carried along, so column names cannot clash.
    """
    length = word_count(F.col(text)) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    extra = (F.xxhash64(text) if order is None else order).cast("long")
    base = df.select(F.col(key).alias("doc_id"), length.alias("n_tokens"), extra.alias("__mark"))
    base = base.withColumn("__bin", length_bin(F.col("n_tokens")))
    histogram = base.groupBy("__bin").agg(F.max("n_tokens"), F.count(F.lit(1)), F.sum("n_tokens")).orderBy("__bin").collect()
    bins, longest, count, total = (np.array([r[i] for r in histogram], dtype=np.int64) for i in range(4))
    ends = best_buckets(longest, count, total, buckets)
    edges = [(int(bins[e]), int(longest[e])) for e in ends]
    bucket, padded = F.lit(0), F.lit(0)
    for number, (last, size) in reversed(list(enumerate(edges))):
        bucket = F.when(F.col("__bin") <= last, F.lit(number)).otherwise(bucket)
        padded = F.when(F.col("__bin") <= last, F.lit(size)).otherwise(padded)
    placed = base.withColumn("bucket", bucket.cast("int")).withColumn("padded_length", padded.cast("long")).drop("__bin")
    numbered = number_rows(placed, ["bucket"], ["doc_id", "n_tokens", "__mark"], "__number")
    fit = F.greatest(F.lit(1), F.least(F.lit(max_rows), F.floor(F.lit(budget) / F.greatest(F.col("padded_length"), F.lit(1))))).cast("long")
    return numbered.select(
        "doc_id", "n_tokens", "bucket", "padded_length", F.floor(F.col("__number") / fit).alias("batch"), (F.col("__number") % fit).alias("position"))
