from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from anemora.llm.packing import best_buckets, length_bin, pack

SCHEMA = "doc_id bigint, text string, bucket string, batch int"


def _padding(longest, count, total, ends):
    cost, begin = 0, 0
    for e in ends:
        cost += longest[e] * count[begin:e + 1].sum() - total[begin:e + 1].sum()
        begin = e + 1
    return cost


def test_boundaries_are_optimal():
    random = np.random.default_rng(3)
    for _ in range(40):
        n, buckets = int(random.integers(1, 9)), int(random.integers(1, 5))
        longest = np.sort(random.choice(40, n, replace=False))
        count = random.integers(1, 9, n)
        total = longest * count
        ends = best_buckets(longest, count, total, buckets)
        best = min(_padding(longest, count, total, [*c, n - 1]) for k in range(min(buckets, n)) for c in combinations(range(n - 1), k))
        assert _padding(longest, count, total, ends) == best and len(ends) <= buckets
    assert best_buckets(np.zeros(0), np.zeros(0), np.zeros(0), 4) == []


def test_bins_are_ordered(spark):
    lengths = [*range(0, 300), 1000, 1001, 10 ** 6, 2 ** 40, 2 ** 62]
    frame = spark.createDataFrame([(x,) for x in lengths], "n bigint")
    bins = [r.b for r in frame.select(length_bin(F.col("n")).alias("b"), "n").orderBy("n").collect()]
    assert bins == sorted(bins) and bins[:128] == list(range(128)) and max(bins) < 58 * 64


def test_batches(spark):
    random = np.random.default_rng(5)
    data = [(i, " ".join(["w"] * int(random.integers(0, 60))), "b", 1) for i in range(300)]
    data += [(None, None, None, None), (7, data[7][1], "b", 1), (1000, "w " * 5000, "b", 1)]
    got = pack(spark.createDataFrame(data, SCHEMA), buckets=4, budget=200, max_rows=8).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_tokens) for r in got) == sorted((d[0] is None, d[0], len((d[1] or "").split())) for d in data)
    batches, longest = {}, {}
    for r in got:
        assert r.n_tokens <= r.padded_length
        batches.setdefault((r.bucket, r.batch), []).append(r)
        longest[r.bucket] = max(longest.get(r.bucket, 0), r.n_tokens)
    for (bucket, _), rows in batches.items():
        assert sorted(r.position for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or len(rows) * rows[0].padded_length <= 200 and len(rows) <= 8
        assert rows[0].padded_length == longest[bucket]
    for bucket in longest:
        numbers = sorted(b for k, b in batches if k == bucket)
        assert numbers == list(range(len(numbers)))
        full = max(len(batches[bucket, b]) for b in numbers)
        assert all(len(batches[bucket, b]) == full for b in numbers[:-1])
    assert pack(spark.createDataFrame([], SCHEMA)).count() == 0
