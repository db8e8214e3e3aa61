import math
import zlib
from hashlib import md5

from pyspark.sql import functions as F

from anemora.llm.sharding import Tree, assign, place

SCHEMA = "doc_id bigint, text string, shard string, slot int"


def _descend(tree, key):
    node = ""
    for level in tree.levels():
        draws = []
        for name, weight in level[node]:
            u = int(md5(f"{key}|{name}".encode()).hexdigest()[:13], 16) / 2 ** 52 + 2.0 ** -53
            draws.append((-math.log(u) / weight, name))
        node = min(draws)[1]
    return int(node)


def _placed(spark, tree, n=3000):
    keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
    return {r.k: r.s for r in keys.select("k", place(tree, F.col("k")).alias("s")).collect()}


def test_descent_and_growth(spark):
    for shards in (1, 5, 24):
        tree = Tree.even(shards)
        before, after = _placed(spark, tree), _placed(spark, tree.with_shard())
        assert all(before[k] == _descend(tree, k) for k in list(before)[:300])
        moved = {k for k in before if before[k] != after[k]}
        assert moved and {after[k] for k in moved} == {shards}
        assert abs(len(moved) / len(before) - 1 / (shards + 1)) < 0.05


def test_balance_and_confined_moves(spark):
    tree = Tree.even(24)
    before = _placed(spark, tree, 12000)
    counts = [list(before.values()).count(s) for s in range(24)]
    assert max(counts) < 1.3 * 500 and min(counts) > 0.7 * 500
    after = _placed(spark, tree.with_weight(5, 3.0), 12000)
    region, rack = 5 // 8, 5 // 4
    for k in before:
        if before[k] != after[k]:
            assert after[k] // 8 == region
            if before[k] // 8 == region:
                assert after[k] // 4 == rack
                if before[k] // 4 == rack:
                    assert after[k] == 5


def test_rows_with_nulls_repeats_and_clashing_names(spark):
    data = [(1, "é", "x", 1), (1, "é", "x", 1), (None, None, None, None), (2, "", "y", 2), (3, "a" * 50000, "z", 3)]
    got = assign(spark.createDataFrame(data, SCHEMA), Tree.even(24)).collect()
    assert len(got) == 5
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in got}
    assert sizes == {1: (10, zlib.crc32("é".encode())), None: (8, 0), 2: (8, 0), 3: (50008, zlib.crc32(b"a" * 50000))}
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert assign(spark.createDataFrame([], SCHEMA), Tree.even(24)).count() == 0
