import math

import numpy as np
import pytest

from anemora.llm import mtree, vectors
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, component_id int"


def _usable(x):
    return x is not None and len(x) and all(c is not None and math.isfinite(c) for c in x) and any(x)


def _rows():
    random = np.random.default_rng(4)
    out = []
    for _ in range(40):
        base = random.standard_normal(32)
        for _ in range(int(random.integers(1, 8))):
            out.append((base + random.standard_normal(32) * float(random.choice([0.02, 0.1, 0.3]))).astype(np.float32).tolist())
    near = random.standard_normal(32)
    out += [(near + 0.05 * random.standard_normal(32)).astype(np.float32).tolist() for _ in range(60)]
    data = [(int(k), x, int(k) % 2) for k, x in zip(random.permutation(10 ** 4)[:len(out)], out)]
    same = data[0][1]
    data += [(20000 + i, same, data[0][2]) for i in range(20)] + [(30000, same, 1 - data[0][2]), (30001, same, None), (30002, None, 1), (30003, [0.0] * 32, 1),
             (30004, [float("nan")] + same[1:], 1), (30005, [None] + same[1:], 1), (30006, [], 1), (30007, same[:5], 1), (30008, [float("inf")] * 32, 1), (None, same, 1)]
    return data


def brute(data, least=0.93):
    links = [set() for _ in data]
    for i, (a, x, p) in enumerate(data):
        for j, (b, y, q) in enumerate(data):
            if i != j and a is not None and b is not None and p == q and p is not None and _usable(x) and _usable(y) and len(x) == len(y):
                x64, y64 = np.array(x, float), np.array(y, float)
                if x64 @ y64 / math.sqrt((x64 @ x64) * (y64 @ y64)) >= least:
                    links[i].add(j)
    return links


@pytest.mark.parametrize("block", [1_024, 7])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    data = _rows()
    links = brute(data)
    got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame([(*d, "x", 1) for d in data], SCHEMA)).collect()}
    assert len(got) == len(data)
    found, total = sum(r.n_links for r in got.values()), sum(map(len, links))
    assert 0.95 * total <= found <= total
    for i, (key, *_) in enumerate(data):
        assert got[key].n_links <= len(links[i])
        assert got[key].kept == (key is not None and got[key].component_id == key)
    component, stack = {}, []
    for i in sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0])):
        stack = [i] if i not in component else []
        while stack:
            x = stack.pop()
            if x not in component:
                component[x] = data[i][0]
                stack += links[x]
    assert all(got[d[0]].component_id == component[i] for i, d in enumerate(data))


def test_equal_vectors_count_each_other(spark):
    data = [(i, [1.0, 2.0, float(i % 2) * 1e-3], 0, None, None) for i in range(50)]
    got = vectors.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(49, 0)} and sum(r.kept for r in got) == 1
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tables_keep_the_recall():
    for rows in (10, 10 ** 4, 10 ** 9):
        signs, tables = vectors.tables_for(rows, 0.93)
        agree = (1 - math.acos(0.93) / math.pi) ** signs
        assert 1 - (1 - agree) ** tables >= 0.98


def _search(data, k=5):
    out = []
    good = [(key, np.floor(256 * np.array(x, np.float64)).astype(int)) for key, x, _ in data if key is not None and x is not None and len(x) and all(c is not None and math.isfinite(c) for c in x)]
    width = max(len(x) for _, x in good)
    good = [(key, np.pad(x, (0, width - len(x)))) for key, x in good]
    for q, x in good:
        if q % 5 == 0:
            scores = sorted(((-int(x @ y), key) for key, y in good if key != q))[:k]
            out += [(q, r + 1, key, -s) for r, (s, key) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("sample, block, queries", [(8_192, 4_096, 512), (40, 16, 3), (3, 5, 1)])
def test_top_k(spark, monkeypatch, sample, block, queries):
    monkeypatch.setattr(mtree, "SAMPLE", sample)
    monkeypatch.setattr(mtree, "BLOCK_ROWS", block)
    monkeypatch.setattr(mtree, "QUERY_ROWS", queries)
    data = _rows()
    frame = spark.createDataFrame([(*d, "x", 1) for d in data], SCHEMA)
    got = mtree.top_k(frame, F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == _search(data)


def test_top_k_few_rows_and_ties(spark):
    data = [(5, [1.0, 0.0], 1, None, None), (1, [0.5, 0.0], 1, None, None), (2, [0.5, 9.0], 1, None, None), (3, None, 1, None, None)]
    got = mtree.top_k(spark.createDataFrame(data, SCHEMA), F.col("vec_id") == 5).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(5, 1, 1, 256 * 128), (5, 2, 2, 256 * 128)]
    assert mtree.top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    assert mtree.top_k(spark.createDataFrame(data[:1], SCHEMA), F.lit(True)).count() == 0
    zeros = [(i, [0.0, 0.0], 1, None, None) for i in range(9)]
    assert sorted((r.query_id, r.vec_id) for r in mtree.top_k(spark.createDataFrame(zeros, SCHEMA), F.col("vec_id") == 0).collect()) == [(0, i) for i in range(1, 6)]
