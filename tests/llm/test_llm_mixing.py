import pytest
from conftest import rows

from anemora.llm.mixing import WEIGHTS, mix, repeat

SCHEMA = "doc_id bigint, text string, source string, size int, target string"


def _targets(sizes, share=1.5, cap=2.0):
    """Reshare the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return target | stopped
        stopped |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 500, "d": 1, None: 300}, {"b": 7}, {"é": 50, "z": 900, "Z": 20, "a": 2, "k": 60, "": 9}])
def test_targets(spark, sizes):
    data = [(i, " ".join("w" * n), s, 0, "x") for i, (s, n) in enumerate(sizes.items())]
    got = {r.source: r for r in mix(spark.createDataFrame(data, SCHEMA)).collect()}
    want = _targets(sizes)
    for s in sizes:
        assert got[s].source_size == sizes[s] and got[s].target == pytest.approx(want[s])
        rate = want[s] / sizes[s]
        assert int(rate) <= got[s].copies <= int(rate) + (rate > int(rate)) and got[s].copies <= 2


def test_mix_comes_near_targets_and_repeats(spark):
    data = [(i, "w " * (1 + i % 17), "hot" if i % 3 else f"s{i % 5}", None, None) for i in range(4000)]
    frame = spark.createDataFrame(data, SCHEMA)
    mixed = mix(frame)
    taken, target = {}, {}
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.12 * target[s] for s in target)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(1 + i % 17 for i in range(4000)), rel=0.05)
    again = mix(frame.repartition(7))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    out = repeat(mixed)
    assert out.count() == sum(r.copies for r in mixed.collect()) and out.columns == ["doc_id", "text", "source"]


def test_edges(spark):
    data = [(None, None, None, 1, "t"), (1, "", None, 1, "t"), (2, "a b", "s", 1, "t"), (2, "a b", "s", 1, "t")]
    got = rows(mix(spark.createDataFrame(data, SCHEMA)), "source", "doc_id")
    assert [r["size"] for r in got] == [2, 2, 0, 0]
    assert got[0]["copies"] == got[1]["copies"] and got[2]["target"] == 0 and got[2]["copies"] == 0
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mix(spark.createDataFrame([(1, None, "s", 1, "t")], SCHEMA)).first().copies == 0
