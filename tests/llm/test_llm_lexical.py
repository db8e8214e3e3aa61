import math
import re
from collections import Counter

import numpy as np
import pytest

from anemora.llm import lexical
from anemora.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=50):
    held = [(key, Counter(terms(text))) for key, text in docs]
    held = [(key, c) for key, c in held if c]
    n, total, df = len(held), sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    for item, text in items:
        scores = []
        for key, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, key is None, key))
        for rank, (score, _, key) in enumerate(sorted(scores)[:k], 1):
            yield (item, rank, key, -score)


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def test_share_adds_the_same():
    rng = np.random.default_rng(3)
    common = [rng.choice(60, 12, replace=False).tolist() for _ in range(4)]
    sets = [sorted({*common[i % 4], *rng.choice(200, 6).tolist()}) for i in range(40)] + [[], [199]]
    plan = lexical.share(range(len(sets)), sets, 200)
    leaves = rng.integers(0, 1 << 40, (200, 7))
    assert (lexical.evaluate(plan, leaves) == np.array([leaves[s].sum(axis=0) for s in sets])).all()
    assert len(plan.levels) > 1 and plan.additions() < 0.6 * sum(max(0, len(s) - 1) for s in sets)
    # Every node serves two items at least.
    served = np.zeros((200 + len(plan.left), len(sets)), bool)
    for i in range(len(sets)):
        served[plan.part[plan.first[i]:plan.first[i + 1]], i] = True
    for i in reversed(range(len(plan.left))):
        served[[plan.left[i], plan.right[i]]] |= served[200 + i]
    assert (served[200:].sum(axis=1) > 1).all()


def test_terms():
    import pyarrow as pa

    texts = ["Ab1 c_dÉÉ-é", None, "", "..", "x", "ŻY z 9", "end"]
    found, counts = lexical.terms(pa.array(texts))
    assert [t.decode() for t in found.to_pylist()] == [t for x in texts for t in terms(x)]
    assert counts.tolist() == [len(terms(x)) for x in texts]


@pytest.mark.parametrize("limit", [100_000, 12])
def test_against_brute_force(spark, sf, monkeypatch, limit):
    """In one pass and in many."""
    monkeypatch.setattr(lexical, "PASS_TERMS", limit)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(5, "Same words"), (5, "Same words"), (None, "same words"), (9001, None), (9002, ""), (9003, "!?"), (9004, "words " * 30_000)]
    items = [(1, "Same same words"), (2, None), (3, "neverseen"), (4, ""), (None, "words der"), (7, docs[3][1][:200]), (8, docs[3][1][:200])]
    frame = spark.createDataFrame([(k, t, "s", 1) for k, t in docs], "doc_id long, text string, score string, item int").repartition(5)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    got = [tuple(r) for r in lexical.search(frame, asked, k=9).collect()]
    assert order(got) == order(brute(docs, items, 9))


def test_repeated_items_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b"), (1, "b")], "item_id long, text string")
    got = [tuple(r) for r in lexical.search(docs, items).collect()]
    assert len(got) == 2 and got[0] == got[1] and got[0][:3] == (1, 1, 1)
    assert lexical.search(docs.limit(0), items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0


def test_query(spark, sf):
    read = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(key, "text").collect()]
    got = [tuple(r) for r in QUERIES["op11_shared_accumulators"](spark, sf).select("item_id", "rank", "doc_id", "score").collect()]
    assert order(got) == order(brute(read("documents", "doc_id"), read("benchmark", "item_id")))
