import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from anemora.llm import similar
from anemora.llm.common import table
from anemora.llm.similar import REACH, deduplicate, near_duplicates, sketches, tables


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows):
    """The least key of each row's component, by the Jaccard similarity of all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        return x if root[x] == x else top(root[x])

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
            root[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[top(i)] = min(k, least.get(top(i), k))
    return {k: least[top(i)] for i, (k, _) in enumerate(rows)}


def _texts():
    draw, out = random.Random(2), [(0, None), (1, ""), (2, "One two"), (3, "one  TWO"), (4, "one two three")]
    for g in range(12):
        words = [f"w{draw.randrange(5000)}" for _ in range(300)]
        for edits in (0, 0, 1, 2, 4, 5, 6, 8, 9, 20):
            some = list(words)
            for at in draw.sample(range(300), edits):
                some[at] = f"x{draw.randrange(5000)}"
            out.append((len(out), " ".join(some)))
    return out


@pytest.mark.parametrize("block, bucket", [(2_000_000, 2_048), (900, 16)])
def test_near_copies_against_brute_force(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(similar, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(similar, "BUCKET_ROWS", bucket)
    rows = _texts()
    want = brute(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(frame).collect()} == want
    assert sorted(r.doc_id for r in deduplicate(frame).collect()) == sorted(set(want.values()))
    assert deduplicate(frame.limit(0)).count() == 0


def test_stage_drops_all_near_copies_of_the_table(spark):
    import corpus_pipeline

    docs = table(spark, "/root/testdata/sf0.01", "documents").where(F.length("text") < 20_000)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()}
    assert kept == set(brute(rows).values())


def test_recall_of_candidates():
    """Of pairs at similarity 0.8, nine in ten meet in a table and lie within reach, for any number of rows."""
    draw = np.random.default_rng(4)
    sets = []
    for _ in range(500):
        pool = draw.integers(0, 1 << 63, 300).astype(np.uint64)
        both, only = pool[:240], pool[240:]
        sets += [np.unique(np.concatenate([both, only[:30]])), np.unique(np.concatenate([both, only[30:]]))]
    _, high, low = sketches(sets)
    apart_high, apart_low = high[::2] ^ high[1::2], low[::2] ^ low[1::2]
    near = np.bitwise_count(apart_high) + np.bitwise_count(apart_low) <= REACH
    found = {}
    for rows in (100, 50_000, 250_000, 10_000_000, 1_000_000_000):
        met = np.zeros(500, bool)
        for h, x in tables(rows):
            met |= (apart_high & np.int64(h).view(np.uint64) == 0) & (apart_low & np.int64(x).view(np.uint64) == 0)
        found[rows] = (met & near).mean()
    print(found)
    assert min(found.values()) >= 0.9


def test_simhash_finds_all_nearest_pairs(spark, monkeypatch):
    """Pairs whose fingerprints differ in few bits are candidates by SimHash's own search, whatever the tables draw."""
    draw = np.random.default_rng(9)
    base = draw.integers(0, 1 << 63, 40)
    rows = []
    for g, x in enumerate(base.tolist()):
        low = int(draw.integers(0, 1 << 62))
        rows += [(4 * g + k, x ^ sum(1 << b for b in bits), low) for k, bits in enumerate([(), (1,), (5, 40), (3, 17, 60)])]
    rows.append((160, rows[0][1], rows[0][2]))
    monkeypatch.setattr(similar, "tables", lambda n: [(-1, -1)])  # a table that only equal fingerprints share
    frame = spark.createDataFrame(rows, "node bigint, high bigint, low bigint")
    root = {n: n for n, _, _ in rows}

    def top(n):
        return n if root[n] == n else top(root[n])

    for r in similar.candidates(frame, len(rows)).collect():
        root[top(r.a)] = top(r.b)
    assert len({top(n) for n, _, _ in rows}) == 40
    assert all(top(4 * g) == top(4 * g + k) for g in range(40) for k in range(4)) and top(160) == top(0)
