import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from anemora.llm import simhash

SCHEMA = "doc_id bigint, text string, fingerprint string, component_id int"


def fingerprint(text):
    data = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, reach=3):
    """Least key of each row's component; rows are ``(key, fingerprint)``."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= reach:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(prints):
        least.setdefault(find(i), []).append(key)
    return [min((k for k in least[find(i)] if k is not None), default=None) for i in range(len(prints))]


def _texts():
    random = np.random.default_rng(11)
    words = ["the", "of", "Äpfel", "stone", "River", "x9", "blue", "and", "walk", "ten"]
    out = []
    for i in range(40):
        base = [words[int(k)] for k in random.integers(0, len(words), int(random.integers(1, 300)))]
        out.append(" ".join(base))
        for _ in range(int(random.integers(0, 4))):
            copy = list(base)
            copy[int(random.integers(len(copy)))] = "other"
            out.append("\t".join(copy).upper())
    return [*out, None, "", " \n", "one", "one two", "ONE two", "w " * 20000]


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    texts = _texts()
    data = [(int(i * 7 % 1009), t, "f", 1) for i, t in enumerate(texts)] + [(None, texts[0], "f", 1), (None, "alone here today", "f", 1)]
    data += [data[3], data[3]]
    want = groups([(k, fingerprint(t)) for k, t, _, _ in data])
    expected = sorted((str(k), f"{fingerprint(t):016x}", str(c)) for (k, t, _, _), c in zip(data, want))
    frame = spark.createDataFrame(data, SCHEMA)
    for bound in (2_048, 2):
        monkeypatch.setattr(simhash, "BUCKET_ROWS", bound)
        got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(frame).collect())
        assert got == expected
    kept = simhash.deduplicate(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for (k, *_), c in zip(data, want) if k is None or k == c)
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(0.01, 1.0), min_size=9, max_size=9), min_size=8, max_size=8), st.integers(1, 10 ** 12), st.integers(0, 4))
def test_thresholds_keep_the_pigeonhole_sum(apart, rows, reach):
    plan = simhash.allocate([np.array(a) / sum(a) for a in apart], rows, reach)
    assert plan[0][0] == 0 and plan[-1][1] == 8 and all(a[1] == b[0] for a, b in zip(plan, plan[1:]))
    assert sum(t + 1 for _, _, t in plan) == reach + 1


def test_allocation_follows_the_number_of_rows():
    even = [np.bincount(np.bitwise_count(np.arange(256))) / 256.0] * 8
    assert simhash.allocate(even, 10 ** 5, 3) == [(0, 2, 0), (2, 4, 0), (4, 6, 0), (6, 8, 0)]
    assert max(t for _, _, t in simhash.allocate(even, 10 ** 11, 3)) >= 1


def test_links_with_thresholds_above_zero(spark, monkeypatch):
    random = np.random.default_rng(2)
    base = random.integers(-2 ** 62, 2 ** 62, 60)
    values = {int(b) for b in base}
    for b in base[:30]:
        for _ in range(5):
            flips = random.choice(64, int(random.integers(1, 5)), replace=False)
            x = int(b) & (2 ** 64 - 1)
            for f in flips:
                x ^= 1 << int(f)
            values.add(x - 2 ** 64 if x >= 2 ** 63 else x)
    values = sorted(values)
    want = groups([(v, v & (2 ** 64 - 1)) for v in values])
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    for plan in ([(0, 4, 1), (4, 8, 1)], [(0, 8, 3)] if False else [(0, 2, 0), (2, 8, 2)], [(0, 3, 1), (3, 6, 1), (6, 8, -1)]):
        monkeypatch.setattr(simhash, "allocate", lambda *a, plan=plan: plan)
        from anemora.llm.common import components
        found = {r.node: r.component for r in components(simhash.links(frame)).collect()}
        assert [found.get(v, v) for v in values] == want


def test_split_covers_the_open_bits():
    order = list(range(64))
    for mask in (0xFFFF, 0xFFFF << 48):
        parts = simhash._split(simhash._signed(mask), order, 4)
        added = [(p & (2 ** 64 - 1)) & ~mask for p in parts]
        assert sum(added) == (2 ** 64 - 1) & ~mask and len(parts) == 4
    assert simhash._split(-1, order, 4) == []


@pytest.mark.parametrize("n", [1, 2, 254, 255, 256, 700])
def test_majority(n):
    h = np.random.default_rng(n).integers(0, 2 ** 63, n * 2, dtype=np.uint64)
    got = simhash._majority(h, np.array([n, n]))
    for part, value in zip((h[:n], h[n:]), got):
        want = sum(1 << b for b in range(64) if 2 * int(((part >> np.uint64(b)) & np.uint64(1)).sum()) > n)
        assert int(value) == want
