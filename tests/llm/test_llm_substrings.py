import re

import numpy as np
import pytest

from anemora.llm import substrings
from anemora.llm.substrings import repeats

SCHEMA = "doc_id bigint, text string, n_words string, note string"


def brute(data, window):
    """Removed flags per row, from the definition; rows are ``(key, words)``."""
    first = {}
    for key, words in data:
        if key is not None:
            for s in range(len(words) - window + 1):
                run = tuple(words[s:s + window])
                first[run] = min(first.get(run, (key, s)), (key, s))
    out = []
    for key, words in data:
        gone = np.zeros(len(words), bool)
        if key is not None:
            for s in range(len(words) - window + 1):
                if first[tuple(words[s:s + window])] < (key, s):
                    gone[s:s + window] = True
        out.append(gone)
    return out


def _data(seed, window):
    random = np.random.default_rng(seed)
    vocabulary = ["a", "bé", "c", "dd", "e!"]
    passages = [[f"p{i}", *random.choice(vocabulary, window + 15)] for i in range(4)]
    data = []
    for i in range(60):
        words = list(random.choice([f"w{k}" for k in range(500)], int(random.integers(0, 80))))
        for _ in range(int(random.integers(0, 4))):
            p = passages[int(random.integers(4))]
            a = int(random.integers(0, 10))
            at = int(random.integers(0, len(words) + 1))
            words[at:at] = p[a:a + window + int(random.integers(-3, 6))]
        data.append((int(random.integers(0, 10 ** 6)), words))
    data += [(5, data[3][1]), (10 ** 7, data[3][1]), (None, data[3][1]), (77, ["x"] * 70), (78, ["x"] * 30), (79, []), (3, list("ab" * 40)), (80, None)]
    return [*data, data[0], data[0]]


@pytest.mark.parametrize("window, seed", [(20, 1), (7, 2), (2, 3), (1, 4)])
def test_against_brute_force(spark, window, seed, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 3_000)
    data = _data(seed, window)
    want = brute([(k, w or []) for k, w in data], window)
    frame = spark.createDataFrame([(k, None if w is None else " \n".join(w), "x", f"n{i}") for i, (k, w) in enumerate(data)], SCHEMA)
    got = {int(r.note[1:]): r for r in repeats(frame, window=window).collect()}
    assert len(got) == len(data)
    for i, ((_, words), gone) in enumerate(zip(data, want)):
        words, r = words or [], got[i]
        assert (r.n_words, r.n_removed) == (len(words), gone.sum())
        assert re.findall(r"[^\x20\x09-\x0D]+", r.text or "") == [w for w, g in zip(words, gone) if not g]
        if not gone.any():
            assert r.text == (None if data[i][1] is None else " \n".join(words))


def test_white_space_around_a_cut(spark):
    p = " ".join(f"k{i}" for i in range(20))
    frame = spark.createDataFrame([(1, p), (2, f"  Head\n\n{p}\ttail  end \n"), (3, f"{p}\n")], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in repeats(frame).collect()} == {1: p, 2: "Head\n\ntail  end", 3: ""}


def test_empty_and_other_words(spark):
    assert repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"w {i} x" for i in range(25))
    got = repeats(spark.createDataFrame([(1, text), (2, text), (3, "long" * 30000)], "doc_id bigint, text string"))
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got.collect()} == {1: (25, 0), 2: (25, 25), 3: (1, 0)}


def test_planes():
    values = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 1000, dtype=np.uint64))
    assert (substrings.unplanes(substrings.planes(values), np.uint64) == values).all()
    assert not len(substrings.unplanes(substrings.planes(values[:0]), np.uint64))
