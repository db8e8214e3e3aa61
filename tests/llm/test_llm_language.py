from itertools import product

import numpy as np
import pytest

from anemora.llm import language

SCHEMA = "doc_id bigint, text string, lang string, score int, lang_pred int"


def _exact(potential, moves):
    n, k = potential.shape
    out = np.zeros((n, k))
    for path in product(range(k), repeat=n):
        weight = np.prod([potential[i, y] for i, y in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
        for i, y in enumerate(path):
            out[i, y] += weight
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("segment", [1, 2, 3, 32])
def test_marginals_against_enumeration(monkeypatch, segment):
    monkeypatch.setattr(language, "_SEGMENT", segment)
    random = np.random.default_rng(segment)
    counts = np.array([3, 0, 1, 7, 2, 5])
    potential, moves = random.random((counts.sum(), 3)) + 0.01, random.random((3, 3)) + 0.01
    got = language.marginals(potential, moves, counts)
    ends = np.cumsum(counts)
    for n, end in zip(counts, ends):
        if n:
            assert np.allclose(got[end - n:end], _exact(potential[end - n:end], moves))


def test_pair_sums_against_enumeration():
    random = np.random.default_rng(0)
    potential, moves = random.random((6, 3)) + 0.1, random.random((3, 3)) + 0.1
    follows = np.arange(6) > 0
    got = language._pair_sums(potential, moves, language.marginals(potential, moves, np.array([6])), follows)
    want, total = np.zeros((3, 3)), 0.0
    for path in product(range(3), repeat=6):
        weight = np.prod([potential[i, y] for i, y in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
        total += weight
        for a, b in zip(path, path[1:]):
            want[a, b] += weight
    assert np.allclose(got, want / total, rtol=0.02)


def test_held_out_accuracy_and_edges(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    out = language.held_out("doc_id", 4, 2)
    model = language.train(docs.where(~out))
    answers = language.identify(docs, model).where(out).collect()
    assert len(answers) > 30 and np.mean([r.lang == r.lang_pred for r in answers]) >= 0.97
    assert all(0 <= r.score <= 1 for r in answers)
    texts = {r.lang: r.text for r in answers if len(r.text) > 200 and r.lang == r.lang_pred}
    mixed = " ".join([*texts["en"].split()[:60], *texts["de"].split()[:20]])
    data = [(1, None, "x"), (2, "", "x"), (3, "12 ... !?", "x"), (4, "… — ’", "x"), (5, texts["fr"].upper(), "x"), (6, mixed, "x"), (7, texts["en"] * 300, "x"), (7, texts["en"] * 300, "x")]
    frame = spark.createDataFrame([(*d, 1, 2) for d in data], SCHEMA)
    got = {r.doc_id: r for r in language.identify(frame, model).collect()}
    assert [got[i].lang_pred for i in range(1, 8)] == ["und"] * 4 + ["fr", "en", "en"]
    assert got[1].score == 0 and 0.5 < got[6].score < 0.95
    kept = language.keep_identified(frame, model)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 7]
    shares, counts = model.shares(*__import__("anemora.llm.common", fromlist=["text_bytes"]).text_bytes(__import__("pyarrow").array([mixed])))
    assert counts[0] == sum(1 for w in __import__("re").split(r"[\W\d_]+", mixed) if w) or shares.shape[1] == len(model.labels)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = language.train(empty)
    assert model.labels == () and language.identify(empty, model).count() == 0
    assert language.identify(spark.createDataFrame([(1, "some text", None, None, None)], SCHEMA), model).first().lang_pred == "und"
    only = language.train(spark.createDataFrame([(1, "some text", "en", None, None), (2, "1 2", "de", None, None)], SCHEMA))
    assert only.labels == ("en",)


def test_short_marginals_agree():
    random = np.random.default_rng(1)
    counts = np.array([3, 1, 7, 2, 5])
    potential, moves = random.random((counts.sum(), 3)) + 0.01, random.random((3, 3)) + 0.01
    got, sums = language._short_marginals(potential, moves, counts)
    assert np.allclose(got, language.marginals(potential, moves, counts))
    want, begin = np.zeros((3, 3)), 0
    for n in counts:
        joint, total = np.zeros((3, 3)), 0.0
        for path in product(range(3), repeat=int(n)):
            weight = np.prod([potential[begin + i, y] for i, y in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
            total += weight
            for a, b in zip(path, path[1:]):
                joint[a, b] += weight
        want += joint / total
        begin += n
    assert np.allclose(sums, want)


def test_every_language_is_learned(spark):
    random, data = np.random.default_rng(8), []
    for k in range(70):
        words = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)]
        data += [(1000 * k + i, " ".join(random.choice(words, 40)), f"l{k:02}", 0, 0) for i in range(12 if k else 40)]
    frame = spark.createDataFrame(data, SCHEMA)
    model = language.train(frame)
    assert model.labels == tuple(f"l{k:02}" for k in range(70))
    assert np.mean([r.lang == r.lang_pred for r in language.identify(frame, model).collect()]) >= 0.97
