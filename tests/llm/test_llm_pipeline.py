import re
from collections import Counter

import pytest

import corpus_pipeline
from anemora.llm.common import table
from test_llm_mixing import _targets
from test_llm_similar import brute as by_jaccard
from test_llm_substrings import brute

FOLDER = "/root/testdata/sf0.001"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output over documents with a few odd ones."""
    docs = table(spark, FOLDER, "documents")
    odd = spark.createDataFrame([(90001, None, "en", "src1", 0), (90002, "1 2 3", "en", None, 5), (None, "Is and retitioning ouen the of", None, None, 3)], docs.schema)
    docs, out, base = docs.union(odd), [], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{base}/{name}")
        made = spark.read.parquet(f"{base}/{name}")
        out.append((docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_columns(stages):
    assert all(columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, _, columns in stages[:-1])


def test_language_stage(stages):
    before, after, _ = stages[0]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {90001, 90002}
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if r.doc_id not in gone)


def test_near_duplicate_stage(stages):
    """The stage keeps what the Jaccard similarity of all pairs keeps: the least key of each component, and rows without key."""
    before, after, _ = stages[1]
    # Rows without key come last, so they never name a component.
    place = {i: (r.doc_id is None, r.doc_id or 0, i) for i, r in enumerate(before)}
    least = by_jaccard([(place[i], r.text) for i, r in enumerate(before)])
    want = [tuple(r) for i, r in enumerate(before) if r.doc_id is None or r.doc_id == least[place[i]][1]]
    assert Counter(map(tuple, after)) == Counter(want)
    assert len(after) < len(before)


def test_substring_stage(stages):
    before, after, _ = stages[2]
    flags = brute([(r.doc_id, _words(r.text)) for r in before], 20)
    want = {r.doc_id: [w for w, g in zip(_words(r.text), f) if not g] for r, f in zip(before, flags) if not len(f) or not f.all()}
    assert {r.doc_id: _words(r.text) for r in after} == want
    assert all(len(r.text) == r.n_chars for r in after if len(want[r.doc_id]) < len(_words({b.doc_id: b.text for b in before}[r.doc_id])))


def test_mix_stage(stages):
    before, after, _ = stages[3]
    sizes = Counter()
    for r in before:
        sizes[r.source] += len(_words(r.text))
    target = _targets(dict(sizes))
    copies = Counter(map(tuple, after))
    for r in before:
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(rate) <= copies[tuple(r)] <= int(rate) + 1
    assert set(copies) <= {tuple(r) for r in before}


def test_packing_stage(stages):
    before, after, _ = stages[4]
    assert Counter((r.doc_id, len(_words(r.text))) for r in before) == Counter((r.doc_id, r.n_tokens) for r in after)


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() > 0 and {"doc_id", "n_tokens", "bucket", "batch", "position"} <= set(got.columns)
