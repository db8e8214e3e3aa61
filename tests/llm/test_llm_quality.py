import numpy as np
import pyarrow as pa

from anemora.llm import quality
from anemora.llm.common import text_bytes
from anemora.llm.language import held_out

SCHEMA = "doc_id bigint, text string, score int"


def test_prior_and_risk_on_known_mixtures():
    random = np.random.default_rng(1)
    for prior in (0.3, 0.7):
        positive = random.normal(1.5, 1, (3000, 4))
        n = int(4000 * prior)
        unlabelled = np.concatenate([random.normal(1.5, 1, (n, 4)), random.normal(-1.5, 1, (4000 - n, 4))])
        model = quality.fit(positive.astype(np.float32), unlabelled.astype(np.float32))
        assert abs(model.prior - prior) < 0.08
        fresh = np.concatenate([random.normal(1.5, 1, (1000, 4)), random.normal(-1.5, 1, (1000, 4))])
        assert np.mean((model.score(fresh) >= 0.5) == (np.arange(2000) < 1000)) > 0.95


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = held_out("doc_id", 3, 1)
    model = quality.train(docs, labels, ~out)
    got = quality.score(docs, model).where(out).join(labels, "doc_id").collect()
    assert len(got) > 80 and np.mean([(r.score >= 0.5) == (r.quality == 1) for r in got]) >= 0.93
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    data = [(1, None, 5), (2, "", 5), (3, "word " * 60000, 5), (4, "a", 5), (4, "a", 5)]
    frame = spark.createDataFrame(data, SCHEMA)
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (None, 1, 0), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(frame, labels, frame.doc_id.isNotNull())
    got = {r.doc_id: r.score for r in quality.score(frame, model).collect()}
    assert len(got) == 4 and got[1] == got[2] and all(0 <= s <= 1 for s in got.values())
    none = quality.train(frame.limit(0), labels.limit(0), frame.doc_id.isNotNull())
    assert quality.score(frame, none).count() == 5 and quality.score(frame.limit(0), none).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["One two. One two.\nOne two.", None, "", "é#$%", "A|B|C\n\nA|B|C"]
    whole = quality.features(*text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], quality.features(*text_bytes(pa.array([t], pa.string())))[0], atol=1e-6)
