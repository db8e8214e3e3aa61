import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from anemora.llm import alignment
from anemora.llm.pieces import byte_level, default_path
from anemora.llm.queries import QUERIES

A, B = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")
ODD = ["a  b", " a", "  ", "it's, 'tis", "don't'x <|endoftext|>a <s></s>", "a\n b\n\nc", "　x 　y", "é ́", "😀 😀!a", "", "A.B,C", "a \x1cb x\x85 y", "x ▁y z", None, "▁",
       "a\x00b 的中文 字", "\U000e0001 z", "w" * 3000, "no break   wide", " \n"]


@pytest.fixture(scope="module")
def tokens():
    a, b, byte = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_level()
    a.encode_special_tokens = True

    def spelled(text):
        first = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        piece = b.id_to_piece
        return first, [(i, bytes([int(piece(i)[3:5], 16)]) if b.is_byte(i) else piece(i).replace("▁", " ").encode()) for i in b.encode(text)]

    return spelled


def brute(texts, tokens):
    """Walk both token lists from one common end to the next, each text as a whole."""
    parts = []
    for text in texts:
        if not text:
            parts.append(None)
            continue
        sides, whole = tokens(text), (" " + text).encode()
        if any(b"".join(t for _, t in side) != whole for side in sides):
            parts.append(None)
            continue
        ends = [np.cumsum([len(t) for _, t in side]).tolist() for side in sides]
        groups, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            group = []
            for k in (0, 1):
                stop = ends[k].index(end, at[k]) + 1
                group.append([i for i, _ in sides[k][at[k]:stop]])
                at[k] = stop
            groups.append(group)
        parts.append((groups, len(sides[0]), len(sides[1])))
    n = Counter((a[-1], b[-1]) for p in parts if p for a, b in p[0])
    most = {}
    for (_, b), c in n.items():
        most[b] = max(most.get(b, 0), c)
    for p in parts:
        if p is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        links = [(a[-1], b[-1]) for a, b in p[0]]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in p[0])
        yield (p[1], p[2], len(p[0]), len(links), sum(n[x] == most[x[1]] for x in links), sum(n[x] for x in links), hashlib.sha256(text.encode()).hexdigest())


def test_coalesce():
    start_a, end_a = np.array([0, 2, 5, 9]), np.array([2, 5, 9, 12])
    start_b, end_b = np.array([0, 3, 9, 10]), np.array([3, 9, 10, 12])
    order, is_b, group, breaks = alignment.coalesce(start_a, end_a, start_b, end_b)
    assert group.tolist() == [0, 0, 0, 0, 0, 1, 1, 1] and breaks.sum() == 2
    assert order.tolist() == [0, 4, 1, 5, 2, 6, 3, 7] and is_b.tolist() == [o > 3 for o in order]
    empty = np.zeros(0, np.int64)
    assert len(alignment.coalesce(empty, empty, empty, empty)[0]) == 0


def test_coalesce_is_common_ends():
    rng = np.random.default_rng(5)
    for _ in range(50):
        ends = [np.append(np.sort(rng.choice(np.arange(1, 60), rng.integers(1, 30), replace=False)), 60) for _ in range(2)]
        starts = [np.concatenate([[0], e[:-1]]) for e in ends]
        group = alignment.coalesce(starts[0], ends[0], starts[1], ends[1])[2]
        assert group[-1] + 1 == len(np.intersect1d(*ends))


@pytest.mark.parametrize("parts", [1, 5])
def test_against_brute_force(spark, sf, tokens, parts):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()] + ODD * 2
    frame = spark.createDataFrame([(i, t, "n", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, n_a string, extra double").repartition(parts)
    got = {r[0]: tuple(r)[1:] for r in alignment.align(frame, A, B).collect()}
    assert got == dict(enumerate(brute(texts, tokens)))


def test_edges(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(frame, A, B).columns == ["doc_id", *[c.split()[0] for c in alignment.COLUMNS.split(", ")]]
    assert alignment.align(frame, A, B).count() == 0
    odd = spark.createDataFrame([(None, None), ("k", "a b"), ("k", "a b")], "n_a string, text string")
    made = alignment.align(odd, A, B, key="n_a")
    rows = sorted(tuple(r) for r in made.collect() if r[0] == "k")
    assert rows[0] == rows[1] and rows[0][1] == 2 and rows[0][6] == 4 and made.columns[1] == "n_a"


def test_query(spark, sf, tokens):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = dict(zip([d for d, _ in docs], brute([t for _, t in docs], tokens)))
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op12_interval_coalescing"](spark, sf).collect()} == want
