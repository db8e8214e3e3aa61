import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from anemora.llm import token_files
from anemora.llm.pieces import Memory, Rows, cut, default_path
from anemora.llm.queries import QUERIES

VOCABULARY = default_path("byte_bpe_50k.json")
ODD = ["a  b", " a", "  ", "  b", "x  b ", "it's, 'tis", "don't'x <|endoftext|>a", "a\n b\n\nc", "　x 　y", "é ́", "😀 😀!a", "", "A.B,C", "a  b",
       "a \x1cb x\x85 y", "l'été -'s", "1'll2 're", "x" * 5000, "…!?" * 40, "﻿a b"]


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("n", [0, 1, 5, 255, 256, 257, 5000])
@pytest.mark.parametrize("most", [2, 100, 32768, 50257, 1 << 32])
def test_words_round_trip(n, most):
    ids = np.random.default_rng(n).integers(0, most, n).astype(np.uint32)
    words, escapes, first_word, first_escape = token_files.pack(ids)
    assert (token_files.unpack(words, escapes) == ids).all()
    assert len(first_word) == len(first_escape) == -(-n // token_files.GROUP) + 1 and first_word[-1] == len(words) and first_escape[-1] == len(escapes)


def test_escapes_pay():
    """Rare large ids among small ones are escaped instead of widening their words."""
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 1000, 20_000).astype(np.uint32)
    ids[rng.integers(0, 20_000, 200)] = 50_000
    words, escapes, _, _ = token_files.pack(ids)
    assert len(escapes) > 100 and 64 * len(words) + 32 * len(escapes) < 13 * len(ids)
    assert (token_files.unpack(words, escapes) == ids).all()


def test_block_parts():
    """Any range of a block is decoded from the groups it lies in."""
    ids = np.random.default_rng(1).integers(0, 50_257, 3000).astype(np.uint32)
    block = token_files.Block(token_files.write_block(3, 1, 77, [5, None], np.array([1000, 2000]), ids))
    assert (block.file, block.number, block.before, block.keys, block.sizes.tolist()) == (3, 1, 77, [5, None], [1000, 2000])
    for a, b in [(0, 3000), (0, 0), (255, 257), (1000, 1001), (2999, 9000), (700, 600)]:
        assert block.ids(a, b).tolist() == ids[a:b].tolist()
    data = bytearray(token_files.write_block(0, 0, 0, [1], np.array([2]), np.array([1, 2])))
    data[-1] ^= 1
    with pytest.raises(ValueError):
        token_files.Block(bytes(data))


def test_pieces_do_not_change_ids(tokenizer):
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice(["a", "Zb", " ", "  ", "\n", "\t", "'s", ".", ",", "9", "é", " ", "的", " ", "-"]) for _ in range(60)) for _ in range(300)]
    sizes, ids = token_files.encode_texts(pa.array([*texts, None]), VOCABULARY, 2)
    ends = np.cumsum(sizes)
    for text, end, size in zip([*texts, None], ends.tolist(), sizes.tolist()):
        assert ids[end - size:end].tolist() == plain(tokenizer, text), text


def test_memory_forgets():
    memory = Memory(lambda pieces: [(np.array([len(p) for p in pieces for _ in range(2)]), np.full(len(pieces), 2))], [np.int64], limit=4)
    for batch in ([b"a", b"bb"], [b"a", b"ccc"], [b"dddd", b"eeeee", b"a"], [b"f", b"bb", b"a"], [b"a", b"g"]):
        rows, counts = memory.kinds[0].take(memory.find(batch))
        assert counts.tolist() == [2] * len(batch) and rows.reshape(-1, 2)[:, 0].tolist() == [len(p) for p in batch]
    assert len(memory.known) < 6
    rows = Rows(np.int32)
    rows.add(np.arange(2000), np.array([1999, 0, 1]))
    rows.keep(np.array([2, 1]))
    assert rows.take(np.array([0, 1]))[0].tolist() == [1999]


def test_cut_bounds():
    raw = np.frombuffer(b"a b  c'd" + b" e", np.uint8)
    bounds, first = cut(raw, np.array([0, 8, 8, 10]), marks=True)
    assert bounds.tolist() == [0, 1, 6, 8, 10] and first.tolist() == [0, 3, 3, 4]


SCHEMA = "doc_id long, text string, start string, key int"


def test_table(spark, tokenizer, tmp_path):
    """Ids come back in ascending key order; nulls, empty and repeated rows, extra columns, several blocks."""
    data = [(None, "null key", "x", 1), (3, None, "x", 1), (3, "", "x", 1), (-4, "first", "x", 1), (7, "same", None, 1), (7, "same", None, 1)]
    data += [(100 + i, t, "y", 2) for i, t in enumerate(ODD)] + [(50, "long " * 300_000, "z", None)]
    path = f"{tmp_path}/ids"
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    token_files.write(frame, path, VOCABULARY)
    ids = {}
    for r in token_files.documents(spark, path).collect():
        ids.setdefault(r.doc_id, []).append(r.ids)
    want = {}
    for k, text, _, _ in data:
        want.setdefault(k, []).append(plain(tokenizer, text))
    assert {k: sorted(v) for k, v in ids.items()} == {k: sorted(v) for k, v in want.items()}
    found = sorted(token_files.digests(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
        assert r.ids_crc32 in {zlib.crc32(np.array(v, "<u4").tobytes()) for v in want[r.doc_id]}
    keys = [r.doc_id for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(keys) == len(data)


def test_empty_table(spark, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    token_files.write(spark.createDataFrame([], SCHEMA), path, VOCABULARY)
    assert token_files.digests(spark, path).count() == 0


def test_query(spark, sf, tokenizer):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got, at = {r.doc_id: r for r in QUERIES["op13_simple8b_ids"](spark, sf).collect()}, 0
    for key, text in docs:
        ids = plain(tokenizer, text)
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
