"""Token ids in word-aligned binary files: Simple-8b words with escapes and offsets.

A table of ids is a folder of files; file k holds the documents of the k-th range of keys.
A file is a run of blocks, each ended by the folder's sync mark, so that readers split
files anywhere.  A block (little-endian) holds whole documents:

    header      see ``HEADER``: file and block number, ids before it in the file, sizes, checksum of what follows
    keys        int64 a document, then one byte a document that is 1 for a null key
    sizes       uint32 a document
    offsets     uint32 a group of ``GROUP`` ids: its first word, and its first escape; one entry more than groups
    words       uint64; the low 4 bits select how many ids of which width follow
    escapes     uint32, the ids that did not fit, in order

In a word of width w the value 2^w - 1 stands for the next escape.  Groups start on a word
of their own, so any range of ids is decoded without what lies before it.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemora.llm.common import slices, text_bytes
from anemora.llm.pieces import ByteBpe, Memory, cut, distinct, spread, sums, vocabulary
from anemora.session import checkpoint_ready

#: Ids of a group, and of a block (a longer document is a block of its own).
GROUP, BLOCK_IDS = 256, 1 << 20
#: (ids in a word, bits of each) by selector; the fewest bits first.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
#: An escape costs its own bits besides its place in the word.
ESCAPE_BITS = 32
#: magic, file, block, ids before in the file, documents, ids, groups, words, escapes, crc32 of the rest.
HEADER = struct.Struct("<4sIIQIQIIII")
MAGIC = b"S8BW"
#: Bytes of text in a piece of work.
TEXT_BYTES = 24 << 20

_COUNT = np.array([c for c, _ in PACKS], np.int64)
_WIDTH = np.array([w for _, w in PACKS], np.int64)


# --- the code ---


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, escapes, first word and first escape of each group (one entry more than groups).

    All groups advance together by a word: each picks the selector with the fewest bits per
    id, escapes included, among those that its remaining ids fill.  Then the words of a selector are filled at once.
    """
    n = len(ids)
    groups = -(-n // GROUP)
    ids = np.asarray(ids, np.uint32)
    # Selectors that cost half as much again as the best on average are not weighed; one of a single id fits every end of a group.
    over = [int((ids >= (1 << w) - 1).sum()) if w < 32 else 0 for w in _WIDTH.tolist()]
    mean = 64 / _COUNT + ESCAPE_BITS * np.array(over) / max(1, n)
    weighed = [s for s in range(len(PACKS)) if mean[s] <= 1.5 * mean.min() or _COUNT[s] == 1]
    span = n + 1 + int(_COUNT[0])
    rest = np.zeros((len(weighed), span), np.int32)
    for row, s in zip(rest, weighed):
        if over[s]:
            np.cumsum(ids >= (1 << PACKS[s][1]) - 1, dtype=np.int32, out=row[1:n + 1])
            row[n + 1:] = row[n]
    rest, counts, base = rest.ravel(), _COUNT[weighed][:, None], (np.arange(len(weighed)) * span)[:, None]
    ends = np.minimum((np.arange(groups, dtype=np.int64) + 1) * GROUP, n)
    at, live = np.arange(groups, dtype=np.int64) * GROUP, np.arange(groups)
    places, owner, selected = [], [], []
    while len(live):
        here = base + at
        escaped = rest[here + counts] - rest[here]
        cost = np.where(ends - at >= counts, (64 + ESCAPE_BITS * escaped) / counts, np.inf)
        best = np.argmin(cost, axis=0)
        places.append(at)
        owner.append(live)
        selected.append(best)
        at = at + counts[best, 0]
        stay = at < ends
        at, live, ends = at[stay], live[stay], ends[stay]
    if not places:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(1, np.uint32), np.zeros(1, np.uint32)
    places, owner, selected = np.concatenate(places), np.concatenate(owner), np.array(weighed)[np.concatenate(selected)]
    order = np.argsort(places)
    places, owner, selected = places[order], owner[order], selected[order]
    words, out = selected.astype(np.uint64), np.zeros(n, bool)
    for s in np.unique(selected).tolist():
        count, width = PACKS[s]
        rows = np.flatnonzero(selected == s)
        for k in range(count):
            values = ids[places[rows] + k].astype(np.uint64)
            most = np.uint64((1 << width) - 1)
            out[places[rows] + k] = values >= most
            words[rows] |= np.minimum(values, most) << np.uint64(4 + k * width)
    escaped, edges = np.flatnonzero(out), np.arange(groups + 1)
    return words, ids[escaped], np.searchsorted(owner, edges).astype(np.uint32), np.searchsorted(escaped // GROUP, edges).astype(np.uint32)


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of consecutive words, all words of a selector at once."""
    select = (words & np.uint64(15)).astype(np.int64)
    counts = _COUNT[select]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    marked = np.zeros(len(out), bool)
    for s in np.unique(select).tolist():
        count, width = PACKS[s]
        rows = np.flatnonzero(select == s)
        most = np.uint64((1 << width) - 1)
        values = (words[rows][:, None] >> (np.arange(count) * width + 4).astype(np.uint64)) & most
        places = starts[rows][:, None] + np.arange(count)
        out[places] = values
        marked[places] = values == most
    out[marked] = escapes
    return out.astype(np.uint32)


# --- blocks ---


def write_block(file: int, block: int, before: int, keys: Sequence[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    words, escapes, first_word, first_escape = pack(ids)
    null = np.array([k is None for k in keys], np.uint8)
    rest = b"".join(x.tobytes() for x in (
        np.array([0 if k is None else k for k in keys], "<i8"), null, sizes.astype("<u4"), first_word.astype("<u4"), first_escape.astype("<u4"),
        words.astype("<u8"), escapes.astype("<u4")))
    return HEADER.pack(MAGIC, file, block, before, len(keys), len(ids), len(first_word) - 1, len(words), len(escapes), zlib.crc32(rest)) + rest


class Block:
    """A block read back; ids are decoded when asked for."""

    def __init__(self, data: bytes):
        magic, self.file, self.number, self.before, docs, self.n_ids, groups, words, escapes, crc = HEADER.unpack_from(data)
        if magic != MAGIC or zlib.crc32(memoryview(data)[HEADER.size:]) != crc:
            raise ValueError("damaged block of token ids")
        at = HEADER.size

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        keys, null = part("<i8", docs), part("u1", docs)
        self.keys = [None if n else k for k, n in zip(keys.tolist(), null.tolist())]
        self.sizes = part("<u4", docs).astype(np.int64)
        self.first_word, self.first_escape = part("<u4", groups + 1), part("<u4", groups + 1)
        self.words, self.escapes = part("<u8", words), part("<u4", escapes)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start .. stop`` of the block; only the groups they lie in are decoded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // GROUP, -(-stop // GROUP)
        found = unpack(self.words[self.first_word[a]:self.first_word[b]], self.escapes[self.first_escape[a]:self.first_escape[b]])
        return found[start - a * GROUP:stop - a * GROUP]


# --- tables ---


def write(df: DataFrame, path: str, vocabulary_path: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending order of the key.

    Rows are dealt into ranges of the key, ties by the text's hash and then by arrival, so a key that
    many rows share is split; texts are shuffled, ids are not.  Spark's own writer commits the files, hence a
    lost task leaves none.  Nulls and empty texts have the end id alone; null keys come first; repeated rows
    are written as often as they come; an empty table is a folder without blocks; other columns are not read.
    A text of any length is one document; it must fit a task's memory.
    """
    mark = f"\n--{uuid.uuid4().hex}--\n"
    tie = F.monotonically_increasing_id()
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("turn"), tie.alias("tie"))
    dealt = rows.repartitionByRange("key", "turn", "tie").sortWithinPartitions("key", "turn", "tie").select("key", "text")
    blocks = dealt.mapInArrow(_encoder(vocabulary_path, end_id, mark.encode()), "block binary")
    spark = df.sparkSession
    blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", mark).text(path)
    spark.range(1).select(F.lit(mark[1:-1]).alias("value")).coalesce(1).write.text(f"{path}/_sync")


def _encoder(vocabulary_path: str, end_id: int, mark: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Blocks(TaskContext.get().partitionId(), mark)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                sizes, ids = encode_texts(part.column("text"), vocabulary_path, end_id)
                yield from made.add(part.column("key").to_pylist(), sizes, ids)
        yield from made.rest()

    return run


def encode_texts(texts: pa.Array, vocabulary_path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids per text (with the end id), and all ids."""
    raw, offsets = text_bytes(texts)
    bounds, first = cut(raw, offsets, marks=True)
    found, number = distinct(raw, bounds)
    rows, counts = remembered(vocabulary_path).kinds[0], np.zeros(0, np.int64)
    if found:
        number = remembered(vocabulary_path).find(found)[number]
        counts = rows.count[number]
    sizes = sums(counts, first)
    ends = np.cumsum(sizes + 1) - 1
    ids = np.full(int((sizes + 1).sum()), end_id, np.int32)
    inside = np.ones(len(ids), bool)
    inside[ends] = False
    if found:
        ids[inside] = rows.flat[spread(rows.start[number], counts)]
    return sizes + 1, ids


_REMEMBERED: dict[str, Memory] = {}


def remembered(path: str) -> Memory:
    if path not in _REMEMBERED:
        _REMEMBERED[path] = Memory(lambda pieces: [vocabulary(ByteBpe, path).encode(pieces)], [np.int32])
    return _REMEMBERED[path]


class Blocks:
    """Collects documents of a task and hands out full blocks."""

    def __init__(self, file: int, mark: bytes):
        self.file, self.mark, self.number, self.before = file, mark, 0, 0
        self.keys: list[int | None] = []
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(sizes)
        start = 0
        while start < len(keys):
            base = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, base + BLOCK_IDS - self.held, side="right"))
            if stop <= start:
                if self.held:
                    yield self._block()
                    continue
                stop = start + 1
            self.keys += keys[start:stop]
            self.sizes.append(sizes[start:stop])
            self.ids.append(ids[base:int(ends[stop - 1])])
            self.held += int(ends[stop - 1]) - base
            start = stop
            if self.held >= BLOCK_IDS:
                yield self._block()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.keys:
            yield self._block()

    def _block(self) -> pa.RecordBatch:
        data = write_block(self.file, self.number, self.before, self.keys, np.concatenate(self.sizes), np.concatenate(self.ids))
        if self.mark in data:
            raise ValueError("the sync mark occurs in the data; write again")
        self.number, self.before = self.number + 1, self.before + self.held
        self.keys, self.sizes, self.ids, self.held = [], [], [], 0
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["block"])


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a table, one row each."""
    mark = spark.read.text(f"{path}/_sync").first()[0]
    if not re.fullmatch(r"--[0-9a-f]{32}--", mark):
        raise ValueError(f"no sync mark in {path}")
    lines = spark.read.option("lineSep", f"\n{mark}\n").schema("value string").text(path)
    return lines.where(F.length("value") > 0).select(F.col("value").cast("binary").alias("block"))


def digests(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document, from the files.

    ``start`` counts the ids of all documents before it: those before it in its file, and those of the files before.
    The sums over files are one row a file.
    """
    checkpoint_ready(spark)
    found = blocks(spark, path).mapInArrow(_digests, "file long, key long, local long, n_tokens long, ids_crc32 long").checkpoint()
    per_file = found.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    base = per_file.select(F.col("file").alias("of"), (F.sum("ids").over(Window.orderBy("file")) - F.col("ids")).alias("base"))
    joined = found.join(base, F.col("file") == F.col("of"))
    return joined.select(F.col("key").alias(key), (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            block = Block(data.as_py())
            ends = np.cumsum(block.sizes)
            view = memoryview(block.ids().astype("<u4")).cast("B")
            crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip((ends - block.sizes).tolist(), ends.tolist())]
            n = len(crc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block.file, np.int64)), pa.array(block.keys, pa.int64()), pa.array(block.before + ends - block.sizes), pa.array(block.sizes), pa.array(crc, pa.int64())],
                ["file", "key", "local", "n_tokens", "ids_crc32"])


def documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key, ids`` of every document of a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                block = Block(data.as_py())
                ends = np.concatenate([[0], np.cumsum(block.sizes)])
                values = pa.array(block.ids().astype(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([pa.array(block.keys, pa.int64()), lists], ["key", "ids"])

    return blocks(spark, path).mapInArrow(run, "key long, ids array<long>").withColumnRenamed("key", key)
