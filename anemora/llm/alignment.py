"""Two tokenizers' tokens of the same text, aligned by interval coalescing over byte ranges.

Both tokenizers cut a text before a lone space that something solid follows
(``pieces.cut``), so the tokens of a piece depend on the piece alone: every distinct piece
is encoded and coalesced once per worker, and a document is the sequence of its pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import free_name, slices, text_bytes
from anemora.llm.pieces import ByteBpe, Memory, PieceBpe, cut, distinct, spread, sums, vocabulary

#: Bytes of text in a piece of work.
TEXT_BYTES = 4 << 20
#: Pieces a worker remembers of this kind.
REMEMBERED = 150_000

COLUMNS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of all tokens (A's first, then B's), which of them are B's, their groups in that order, and where groups break.

    Tokens are sorted by start; a group breaks where a start reaches the largest end before
    it, and what overlaps stays in the group.  Tokens of no bytes belong to the group that follows.
    """
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    kind = np.zeros(len(start), np.int8)
    kind[len(start_a):] = 1
    order = np.lexsort((kind, end, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    return order, kind[order] == 1, np.cumsum(breaks) - 1, breaks


class Aligner:
    """Rows of new pieces: facts (tokens of A, of B, groups; -1 where the bytes differ), links as pair numbers, group text."""

    def __init__(self, path_a: str, path_b: str, limit: int = REMEMBERED):
        self.a, self.b = vocabulary(ByteBpe, path_a), vocabulary(PieceBpe, path_b)
        self.pairs: dict[int, int] = {}
        self.memory = Memory(self._build, [np.int64, np.int32, np.uint8], limit)
        self.digits = pa.array([str(i).encode() for i in range(max(len(self.a.token), len(self.b.token)))], pa.large_binary())
        self.spelled = [_flat(v.token) for v in (self.a, self.b)]

    def _build(self, pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        raw, sizes = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces], np.int64)
        first = np.cumsum(sizes) - sizes
        made = [v.encode(pieces) for v in (self.a, self.b)]
        good = np.ones(len(pieces), bool)
        for (ids, counts), v, (text, place) in zip(made, (self.a, self.b), self.spelled):
            spelled = sums(v.size[ids], np.concatenate([[0], np.cumsum(counts)]))
            good &= spelled == sizes
            same = np.flatnonzero(spelled == sizes)
            mine = np.repeat(spelled == sizes, counts)
            found = text[spread(place[ids[mine]], v.size[ids[mine]])]
            wrong = np.concatenate([[0], np.cumsum(found != raw[spread(first[same], sizes[same])])])
            ends = np.cumsum(sizes[same])
            good[same] &= wrong[ends] == wrong[ends - sizes[same]]
        tokens, starts, ends, owners = [], [], [], []
        for (ids, counts), v in zip(made, (self.a, self.b)):
            inside = np.repeat(good, counts)
            owner = np.repeat(np.arange(len(pieces)), counts)[inside]
            kept = ids[inside]
            size = v.size[kept]
            end = np.cumsum(size)
            shift = np.cumsum(np.where(good, sizes, 0)) - np.where(good, sizes, 0) - first
            tokens.append(kept)
            ends.append(end - shift[owner])
            starts.append(end - size - shift[owner])
            owners.append(owner)
        order, is_b, group, breaks = coalesce(starts[0], ends[0], starts[1], ends[1])
        token, owner = np.concatenate(tokens)[order], np.concatenate(owners)[order]
        # A's tokens of a group come before B's.
        order = np.lexsort((is_b, group))
        token, owner, is_b, group = token[order], owner[order], is_b[order], group[order]
        many = np.bincount(owner[np.flatnonzero(breaks)], minlength=len(pieces)) if len(owner) else np.zeros(len(pieces), np.int64)
        facts = np.where(good, np.stack([np.bincount(o, minlength=len(pieces)) for o in owners] + [many]), -1)
        common, in_a, in_b = np.intersect1d(ends[0], ends[1], assume_unique=True, return_indices=True)
        packed = tokens[0][in_a].astype(np.int64) << 32 | tokens[1][in_b].astype(np.int64)
        links = np.bincount(owners[0][in_a], minlength=len(pieces))
        text, lengths = self._text(token, owner, is_b, group, len(pieces))
        three = np.full(len(pieces), 3)
        return [(facts.T.ravel(), three), (self._numbers(packed), links), (text, lengths)]

    def _numbers(self, packed: np.ndarray) -> np.ndarray:
        values, back = np.unique(packed, return_inverse=True)
        known = self.pairs
        numbers = np.fromiter((known.setdefault(p, len(known)) for p in values.tolist()), np.int32, len(values))
        return numbers[back]

    def _text(self, token: np.ndarray, owner: np.ndarray, is_b: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;`` of every group, the groups of a piece joined."""
        if not len(token):
            return np.zeros(0, np.uint8), np.zeros(n, np.int64)
        follows = np.zeros(len(token), np.int8)  # 0: a new group, 1: B's tokens, 2: another of the same
        follows[:-1] = np.where(group[1:] != group[:-1], 0, np.where(is_b[1:] != is_b[:-1], 1, 2))
        marks = pa.array([b";", b"|", b","], pa.large_binary()).take(pa.array(follows))
        joined = pc.binary_join_element_wise(self.digits.take(pa.array(token)), marks, pa.scalar(b"", pa.large_binary()))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
        edges = np.searchsorted(owner, np.arange(n + 1))
        return np.frombuffer(joined.buffers()[2], np.uint8)[ends[0]:ends[-1]], np.diff(ends[edges])


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """A worker's aligner, kept for all its tasks."""
    return Aligner(path_a, path_b)


class Texts:
    """Some texts as pieces: row numbers, the first piece of each text, and which texts have tokens."""

    def __init__(self, texts: pa.Array, made: Aligner):
        spaced = pc.binary_join_element_wise(pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string()), texts.cast(pa.large_string()),
                                             pa.scalar("", pa.large_string()))
        raw, offsets = text_bytes(spaced)
        bounds, self.first = cut(raw, offsets)
        found, number = distinct(raw, bounds)
        self.rows = made.memory.find(found) if found else np.zeros(0, np.int64)
        self.facts = made.memory.kinds[0].take(self.rows)[0].reshape(-1, 3)
        self.number = number
        self.whole = (sums((self.facts[:, 0] < 0).astype(np.int64)[number], self.first) == 0) & (np.diff(self.first) > 0)


def pair_counts(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``a, b, n``: how many links of the whole table hold each pair of ids.

    Every task sums by pair before the shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, total = aligner(path_a, path_b), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                texts = Texts(part.column("text"), made)
                live = np.repeat(texts.whole, np.diff(texts.first))
                times = np.bincount(texts.number[live], minlength=len(texts.rows))
                links, counts = made.memory.kinds[1].take(texts.rows)
                if len(total) < len(made.pairs):
                    total = np.concatenate([total, np.zeros(len(made.pairs) - len(total), np.int64)])
                total += np.bincount(links, np.repeat(times, counts), minlength=len(total)).astype(np.int64)
        some = np.flatnonzero(total)
        packed = np.fromiter(made.pairs, np.int64, len(made.pairs))[some]
        for at in range(0, len(some), 65_536):
            p = packed[at:at + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(p >> 32), pa.array(p & 0xFFFFFFFF), pa.array(total[some[at:at + 65_536]])], ["a", "b", "n"])

    counted = df.select(F.col(text).alias("text")).mapInArrow(run, "a long, b long, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def align(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the columns ``COLUMNS`` of every row.

    The table of pair counts goes to all workers.  Two ids are linked only where their
    tokens end together, so the shorter token's bytes end the longer's: a vocabulary pair has at
    most (bytes of all its tokens) times (ids that spell the same bytes) pairs, about a
    million for vocabularies of 50,000 and 32,000 ids, whatever the size of the corpus.

    Null and empty texts, and those that either tokenizer does not spell (a literal U+2581), have zeros and
    an empty digest; repeated rows count as often as they come; a text of any length is one row; an empty table
    gives none; other columns are not read, and a key named like a result column keeps its values under a free name.
    """
    rows = pair_counts(df, path_a, path_b, text).toArrow()
    columns = [rows.column(c).to_numpy() for c in ("a", "b", "n")]
    packed = columns[0] << 32 | columns[1]
    order = np.argsort(packed)
    packed, n, b = packed[order], columns[2][order], columns[1][order]
    most = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
    np.maximum.at(most, b, n)
    table = df.sparkSession.sparkContext.broadcast((packed, n, n == most[b] if len(b) else np.zeros(0, bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(path_a, path_b)
        packed, n, best = table.value
        count, first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                texts = Texts(part.column("text"), made)
                if len(count) < len(made.pairs):
                    mine = np.fromiter(made.pairs, np.int64, len(made.pairs))
                    at = np.minimum(np.searchsorted(packed, mine), max(0, len(packed) - 1))
                    known = packed[at] == mine if len(packed) else np.zeros(len(mine), bool)
                    count, first = (np.where(known, x[at] if len(packed) else 0, 0).astype(np.int64) for x in (n, best))
                links, counts = made.memory.kinds[1].take(texts.rows)
                edges = np.concatenate([[0], np.cumsum(counts)])
                per_piece = [*texts.facts.T, counts, sums(first[links], edges), sums(count[links], edges)]
                out = [np.where(texts.whole, sums(x[texts.number], texts.first), 0) for x in per_piece]
                yield pa.RecordBatch.from_arrays([part.column("key"), *map(pa.array, out), pa.array(_digests(texts, made))], names)

    names = ["key", *[c.split()[0] for c in COLUMNS.split(", ")]]
    kind = dict(df.dtypes)[key]
    made = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, {COLUMNS}")
    return made.withColumnRenamed("key", key if key not in names[1:] else free_name(made, key))


def _digests(texts: Texts, made: Aligner) -> list[str]:
    """SHA-256 of every text's groups; empty without tokens."""
    flat, counts = made.memory.kinds[2].take(texts.rows)
    place, edges = np.cumsum(counts) - counts, texts.first.tolist()
    out = []
    for i, whole in enumerate(texts.whole.tolist()):
        if not whole:
            out.append("")
            continue
        pieces = texts.number[edges[i]:edges[i + 1]]
        text = flat[spread(place[pieces], counts[pieces])]
        out.append(hashlib.sha256(memoryview(text)[:-1]).hexdigest())
    return out
