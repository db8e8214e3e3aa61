"""Substring dedup: fixed-block anchors, rolling probes, exact maximal repeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import Words, free_name, mix, text_bytes

#: Bytes of text that one chunk of documents, and one bucket of hashes, holds on average.
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20

_CODE_BITS = 30
_LAST = np.iinfo(np.int64).max
_A, _B, _C = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive hashes."""
    if n == 1 or len(hashes) < n:
        return hashes[:max(0, len(hashes) - n + 1)]
    left = n // 2
    a, b = rolled(hashes, left), rolled(hashes, n - left)
    size = len(hashes) - n + 1
    return mix(a[:size] * _A + b[left:left + size])


def planes(values: np.ndarray) -> bytes:
    """Differences of ascending numbers, byte by byte apart; Spark's shuffle compresses the empty planes."""
    return _apart(np.diff(values, prepend=values.dtype.type(0)))


def _apart(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _together(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, len(data) // width).T).view(kind).ravel()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(_together(data, kind), dtype=kind)


def _bools(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


class Chunk:
    """The documents of one chunk in order of their keys, and their hashes."""

    def __init__(self, rows: pa.Table, key: str, text: str, window: int, buckets: int):
        self.rows = rows.take(pc.sort_indices(rows, sort_keys=[(key, "ascending")]))
        keys = self.rows.column(key).combine_chunks().cast(pa.int64())
        self.keyed = np.asarray(pc.is_valid(keys))
        self.keys = np.asarray(keys.fill_null(_LAST), dtype=np.int64)
        texts = self.rows.column(text).combine_chunks()
        self.words = Words(*text_bytes(texts))
        self.window, self.block, self.buckets = window, (window + 1) // 2, buckets
        self.hashes = self.words.hashes()
        self.doc = np.repeat(np.arange(len(self.keys)), self.words.counts)
        self.place = np.arange(len(self.words)) - self.words.first[:-1][self.doc]
        self.left = self.words.counts[self.doc] - self.place

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)

    def anchors(self):
        """Distinct hashes of all rolling blocks (bucket and code), whether one of them is a reference block, whether several agree; positions and codes of the reference blocks."""
        hashes = rolled(self.hashes, self.block)
        n = len(hashes)
        ok = (self.left[:n] >= self.block) & self.keyed[self.doc[:n]]
        code = self._bucket(hashes) << np.uint64(_CODE_BITS) | hashes & np.uint64((1 << _CODE_BITS) - 1)
        fixed = ok & (self.place[:n] % self.block == 0)
        ordered = np.sort(code[ok] << np.uint64(1) | fixed[ok])
        first, last = _runs(ordered >> np.uint64(1))
        distinct = ordered[first] >> np.uint64(1)
        is_block = (ordered[last - 1] & np.uint64(1)).astype(bool)
        at = np.flatnonzero(fixed)
        return distinct, is_block, last - first > 1, at, code[at]

    def candidates(self, hits: np.ndarray):
        """Windows whose reference blocks are all hit, by hash: ``(positions, hash, check, first of its hash, group)``."""
        distinct, is_block, _, at, code = self.anchors()
        missed = np.zeros(len(self.words) + 1, np.int64)
        if len(at):
            missed[at + 1] = ~hits[np.searchsorted(distinct[is_block], code)]
        missed = np.cumsum(missed)
        n = max(0, len(self.words) - self.window + 1)
        start = np.flatnonzero((self.left[:n] >= self.window) & self.keyed[self.doc[:n]])
        start = start[missed[start + self.window - self.block + 1] == missed[start]]
        part = self.window // 2
        b = rolled(self.hashes, self.window - part)[start + part]
        a = rolled(self.hashes, part)[start] if part else b
        hashes, check = mix(a * _A + b), mix(a * _B + b * _C).astype(np.uint16)
        earlier = np.lexsort((self.place[start], self.keys[self.doc[start]])) if self._repeats() else np.arange(len(start))
        order = earlier[np.argsort(hashes[earlier], kind="stable")]
        start, hashes, check = start[order], hashes[order], check[order]
        first, last = _runs(hashes, check)
        return start, hashes, check, first, np.repeat(np.arange(len(first)), last - first)

    def _repeats(self) -> bool:
        return bool((self.keys[1:] == self.keys[:-1]).any())

    def removed(self, hits: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
        """Which words a window covers that starts earlier, here or in another chunk."""
        start, _, _, first, group = self.candidates(hits)
        lead = start[first][group]
        later = (self.keys[self.doc[start]] != self.keys[self.doc[lead]]) | (self.place[start] != self.place[lead]) | elsewhere[group]
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, start[later], 1)
        np.add.at(edge, start[later] + self.window, -1)
        return np.cumsum(edge[:-1]) > 0

    def kept(self, removed: np.ndarray) -> list[bytes]:
        """The texts without the removed words and the white space after them; untouched texts as they were."""
        words, out = self.words, []
        raw = words.raw.tobytes()
        gone = np.concatenate([[0], np.cumsum(removed)])
        for d in range(len(self.keys)):
            a, b = int(words.first[d]), int(words.first[d + 1])
            low, high = int(words.offsets[d]), int(words.offsets[d + 1])
            if gone[a] == gone[b]:
                out.append(raw[low:high])
                continue
            stay = np.flatnonzero(~removed[a:b]) + a
            if not len(stay):
                out.append(b"")
                continue
            breaks = np.flatnonzero(np.diff(stay) > 1)
            begin, end = stay[np.concatenate([[0], breaks + 1])], stay[np.concatenate([breaks, [len(stay) - 1]])]
            ends = [int(words.start[e + 1]) if e + 1 < b else high for e in end.tolist()]
            out.append(b"".join(raw[int(words.start[s]):e] for s, e in zip(begin.tolist(), ends)).rstrip(b"\t\n\v\f\r "))
        return out


def _runs(*values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of equal neighbours."""
    n = len(values[0])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for v in values:
        new[1:] |= v[1:] != v[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], n)


def _table(schema: pa.Schema, columns: dict) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_PROBES = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("code", pa.binary()), ("is_block", pa.binary()), ("several", pa.binary())])
_HITS = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("hits", pa.binary())])
_WINDOWS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("hits", pa.binary()),
                      ("hash", pa.binary()), ("check", pa.binary()), ("key", pa.binary())])
_VERDICT = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("hits", pa.binary()), ("m", pa.int32()), ("earlier", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)


def repeats(df: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame with repeated passages cut out of ``text``, and ``n_words`` and ``n_removed``.

    A word is removed if a run of ``window`` words that covers it also starts earlier: under a
    smaller key, or under the same key at a smaller word position.  Runs are judged on the input.
    Texts without such a run stay byte for byte; others lose the words and the white space after them.

    Documents are dealt into chunks by key.  (1) Non-overlapping blocks of half a window are the index; all
    rolling blocks probe it, both as 30-bit codes inside hash buckets, each code once per chunk, so a passage in a third of all documents costs
    one code per chunk.  Every window holds a whole block of its own document, so a window can only repeat if all its
    blocks were hit.  (2) Such windows meet by an 80-bit hash, again once per chunk, and each bucket says whose is the
    earliest.  (3) The chunk extends the repeated windows to maximal runs and cuts them.
    The three steps share one shuffle of the texts.

    ``key`` is an integral column.  Rows without key have no place in the order: they stay whole and remove nothing.  Rows
    that repeat a key are one document at equal positions.  Null texts have no words and stay null; no rows
    give no rows.  Columns named ``n_words`` or ``n_removed`` are replaced, others are carried along.
    """
    df = df.drop("n_words", "n_removed")
    spark = df.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks, buckets = (max(shuffles, -(-size // each)) for each in (CHUNK_BYTES, BUCKET_BYTES))
    at = free_name(df, "__chunk")
    spread = F.when(F.col(key).isNull(), F.xxhash64(F.substring(text, 1, 64), F.octet_length(text))).otherwise(F.xxhash64(key))
    docs = df.withColumn(at, F.pmod(spread, F.lit(chunks)).cast("int"))

    def chunk_of(rows: pa.Table) -> tuple[int, Chunk]:
        return rows.column(at)[0].as_py(), Chunk(rows, key, text, window, buckets)

    def parts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        return [(b, int(edge[b]), int(edge[b + 1])) for b in range(buckets)]

    def probe(rows: pa.Table) -> pa.Table:
        number, chunk = chunk_of(rows)
        distinct, is_block, several, _, _ = chunk.anchors()
        code = (distinct & np.uint64((1 << _CODE_BITS) - 1)).astype(np.uint32)
        used = [p for p in parts(distinct >> np.uint64(_CODE_BITS)) if p[1] < p[2]]
        return _table(_PROBES, {
            "bucket": [b for b, _, _ in used], "chunk": [number] * len(used), "code": [planes(code[i:j]) for _, i, j in used],
            "is_block": [np.packbits(is_block[i:j]).tobytes() for _, i, j in used], "several": [np.packbits(several[i:j]).tobytes() for _, i, j in used]})

    def meet(rows: pa.Table) -> pa.Table:
        codes = [unplanes(x, np.uint32) for x in rows.column("code").to_pylist()]
        ordered = np.sort(np.concatenate(codes))
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        out = {"chunk": rows.column("chunk").to_pylist(), "bucket": rows.column("bucket").to_pylist(), "n": [], "hits": []}
        for code, block, several in zip(codes, rows.column("is_block").to_pylist(), rows.column("several").to_pylist()):
            block = _bools(block, len(code))
            mine = code[block]
            found = np.searchsorted(twice, mine)
            hit = _bools(several, len(code))[block] | ((found < len(twice)) & (twice[np.minimum(found, len(twice) - 1)] == mine) if len(twice) else False)
            out["n"].append(len(mine))
            out["hits"].append(np.packbits(hit).tobytes())
        return _table(_HITS, out)

    def in_order(answers: pa.Table, n: str, bits: str) -> np.ndarray:
        found = sorted(zip(answers.column("bucket").to_pylist(), answers.column(n).to_pylist(), answers.column(bits).to_pylist()))
        return np.concatenate([np.zeros(0, bool), *[_bools(x, k) for _, k, x in found if k]])

    def look(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if rows.num_rows == 0:
            return _WINDOWS.empty_table()
        number, chunk = chunk_of(rows)
        start, hashes, check, first, _ = chunk.candidates(in_order(answers, "n", "hits"))
        hashes, check, owner = hashes[first], check[first], chunk.keys[chunk.doc[start[first]]]
        hits = {b: (n, x) for b, n, x in zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "hits")))}
        used = [p for p in parts(chunk._bucket(hashes)) if p[1] < p[2] or p[0] in hits]
        return _table(_WINDOWS, {
            "bucket": [b for b, _, _ in used], "chunk": [number] * len(used), "n": [hits.get(b, (0, b""))[0] for b, _, _ in used],
            "hits": [hits.get(b, (0, b""))[1] for b, _, _ in used], "hash": [planes(hashes[i:j]) for _, i, j in used],
            "check": [_apart(check[i:j]) for _, i, j in used], "key": [_apart(owner[i:j]) for _, i, j in used]})

    def judge(rows: pa.Table) -> pa.Table:
        hashes, check, owner = (
            [f(x) for x in rows.column(c).to_pylist()]
            for c, f in (("hash", lambda x: unplanes(x, np.uint64)), ("check", lambda x: _together(x, np.uint16)), ("key", lambda x: _together(x, np.int64))))
        sizes = [len(x) for x in hashes]
        h, c, k = np.concatenate(hashes), np.concatenate(check), np.concatenate(owner)
        order = np.lexsort((k, c, h))
        first, last = _runs(h[order], c[order])
        late = np.zeros(len(h), bool)
        late[order] = k[order] > np.repeat(k[order][first], last - first)
        cuts = np.split(late, np.cumsum(sizes)[:-1])
        return _table(_VERDICT, {
            **{c: rows.column(c).to_pylist() for c in ("chunk", "bucket", "n", "hits")}, "m": sizes, "earlier": [np.packbits(x).tobytes() for x in cuts]})

    def cut(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if rows.num_rows == 0:
            return rows.drop_columns([at]).append_column("n_words", pa.array([], pa.int64())).append_column("n_removed", pa.array([], pa.int64()))
        _, chunk = chunk_of(rows)
        removed = chunk.removed(in_order(answers, "n", "hits"), in_order(answers, "m", "earlier"))
        gone = np.concatenate([[0], np.cumsum(removed)])
        first = chunk.words.first
        column = chunk.rows.column(text)
        texts = pa.array(chunk.kept(removed), pa.binary()).cast(column.type)
        texts = pc.if_else(pc.is_valid(column.combine_chunks()), texts, pa.scalar(None, column.type))
        out = chunk.rows.set_column(chunk.rows.column_names.index(text), text, texts).drop_columns([at])
        return (
            out.append_column("n_words", pa.array(chunk.words.counts.astype(np.int64)))
            .append_column("n_removed", pa.array((gone[first[1:]] - gone[first[:-1]]).astype(np.int64))))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", n_words bigint, n_removed bigint"
    hits = docs.groupBy(at).applyInArrow(probe, _ddl(_PROBES)).groupBy("bucket").applyInArrow(meet, _ddl(_HITS))
    windows = docs.groupBy(at).cogroup(hits.groupBy("chunk")).applyInArrow(look, _ddl(_WINDOWS))
    verdict = windows.groupBy("bucket").applyInArrow(judge, _ddl(_VERDICT))
    return docs.groupBy(at).cogroup(verdict.groupBy("chunk")).applyInArrow(cut, schema)
