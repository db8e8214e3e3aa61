"""Near-duplicates by SimHash: its partition search and wider tables propose, the exact Jaccard similarity of word shingles decides."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import components, local_forest, mix, slices, text_bytes
from anemora.llm.simhash import BUCKET_ROWS, _majority, _signed, probes, shingle_hashes
from anemora.session import checkpoint_ready

#: Words of a shingle, and the least similarity of near-duplicates as a fraction.
SHINGLE, SIMILAR = 5, (4, 5)
#: Bits of a fingerprint; candidates differ in at most ``REACH`` of them.  Sets of Jaccard similarity 0.8 have a cosine of 0.889, so a bit differs
#: with probability ``APART`` and 19.4 bits do on average; 28 or fewer in 98 of 100 pairs.
BITS, REACH, APART = 128, 28, 0.1515
#: Bits of the first half in which SimHash's own search finds every pair; its probes grow too fast for ``REACH``.
NEAREST = 3
#: Share of the pairs at similarity 0.8 that lie within reach and meet in a bucket of some table, and rows of a bucket on average.
RECALL, ROWS = 0.95, 256
#: Shingles of a block of texts that are verified against another block in one task.
BLOCK_SHINGLES = 2_000_000
#: Rows of a list of wanted texts up to which it is sent to all executors.
BROADCAST_ROWS = 2_000_000


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles."""
    sets = [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    some, counts, hashes = shingle_hashes(raw, offsets, SHINGLE, 42)
    ends = np.cumsum(counts)
    for d, a, b in zip(some.tolist(), (ends - counts).tolist(), ends.tolist()):
        sets[d] = np.unique(hashes[a:b])
    return sets


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number that names each set, and its fingerprint's two halves; sets without shingles have the fingerprint 0."""
    nodes = np.fromiter((xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets))
    high, low = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    counts = np.array([len(s) for s in sets], np.int64)
    some = np.flatnonzero(counts)
    if len(some):
        hashes = np.concatenate([sets[i] for i in some])
        high[some], low[some] = _majority(hashes, counts[some]), _majority(mix(hashes), counts[some])
    return nodes, high, low


def _sketched(df: DataFrame, key: str | None, text: str, whole: bool) -> DataFrame:
    """``node, high, low`` of every row's text, with the key and a mark of the text, or with the hashes of the shingles."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                sets = shingle_sets(*text_bytes(piece.column("text")))
                made = [pa.array(x.view(np.int64)) for x in sketches(sets)]
                if whole:
                    more, names = [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["hashes"]
                else:
                    more, names = [piece.column("key"), piece.column("mark")], ["key", "mark"]
                yield pa.RecordBatch.from_arrays([*made, *more], ["node", "high", "low", *names])

    if whole:
        return df.select(F.col(text).alias("text")).mapInArrow(work, "node bigint, high bigint, low bigint, hashes array<bigint>")
    kind = df.select(key).dtypes[0][1]
    return df.select(F.col(key).alias("key"), F.col(text).alias("text"), _mark(text).alias("mark")).mapInArrow(
        work, f"node bigint, high bigint, low bigint, key {kind}, mark bigint")


def _mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


# --- candidates ---


def tables(rows: int, seed: int = 7) -> list[tuple[int, int]]:
    """Masks over both halves of a fingerprint, one a table: more bits for more rows, and as many tables as ``RECALL`` takes."""
    bits = max(0, min(BITS // 2, round(log2(max(rows, 1) / ROWS))))
    # Tables are drawn from the same bits, so recall is summed over the number of bits that differ.
    differ = np.arange(REACH + 1)
    chance = np.array([comb(BITS, d) * APART ** d * (1 - APART) ** (BITS - d) for d in differ.tolist()])
    miss = 1 - np.array([comb(BITS - d, bits) / comb(BITS, bits) for d in differ.tolist()])
    count = next(n for n in range(1, 1 << 20) if (chance * (1 - miss ** n)).sum() >= RECALL)
    random, out = np.random.default_rng(seed), []
    for _ in range(count):
        mask = sum(1 << int(b) for b in random.choice(BITS, bits, replace=False))
        out.append((_signed(mask >> 64), _signed(mask & ((1 << 64) - 1))))
    return out


def _near(high: np.ndarray, low: np.ndarray, block: np.ndarray, single: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``REACH``, in pieces; of two blocks only pairs between them."""
    step = max(1, (1 << 18) // max(1, len(high)))
    for i in range(0, len(high), step):
        apart = np.bitwise_count(high[i:i + step, None] ^ high[None, i:]) + np.bitwise_count(low[i:i + step, None] ^ low[None, i:])
        a, b = np.nonzero(apart <= REACH)
        keep = a < b
        if not single:
            keep &= block[i:][a] != block[i:][b]
        yield a[keep] + i, b[keep] + i


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out_a, out_b = [], []
        columns = [batch.column(i) for i in range(4)]
        for r, single in enumerate(batch.column(4).to_pylist()):
            node, high, low, block = (np.asarray(c[r].values) for c in columns)
            a = b = np.zeros(0, np.int64)
            for more_a, more_b in _near(high.view(np.uint64), low.view(np.uint64), block, single):
                a, b = local_forest(np.concatenate([a, more_a]), np.concatenate([b, more_b]), len(node))
            out_a.append(node[a])
            out_b.append(node[b])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])


def candidates(classes: DataFrame, rows: int) -> DataFrame:
    """Links ``(a, b)`` that keep the components of the pairs that share a bucket and differ in at most ``REACH`` bits.

    Buckets are those of the tables and those of SimHash's partitions and probes, in which all pairs meet whose first halves differ in at
    most ``NEAREST`` bits.
    """
    nearest, _ = probes(classes.select(F.col("high").alias("fingerprint")), NEAREST)
    masks = {m: -1 - i for i, m in enumerate(dict.fromkeys(m for m, _, _ in nearest))}
    places = [(t, h, x, 0) for t, (h, x) in enumerate(tables(rows))] + [(masks[m], m, 0, flip) for m, flip, _ in nearest]
    long = lambda x, name: F.lit(x).cast("long").alias(name)
    table = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), long(h, "h"), long(x, "l"), long(flip, "x")) for t, h, x, flip in places]))
    shape = F.col("high").bitwiseXOR(F.col("m.x")).bitwiseAND(F.col("m.h"))
    dealt = classes.select("node", "high", "low", table.alias("m")).select(
        "node", "high", "low", F.col("m.t").alias("t"), F.xxhash64(shape, F.col("low").bitwiseAND(F.col("m.l"))).alias("value"))
    hot = dealt.groupBy("t", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS)
    hot = hot.select(F.col("t").alias("_t"), F.col("value").alias("_value"), F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("blocks")).checkpoint()
    if hot.isEmpty():
        near = dealt.withColumn("block", F.lit(0)).withColumn("other", F.lit(0))
    else:
        near = dealt.join(hot, (F.col("t") == F.col("_t")) & (F.col("value") == F.col("_value")), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        near = near.withColumn("block", F.pmod("node", F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = near.groupBy("t", "value", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).agg(
        *[F.collect_list(c).alias(c) for c in ("node", "high", "low", "block")]).where(F.size("node") > 1)
    return lists.select("node", "high", "low", "block", (F.col("lo") == F.col("hi")).alias("single")).mapInArrow(_propose, "a bigint, b bigint")


# --- verification ---


def _verify(rows: pa.Table) -> pa.Table:
    """Links of a spanning forest of the similar pairs between two blocks (or in one); rows of one group are linked already."""
    node, block = (rows.column(c).to_numpy() for c in ("node", "block"))
    high, low = (rows.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
    group = np.unique(rows.column("group").to_numpy(), return_inverse=True)[1]
    hashes = rows.column("hashes").combine_chunks()
    hashes = hashes.chunk(0) if isinstance(hashes, pa.ChunkedArray) else hashes
    sets = [np.asarray(h.values) for h in hashes]
    size = np.array([len(s) for s in sets])
    root = list(range(int(group.max(initial=0)) + 1))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out_a, out_b = [], []
    for a, b in _near(high, low, block, rows.column("single")[0].as_py()):
        keep = (group[a] != group[b]) & (SIMILAR[1] * np.minimum(size[a], size[b]) >= SIMILAR[0] * np.maximum(size[a], size[b]))
        for i, j in zip(a[keep].tolist(), b[keep].tolist()):
            x, y = top(group[i]), top(group[j])
            if x == y:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if SIMILAR[1] * both >= SIMILAR[0] * (size[i] + size[j] - both):
                root[x] = y
                out_a.append(node[i])
                out_b.append(node[j])
    return pa.table([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def verified(members: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that keep the components of the similar pairs within ``REACH`` in each candidate component.

    All texts are compared with the component's least node first.  Where that links all, nothing is left; the others' components
    are compared block by block, except pairs that this links already.
    """
    lead = members.where("node = component").select(F.col("component").alias("of"), F.col("hashes").alias("lead"))
    both = F.size(F.array_intersect("hashes", "lead"))
    linked = SIMILAR[1] * both >= SIMILAR[0] * (F.size("hashes") + F.size("lead") - both)
    starred = members.join(lead, F.col("component") == F.col("of")).withColumn("linked", linked).drop("of", "lead").checkpoint()
    left = starred.groupBy("component").agg(F.sum(F.size("hashes") + 1).alias("size"), F.min("linked").alias("all")).where(~F.col("all"))
    left = left.select(F.col("component").alias("of"), F.ceil(F.col("size") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    dealt = starred.join(left, F.col("component") == F.col("of")).withColumn("group", F.when(F.col("linked"), F.col("component")).otherwise(F.col("node")))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).withColumn("single", F.col("lo") == F.col("hi"))
    more = dealt.select("component", "lo", "hi", "node", "high", "low", "hashes", "group", "block", "single").groupBy("component", "lo", "hi").applyInArrow(_verify, "a bigint, b bigint")
    return starred.where("linked and node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, component_id)`` of every row.

    Texts are linked if the Jaccard similarity of their distinct shingles of ``SHINGLE`` words is 0.8 or more, verified on the
    hashes of all their shingles; ``component_id`` is the smallest key reachable.  A-Z count as a-z; a text of fewer words is one shingle, null and
    empty texts have none and are copies of each other.  Texts of equal sets are collapsed before any comparison.  Rows without key take part;
    no rows give no rows.
    """
    checkpoint_ready(df.sparkSession)
    prints = _sketched(df, key, text, False).checkpoint()
    classes = prints.groupBy("node").agg(F.first("high").alias("high"), F.first("low").alias("low"), F.min("key").alias("least"), F.min("mark").alias("mark")).checkpoint()
    proposed = components(candidates(classes, classes.count())).checkpoint()
    wanted = classes.join(proposed.select(F.col("node").alias("of")), F.col("node") == F.col("of")).select(F.col("mark").alias("wanted")).distinct().checkpoint()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = df.select(F.col(text).alias("text")).join(wanted, _mark("text") == F.col("wanted"), "left_semi")
    sets = _sketched(texts, None, "text", True).dropDuplicates(["node"])
    members = sets.join(proposed.select(F.col("node").alias("of"), "component"), F.col("node") == F.col("of")).drop("of").checkpoint()
    found = components(verified(members))
    named = classes.join(found.select(F.col("node").alias("of"), "component"), F.col("node") == F.col("of"), "left").select(
        F.coalesce("component", "node").alias("class"), "node", "least").checkpoint()
    least = named.groupBy("class").agg(F.min("least").alias("component_id")).checkpoint()
    member = named.select("class", F.col("node").alias("of")).join(least, "class").select("of", "component_id")
    return prints.join(member, F.col("node") == F.col("of")).select(F.col("key").alias("doc_id"), "component_id")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the document with the smallest key stays.

    Rows without key are kept, for nothing can name them; rows that repeat a key are one document and stay together.
    """
    found = near_duplicates(df, key, text)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return df.join(gone, F.col(key) == F.col("__gone"), "left_anti")
