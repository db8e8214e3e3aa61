"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import Words, components, local_forest, slices, text_bytes
from anemora.session import checkpoint_ready

BITS = 64
#: Groups of correlated bits that a partition is made of.
GROUP = 8
#: Rows of a bucket that are compared with each other in one task; a larger bucket is dealt on by further bits up to
#: ``SPLITS`` times, which parts what is not alike, and what remains is compared block by block.
BUCKET_ROWS = 2_048
SPLITS = 2

_LANES = np.uint64(0x0101010101010101)


# --- fingerprints ---


def fingerprints(raw: np.ndarray, offsets: np.ndarray, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """One 64-bit fingerprint per text; A-Z count as a-z, words are joined by one space."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    some, counts, hashes = shingle_hashes(raw, offsets, shingle, seed)
    if len(some):
        out[some] = _majority(hashes, counts)
    return out


def shingle_hashes(raw: np.ndarray, offsets: np.ndarray, shingle: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which texts have words, how many shingles each of these has (one, if it has fewer words), and the shingles' hashes in order."""
    raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    words = Words(raw, offsets)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sizes = words.end - words.start
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    joined = np.full(int(ends[-1]), 32, np.uint8)
    joined[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = raw[words.inside]
    data = joined.tobytes()
    some = np.flatnonzero(words.counts)
    counts = np.maximum(1, words.counts[some] - shingle + 1)
    first = np.repeat(words.first[some], counts) + _ranges(counts)
    last = np.minimum(first + shingle, np.repeat(words.first[some] + words.counts[some], counts)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[a:b], seed) for a, b in zip(begins[first].tolist(), (ends[last] - 1).tolist())), np.uint64, len(first))
    return some, counts, hashes


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each n, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits set in over half of each run of hashes; byte lanes add up to 255 hashes at once."""
    parts = -(-counts // 255)
    part_of = np.repeat(np.arange(len(counts)), parts)
    starts = (np.cumsum(counts) - counts)[part_of] + 255 * _ranges(parts)
    runs = np.cumsum(parts) - parts
    result = np.zeros(len(counts), np.uint64)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, starts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), runs, axis=0)
        for byte in range(8):
            bit = (2 * ones[:, byte] > counts).astype(np.uint64)
            result |= bit << np.uint64(8 * byte + shift)
    return result


def with_fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(key, fingerprint)`` as longs for every row; texts without words have fingerprint 0."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                made = fingerprints(*text_bytes(piece.column("text")), shingle, seed)
                yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(made.view(np.int64))], ["key", "fingerprint"])

    kind = df.select(key).dtypes[0][1]
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(work, f"key {kind}, fingerprint bigint")


# --- partitions and thresholds ---


def bit_groups(together: np.ndarray, ones: np.ndarray, rows: int) -> list[list[int]]:
    """Group correlated bits: each group starts at the most skewed free bit and takes the bits most correlated with it."""
    p = ones / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(together / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    while free:
        group = [min(free, key=lambda b: (spread[b], b))]
        free.remove(group[0])
        while len(group) < GROUP:
            best = max(free, key=lambda b: (related[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(group)
    return groups


def distances(histogram: np.ndarray) -> np.ndarray:
    """How often two random rows differ in 0, 1, ... bits of a group, from the counts of its values."""
    share = histogram / max(histogram.sum(), 1)
    apart = np.bitwise_count(np.arange(len(share))[:, None] ^ np.arange(len(share))[None, :])
    return np.bincount(apart.ravel(), weights=np.outer(share, share).ravel(), minlength=GROUP + 1)


def allocate(apart: list[np.ndarray], rows: int, reach: int, probe_cost: float = 4.0) -> list[tuple[int, int, int]]:
    """Partitions ``(first group, end group, threshold)`` of least estimated work.

    If two fingerprints differ in at most ``reach`` bits and the thresholds t of the
    partitions satisfy sum(t + 1) = reach + 1, some partition differs in at most its t bits.  A threshold
    of -1 leaves the partition out.  The work of a partition is its candidate pairs, estimated by
    the distances of its groups as if independent, and its probes.
    """
    n = len(apart)
    cost = {}
    for i in range(n):
        spread = np.ones(1)
        for j in range(i + 1, n + 1):
            spread = np.convolve(spread, apart[j - 1])
            for t in range(reach + 1):
                probes = sum(comb((j - i) * GROUP, k) for k in range(t + 1))
                cost[i, j, t] = rows * rows / 2 * spread[:t + 1].sum() + probe_cost * rows * probes
            cost[i, j, -1] = 0.0
    best: dict[tuple[int, int], tuple[float, list]] = {(n, 0): (0.0, [])}
    for i in range(n - 1, -1, -1):
        for left in range(reach + 2):
            for j in range(i + 1, n + 1):
                for t in range(-1, left):
                    if (rest := best.get((j, left - t - 1))) is not None:
                        total = cost[i, j, t] + rest[0]
                        if (i, left) not in best or total < best[i, left][0]:
                            best[i, left] = (total, [(i, j, t), *rest[1]])
    return best[0, reach + 1][1]


def statistics(prints: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, bits set and bits set together over all fingerprints; 64 x 64 sums reach the driver."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(np.asarray(batch.column(0)).view(np.uint64)).astype(np.float32)
            sums += bits.T @ bits
            rows += len(bits)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(sums.ravel(), rows).astype(np.int64))], ["i", "j", "n"])

    together, rows = np.zeros((BITS, BITS)), 0
    for i, j, n in prints.select("fingerprint").mapInArrow(work, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(F.sum("n")).collect():
        if i < 0:
            rows = n
        else:
            together[i, j] = n
    return rows, np.diag(together).copy(), together


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def histograms(prints: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """Counts of the values of each group of bits over all fingerprints, 256 a group."""
    value = F.array(*[
        sum(((F.shiftrightunsigned(F.col("fingerprint"), b).bitwiseAND(F.lit(1))) * (1 << k) for k, b in enumerate(g)), F.lit(0).cast("long")) for g in groups])
    found = prints.select(F.posexplode(value).alias("g", "v")).groupBy("g", "v").count().collect()
    out = [np.zeros(1 << GROUP) for _ in groups]
    for g, v, n in found:
        out[g][v] = n
    return out


# --- links ---


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def probes(prints: DataFrame, reach: int) -> tuple[list[tuple[int, int, bool]], list[int]]:
    """``(mask, flip, own)`` of every partition's values that a fingerprint is dealt to, and all bits in the order of their groups.

    Two fingerprints at most ``reach`` bits apart meet under some mask: one by its own value, the other by a flip within the threshold.
    """
    rows, ones, together = statistics(prints)
    groups = bit_groups(together, ones, rows)
    plan = allocate([distances(h) for h in histograms(prints, groups)], rows, reach)
    out = []
    for i, j, t in plan:
        bits = [b for g in groups[i:j] for b in g]
        for k in range(t + 1):
            out += [(_signed(_mask(bits)), _signed(_mask(list(c))), k == 0) for c in combinations(bits, k)]
    return out, [b for g in groups for b in g]


def links(prints: DataFrame, reach: int = 3) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that keep all components of "at most ``reach`` bits apart".

    Every fingerprint is put into the bucket of its value in each partition, and probes the buckets within the
    partition's threshold.  A bucket above ``BUCKET_ROWS`` is dealt on by the bits it does not fix: of
    ``reach + 1`` parts of them one must agree.  Inside a bucket all rows are
    compared, in blocks if they are many, and a spanning forest of the links is returned, not the pairs.
    """
    dealt_to, order = probes(prints, reach)
    probe = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(x).cast("long").alias("flip"), F.lit(own).alias("own")) for m, x, own in dealt_to]))
    dealt = prints.select("fingerprint", probe.alias("p")).select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("p.flip")).alias("shape"), "p.mask", "p.own")
    dealt = dealt.withColumn("value", F.col("shape").bitwiseAND(F.col("mask")))
    found, masks = [], {m for m, _, _ in dealt_to}
    for level in range(SPLITS + 1):
        sizes = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("has_own")).where("n > 1 and has_own")
        sizes = sizes.select(F.col("mask").alias("_mask"), F.col("value").alias("_value"), "n").checkpoint()
        same = (F.col("mask") == F.col("_mask")) & (F.col("value") == F.col("_value"))
        splits = {m: parts for m in masks if level < SPLITS and (parts := _split(m, order, reach + 1))}
        hot = (F.col("n") > BUCKET_ROWS) & F.col("_mask").isin(list(splits)) if splits else F.lit(False)
        near = dealt.join(sizes.where(~hot), same).withColumn("blocks", F.ceil(F.col("n") / BUCKET_ROWS).cast("int"))
        near = near.withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
        near = near.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        lists = near.groupBy("mask", "value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).agg(
            F.collect_list("fingerprint").alias("prints"), F.collect_list("own").alias("own"), F.collect_list("block").alias("block"))
        found.append(lists.select("prints", "own", "block", (F.col("low") == F.col("high")).alias("single")).mapInArrow(lambda b, reach=reach: _compare(b, reach), "a bigint, b bigint"))
        if not splits or sizes.where(hot).isEmpty():
            break
        table = F.create_map(*[x for m, parts in splits.items() for x in (F.lit(m).cast("long"), F.array(*[F.lit(p).cast("long") for p in parts]))])
        dealt = (
            dealt.join(sizes.where(hot), same).select("fingerprint", "shape", "own", F.explode(F.element_at(table, F.col("mask"))).alias("mask"))
            .withColumn("value", F.col("shape").bitwiseAND(F.col("mask"))).checkpoint()
        )
        masks = {p for parts in splits.values() for p in parts}
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _split(mask: int, order: list[int], parts: int) -> list[int]:
    """The mask with each of ``parts`` shares of the bits it leaves open."""
    left = [b for b in order if not mask >> b & 1]
    if len(left) < parts:
        return []
    return [_signed((mask & ((1 << BITS) - 1)) | _mask(left[k * len(left) // parts:(k + 1) * len(left) // parts])) for k in range(parts)]


def _compare(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.asarray(pc.list_value_length(batch.column(0)), dtype=np.int64)
        values = np.asarray(batch.column(0).flatten()).view(np.uint64)
        own = np.asarray(batch.column(1).flatten().cast(pa.uint8())).astype(bool)
        block, single = np.asarray(batch.column(2).flatten()), np.repeat(np.asarray(batch.column(3).cast(pa.uint8())).astype(bool), sizes)
        size = np.repeat(sizes, sizes)
        a = b = np.zeros(0, np.int64)
        at = np.flatnonzero(size > 1)
        place = _ranges(sizes)
        for step in range(1, int(sizes.max(initial=1))):
            at = at[place[at] + step < size[at]]
            near = (np.bitwise_count(values[at] ^ values[at + step]) <= reach) & (own[at] | own[at + step]) & (single[at] | (block[at] != block[at + step]))
            a, b = np.concatenate([a, at[near]]), np.concatenate([b, at[near] + step])
            if len(a) > 1_000_000:
                a, b = local_forest(a, b, len(values))
        a, b = local_forest(a, b, len(values))
        different = values[a] != values[b]
        signed = values.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[a[different]]), pa.array(signed[b[different]])], ["a", "b"])


def near_duplicates(df: DataFrame, reach: int = 3, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row.

    Fingerprints as in ``fingerprints`` over all shingles of the whole text, as 16 hexadecimal
    digits; rows are linked if they differ in at most ``reach`` bits; ``component_id`` is the smallest key
    reachable.  Null and empty texts have fingerprint 0 and are linked like others.  Rows without key take part, but
    a component's id is null only if none of its rows has a key.  Copies and repeated
    rows share a fingerprint and are collapsed before any comparison; no rows give no rows.
    """
    checkpoint_ready(df.sparkSession)
    prints = with_fingerprint(df, key, text, shingle, seed).checkpoint()
    classes = prints.groupBy("fingerprint").agg(F.min("key").alias("least")).checkpoint()
    found = components(links(classes.select("fingerprint"), reach))
    named = classes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        F.coalesce("component", "fingerprint").alias("class"), "fingerprint", "least").checkpoint()
    least = named.groupBy("class").agg(F.min("least").alias("component_id")).checkpoint()
    member = named.select("class", F.col("fingerprint").alias("of")).join(least, "class").select("of", "component_id").checkpoint()
    return prints.join(member, F.col("fingerprint") == F.col("of")).select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(df: DataFrame, reach: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the document with the smallest key stays.

    Rows without key are kept, for nothing can name them; rows that repeat a key are one document and stay together.
    """
    found = near_duplicates(df, reach, key, text)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return df.join(gone, F.col(key) == F.col("__gone"), "left_anti")
