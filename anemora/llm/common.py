"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemora.session import checkpoint_ready, configure

#: What separates words everywhere here: space and the control characters 9 to 13.
SPACE_CODES = (9, 10, 11, 12, 13, 32)
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one ranking window holds on average at most.
ROWS_PER_CELL = 16_384


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest(*parts: Column) -> Column:
    """The first 52 bits of an MD5 digest over the parts; other engines can repeat it."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from ``digest``."""
    return digest(*parts).cast("double") / F.lit(float(1 << 52))


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, whatever a group's size.

    Rows come in the order of a digest of the order columns, then of these.  Ranges of the
    digest are cells; a cell's rows are numbered by one window and shifted by the sizes of
    the cells before it.  Rows that agree in all order columns are interchangeable.
    """
    group, order = list(group), list(order)
    cells = max(1, -(-df.count() // ROWS_PER_CELL))
    turn = digest(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order])
    dealt = df.withColumn("__turn", turn).withColumn("__cell", F.floor(F.col("__turn") * F.lit(cells / float(1 << 52))))
    sizes = dealt.groupBy(*group, "__cell").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.partitionBy(*group).orderBy("__cell")) - F.col("__rows")
    starts = sizes.select(*[F.col(c).alias(f"__g_{c}") for c in group], F.col("__cell").alias("__at"), before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*group, "__cell").orderBy("__turn", *order)) - 1
    same = F.col("__cell") == F.col("__at")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    return (
        dealt.withColumn("__inside", inside).join(starts, same)
        .withColumn(name, (F.col("__inside") + F.col("__before")).cast("long"))
        .drop("__turn", "__cell", "__inside", "__at", "__before", *[f"__g_{c}" for c in group])
    )


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores where the frame has a column of that name."""
    while wanted.lower() in {c.lower() for c in df.columns}:
        wanted += "_"
    return wanted


# --- distributed connected components ---


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; the component is its least node.

    Large-star and small-star steps in turn.  Each half step is one partial minimum and one
    join between two checkpointed tables, so hubs are split by adaptive execution, lineage
    stays short and nothing but two sums per round reaches the driver.
    """
    checkpoint_ready(edges.sparkSession)
    a, b = F.col("a"), F.col("b")
    links = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct().checkpoint()
    seen = _mark(links)
    while True:
        links = _star(links, large=True)
        links = _star(links, large=False)
        now = _mark(links)
        if now == seen:
            break
        seen = now
    return links.select(a.alias("node"), b.alias("component")).union(links.select(b, b).distinct())


def _mark(links: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    row = links.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))).first()
    return tuple(row)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Point each neighbour (large: those above, small: those below) at the least one."""
    both = links.union(links.select("b", "a")) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("k", "m").alias("m")).checkpoint()
    joined = both.join(least, F.col("a") == F.col("k"))
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("k", "m"))
    return out.where("a != b").distinct().checkpoint()


def local_forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(member, least member)`` that keep the components of the links among 0..n-1."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            break
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    member = np.flatnonzero(root != np.arange(n))
    return member, root[member]


# --- texts in Arrow batches ---


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece hold about ``limit`` bytes (one row at least)."""
    if batch.num_rows == 0:
        return
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column in one array, and each text's offsets (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


_SEPARATES = np.zeros(256, bool)
_SEPARATES[list(SPACE_CODES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts as arrays: byte bounds, first word of each text, words per text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separates: np.ndarray = _SEPARATES):
        self.raw, self.offsets = raw, offsets
        inside = ~separates[raw]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(raw))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.inside = inside
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, piece: int = 1 << 17) -> np.ndarray:
        """A 64-bit hash of each word's bytes, ``piece`` words at a time."""
        out = np.empty(len(self), np.uint64)
        for a in range(0, len(self), piece):
            begin, end = self.start[a:a + piece], self.end[a:a + piece]
            sizes = end - begin
            first = np.cumsum(sizes) - sizes
            raw = self.raw[begin[0]:end[-1]][self.inside[begin[0]:end[-1]]]
            place = np.arange(len(raw)) - np.repeat(first, sizes)
            weight = mix(np.arange(1, int(sizes.max()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
            terms = (raw.astype(np.uint64) + np.uint64(1)) * weight[place]
            out[a:a + piece] = mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64))
        return out
