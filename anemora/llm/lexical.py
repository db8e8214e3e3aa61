"""Ranked lexical search for many queries at once, sharing common subexpressions.

The items' term sets are rewritten as a graph of sums: pairs of neighbours that several items
share become nodes of their own, pairs of such nodes again, and so on.  Over a block of documents
every node's partial scores are materialised once, and items are sums of few nodes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemora.llm.common import slices, text_bytes
from anemora.session import checkpoint_ready

#: Terms of all items of one pass over the documents (about; an item is never parted); more items take more passes.
PASS_TERMS = 100_000
#: Bytes of text in a piece of work, and cells (nodes times documents) of a block of accumulators.
TEXT_BYTES, CELLS = 8 << 20, 1 << 21

FOUND = "row long, item long, key long, score long, part int"

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


# --- terms ---


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, lower-cased from A-Z only, and terms per text (null: none)."""
    raw, offsets = text_bytes(texts)
    inside = _TERM[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][(offsets[:-1] < len(raw)) & (np.diff(offsets) > 0)]
    begins[heads] = inside[heads]
    start = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(start, offsets))
    place = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    kept = raw[inside]
    kept = np.where((kept >= 65) & (kept <= 90), kept + np.uint8(32), kept)
    bounds = np.append(place[start], len(kept)).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
    return column, counts


# --- the sharing graph ---


@dataclass
class Plan:
    """Items as sums over a graph: node i of ``left`` adds its two parts; parts below ``n_terms`` are terms.

    ``levels`` says how many nodes each round made; a round adds parts of the rounds before it only.
    """

    items: list
    n_terms: int
    left: np.ndarray
    right: np.ndarray
    levels: list[int]
    part: np.ndarray
    first: np.ndarray

    def additions(self) -> int:
        return len(self.left) + len(self.part) - len(self.items)


def share(items: Sequence, sets: Sequence[Sequence[int]], n_terms: int) -> Plan:
    """Mine shared sets of terms and build the graph.

    Terms lie in the order of how many items hold them, so that shared ones are neighbours.  In a
    round the neighbours that most items share are merged first, each part once an
    item; rounds go on while two items share neighbours.  A round costs the sum of the sets' sizes.
    """
    held = Counter(t for s in sets for t in s)
    rows = [sorted(s, key=lambda t: (-held[t], t)) for s in sets]
    left, right, levels, made = [], [], [], n_terms
    while True:
        pairs = Counter(p for row in rows for p in zip(row, row[1:]))
        shared = {p: n for p, n in pairs.items() if n > 1}
        if not shared:
            break
        number, new = {}, []
        for i, row in enumerate(rows):
            free = [True] * len(row)
            at = sorted((k for k in range(len(row) - 1) if (row[k], row[k + 1]) in shared), key=lambda k: (-shared[row[k], row[k + 1]], row[k], row[k + 1]))
            merged = {}
            for k in at:
                if free[k] and free[k + 1]:
                    free[k] = free[k + 1] = False
                    merged[k] = (row[k], row[k + 1])
            new.append(merged)
        # A pair that only one item still merges is no sharing.
        uses = Counter(p for merged in new for p in merged.values())
        for p in sorted(p for p, n in uses.items() if n > 1):
            number[p] = made + len(number)
            left.append(p[0])
            right.append(p[1])
        if not number:
            break
        for i, merged in enumerate(new):
            out, k = [], 0
            while k < len(rows[i]):
                if k in merged and merged[k] in number:
                    out.append(number[merged[k]])
                    k += 2
                else:
                    out.append(rows[i][k])
                    k += 1
            rows[i] = out
        levels.append(len(number))
        made += len(number)
    part = np.array([p for row in rows for p in row], np.int64)
    return Plan(list(items), n_terms, np.array(left, np.int64), np.array(right, np.int64), levels, part, np.cumsum([0] + [len(r) for r in rows]))


def evaluate(plan: Plan, leaves: np.ndarray) -> np.ndarray:
    """Scores (item, document) from the terms' scores (term, document); every shared node is added up once."""
    held = np.empty((plan.n_terms + len(plan.left), leaves.shape[1]), np.int64)
    held[:plan.n_terms] = leaves
    at, made = 0, plan.n_terms
    for n in plan.levels:
        np.add(held[plan.left[at:at + n]], held[plan.right[at:at + n]], out=held[made:made + n])
        at, made = at + n, made + n
    scores = np.zeros((len(plan.items), leaves.shape[1]), np.int64)
    for i, (a, b) in enumerate(zip(plan.first.tolist(), plan.first[1:].tolist())):
        if b > a:
            np.add.reduce(held[plan.part[a:b]], axis=0, out=scores[i])
    return scores


# --- search ---


def search(df: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item, rank, key, score``: each item's ``k`` best documents with a score above zero, ties by ascending key.

    A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``, its part of a score ``w ((10^9 tf) div (1000 tf + 20 m))`` with
    ``m = 100 - 50 + ((50 n N) div L)``; N counts the documents with a term, L all their terms.

    Items are taken in passes of a bounded number of terms, so what is sent to the workers is
    bounded by ``PASS_TERMS`` and the largest item.  A pass reads the documents once and keeps of each only its number of terms and the pass's
    terms in it, as a checkpoint; the terms' weights and the scores come from that.  A task keeps the best ``k`` per item; two rounds of
    ranking, first among groups of tasks, end it.

    Null texts and texts without a term are no documents; an item without text or without known terms has no rows; repeated rows of
    either side are rows of their own (equal scores and keys are interchangeable); null keys come last among ties; texts of any length count
    whole; an empty table gives no rows; other columns are not read, so their names do not matter.
    """
    spark = df.sparkSession
    checkpoint_ready(spark)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    wanted = _items(items.select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text"))).where(F.size("terms") > 0).checkpoint()
    size = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = -(-2 * size // PASS_TERMS)
    best = spark.createDataFrame([], FOUND)
    for turn in range(passes):
        mine = wanted.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == turn).orderBy("row").collect()
        if mine:
            best = best.unionByName(_pass(docs, mine, k))
    best = _top(_top(best, ["row", "part"], k), ["row"], k)
    return best.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def _pass(docs: DataFrame, items: list, k: int) -> DataFrame:
    """The best documents, by task, of some items (their row, item and terms)."""
    context = docs.sparkSession.sparkContext
    words = sorted({bytes(t) for r in items for t in r.terms})
    posted = _postings(docs, context.broadcast(words)).checkpoint()
    n, total = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
    held = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    weights = np.zeros(len(words), np.int64)
    for r in held:
        weights[r.term] = floor(1000 * log((2 * n + 2) / (2 * r.df + 1)))
    # Terms that no document holds, or of no weight, add nothing.
    place = {t: i for i, t in enumerate(words)}
    sets = [[i for i in (place[bytes(t)] for t in r.terms) if weights[i]] for r in items]
    plan = share([(r.row, r.item) for r in items], sets, len(words))
    return posted.mapInArrow(_scorer(context.broadcast((plan, weights, n, total, k))), FOUND)


def _top(df: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _items(items: DataFrame) -> DataFrame:
    """``row, item, terms``: the distinct terms of every item, as row numbers that hold within the run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                found, counts = terms(part.column("text"))
                ends, rows = np.cumsum(counts), []
                for a, b in zip((ends - counts).tolist(), ends.tolist()):
                    rows.append(found.slice(a, b - a).unique().to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("item"), pa.array(rows, pa.list_(pa.binary()))], ["row", "item", "terms"])

    return items.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, "row long, item long, terms array<binary>")


def _postings(docs: DataFrame, sent) -> DataFrame:
    """``key, n, terms, counts`` of every document with a term: how many terms it has, and which of the sent ones how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.large_binary())
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                found, counts = terms(part.column("text"))
                at = pc.index_in(found, value_set=known)
                hit = np.flatnonzero(np.asarray(at.is_valid()))
                owner = np.repeat(np.arange(len(counts)), counts)[hit]
                cells, times = np.unique(owner * len(known) + np.asarray(at.drop_null()), return_counts=True)
                rows = np.flatnonzero(counts)
                edges = pa.array(np.searchsorted(cells, np.append(rows, len(counts)) * len(known)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(edges, pa.array(v.astype(np.int32))) for v in (cells % len(known), times)]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(rows)), pa.array(counts[rows]), *lists], ["key", "n", "terms", "counts"])

    return docs.mapInArrow(run, "key long, n long, terms array<int>, counts array<int>")


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights, n_docs, total, k = sent.value
        best = Best(len(plan.items), k)
        width = max(1, CELLS // max(1, plan.n_terms + len(plan.left)))
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                lists = part.column("terms")
                edges = np.asarray(lists.offsets).astype(np.int64)
                term, tf = np.asarray(lists.flatten()), np.asarray(part.column("counts").flatten()).astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), np.diff(edges))
                length = np.asarray(part.column("n"))
                # 50 n N may pass 64 bits: Python's integers divide it.
                m = 50 + np.array([50 * x * n_docs // total for x in length.tolist()], np.int64)
                leaves = np.zeros((plan.n_terms, part.num_rows), np.int64)
                leaves[term, doc] = weights[term] * ((1_000_000_000 * tf) // (1_000 * tf + 20 * m[doc]))
                best.add(evaluate(plan, leaves), part.column("key"))
        # Tasks meet in groups of about the root of their number before all meet.
        yield from best.rows(plan.items, TaskContext.get().partitionId() // 64)

    return run


class Best:
    """The ``k`` best documents of every item so far; a null key counts as the largest."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score: list[np.ndarray] = [np.zeros(0, np.int64)] * items
        self.key: list[np.ndarray] = [np.zeros(0, np.int64)] * items
        self.null: list[np.ndarray] = [np.zeros(0, bool)] * items
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, keys: pa.Array) -> None:
        null = np.asarray(keys.is_null())
        key = np.asarray(keys.fill_null(0))
        item, doc = np.nonzero(scores >= self.least[:, None])
        edges = np.searchsorted(item, np.arange(len(self.score) + 1))
        for i in np.unique(item).tolist():
            mine = doc[edges[i]:edges[i + 1]]
            s, ke, nu = np.concatenate([self.score[i], scores[i, mine]]), np.concatenate([self.key[i], key[mine]]), np.concatenate([self.null[i], null[mine]])
            order = np.lexsort((ke, nu, -s))[:self.k]
            self.score[i], self.key[i], self.null[i] = s[order], ke[order], nu[order]
            if len(order) == self.k:
                self.least[i] = s[order[-1]]

    def rows(self, items: list, part: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(items), 1_024):
            some = range(at, min(at + 1_024, len(items)))
            counts = [len(self.score[i]) for i in some]
            if sum(counts):
                names = [items[i] for i, c in zip(some, counts) for _ in range(c)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in names], pa.int64()), pa.array([i for _, i in names], pa.int64()),
                     pa.array(np.concatenate([self.key[i] for i in some]), mask=np.concatenate([self.null[i] for i in some])),
                     pa.array(np.concatenate([self.score[i] for i in some])), pa.array(np.full(sum(counts), part, np.int32))],
                    ["row", "item", "key", "score", "part"])
