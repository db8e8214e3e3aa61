"""Exact top-k inner products by an M-tree: paged nodes, covering radii, stored parent distances."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemora.session import checkpoint_ready

#: Routing objects: nodes below the root and pages below a node at most; rows of the sample that they are chosen from.
NODES, PAGES, SAMPLE = 16, 16, 8_192
#: Rows of a stored block, and queries that travel together.
BLOCK_ROWS, QUERY_ROWS = 1_024, 256

#: Slack of computed distances, relative to the greatest norm.
_SLACK = 1e-6


def scaled(column: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(256 x) in double precision, padded with zeros."""
    out = np.zeros((len(column), width))
    for i, value in enumerate(column):
        x = np.asarray(value.values).astype(np.float64)
        out[i, :len(x)] = np.floor(256.0 * x)
    return out


def _valid(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between all rows of two matrices."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Directory:
    """The inner levels of the tree; its size is bounded by ``NODES`` and ``PAGES``, whatever the number of rows.

    Inner products become distances by one more coordinate: with ``reach`` the greatest norm, x gets
    sqrt(reach^2 - |x|^2) and a query gets 0, so that d^2 = |q|^2 + reach^2 - 2 <q, x>.
    """

    reach: float
    nodes: np.ndarray
    pages: np.ndarray
    parent: np.ndarray
    to_parent: np.ndarray
    radius: np.ndarray | None = None
    node_radius: np.ndarray | None = None

    def lift(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.reach ** 2 - (rows * rows).sum(axis=1), 0))
        return np.concatenate([rows, rest[:, None]], axis=1)

    def place(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Page of each row (nearest node, then its nearest page) and distance to the page's routing object."""
        node = _apart(lifted, self.nodes).argmin(axis=1)
        page, far = np.zeros(len(lifted), np.int64), np.zeros(len(lifted))
        for k in np.unique(node):
            at, own = np.flatnonzero(node == k), np.flatnonzero(self.parent == k)
            d = _apart(lifted[at], self.pages[own])
            best = d.argmin(axis=1)
            page[at], far[at] = own[best], d[np.arange(len(at)), best]
        return page, far


def _choose(rows: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Up to ``count`` spread routing objects: each next one is far from those chosen so far."""
    random = np.random.default_rng(seed)
    chosen = [int(random.integers(len(rows)))]
    near = _apart(rows, rows[chosen])[:, 0]
    while len(chosen) < count and near.max() > 0:
        nxt = int(random.choice(len(rows), p=near ** 2 / (near ** 2).sum()))
        chosen.append(nxt)
        near = np.minimum(near, _apart(rows, rows[[nxt]])[:, 0])
    return np.array(chosen)


def directory(sample: np.ndarray, reach: float, seed: int = 5) -> Directory:
    made = Directory(reach, *[np.zeros(0)] * 4)
    lifted = made.lift(sample)
    made.nodes = lifted[_choose(lifted, NODES, seed)]
    own = _apart(lifted, made.nodes).argmin(axis=1)
    pages, parent = [], []
    for k in range(len(made.nodes)):
        rows = lifted[own == k]
        rows = rows if len(rows) else made.nodes[[k]]
        found = rows[_choose(rows, PAGES, seed + k + 1)]
        pages.append(found)
        parent += [k] * len(found)
    made.pages, made.parent = np.concatenate(pages), np.array(parent)
    made.to_parent = np.linalg.norm(made.pages - made.nodes[made.parent], axis=1)
    return made


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` greatest integer inner products.

    Components x count as floor(256 x); candidates are all rows but those with the query's own key; equal scores go to the
    smaller key.  Exact: every row is in the tree, and a page, block or row is passed over only if
    the triangle inequality shows that it cannot reach the query's k-th score so far.

    The routing objects come from a bounded sample; rows are dealt to the nearest, stored in blocks of bounded size with
    their distance to the routing object, and a page of any size is many blocks.  A query starts
    with the k-th score among the sample, visits its most promising page, and with
    the better bound all pages that remain. 

    Vectors that are null, empty or hold null or non-finite components, and rows without key, take no part; shorter vectors are padded with
    zeros; rows that repeat a key are candidates each.  Fewer rows than ``k`` give fewer ranks; no rows give
    no rows.  Other columns are not carried along.
    """
    spark = df.sparkSession
    checkpoint_ready(spark)
    usable = df.where(_valid(F.col(vector)) & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * 256).cast("double"), F.lit(2.0)))
    total, width, square = usable.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(norm)).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not total:
        return spark.createDataFrame([], schema)
    part = min(1.0, 1.2 * SAMPLE / total)
    drawn = usable.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < part * 1_000_000 + 1).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    taken = drawn.select("id", "vector").toArrow()
    if not taken.num_rows:
        taken = usable.limit(1).select("id", "vector").toArrow()
    sample_ids, sample = np.asarray(taken.column("id")), scaled(taken.column("vector").combine_chunks(), width)
    tree = directory(sample, float(np.sqrt(square)))

    biggest = usable.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(F.floor(x.cast("double") * 256).cast("double")))))).first()[0]
    kind = np.dtype(np.int16 if biggest < 2**15 else np.int32 if biggest < 2**31 else np.float64)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = scaled(batch.column("vector"), width)
            page, far = tree.place(tree.lift(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("asks"), pa.array([r.tobytes() for r in rows.astype(kind)], pa.binary()), pa.array(page), pa.array(far)],
                ["id", "asks", "row", "page", "far"])

    stored = usable.mapInArrow(store, "id bigint, asks boolean, row binary, page bigint, far double").checkpoint()
    tree.radius = np.full(len(tree.pages), -1.0)
    sizes = np.zeros(len(tree.pages), np.int64)
    for page, far, n in stored.groupBy("page").agg(F.max("far"), F.count(F.lit(1))).collect():
        tree.radius[page], sizes[page] = far, n
    covered = np.where(tree.radius >= 0, tree.to_parent + tree.radius, -1.0)
    tree.node_radius = np.array([covered[tree.parent == m].max() for m in range(len(tree.nodes))])
    blocks = F.element_at(F.array(*[F.lit(int(-(-n // BLOCK_ROWS)) or 1) for n in sizes]), (F.col("page") + 1).cast("int"))
    held = (
        stored.withColumn("block", F.pmod(F.xxhash64("id"), blocks)).groupBy("page", "block")
        .agg(F.sort_array(F.collect_list(F.struct("far", "id", "row"))).alias("rows"))
    )
    asks = stored.where("asks").select("id", "row").distinct()
    turns = max(1, -(-asks.count() // QUERY_ROWS))
    queries = asks.withColumn("turn", F.pmod(F.xxhash64("id", F.lit("turn")), F.lit(turns))).groupBy("turn").agg(
        F.sort_array(F.collect_list(F.struct("id", "row"))).alias("asked")).checkpoint()

    def first_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn, asked in zip(batch.column("turn").to_pylist(), batch.column("asked")):
                ids, rows = _queries(asked, kind)
                scores = rows @ sample.T
                scores[ids[:, None] == sample_ids[None, :]] = -np.inf
                bound = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(ids), -np.inf)
                lower = _lower_bounds(tree, rows, bound)
                yield _visits(turn, lower == lower.min(axis=1, keepdims=True), bound, first=True)

    def later_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn, asked, known in zip(batch.column("turn").to_pylist(), batch.column("asked"), batch.column("known")):
                ids, rows = _queries(asked, kind)
                order = np.argsort(np.asarray(known.values.field("id")), kind="stable")
                bound = np.asarray(known.values.field("bound"))[order]
                seen = np.asarray(known.values.field("page"))[order]
                lower = _lower_bounds(tree, rows, bound)
                lower[np.arange(len(ids)), seen] = np.inf
                yield _visits(turn, np.isfinite(lower), bound, first=False)

    plan = "turn bigint, page bigint, members array<int>, bounds array<double>"
    once = queries.mapInArrow(first_visits, plan).checkpoint()
    early = _meet(once, queries, held, tree, k, kind).checkpoint()
    kth = early.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("least"))
    visited = once.join(queries, "turn").select("turn", "page", F.explode(F.arrays_zip(
        F.transform("members", lambda i: F.get("asked", i)["id"]).alias("id"), F.col("bounds").alias("bound"))).alias("v")).select("turn", "page", "v.*")
    known = visited.join(kth, F.col("id") == F.col("query_id"), "left").groupBy("turn").agg(F.collect_list(F.struct(
        "id", F.greatest("bound", F.coalesce("least", F.lit(float("-inf")))).alias("bound"), "page")).alias("known"))
    late = _meet(queries.join(known, "turn").mapInArrow(later_visits, plan), queries, held, tree, k, kind)
    return _best(early.union(late), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _queries(asked: pa.Scalar, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(asked.values.field("id"))
    return ids, np.frombuffer(b"".join(asked.values.field("row").to_pylist()), kind).reshape(len(ids), -1).astype(np.float64)


def _visits(turn: int, wanted: np.ndarray, bound: np.ndarray, first: bool) -> pa.RecordBatch:
    """A row per page with the queries (by place in their block) that visit it; the first time one page each."""
    if first:
        one = np.zeros_like(wanted)
        one[np.arange(len(wanted)), wanted.argmax(axis=1)] = True
        wanted = one
    pages = np.flatnonzero(wanted.any(axis=0))
    members = [np.flatnonzero(wanted[:, p]).astype(np.int32) for p in pages]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(pages), turn)), pa.array(pages), pa.array(members, pa.list_(pa.int32())), pa.array([bound[m] for m in members], pa.list_(pa.float64()))],
        ["turn", "page", "members", "bounds"])


def _best(rows: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.select("query_id", "vec_id", "score").withColumn("rank", rank).where(F.col("rank") <= k)


def _reach(tree: Directory, rows: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Greatest distance at which a row can still reach each query's bound."""
    square = (rows * rows).sum(axis=1)
    far = np.sqrt(np.maximum(square + tree.reach ** 2 - 2 * bound, 0.0))
    return far + _SLACK * (tree.reach + np.sqrt(square) + 1.0)


def _lower_bounds(tree: Directory, rows: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Least possible distance of each query to each page's rows; infinite where no row can reach the bound.

    Nodes out of reach spare all their pages; of the others, the stored distance of a page to its node
    and the triangle inequality spare the pages that it rules out; only the rest are measured.
    """
    points = np.concatenate([rows, np.zeros((len(rows), 1))], axis=1)
    far = _reach(tree, rows, bound)
    to_node = _apart(points, tree.nodes)
    out = np.full((len(rows), len(tree.pages)), np.inf)
    for m in range(len(tree.nodes)):
        own = np.flatnonzero((tree.parent == m) & (tree.radius >= 0))
        near = np.flatnonzero(to_node[:, m] - tree.node_radius[m] <= far) if len(own) else []
        if not len(near):
            continue
        open_ = np.abs(to_node[near, m][:, None] - tree.to_parent[own][None]) - tree.radius[own][None] <= far[near][:, None]
        asked, pages = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if len(asked):
            lower = _apart(points[near[asked]], tree.pages[own[pages]]) - tree.radius[own[pages]][None]
            lower = np.where(open_[np.ix_(asked, pages)] & (lower <= far[near[asked]][:, None]), lower, np.inf)
            out[np.ix_(near[asked], own[pages])] = lower
    # A query whose bound nothing reaches still visits a page.
    empty = ~np.isfinite(out).any(axis=1)
    if empty.any() and not np.isfinite(bound[empty]).all():
        out[empty] = np.where(tree.radius >= 0, 0.0, np.inf)
    return out


def _meet(visits: DataFrame, queries: DataFrame, held: DataFrame, tree: Directory, k: int, kind: np.dtype) -> DataFrame:
    """The best ``k`` of each query among the blocks of the pages it visits; a block of queries meets a block of rows."""
    pairs = visits.join(queries.withColumnRenamed("turn", "of"), F.col("turn") == F.col("of"))
    pairs = pairs.join(held.withColumnRenamed("page", "at"), F.col("page") == F.col("at")).select("page", "members", "bounds", "asked", "rows")
    found = pairs.mapInArrow(lambda batches: _search(batches, tree, k, kind), "query_id bigint, vec_id bigint, score bigint")
    return _best(found, k).drop("rank")


def _search(batches: Iterator[pa.RecordBatch], tree: Directory, k: int, kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """Only rows whose stored distance to the routing object lets one of the queries reach its bound are computed."""
    for batch in batches:
        for page, members, bounds, asked, rows in zip(*(batch.column(c) for c in ("page", "members", "bounds", "asked", "rows"))):
            page, members, bound, rows = page.as_py(), np.asarray(members.values), np.asarray(bounds.values), rows.values
            ids, queries = _queries(asked, kind)
            ids, queries = ids[members], queries[members]
            other, far = np.asarray(rows.field("id")), np.asarray(rows.field("far"))
            stored = np.frombuffer(b"".join(rows.field("row").to_pylist()), kind).reshape(len(other), -1).astype(np.float64)
            reach = _reach(tree, queries, bound)
            centre = _apart(np.concatenate([queries, np.zeros((len(ids), 1))], axis=1), tree.pages[[page]])[:, 0]
            low = np.searchsorted(far, np.min(centre - reach) - _SLACK * (tree.reach + 1.0))
            high = np.searchsorted(far, np.max(centre + reach) + _SLACK * (tree.reach + 1.0), side="right")
            other, stored = other[low:high], stored[low:high]
            if not len(other):
                continue
            exact = max(np.abs(queries).max(), 1) * max(np.abs(stored).max(), 1) * queries.shape[1] < 2.0 ** 53
            scores = queries @ stored.T if exact else queries.astype(np.int64) @ stored.astype(np.int64).T
            good = (scores >= bound[:, None]) & (ids[:, None] != other[None, :])
            q, x = np.nonzero(good)
            order = np.lexsort((other[x], -scores[q, x], q))
            q, x = q[order], x[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            q, x = q[rank < k], x[rank < k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v.astype(np.int64)) for v in (ids[q], other[x], scores[q, x])], ["query_id", "vec_id", "score"])
