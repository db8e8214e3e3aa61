"""Near-duplicate vectors by random-hyperplane signs, exact cosines and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import components, local_forest
from anemora.session import checkpoint_ready

#: Share of the links at exactly the threshold that the tables are to find; closer links are likelier.
RECALL = 0.98
#: Rows of a bucket that meet in one comparison; larger buckets are compared block by block.
BLOCK_ROWS = 1_024


def tables_for(rows: int, least: float, recall: float = RECALL) -> tuple[int, int]:
    """Signs per table and number of tables for so many vectors of one label.

    Two vectors at cosine c agree in a sign with probability 1 - acos(c)/pi.  Signs grow with the
    logarithm of the rows so that buckets stay small, tables so that the recall stays.
    """
    agree = 1 - acos(least) / pi
    signs = min(30, max(8, ceil(log2(max(rows, 2))) - 1))
    return signs, max(1, ceil(log(1 - recall) / log(1 - agree ** signs)))


def planes(size: int, signs: int, tables: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, signs * tables))


def _read(column: pa.Array) -> list[np.ndarray | None]:
    """Usable vectors in double precision; None for the rest."""
    out = []
    for value in column:
        if not value.is_valid or value.values.null_count or not len(value.values):
            out.append(None)
            continue
        x = np.asarray(value.values).astype(np.float64) + 0.0
        out.append(x if np.isfinite(x).all() and x.any() else None)
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _read(batch.column("vector"))
        data = [None if x is None else x.tobytes() for x in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array([None if x is None else blake2b(x, digest_size=16).digest() for x in data], pa.binary()),
             pa.array(data, pa.binary())], ["id", "label", "digest", "vector"])


def near_duplicates(df: DataFrame, least: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label", seed: int = 17) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows with equal, non-null labels are linked if their cosine in double precision is at least ``least`` and they share all
    signs of one table; ``n_links`` counts a row's direct links, ``component_id`` is the smallest key it reaches.
    Equal vectors of a label are one class, compared once and counted with its rows.  A pair that meets in several
    tables counts in the first.  Large buckets are compared block by block; tasks return sums and a spanning forest, never pairs.

    Vectors that are null, empty, zero or hold null or non-finite components, rows without label and rows without key link with nothing: no
    links, their own component.  Vectors of different length never link.  Keys are meant to be
    distinct; rows that share one are one node of the components.  No rows give no rows.
    """
    checkpoint_ready(df.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.mapInArrow(_digests, f"id {kind[key]}, label {kind[label]}, digest binary, vector binary")
    rows = rows.withColumn("digest", F.when(F.col("label").isNotNull() & F.col("id").isNotNull(), F.col("digest"))).checkpoint()
    classes = rows.where(F.col("digest").isNotNull()).groupBy("label", "digest").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector")).checkpoint()
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs, tables = tables_for(largest, least)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            out = np.empty((len(raw), tables), np.int32)
            lengths = np.array([len(x) // 8 for x in raw])
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                matrix = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), size)
                bits = (matrix @ planes(size, signs, tables, seed) > 0).reshape(len(at), tables, signs)
                out[at] = bits @ (1 << np.arange(signs))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths.astype(np.int32)), pa.array([r.tobytes() for r in out], pa.binary()), pa.array(list(out), pa.list_(pa.int32()))],
                [*batch.schema.names, "size", "signs", "bucket"])

    made = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema.fields)
    signed = classes.mapInArrow(sign, made + ", size int, signs binary, bucket array<int>").drop("digest")
    dealt = signed.select("id", "n", "vector", "signs", "label", "size", F.posexplode("bucket").alias("table", "bucket"))
    place = ["label", "size", "table", "bucket"]
    sizes = dealt.groupBy(*place).count().where("count > 1").select(*[F.col(c).alias(f"_{c}") for c in place], "count").checkpoint()
    same = [F.col(c) == F.col(f"_{c}") for c in place]
    blocks = F.ceil(F.col("count") / BLOCK_ROWS).cast("int")
    shared = dealt.join(sizes, same).drop(*[f"_{c}" for c in place]).withColumn("blocks", blocks)
    shared = shared.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = shared.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    lists = met.groupBy(*place, "low", "high").agg(F.collect_list(F.struct("id", "n", "vector", "signs", "block")).alias("rows"))
    found = lists.select("table", "low", "high", "rows").mapInArrow(
        lambda batches: _compare(batches, least), "a bigint, b bigint, links bigint").checkpoint()
    links = found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("links").alias("links")).checkpoint()
    reach = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    member = (
        classes.join(links, F.col("id") == F.col("a"), "left").join(reach, F.col("id") == F.col("node"), "left")
        .select(F.col("label").alias("_label"), F.col("digest").alias("_digest"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"),
                F.coalesce("component", "id").alias("_component")).checkpoint()
    )
    joined = rows.select("id", "label", "digest").join(member, (F.col("label") == F.col("_label")) & (F.col("digest") == F.col("_digest")), "left")
    component = F.coalesce("_component", "id")
    return joined.select(
        F.col("id").alias("vec_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, counts = [], [], []
        for table, low, high, rows in zip(*(batch.column(c) for c in ("table", "low", "high", "rows"))):
            table, rows = table.as_py(), rows.values
            ids, n = np.asarray(rows.field("id")), np.asarray(rows.field("n"))
            matrix = np.frombuffer(b"".join(rows.field("vector").to_pylist()), np.float64).reshape(len(ids), -1)
            signs = np.frombuffer(b"".join(rows.field("signs").to_pylist()), np.int32).reshape(len(ids), -1)
            unit = matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
            if low.as_py() == high.as_py():
                left = right = np.arange(len(ids))
            else:
                block = np.asarray(rows.field("block"))
                left, right = np.flatnonzero(block == low.as_py()), np.flatnonzero(block == high.as_py())
            i, j = np.nonzero(unit[left] @ unit[right].T >= least)
            i, j = left[i], right[j]
            once = i < j if low.as_py() == high.as_py() else np.ones(len(i), bool)
            i, j = i[once], j[once]
            if not len(i):
                continue
            new = np.ones(len(i), bool)
            for t in range(table):
                new &= signs[i, t] != signs[j, t]
            total = np.bincount(i[new], weights=n[j[new]], minlength=len(ids)) + np.bincount(j[new], weights=n[i[new]], minlength=len(ids))
            some = np.flatnonzero(total)
            x, y = local_forest(i, j, len(ids))
            a += [ids[some], ids[x]]
            b += [[None] * len(some), ids[y].tolist()]
            counts += [total[some].astype(np.int64), np.zeros(len(x), np.int64)]
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array([v for part in b for v in part], pa.int64()), pa.array(np.concatenate(counts))], ["a", "b", "links"])
