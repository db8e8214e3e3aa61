"""Writers.  Data leaves through Spark's writers or from the tasks that hold it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.functions.geometry import feature
from anemora.operators.nodes import latest_per_key, pending
from anemora.sources import files


def write_parquet(df: DataFrame, path: str, *, by: str | None = None, buckets: int | None = None, mode: str = "overwrite") -> None:
    """Parquet, clustered by a key if given, so that a predicate on the key skips row groups.

    ``buckets`` spreads the output; the range split also divides a key that dominates.
    """
    if by:
        df = (df.repartitionByRange(buckets, by) if buckets else df.repartitionByRange(by)).sortWithinPartitions(by)
    df.write.mode(mode).parquet(path)


def _sorted(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order) if order else df


def write_csv(df: DataFrame, path: str, single: bool = False, order: Sequence[str] = ()) -> None:
    """CSV with a header; ``single`` is for node-level results, ``order`` sorts the whole table, part by part."""
    df = _sorted(df, order)
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    _sorted(df, order).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _listed(rows: Iterator[str], head: str, tail: str) -> Iterator[str]:
    """The lines of a document that separates its entries by commas."""
    yield head
    held = None
    for row in rows:
        if held is not None:
            yield held + ","
        held = row
    if held is not None:
        yield held
    yield tail


def write_json_array(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """One JSON array of objects, for node-level results; partitions are streamed in turn."""
    rows = _sorted(df, order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j"))
    files.write_lines(df.sparkSession, path, _listed((r["j"] for r in rows.toLocalIterator()), "[", "]"))


def write_geojson(df: DataFrame, path: str, *, identifier: str = "node_id", lon: str = "lon", lat: str = "lat",
                  properties: Sequence[str] | None = None) -> None:
    """FeatureCollection of node points; features are built in the tasks and streamed."""
    names = list(properties or [c for c in df.columns if c not in (identifier, lon, lat)])
    rows = df.select(feature(F.col(identifier), F.col(lon), F.col(lat), names).alias("f"))
    files.write_lines(df.sparkSession, path, _listed(
        (r["f"] for r in rows.toLocalIterator()), '{"type": "FeatureCollection", "features": [', "]}"))


def write_geojson_sequence(df: DataFrame, path: str, *, identifier: str = "node_id", lon: str = "lon", lat: str = "lat",
                           properties: Sequence[str] | None = None) -> None:
    """One feature a line, written by the tasks and committed by Spark, for tables of any size; a failed task leaves nothing."""
    names = list(properties or [c for c in df.columns if c not in (identifier, lon, lat)])
    df.select(feature(F.col(identifier), F.col(lon), F.col(lat), names).alias("value")).write.mode("overwrite").text(path)


def write_geoparquet(df: DataFrame, path: str, *, geometry: str = "geometry", crs: str = "EPSG:4326",
                     geometry_types: Sequence[str] = ("Point",)) -> None:
    """Parquet part files whose footers carry the ``geo`` entry Spark's writer cannot set.

    Each task streams its Arrow batches into a file of its own on the target's file system and moves it to the name of
    its partition at the end, so a repeated task replaces its own file.  What the folder held before is removed
    first.
    """
    if geometry not in df.columns:
        raise KeyError(f"geometry column {geometry!r} not found")
    column = {"encoding": "WKB", "crs": crs, "geometry_types": list(geometry_types)}
    geo = json.dumps({"version": "1.0.0", "primary_column": geometry, "columns": {geometry: column}}).encode()
    files.remove(df.sparkSession, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(path)
        system.create_dir(base, recursive=True)
        context, writer, count = TaskContext.get(), None, 0
        name = f"part-{context.partitionId():05d}.parquet"
        partial = f"{base}/.{name}.{context.taskAttemptId()}"
        for batch in batches:
            if writer is None:
                schema = batch.schema.with_metadata({**(batch.schema.metadata or {}), b"geo": geo})
                writer = pq.ParquetWriter(partial, schema, filesystem=system)
            writer.write_batch(batch.replace_schema_metadata(schema.metadata))
            count += batch.num_rows
        if writer is not None:
            writer.close()
            system.move(partial, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "rows": [count]})

    df.mapInArrow(write, "file string, rows long").write.mode("overwrite").json(files.join(path, "_written"))


def subset_key(nodes: Sequence[str], source: str = "") -> str:
    """Content hash of a node list and the identity of its source; repeats count once."""
    return hashlib.sha256("\n".join([source, *dict.fromkeys(nodes)]).encode("utf-8")).hexdigest()[:16]


def materialise_subset(df: DataFrame, nodes: Sequence[str], folder: str, source: str | None = None) -> DataFrame:
    """Rows of some nodes, written once per source and distinct list, and read back.

    ``source`` names the input; without it the files that the input is read from do.
    """
    spark = df.sparkSession
    source = "\n".join(sorted(df.inputFiles())) if source is None else source
    target = files.join(folder, f"nodes-{subset_key(nodes, source)}")
    if not files.exists(spark, files.join(target, "_SUCCESS")):
        df.where(F.col("node_id").isin(list(dict.fromkeys(nodes)))).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def append_results(results: DataFrame, path: str) -> None:
    """Add finished nodes to a result store."""
    results.withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(path)


def pending_nodes(nodes: DataFrame, path: str) -> DataFrame:
    """Nodes without a stored result; all of them when there is no store yet."""
    try:
        done = nodes.sparkSession.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return nodes
    return pending(nodes, done)


def stored_results(spark, path: str) -> DataFrame:
    """The latest stored result per node."""
    return latest_per_key(spark.read.parquet(path), "node_id", "finished_at").drop("finished_at")


def markdown_table(df: DataFrame) -> str:
    """A small result as a Markdown table; rows come in one partition after the other."""
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    for row in df.toLocalIterator():
        lines.append("| " + " | ".join("" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v) for v in row) + " |")
    return "\n".join(lines)
