"""GeoParquet as a data source whose tables appear whole or not at all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: The folder of a table under which tasks write; readers pass over names with an underscore.
STAGED = "_staged-"


def geo_entry(geometry: str, crs: str, geometry_types: Sequence[str]) -> bytes:
    """The ``geo`` entry of a Parquet footer; its keys and version are fixed values of the format."""
    column = {"encoding": "WKB", "crs": crs, "geometry_types": list(geometry_types)}
    return json.dumps({"version": "1.0.0", "primary_column": geometry, "columns": {geometry: column}}).encode()


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class GeoParquetWriter(DataSourceArrowWriter):
    """Tasks write below a folder of this write; the driver moves their files when all are there.

    Every attempt of a task has a file of its own and only those that a successful attempt reports are moved, so a repeated or lost task
    leaves neither half files nor copies.  A failed write removes its folder and leaves the table as it was.
    """

    def __init__(self, path: str, geo: bytes, overwrite: bool):
        self.path, self.geo, self.overwrite = path, geo, overwrite
        self.write_id = uuid.uuid4().hex

    def _folder(self) -> tuple[fs.FileSystem, str, str]:
        system, base = fs.FileSystem.from_uri(self.path)
        return system, base, f"{base}/{STAGED}{self.write_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _, staged = self._folder()
        context, writer, rows = TaskContext.get(), None, 0
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{self.write_id}.parquet"
        try:
            for batch in iterator:
                if writer is None:
                    system.create_dir(staged, recursive=True)
                    schema = batch.schema.with_metadata({**(batch.schema.metadata or {}), b"geo": self.geo})
                    writer = pq.ParquetWriter(f"{staged}/{name}", schema, filesystem=system)
                writer.write_batch(batch.replace_schema_metadata(schema.metadata))
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name if writer is not None else "", rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, base, staged = self._folder()
        system.create_dir(base, recursive=True)
        before = [f for f in system.get_file_info(fs.FileSelector(base)) if f.type == fs.FileType.File and f.base_name.endswith(".parquet")] if self.overwrite else []
        for message in messages:
            if message is not None and message.file:
                system.move(f"{staged}/{message.file}", f"{base}/{message.file}")
        for old in before:
            system.delete_file(old.path)
        self._clear(system, staged)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, staged = self._folder()
        self._clear(system, staged)

    @staticmethod
    def _clear(system: fs.FileSystem, staged: str) -> None:
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class GeoParquetSource(DataSource):
    """``df.write.format("geoparquet")``; options ``path``, ``geometry``, ``crs`` and ``geometry_types``, the last joined by commas."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema: StructType, overwrite: bool) -> GeoParquetWriter:
        geometry = self.options.get("geometry", "geometry")
        if geometry not in schema.names:
            raise KeyError(f"geometry column {geometry!r} not found")
        geo = geo_entry(geometry, self.options.get("crs", "EPSG:4326"), self.options.get("geometry_types", "Point").split(","))
        return GeoParquetWriter(self.options["path"], geo, overwrite)


def write(df: DataFrame, path: str, *, geometry: str = "geometry", crs: str = "EPSG:4326", geometry_types: Sequence[str] = ("Point",), mode: str = "overwrite") -> None:
    """Write a table of WKB geometries, replacing (``overwrite``) or adding to (``append``) what is there."""
    if geometry not in df.columns:
        raise KeyError(f"geometry column {geometry!r} not found")
    df.sparkSession.dataSource.register(GeoParquetSource)
    writer = df.write.format("geoparquet").mode(mode).option("geometry", geometry).option("crs", crs)
    writer.option("geometry_types", ",".join(geometry_types)).option("path", path).save()
