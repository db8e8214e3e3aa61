"""Small documents on whatever file system Spark can reach: local, HDFS, object stores."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import SparkSession


def join(base: str, *names: str) -> str:
    """A path below ``base``; schemes keep their slashes."""
    return "/".join([base.rstrip("/") or "/", *[n.strip("/") for n in names]])


def parent(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0]


def _open(spark: SparkSession, path: str):
    """Hadoop's file system and path objects, on the driver."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _open(spark, path)
    return system.exists(where)


def names(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Names of the files of a folder that end in ``suffix``, in order."""
    system, where = _open(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isFile() and s.getPath().getName().endswith(suffix))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    system, where = _open(spark, path)
    system.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _open(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str) -> Any:
    try:
        return json.loads(read_text(spark, path))
    except json.JSONDecodeError as broken:
        raise ValueError(f"{path} holds no valid JSON") from broken


def write_lines(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """Write a document line by line beside its place and move it there at the end."""
    system, where = _open(spark, path)
    partial = spark._jvm.org.apache.hadoop.fs.Path(path + ".partial")
    stream = system.create(partial, True)
    try:
        for block in _blocks(lines):
            stream.write(block)
    finally:
        stream.close()
    system.delete(where, False)
    if not system.rename(partial, where):
        raise OSError(f"could not move {path}.partial to {path}")


def _blocks(lines: Iterable[str], size: int = 1 << 16) -> Iterator[bytearray]:
    held = bytearray()
    for line in lines:
        held += line.encode("utf-8") + b"\n"
        if len(held) >= size:
            yield held
            held = bytearray()
    if held:
        yield held


def write_json(spark: SparkSession, path: str, payload: Any) -> None:
    write_lines(spark, path, [json.dumps(payload, indent=2, default=str)])
