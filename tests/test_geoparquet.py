import json
import os
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from anemora.functions.special import log_gamma, log_gamma_of
from anemora.sources import geoparquet


def _points(spark, n, start=0):
    data = [(f"n{i}", bytearray(struct.pack("<BIdd", 1, 1, float(i), 2.0))) for i in range(start, start + n)]
    return spark.createDataFrame(data, "node_id string, geometry binary")


def _ids(spark, path):
    return sorted(r.node_id for r in spark.read.parquet(path).collect())


def test_write_replaces_and_appends(spark, tmp_path):
    path = str(tmp_path / "geo")
    geoparquet.write(_points(spark, 20).repartition(3), path)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 3 and not [f for f in os.listdir(path) if f.startswith("_")]
    geo = json.loads(pq.read_schema(f"{path}/{files[0]}").metadata[b"geo"])
    assert geo["primary_column"] == "geometry" and geo["columns"]["geometry"]["encoding"] == "WKB"
    geoparquet.write(_points(spark, 5, 100), path, mode="append")
    assert len(_ids(spark, path)) == 25
    geoparquet.write(_points(spark, 4), path)
    assert _ids(spark, path) == ["n0", "n1", "n2", "n3"]
    with pytest.raises(KeyError):
        geoparquet.write(_points(spark, 1).drop("geometry"), path)


def test_failed_write_leaves_the_table(spark, tmp_path):
    """A task that fails takes the whole write back; the table before it stays."""
    path = str(tmp_path / "geo")
    geoparquet.write(_points(spark, 4), path)
    before = sorted(os.listdir(path))
    broken = _points(spark, 40, 10).repartition(4).withColumn("node_id", F.when(F.col("node_id") == "n33", F.raise_error(F.lit("lost"))).otherwise(F.col("node_id")))
    with pytest.raises(Exception, match="lost|aborted|Writing job"):
        geoparquet.write(broken, path)
    assert sorted(os.listdir(path)) == before and len(_ids(spark, path)) == 4


def test_repeated_attempts_count_once(tmp_path):
    """Of two attempts of a task only the reported one is moved."""
    writer = geoparquet.GeoParquetWriter(str(tmp_path / "geo"), geoparquet.geo_entry("geometry", "EPSG:4326", ("Point",)), True)
    system, base, staged = writer._folder()
    system.create_dir(staged, recursive=True)
    for name in ("part-0-1.parquet", "part-0-2.parquet"):
        with system.open_output_stream(f"{staged}/{name}") as out:
            out.write(b"x")
    writer.commit([geoparquet.Written("part-0-2.parquet", 1), geoparquet.Written("", 0), None])
    assert os.listdir(base) == ["part-0-2.parquet"]
    writer.abort([])


def test_log_gamma_expression(spark):
    values = [0.01, 0.3, 0.4999, 0.5, 1.0, 1.5, 2.0, 3.7, 12.0, 170.5]
    got = [r.g for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").orderBy("i").select(log_gamma_of(F.col("x")).alias("g")).collect()]
    assert got == pytest.approx(log_gamma(values).tolist(), rel=1e-12, abs=1e-13)
