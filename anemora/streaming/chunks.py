"""Chunked reading with an anomaly table, as a file stream processed in micro-batches.

The toolkit's contract is "read in chunks, report anomalies per chunk".  A chunk here is a
micro-batch of newly arrived files; the checkpoint remembers what was read, so an
interrupted run continues and a finished one picks up new files only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from anemora.operators.cadence import with_gaps
from anemora.operators.ranges import anomalies
from anemora.sources import files
from anemora.sources.readers import ObservationFilter


def observation_chunks(spark: SparkSession, folder: str, schema: T.StructType, files_per_chunk: int = 8,
                       keep: ObservationFilter | None = None) -> DataFrame:
    """Streaming scan of a folder of Parquet files, filtered like a batch scan."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_chunk).parquet(folder)
    return stream if keep is None else keep.apply(stream)


def process_chunks(chunks: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``handle(chunk, number)`` on every chunk that is there, then stop."""
    return chunks.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def anomaly_sink(path: str, max_gap_seconds: int = 5400) -> Callable[[DataFrame, int], None]:
    """Handler that writes a chunk's gap and posterior anomalies, one folder per chunk.

    Beside them lies the last time seen of every node, one folder per chunk as well, so that a gap from one chunk to the next is
    found.  A chunk that is processed again after a failure reads the state before it and
    overwrites its own folders.
    """
    def handle(chunk: DataFrame, number: int) -> None:
        spark = chunk.sparkSession
        seen = chunk.select("node_id", "timestamp").withColumn("__old", F.lit(False))
        before = files.join(path, "_last", str(number - 1))
        rows = chunk.withColumn("__old", F.lit(False))
        if files.exists(spark, before):
            known = spark.read.parquet(before).withColumn("__old", F.lit(True))
            seen, rows = seen.unionByName(known), rows.unionByName(known, allowMissingColumns=True)
        found = anomalies(with_gaps(rows).where(~F.col("__old")).drop("__old"), max_gap_seconds)
        found.withColumn("chunk", F.lit(number)).write.mode("overwrite").parquet(files.join(path, f"chunk={number}"))
        last = seen.groupBy("node_id").agg(F.max("timestamp").alias("timestamp"))
        last.write.mode("overwrite").parquet(files.join(path, "_last", str(number)))
        files.remove(spark, files.join(path, "_last", str(number - 2)))

    return handle
