"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "anemora", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session.  On a cluster leave ``master`` unset and let spark-submit decide."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that change results (UTC) or plans (AQE)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_ready(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    The cluster names the shared folder in ``spark.checkpoint.dir``.  Only a local
    session without that setting (tests, laptops) gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    context.setCheckpointDir(os.path.join(tempfile.mkdtemp(prefix="anemora-"), "checkpoints"))


def held(df: DataFrame) -> DataFrame:
    """The frame as a checkpoint, for a reduced table that several aggregates read."""
    checkpoint_ready(df.sparkSession)
    return df.checkpoint()
