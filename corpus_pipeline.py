"""The corpus pipeline: language, near-duplicates, repeated passages, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.llm import language, mixing, packing, similar, substrings
from anemora.llm.common import table
from anemora.session import checkpoint_ready, configure

#: SQL cannot express language identification; tests compare each stage with a brute-force version.
ORACLE_SQL = None

#: Least share of a text's words in its language; texts below it and texts without a letter go.
LEAST_SHARE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language; ``lang`` stays as it came."""
    model = language.train(docs.where(~language.held_out("doc_id", 4, 2)))
    return language.keep_identified(docs, model, LEAST_SHARE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return similar.deduplicate(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 20 words or more that start earlier; documents of which nothing is left go, ``n_chars`` follows the text."""
    found = substrings.repeats(docs)
    cut = F.col("n_removed") > 0
    left = found.where(~cut | (F.col("n_removed") < F.col("n_words")))
    return left.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat(mixing.mix(docs)).select(*docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and position of every document of the mix."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("source_mix", mix_sources),
    ("packing", pack_batches),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder that the cluster names and read again."""
    configure(spark)
    checkpoint_ready(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
