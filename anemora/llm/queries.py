"""The registered corpus queries, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.llm import alignment, extraction, language, lexical, mixing, mtree, packing, quality, sharding, simhash, substrings, token_files, vectors
from anemora.llm.common import table
from anemora.llm.pieces import default_path
from anemora.session import checkpoint_ready

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SHARDS = 24


def register(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@register
def op1_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), sharding.Tree.even(SHARDS))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register
def op2_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@register
def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op4_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language.held_out("doc_id", 3, 1)
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~out)
    scored = quality.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register
def op5_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


@register
def op6_hyperplane_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op7_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register
def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out("doc_id", 4, 2)
    model = language.train(docs.where(~out))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@register
def op11_shared_accumulators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op12_interval_coalescing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model"))


@register
def op13_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    checkpoint_ready(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/token-ids-{uuid.uuid4().hex}"
    token_files.write(docs, path, default_path("byte_bpe_50k.json"))
    return token_files.digests(spark, path)


_TREE = sharding.Tree.even(SHARDS)
_KEY = "coalesce(CAST(doc_id AS VARCHAR), '')"

# The checksum runs over the hexadecimal digits of the text, one table step per byte.
SQL["op1_hash_tree_shards"] = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
digits AS MATERIALIZED (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
bytes AS MATERIALIZED (SELECT doc_id, list_transform(regexp_extract_all(h, '..'), lambda x: CAST(('0x' || x) AS BIGINT)) AS b FROM digits),
base AS (
  SELECT doc_id, len(b) + 8 AS size,
         xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1]))) AS text_crc32,
         CAST({sharding.shard_sql(_TREE, _KEY)} AS INTEGER) AS shard,
         CAST({sharding.shard_sql(_TREE.with_shard(), _KEY)} AS INTEGER) AS grown_shard
  FROM bytes, steps),
turned AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), size, text_crc32)), 1, 13)) AS BIGINT) AS turn FROM base)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY turn, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM turned
"""

SQL["op9_source_mix"] = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [{', '.join(f'{float(w)!r}::DOUBLE' for w in mixing.WEIGHTS)}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} AS BIGINT) + 1] AS w,
         sum(source_size) OVER () * 1.5::DOUBLE AS wanted FROM sources),
rounds(step, stopped) AS (
  SELECT 0, CAST([] AS VARCHAR[])
  UNION ALL
  SELECT step + 1, n FROM (
    SELECT step, stopped, (
      SELECT coalesce(list(coalesce(s.source, chr(0))), []) FROM weighed s WHERE list_contains(stopped, coalesce(s.source, chr(0))) OR 2.0::DOUBLE * s.source_size <= s.w * (
        SELECT (any_value(f.wanted) - coalesce(sum(2.0::DOUBLE * f.source_size) FILTER (list_contains(stopped, coalesce(f.source, chr(0)))), 0)) / sum(f.w) FILTER (NOT list_contains(stopped, coalesce(f.source, chr(0)))) FROM weighed f)
    ) AS n FROM rounds) WHERE len(n) > len(stopped) AND len(n) < (SELECT count(*) FROM weighed)),
ended AS (SELECT stopped FROM rounds ORDER BY step DESC LIMIT 1),
level AS (
  SELECT (any_value(wanted) - coalesce(sum(2.0::DOUBLE * source_size) FILTER (list_contains(stopped, coalesce(source, chr(0)))), 0)) / sum(w) FILTER (NOT list_contains(stopped, coalesce(source, chr(0)))) AS per_weight
  FROM weighed, ended),
goals AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, w * per_weight) AS target FROM weighed, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST(('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / {float(1 << 52)!r} AS draw
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rated
"""
