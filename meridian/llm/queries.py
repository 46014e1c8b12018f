"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.ann import nearest
from meridian.llm.bpe import encode_digests
from meridian.llm.common import table
from meridian.llm.conversation_repair import damage, repair
from meridian.llm.exact_dedup import exact_dedup
from meridian.llm.hard_negatives import hard_negatives, quantised
from meridian.llm.language_id import predict
from meridian.llm.language_id import train as train_language
from meridian.llm.license_scan import license_scan, license_sql
from meridian.llm.maxent_lm import lm_scores
from meridian.llm.near_dedup import near_dedup
from meridian.llm.packing import pack
from meridian.llm.sharding import shard_by_size
from meridian.llm.substring_dedup import substring_dedup
from meridian.llm.toxicity import crc_fold, score, train

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op1_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS len,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha AS text_sha256
FROM d WINDOW w AS (PARTITION BY sha ORDER BY len DESC, doc_id)
"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_size(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "source")


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), words=3, threshold=0.85).select(
        "row.doc_id", "n_shingles", "component_id", "kept")


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), 20).select(
        "rest.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


TOXIC_FROM = 0.3


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model, keep=["doc_id"]).select("row.doc_id", "score").select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = quantised(table(spark, sf_dir, "embeddings").withColumn("label", label))
    return hard_negatives(rows, F.col("ident") % 100 == 0, positives=5, negatives=10, lowest=30, highest=90)


ORACLE["op11_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = train_language(docs, crc_fold(F.col("doc_id"), 5) != 0)
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), 7) != 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).withColumn("notices", F.array_join("notices", ","))


ORACLE["op3_license_scan"] = license_sql()
