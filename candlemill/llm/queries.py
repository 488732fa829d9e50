"""The registered queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from candlemill.llm import (
    chat, decontaminate, near_dup, packing, pii, prefix_trie, quality, rules, sharding, simhash, spelling, token_count,
    warc,
)
from candlemill.llm.shared import table, tokenizer_file
from candlemill.llm.sql import SPELLING, TRIE

Query = Callable[[SparkSession, str], DataFrame]


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn_chain(docs, table(spark, sf_dir, "labels")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.count_tokens(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")
    )
    return token_count.with_limit(counts, 1024)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048
    )


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 0.7)


def op9_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("row")


def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), most=2)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(keys)).drop("name")


def queries() -> dict[str, Query]:
    return {
        "op1_shards": op1_shards,
        "op2_warc": op2_warc,
        "op3_personal_data": op3_personal_data,
        "op4_quality_rules": op4_quality_rules,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_token_counts": op6_token_counts,
        "op7_packing": op7_packing,
        "op8_quality_scores": op8_quality_scores,
        "op9_benchmark_passages": op9_benchmark_passages,
        "op10_perspectives": op10_perspectives,
        "op11_fingerprints": op11_fingerprints,
        "op12_spelling": op12_spelling,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {
        "op2_warc": ROUND_TRIP, "op10_perspectives": PERSPECTIVES, "op12_spelling": SPELLING,
        "op13_prefix_trie": TRIE,
    }
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


ROUND_TRIP = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) || '00' AS hex FROM pages),
digests AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, CAST(i * 5 // 4 + 1 AS INTEGER), 3) AS INTEGER)
      >> CAST(7 - i * 5 % 4 AS INTEGER)) & 31) + 1, 1), '' ORDER BY i) AS payload_digest
  FROM (SELECT DISTINCT hex FROM p), range(32) t(i) GROUP BY hex),
judged AS (
  SELECT p.*, payload_digest, max(page_id) OVER (PARTITION BY payload) AS keeper
  FROM p JOIN digests USING (hex))
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM judged
"""

PERSPECTIVES = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'),
views AS (
  SELECT s.*, p.speaker,
         CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant' ELSE 'user' END
           AS spoken_as
  FROM said s JOIN speakers p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
heads AS (
  SELECT *, '<|im_start|>' || spoken_as
    || CASE WHEN spoken_as = 'user' THEN ' name=' || replace(role, '<|im_', '< |im_') ELSE '' END
    || chr(10) AS head FROM views),
segments AS (
  SELECT *, head || replace(text, '<|im_', '< |im_') || '<|im_end|>' || chr(10) AS segment FROM heads),
placed AS (
  SELECT *, row_number() OVER w - 1 AS place,
         CAST(sum(length(segment)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS finish
  FROM segments
  WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS LAST, role, text))
SELECT conv_id, speaker, place, turn, role, spoken_as, segment, finish - length(segment) AS start, finish,
       CASE WHEN spoken_as = 'assistant' THEN finish - length(segment) + length(head) END AS trained_from
FROM placed
"""
