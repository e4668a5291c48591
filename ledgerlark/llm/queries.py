"""The registered queries of the numbered operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    language_id,
    license_scan,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    packing,
    phrases,
    prefix_trie,
    sharding,
    text_search,
    url_filter,
    vector_search,
)

from ledgerlark.llm.sql import OP11_SQL, OP12_SQL, OP13_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(spark, table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"))
    identifier = language_id.fit(spark, docs.where(~held_out & F.col("doc_id").isNotNull()))
    found = language_id.identify(spark, docs, identifier)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(spark, table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(spark, table(spark, sf_dir, "documents"), shards=40)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(spark, table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_files())


def tokenizer_files() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op8_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_search.search(spark, table(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.fuzzy_lines(spark, table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, url_filter.RULES)
    return url_filter.judge(spark, table(spark, sf_dir, "pages"), rules).drop("component")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark, table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12) AS hash
  FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), reached AS (
  SELECT *, 2 * source_size / weight AS reach FROM ranked
), levels AS (
  SELECT *,
    (1.5 * (sum(source_size) OVER ()) - coalesce(sum(2 * source_size) OVER w, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM reached
  WINDOW w AS (ORDER BY reach, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fixed AS (
  SELECT level FROM levels WHERE reach >= level ORDER BY reach, source NULLS LAST LIMIT 1
), planned AS (
  SELECT source, source_size, least(coalesce((SELECT level FROM fixed), 'Infinity'::DOUBLE) * weight, 2.0 * source_size) AS target
  FROM reached
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS whole,
         target - CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END * source_size AS budget
  FROM planned
), hashes AS (
  SELECT s.source, hash, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY s.source ORDER BY hash) AS upto
  FROM sized s GROUP BY s.source, hash
), passed AS (
  SELECT h.source, min_by(h.hash, h.hash) AS bound, min_by(h.size, h.hash) AS size, min_by(h.upto, h.hash) AS upto, any_value(r.budget) AS budget
  FROM hashes h JOIN rests r ON h.source IS NOT DISTINCT FROM r.source
  WHERE r.source_size > 0 AND h.upto > r.budget GROUP BY h.source
), bounds AS (
  SELECT source, bound, upto - budget < budget - upto + size AS with_it FROM passed
)
SELECT s.doc_id, s.size, r.source_size, r.target,
  (s.size * least(r.whole + coalesce((s.hash < b.bound OR (s.hash = b.bound AND b.with_it))::INT, 0), 2))::BIGINT AS taken
FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
LEFT JOIN bounds b ON s.source IS NOT DISTINCT FROM b.source
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_language_id,
        op3_near_dedup,
        op4_sharding,
        op5_vector_search,
        op6_license_scan,
        op7_packing,
        op8_text_search,
        op9_line_dedup,
        op10_mixing,
        op11_url_filter,
        op12_prefix_trie,
        op13_collocations,
    )
}
ORACLE: dict[str, str] = {
    "op10_mixing": OP10_SQL,
    "op11_url_filter": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
