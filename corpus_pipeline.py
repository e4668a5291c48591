"""A training corpus from ``documents``: known languages, no repeated lines or documents, mixed and packed.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import language_id, line_dedup, mixing, near_dedup, packing
from ledgerlark.llm.graph import written
from ledgerlark.llm.queries import tokenizer_files


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with that language; rejected ones go.

    Learns from all labelled rows of ``docs``. Rows that repeat a doc_id go by their own texts.
    """
    identifier = language_id.fit(spark, docs)
    hashed = docs.withColumn("__hash", F.xxhash64("doc_id", "text"))
    found = language_id.identify(spark, hashed, identifier, "__hash").where(~F.col("rejected"))
    found = found.groupBy(F.col("doc_id").alias("__hash")).agg(F.first("lang_pred").alias("__lang"))
    return hashed.join(found, "__hash").withColumn("lang", F.col("__lang")).select(docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has alike; those left without any line go."""
    decided = line_dedup.fuzzy_lines(spark, docs)
    thinned = line_dedup.drop_lines(docs, decided)
    if "n_chars" in docs.columns:
        thinned = thinned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return thinned.select(docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near copies; one without id comes last.

    Rows are told apart by id and text; of rows equal in both one stays, the smallest by all columns.
    """
    named = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    decided = near_dedup.near_copies(spark, named, "__row").select(F.col("doc_id").alias("__row"), "component_id")
    rows = decided.groupBy("__row").agg(F.first("component_id").alias("__part"), (F.count("*") > 1).alias("__repeats"))
    rows = written(spark, rows, "rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    first = named.select("__row", "doc_id").join(rows, "__row").groupBy("__part").agg(F.min(order).alias("first"))
    kept = named.join(first.select("first.__row").join(rows, "__row"), "__row")
    again = kept.where("__repeats").groupBy("__row").agg(F.min(F.struct(*docs.columns)).alias("__first"))
    return kept.where("not __repeats").select(docs.columns).union(again.select("__first.*"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    plan = written(spark, mixing.mix(spark, docs).select(F.col("doc_id").alias("__id"), "source", "copies"), "mix")
    plan = plan.distinct().withColumnRenamed("source", "__source")
    same = docs["doc_id"].eqNullSafe(plan["__id"]) & docs["source"].eqNullSafe(plan["__source"])
    repeated = docs.join(plan, same).where("copies > 0")
    return repeated.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in windows of 2048 tokens."""
    return packing.pack(docs, *tokenizer_files())


STAGES = [
    ("language", known_language),
    ("lines", distinct_lines),
    ("near_copies", distinct_documents),
    ("mix", mixed_sources),
    ("pack", packed),
]

#: Language models, MinHash and tokenizers are beyond SQL: tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
