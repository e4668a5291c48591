"""Named catalog tables: creation with hidden partitioning, writes, merges and listings.

These need a catalog with DataSource V2 tables; merges also need row-level operations. The Parquet
folders of ``tables`` serve where there is none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.upsert import newest_per_key
from ledgerlark.schemas import TABLES, conform


def create_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def _writer(df: DataFrame, namespace: str, table: str, provider: str | None):
    spec = TABLES[table]
    writer = conform(df, spec.schema).writeTo(f"{namespace}.{table}")
    if provider:
        writer = writer.using(provider)
    partitions = ([F.partitioning.days(spec.day_of)] if spec.day_of else []) + (
        [F.col(spec.identity)] if spec.identity else []
    )
    return writer.partitionedBy(*partitions) if partitions else writer


def create_table(spark: SparkSession, namespace: str, table: str, provider: str | None = None) -> None:
    """Create an empty declared table, partitioned by day and its identity column, unless it exists."""
    if not spark.catalog.tableExists(f"{namespace}.{table}"):
        _writer(spark.createDataFrame([], TABLES[table].schema), namespace, table, provider).create()


def create_all(spark: SparkSession, namespace: str, provider: str | None = None) -> None:
    create_namespace(spark, namespace)
    for table in TABLES:
        create_table(spark, namespace, table, provider)


def drop_all(spark: SparkSession, namespace: str) -> None:
    for table in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {namespace}.{table}")


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary)


def scan(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    return spark.table(f"{namespace}.{table}")


def replace(df: DataFrame, namespace: str, table: str, provider: str | None = None) -> None:
    """Full refresh that keeps the declared schema and partitioning."""
    _writer(df, namespace, table, provider).createOrReplace()


def append(df: DataFrame, namespace: str, table: str) -> None:
    conform(df, TABLES[table].schema).writeTo(f"{namespace}.{table}").append()


def upsert(batch: DataFrame, namespace: str, table: str, order: str | None = None) -> None:
    """Keyed MERGE, last write of the batch wins."""
    key: Sequence[str] = TABLES[table].key
    rows = newest_per_key(conform(batch, TABLES[table].schema), key, order)
    name = f"{namespace}.{table}"
    matched = F.expr(" AND ".join(f"{name}.{c} = source.{c}" for c in key))
    rows.alias("source").mergeInto(name, matched).whenMatched().updateAll().whenNotMatched().insertAll().merge()
