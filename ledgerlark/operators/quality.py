"""Data-quality checks: constraints as set-based violation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.symbols import MARKETS, SECTORS, sector_code
from ledgerlark.operators.holdings import POSITION


def missing_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULL count of every required column, as rows; one pass over the data."""
    required = [f.name for f in schema.fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "null_count")


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is none of ``allowed``; NULL passes, as in a CHECK constraint."""
    return df.where(~F.col(column).isin(*allowed))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parents = parent.select(F.col(parent_key).alias(foreign_key))
    return child.where(F.col(foreign_key).isNotNull()).join(parents, foreign_key, "left_anti")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill NULLs of the named columns with their defaults."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()})


def empty_feeds(requested: DataFrame, loaded: DataFrame) -> DataFrame:
    """Requested symbols for which no row arrived."""
    return requested.select("stock_symbol").distinct().join(loaded, "stock_symbol", "left_anti")


def reconcile_holdings(weighted: DataFrame, net: DataFrame) -> DataFrame:
    """Positions whose weighted-average quantity differs from the net quantity; either may be missing."""
    stored = F.coalesce(F.col("weighted_quantity").cast("decimal(38,6)"), F.lit(0))
    expected = F.coalesce(F.col("net_quantity").cast("decimal(38,6)"), F.lit(0))
    return (
        weighted.select(*POSITION, F.col("quantity").alias("weighted_quantity"))
        .join(net.select(*POSITION, F.col("total_quantity").alias("net_quantity")), POSITION, "full")
        .withColumn("difference", stored - expected)
        .where(F.col("difference") != 0)
    )


def watchlist_violations(entries: DataFrame) -> DataFrame:
    """Watchlist rows with an unknown sector or market, a lower-case ticker or a foreign suffix."""
    suffix_of = F.create_map(*[F.lit(x) for suffix, m in MARKETS.items() for x in (m[0], suffix)])
    suffix = F.try_element_at(suffix_of, F.col("market_code"))
    codes = F.array(*[sector_code(F.lit(s)) for s in SECTORS])
    problems = F.array_compact(
        F.array(
            F.when(~F.array_contains(codes, F.col("gics_sector_code")), F.lit("sector")),
            F.when(suffix.isNull(), F.lit("market")),
            F.when(F.col("stock_symbol") != F.upper("stock_symbol"), F.lit("case")),
            F.when(~F.endswith("stock_symbol", suffix), F.lit("suffix")),
        )
    )
    return entries.withColumn("problems", problems).where(F.size("problems") > 0)
