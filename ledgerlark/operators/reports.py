"""Counting and coverage summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.money import ratio


def price_summary(prices: DataFrame) -> DataFrame:
    """Rows and lowest, highest and mean close per symbol."""
    return prices.groupBy("stock_symbol").agg(
        F.count("close").alias("records"),
        F.min("close").alias("min_price"),
        F.max("close").alias("max_price"),
        ratio(F.sum("close"), F.count("close")).alias("avg_price"),
    )


def coverage_summary(symbols: DataFrame, prices: DataFrame) -> DataFrame:
    """Rows and first and last time per symbol; symbols without prices count 0."""
    found = prices.groupBy("stock_symbol").agg(
        F.count(F.lit(1)).alias("price_count"),
        F.min("timestamp").alias("first_date"),
        F.max("timestamp").alias("last_date"),
    )
    return (
        symbols.select("stock_symbol")
        .join(found, "stock_symbol", "left")
        .withColumn("price_count", F.coalesce("price_count", F.lit(0)))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def load_totals(requested: DataFrame, loaded: DataFrame, fx_loaded: DataFrame) -> DataFrame:
    """Loaded price rows per requested symbol (0 for empty feeds), the FX row count under ``__fx__``, and
    ``__total__`` over prices without FX."""
    per_symbol = (
        requested.select("stock_symbol")
        .distinct()
        .join(loaded.groupBy("stock_symbol").agg(F.count(F.lit(1)).alias("records")), "stock_symbol", "left")
        .select("stock_symbol", F.coalesce("records", F.lit(0)).alias("records"))
    )
    fx = fx_loaded.agg(F.count(F.lit(1)).alias("records")).select(F.lit("__fx__").alias("stock_symbol"), "records")
    total = per_symbol.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records")).select(
        F.lit("__total__").alias("stock_symbol"), "records"
    )
    return per_symbol.unionByName(fx).unionByName(total)
