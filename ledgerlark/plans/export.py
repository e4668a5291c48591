"""Jobs that publish the operational tables as lake tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.predicates import filter_range
from ledgerlark.schemas import EXCHANGE_RATES, SECURITIES, STOCK_PRICES, TRANSACTIONS, conform
from ledgerlark.sources.tables import Lake


@dataclass(frozen=True)
class Operational:
    """The operational tables, as read from the database or from files."""

    stocks: DataFrame
    stock_prices: DataFrame
    transactions: DataFrame
    gics_sectors: DataFrame
    markets: DataFrame
    exchange_rates: DataFrame


def export_prices(source: Operational, start: str | None = None, end: str | None = None) -> DataFrame:
    symbols = source.stocks.select(F.col("id").alias("stock_id"), F.col("symbol").alias("stock_symbol"))
    rows = filter_range(source.stock_prices, "timestamp", start, end).join(symbols, "stock_id")
    return conform(rows.withColumnRenamed("created_at", "ingestion_timestamp"), STOCK_PRICES)


def export_transactions(source: Operational, start: str | None = None, end: str | None = None) -> DataFrame:
    symbols = source.stocks.select(F.col("id").alias("stock_id"), F.col("symbol").alias("stock_symbol"))
    rows = filter_range(source.transactions, "transaction_date", start, end).join(symbols, "stock_id")
    return conform(
        rows.withColumnsRenamed({"id": "transaction_id", "created_at": "ingestion_timestamp"}), TRANSACTIONS
    )


def export_securities(source: Operational) -> DataFrame:
    """Stocks with sector and market codes; the sector name is the dimension's, else the override, else
    the raw text."""
    sectors = source.gics_sectors.select(
        F.col("id").alias("gics_sector_id"), F.col("name").alias("_sector"), F.col("code").alias("gics_sector_code")
    )
    markets = source.markets.select(F.col("id").alias("market_id"), F.col("code").alias("market_code"))
    rows = source.stocks.join(sectors, "gics_sector_id", "left").join(markets, "market_id", "left")
    return conform(
        rows.withColumn("gics_sector", F.coalesce("_sector", "gics_sector_override", "sector")).withColumnsRenamed(
            {"symbol": "stock_symbol", "updated_at": "ingestion_timestamp"}
        ),
        SECURITIES,
    )


def export_fx(source: Operational, start: str | None = None, end: str | None = None) -> DataFrame:
    rows = filter_range(source.exchange_rates, "timestamp", start, end)
    return conform(rows.withColumnRenamed("created_at", "ingestion_timestamp"), EXCHANGE_RATES)


def full_export(spark: SparkSession, source: Operational, lake: Lake) -> dict[str, int]:
    """Publish all four tables. Transactions merge by id, so a second run adds nothing."""
    return {
        "stock_prices": lake["stock_prices"].replace(export_prices(source)),
        "transactions": lake["transactions"].upsert(spark, export_transactions(source), "ingestion_timestamp"),
        "securities": lake["securities"].replace(export_securities(source)),
        "exchange_rates": lake["exchange_rates"].replace(export_fx(source)),
    }


def high_water_mark(target: DataFrame) -> str | None:
    """Newest ingestion time already published; None on an empty table. One value reaches the driver."""
    mark = target.agg(F.max("ingestion_timestamp").cast("string").alias("mark")).first()
    return mark["mark"]


def arrivals(exported: DataFrame, mark: str | None) -> DataFrame:
    """Rows ingested at or after the mark: ties at the mark are taken again and merged by key."""
    return filter_range(exported, "ingestion_timestamp", start=mark)


def incremental_export(spark: SparkSession, source: Operational, lake: Lake) -> dict[str, int]:
    """Merge what arrived since each table's own mark; history stays. Securities are refreshed whole."""
    written = {}
    exports = {
        "stock_prices": export_prices(source),
        "transactions": export_transactions(source),
        "exchange_rates": export_fx(source),
    }
    for name, rows in exports.items():
        table = lake[name]
        mark = high_water_mark(table.read(spark))
        written[name] = table.upsert(spark, arrivals(rows, mark), "ingestion_timestamp")
    written["securities"] = lake["securities"].replace(export_securities(source))
    return written
