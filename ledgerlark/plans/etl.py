"""The load job: feeds to prices and rates, a bought portfolio, checked holdings, published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.allocation import equal_cash_purchases
from ledgerlark.operators.holdings import weighted_holdings
from ledgerlark.operators.reports import load_totals
from ledgerlark.operators.valuation import verified_totals, verify_holdings
from ledgerlark.schemas import TRANSACTIONS, conform
from ledgerlark.sources.feeds import normalize_fx, normalize_ohlcv, rejected_rows
from ledgerlark.sources.tables import Lake


@dataclass(frozen=True)
class LoadConfig:
    portfolio_id: str
    portfolio_name: str
    initial_cash: float = 100_000.0
    base_currency: str = "AUD"
    days_back: int = 7


def create_portfolio(spark: SparkSession, name: str, description: str, currency: str) -> DataFrame:
    """One portfolio row with a generated id."""
    return spark.range(1).select(
        F.expr("uuid()").alias("portfolio_id"),
        F.lit(name).alias("name"),
        F.lit(description).alias("description"),
        F.lit(currency).alias("currency"),
        F.current_timestamp().alias("created_at"),
    )


def purchases(prices: DataFrame, symbols: DataFrame, config: LoadConfig) -> DataFrame:
    """Equal-cash BUY rows as transactions; ids follow from portfolio and symbol, so reruns repeat them."""
    bought = equal_cash_purchases(prices, symbols, config.initial_cash, config.days_back)
    return conform(
        bought.withColumns(
            {
                "transaction_id": F.concat_ws("-", F.lit(config.portfolio_id), "stock_symbol"),
                "portfolio_id": F.lit(config.portfolio_id),
                "commission": F.lit(0),
                "ingestion_timestamp": F.col("transaction_date"),
            }
        ),
        TRANSACTIONS,
    )


def run_load(
    spark: SparkSession,
    lake: Lake,
    watchlist: DataFrame,
    price_feed: DataFrame,
    fx_feed: DataFrame,
    config: LoadConfig,
    loaded_at: str,
) -> DataFrame:
    """Load the watchlist's prices and all rates, buy the portfolio and value it; returns load totals
    per symbol, the rejected row count and the portfolio's totals as (item, records, amount) rows.

    Each step reads the tables the one before wrote. All steps merge by key, so a failed run is simply
    run again.
    """
    stamp = F.lit(loaded_at).cast("timestamp")
    wanted = watchlist.select("stock_symbol").distinct()
    feed = price_feed.join(wanted, "stock_symbol", "left_semi")
    lake["stock_prices"].upsert(spark, normalize_ohlcv(feed).withColumn("ingestion_timestamp", stamp))
    lake["exchange_rates"].upsert(spark, normalize_fx(fx_feed).withColumn("ingestion_timestamp", stamp))

    prices = lake["stock_prices"].read(spark)
    lake["transactions"].upsert(spark, purchases(prices, wanted, config))
    trades = lake["transactions"].read(spark).where(F.col("portfolio_id") == config.portfolio_id)
    totals = verified_totals(verify_holdings(weighted_holdings(trades), prices))

    records = load_totals(wanted, prices, lake["exchange_rates"].read(spark))
    rejected = rejected_rows(feed).agg(F.count(F.lit(1)).alias("records"))
    bought = trades.agg(F.count(F.lit(1)).alias("records"))
    none = F.lit(None).cast("double")
    return (
        records.select(F.col("stock_symbol").alias("item"), "records", none.alias("amount"))
        .unionByName(rejected.select(F.lit("__rejected__").alias("item"), "records", none.alias("amount")))
        .unionByName(bought.select(F.lit("__transactions__").alias("item"), "records", none.alias("amount")))
        .unionByName(
            totals.select(
                F.concat(F.lit("__value__"), "portfolio_id").alias("item"),
                F.lit(1).cast("bigint").alias("records"),
                F.col("current_value").alias("amount"),
            )
        )
    )
