"""Currency conversion, sector and region weights, equal-cash buying."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.money import pct
from ledgerlark.functions.symbols import DEFAULT_CURRENCY
from ledgerlark.operators.latest import latest_by, latest_fx
from ledgerlark.operators.valuation import position_values


def securities_view(securities: DataFrame) -> DataFrame:
    """Sector and region of each security with defaults; an override outranks the sector."""
    unknown = F.lit("Unknown")
    return securities.select(
        "stock_symbol",
        F.coalesce("gics_sector_override", "gics_sector", unknown).alias("gics_sector"),
        "gics_sector_code",
        F.coalesce("country_code", unknown).alias("country_code"),
        F.coalesce("quote_currency", F.lit(DEFAULT_CURRENCY)).alias("quote_currency"),
        F.coalesce("market_code", unknown).alias("market_code"),
    )


def rates_against(latest: DataFrame, base_currency: str) -> DataFrame:
    """Per currency, the rate quoted from the base (direct) and the one quoted to it (inverse)."""
    quoted_from = F.col("base_currency") == base_currency
    quoted_to = F.col("quote_currency") == base_currency
    return (
        latest.where(quoted_from | quoted_to)
        .withColumn("currency", F.when(quoted_from, F.col("quote_currency")).otherwise(F.col("base_currency")))
        .groupBy("currency")
        .agg(
            F.max(F.when(quoted_from, F.col("rate"))).alias("direct_rate"),
            F.max(F.when(quoted_to, F.col("rate"))).alias("inverse_rate"),
        )
    )


def with_fx_multiplier(df: DataFrame, rates: DataFrame, base_currency: str) -> DataFrame:
    """Add ``fx_multiplier`` from ``quote_currency`` to the base.

    1 for the base itself, else 1 / direct rate, else the inverse rate, else 1.
    """
    against = rates_against(latest_fx(rates), base_currency)
    multiplier = (
        F.when(F.col("quote_currency") == base_currency, F.lit(1.0))
        .when(F.col("direct_rate").isNotNull(), F.try_divide(F.lit(1.0), F.col("direct_rate")))
        .when(F.col("inverse_rate").isNotNull(), F.col("inverse_rate"))
        .otherwise(F.lit(1.0))
    )
    return (
        df.join(against, df["quote_currency"] == against["currency"], "left")
        .withColumn("fx_multiplier", multiplier)
        .drop("currency", "direct_rate", "inverse_rate")
    )


def holdings_base_value(
    holdings: DataFrame,
    prices: DataFrame,
    securities: DataFrame,
    rates: DataFrame,
    base_currency: str = "AUD",
    as_of: str | None = None,
) -> DataFrame:
    """Positions with price, security attributes and value in the base currency.

    Rates are always the latest. A symbol missing from ``securities`` keeps NULL attributes and
    multiplier 1.
    """
    valued = (
        position_values(holdings, prices, as_of)
        .drop("unrealized_gain", "unrealized_gain_pct")
        .withColumnRenamed("market_value", "local_market_value")
        .join(securities_view(securities), "stock_symbol", "left")
    )
    return with_fx_multiplier(valued, rates, base_currency).withColumn(
        "market_value_base", F.col("local_market_value").cast("double") * F.col("fx_multiplier")
    )


def _weight(value: str) -> Column:
    """Share of the portfolio's total; the window runs over the few aggregated rows."""
    total = F.sum(value).over(Window.partitionBy("portfolio_id"))
    return pct(F.col(value), total)


def sector_allocation(valued: DataFrame) -> DataFrame:
    """Value, weight, quantity and mean rate per portfolio and sector, heaviest first."""
    return (
        valued.groupBy("portfolio_id", "gics_sector")
        .agg(
            F.sum("market_value_base").alias("market_value_base"),
            F.sum("total_quantity").alias("total_quantity"),
            F.avg("fx_multiplier").alias("avg_fx_rate"),
        )
        .withColumn("weight_pct", _weight("market_value_base"))
        .select("portfolio_id", "gics_sector", "market_value_base", "weight_pct", "total_quantity", "avg_fx_rate")
        .orderBy("portfolio_id", F.col("weight_pct").desc())
    )


def region_allocation(valued: DataFrame) -> DataFrame:
    """Value and weight per portfolio, country and market, heaviest first."""
    return (
        valued.groupBy("portfolio_id", "country_code", "market_code")
        .agg(F.sum("market_value_base").alias("market_value_base"))
        .withColumn("weight_pct", _weight("market_value_base"))
        .orderBy("portfolio_id", F.col("weight_pct").desc())
    )


def equal_cash_purchases(prices: DataFrame, symbols: DataFrame | None, cash: float, days_back: int = 7) -> DataFrame:
    """BUY rows that spread ``cash`` evenly over the ``symbols`` (all if None) that have a price.

    All are bought ``days_back`` days before the latest price of any of them, at the last close by
    then and in whole shares; symbols without such a price, or too dear for one share, get no row.
    """
    wanted = prices
    if symbols is not None:
        wanted = prices.join(symbols.select("stock_symbol").distinct(), "stock_symbol", "left_semi")
    newest = latest_by(wanted, ["stock_symbol"], "timestamp", {"last_seen": "timestamp"})
    # A one-row subquery: the purchase date and the number of symbols sharing the cash.
    back = F.expr(f"INTERVAL {int(days_back)} DAYS")
    terms = newest.agg(
        F.struct((F.max("last_seen") - back).alias("bought_at"), F.count(F.lit(1)).alias("names")).alias("terms")
    ).scalar()
    bought_at = terms["bought_at"]
    quotes = latest_by(
        wanted.where(F.col("timestamp") <= bought_at), ["stock_symbol"], "timestamp", {"price": "close"}
    )
    budget = F.try_divide(F.lit(float(cash)), terms["names"])
    shares = F.floor(F.try_divide(budget, F.col("price").cast("double")))
    return (
        quotes.withColumn("quantity", shares)
        .where(F.col("quantity") > 0)
        .select(
            "stock_symbol",
            F.lit("BUY").alias("transaction_type"),
            "quantity",
            "price",
            bought_at.alias("transaction_date"),
        )
    )
