"""Market value, unrealised gain and return of positions and portfolios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.money import pct, ratio
from ledgerlark.functions.predicates import in_range
from ledgerlark.operators.latest import latest_prices


def position_values(holdings: DataFrame, prices: DataFrame, as_of: str | None = None) -> DataFrame:
    """Positions with the last close at or before ``as_of``; positions without a price drop out.

    Holdings are taken as given: the as-of date limits prices only.
    """
    market_value = F.col("total_quantity") * F.col("current_price")
    gain = F.col("market_value") - F.col("total_cost")
    return (
        holdings.join(latest_prices(prices, as_of), "stock_symbol")
        .withColumn("market_value", market_value)
        .withColumn("unrealized_gain", gain)
        .withColumn("unrealized_gain_pct", ratio(F.col("unrealized_gain"), F.col("total_cost")) * 100)
    )


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column).cast("double"), F.lit(0.0))


def portfolio_value(positions: DataFrame, portfolios: DataFrame | None = None) -> DataFrame:
    """Totals per portfolio. With ``portfolios``, those without positions show zeros."""
    if portfolios is not None:
        positions = portfolios.select("portfolio_id").join(positions, "portfolio_id", "left")
    return (
        positions.groupBy("portfolio_id")
        .agg(
            _total("market_value").alias("total_value"),
            _total("total_cost").alias("total_cost"),
            _total("unrealized_gain").alias("unrealized_gain"),
        )
        .withColumn("unrealized_gain_pct", pct(F.col("unrealized_gain"), F.col("total_cost")))
    )


def portfolio_returns(
    holdings: DataFrame, prices: DataFrame, start: str | None, end: str | None = None, portfolios: DataFrame | None = None
) -> DataFrame:
    """Value of today's positions at two dates and the return between them, from one price scan.

    A position counts at a date only if its symbol has a price by then. With ``portfolios``, those without
    holdings show zeros.
    """
    if portfolios is not None:
        holdings = portfolios.select("portfolio_id").distinct().join(holdings, "portfolio_id", "left")

    def close_at(date: str | None) -> Column:
        return F.max_by("close", F.when(in_range("timestamp", end=date), F.col("timestamp")))

    by_symbol = prices.groupBy("stock_symbol").agg(
        close_at(start).alias("start_close"), close_at(end).alias("end_close")
    )
    gain = F.col("end_value") - F.col("start_value")
    return (
        holdings.join(by_symbol, "stock_symbol", "left")
        .withColumn("start_worth", F.col("total_quantity") * F.col("start_close"))
        .withColumn("end_worth", F.col("total_quantity") * F.col("end_close"))
        .groupBy("portfolio_id")
        .agg(_total("start_worth").alias("start_value"), _total("end_worth").alias("end_value"))
        .withColumn("total_return", gain)
        .withColumn("total_return_pct", pct(F.col("total_return"), F.col("start_value")))
    )


def holdings_report(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """Profit and loss per position, rounded to 2 places as printed.

    Quotients stay DECIMAL until they are rounded, so that halves round up as in exact arithmetic.
    Gain is value - cost, which is (price - average) * quantity without a quotient in between.
    """
    exact = T.DecimalType(28, 6)
    quantity, cost = F.col("total_quantity").cast(exact), F.col("total_cost").cast(exact)
    value = (F.col("total_quantity") * F.col("current_price")).cast(exact)
    return holdings.join(latest_prices(prices), "stock_symbol").select(
        "portfolio_id",
        F.col("stock_symbol").alias("symbol"),
        F.col("total_quantity").alias("quantity"),
        F.round(F.try_divide(cost, quantity), 2).alias("avg_cost"),
        F.round("current_price", 2).alias("current_price"),
        F.round(value, 2).alias("market_value"),
        F.round(value - cost, 2).alias("unrealized_pnl"),
        F.round(F.try_divide(((value - cost) * 100).cast(exact), cost), 2).alias("pnl_pct"),
    )


def report_with_totals(report: DataFrame) -> DataFrame:
    """Report rows plus a TOTAL row per portfolio; its cost sums rounded average cost * quantity."""
    cost = F.col("avg_cost").cast("decimal(20,2)") * F.col("quantity")
    value = F.col("market_value")
    is_total = F.grouping("symbol") == 1
    return (
        report.withColumn("_cost", cost)
        .withColumn("_value", value)
        .rollup("portfolio_id", "symbol")
        .agg(F.sum("_cost").alias("cost"), F.sum("_value").alias("value"), is_total.alias("is_total"))
        .where(F.col("portfolio_id").isNotNull())
        .select(
            "portfolio_id",
            F.when(F.col("is_total"), F.lit("TOTAL")).otherwise(F.col("symbol")).alias("symbol"),
            "cost",
            "value",
            (F.col("value") - F.col("cost")).alias("pnl"),
            pct(F.col("value") - F.col("cost"), F.col("cost")).alias("pnl_pct"),
        )
    )


def verify_holdings(stored: DataFrame, prices: DataFrame) -> DataFrame:
    """Stored weighted-average positions against the latest close."""
    quantity, average = F.col("quantity").cast("double"), F.col("average_cost").cast("double")
    price = F.col("current_price").cast("double")
    return stored.join(latest_prices(prices), "stock_symbol").select(
        "portfolio_id",
        "stock_symbol",
        "quantity",
        "average_cost",
        "current_price",
        (quantity * average).alias("total_cost"),
        (quantity * price).alias("current_value"),
        (ratio(price - average, average) * 100).alias("pnl_pct"),
    )


def verified_totals(verified: DataFrame) -> DataFrame:
    """Investment, value and profit per portfolio of ``verify_holdings``."""
    gain = F.col("current_value") - F.col("total_cost")
    return (
        verified.groupBy("portfolio_id")
        .agg(_total("total_cost").alias("total_cost"), _total("current_value").alias("current_value"))
        .withColumn("pnl", gain)
        .withColumn("pnl_pct", pct(F.col("pnl"), F.col("total_cost")))
    )
