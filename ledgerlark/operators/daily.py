"""Portfolio values day by day from position intervals and carried-forward closes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.money import notional, ratio, signed

UNITS = "decimal(28,6)"


def position_intervals(transactions: DataFrame, last_day: str, strict: bool = False) -> DataFrame:
    """portfolio_id, stock_symbol, valid_from, valid_to, quantity: each open quantity and the days it held, both included.

    Trades of a day act at its end and are summed before they are ordered, so a position has at most a
    row a day. Trades without a date belong to no day and drop out; intervals end with ``last_day``.
    """
    day = F.to_date("transaction_date")
    deltas = (
        transactions.where(F.col("transaction_date").isNotNull() & (day <= F.lit(last_day).cast("date")))
        .groupBy("portfolio_id", "stock_symbol", day.alias("valid_from"))
        .agg(F.sum(signed(F.col("quantity"), strict=strict)).cast(UNITS).alias("_change"))
    )
    by_day = Window.partitionBy("portfolio_id", "stock_symbol").orderBy("valid_from")
    return (
        deltas.withColumn("quantity", F.sum("_change").over(by_day).cast(UNITS))
        .withColumn("valid_to", F.coalesce(F.date_sub(F.lead("valid_from").over(by_day), 1), F.lit(last_day).cast("date")))
        .where(F.col("quantity") > 0)
        .select("portfolio_id", "stock_symbol", "valid_from", "valid_to", "quantity")
    )


def carried_closes(prices: DataFrame, last_day: str) -> DataFrame:
    """stock_symbol, day, close: the last close so far on every day from a symbol's first price on; days without a price carry."""
    closes = (
        prices.where(F.col("close").isNotNull() & F.col("timestamp").isNotNull())
        .groupBy("stock_symbol", F.to_date("timestamp").alias("from"))
        .agg(F.max_by("close", F.struct("timestamp", "close")).alias("close"))
        .where(F.col("from") <= F.lit(last_day).cast("date"))
    )
    by_day = Window.partitionBy("stock_symbol").orderBy("from")
    until = F.coalesce(F.date_sub(F.lead("from").over(by_day), 1), F.lit(last_day).cast("date"))
    days = closes.withColumn("until", until)
    return days.select("stock_symbol", F.explode(F.sequence("from", "until")).alias("day"), "close")


def daily_values(
    transactions: DataFrame, prices: DataFrame, first_day: str, last_day: str, strict: bool = False
) -> DataFrame:
    """portfolio_id, day, total_value, net_flow, daily_return_pct for the days from ``first_day`` to ``last_day``.

    ``total_value`` sums quantity held at the day's end times the last close so far; positions of 0 or less and
    symbols that have no price yet count nothing, and a portfolio has a row for each day on which a priced
    position is open. ``net_flow`` is what the day's trades paid in. ``daily_return_pct`` compares the value without that
    flow with the value of the day before; it is NULL without a row for the day before.

    A position is an interval per quantity, met by symbol and month with that month's closes; the products
    are summed by portfolio and day where they arise, so what is shuffled is intervals and partial sums, not a row a position and day.
    """
    month = F.trunc("day", "month").alias("month")
    closes = carried_closes(prices, last_day).where(F.col("day") >= F.lit(first_day).cast("date"))
    closes = closes.select("stock_symbol", month, "day", "close")
    held = position_intervals(transactions, last_day, strict).where(F.col("valid_to") >= F.lit(first_day).cast("date"))
    start = F.greatest("valid_from", F.lit(first_day).cast("date"))
    months = F.sequence(F.trunc(start, "month"), F.trunc("valid_to", "month"), F.expr("INTERVAL 1 MONTH"))
    held = held.withColumn("month", F.explode(months))
    met = held.join(closes, ["stock_symbol", "month"]).where(F.col("day").between(F.col("valid_from"), F.col("valid_to")))
    value = (F.col("quantity") * F.col("close")).cast("decimal(38,6)")
    totals = met.groupBy("portfolio_id", "day").agg(F.sum(value).alias("total_value"))
    flows = (
        transactions.where(F.to_date("transaction_date").between(first_day, last_day))
        .groupBy("portfolio_id", F.to_date("transaction_date").alias("day"))
        .agg(F.sum(signed(notional(), strict=strict)).alias("net_flow"))
    )
    by_day = Window.partitionBy("portfolio_id").orderBy("day")
    yesterday = F.lag("day").over(by_day) == F.date_sub("day", 1)
    return (
        totals.join(flows, ["portfolio_id", "day"], "left")
        .withColumn("net_flow", F.coalesce("net_flow", F.lit(0)).cast("decimal(38,6)"))
        .withColumn("_before", F.when(yesterday, F.lag("total_value").over(by_day)))
        .withColumn("daily_return_pct", ratio(F.col("total_value") - F.col("net_flow") - F.col("_before"), F.col("_before")) * 100)
        .select("portfolio_id", "day", "total_value", "net_flow", "daily_return_pct")
    )


def latest_return(values: DataFrame) -> DataFrame:
    """portfolio_id, daily_return_pct of each portfolio's last day in ``daily_values``."""
    return values.groupBy("portfolio_id").agg(F.max_by("daily_return_pct", "day").alias("daily_return_pct"))
