"""Daily returns and pooled risk figures."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.money import ratio
from ledgerlark.functions.predicates import filter_range
from ledgerlark.operators.series import Series, windowed

TRADING_DAYS = 252
RISK_FREE_RATE = 0.02


def daily_returns(prices: DataFrame, series: Series = Series()) -> DataFrame:
    """Simple return of each row over the previous one of its symbol; first rows drop out."""

    def with_previous(df: DataFrame, by_time) -> DataFrame:
        return df.withColumn("prev_close", F.lag("close").over(by_time))

    return (
        windowed(prices, series, 1, with_previous)
        .where(F.col("prev_close").isNotNull())
        .withColumn("daily_return", ratio(F.col("close") - F.col("prev_close"), F.col("prev_close")))
    )


def _positive_or_zero(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(0.0))


def risk_metrics(
    holdings: DataFrame,
    prices: DataFrame,
    start: str | None = None,
    end: str | None = None,
    annualize: bool = False,
    series: Series = Series(),
    drawdowns: DataFrame | None = None,
    portfolios: DataFrame | None = None,
) -> DataFrame:
    """Volatility, Sharpe ratio and mean annual return per portfolio over its held symbols' returns.

    Returns of all held symbols are pooled unweighted. Each symbol's returns are reduced to count,
    mean and squared deviation before they meet the portfolios, so a price row is never repeated per
    holder. By default volatility is the daily deviation in percent and the Sharpe ratio divides the
    annual mean by it; ``annualize`` scales the deviation by the square root of the trading days and
    uses the same unit on both sides. ``drawdowns`` (portfolio_id, max_drawdown), as of daily values, fills the
    drawdown, which is 0 without. With ``portfolios``, those without holdings show zeros.
    """
    held = holdings.select("portfolio_id", "stock_symbol")
    window = filter_range(prices, "timestamp", start, end).join(
        held.select("stock_symbol").distinct(), "stock_symbol", "left_semi"
    )
    moments = (
        daily_returns(window.select("stock_symbol", "timestamp", "close"), series)
        .groupBy("stock_symbol")
        .agg(
            F.count("daily_return").alias("_n"),
            F.avg("daily_return").alias("_mean"),
            F.var_pop("daily_return").alias("_variance"),
        )
    )
    n, mean = F.col("_n"), F.col("_mean")
    if portfolios is not None:
        held = portfolios.select("portfolio_id").distinct().join(held, "portfolio_id", "left")
    # Deviations are taken from the pooled mean itself: sums of squares would cancel.
    of_portfolio = Window.partitionBy("portfolio_id")
    pooled_mean = F.try_divide(F.sum(n * mean).over(of_portfolio), F.sum(n).over(of_portfolio))
    pooled = (
        held.join(moments, "stock_symbol", "left")
        .withColumn("_pooled", pooled_mean)
        .groupBy("portfolio_id")
        .agg(
            F.sum(n).alias("_n"),
            F.first("_pooled").alias("_average"),
            F.sum(n * (F.col("_variance") + (mean - F.col("_pooled")) * (mean - F.col("_pooled")))).alias("_squares"),
        )
    )
    if drawdowns is None:
        pooled = pooled.withColumn("max_drawdown", F.lit(0.0))
    else:
        pooled = pooled.join(drawdowns.select("portfolio_id", "max_drawdown"), "portfolio_id", "left")
    average = F.coalesce("_average", F.lit(0.0))
    variance = F.try_divide(F.col("_squares"), F.col("_n") - 1)
    deviation = F.coalesce(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(0.0))
    annual = average * TRADING_DAYS
    if annualize:
        volatility = deviation * math.sqrt(TRADING_DAYS)
    else:
        volatility = deviation * 100
    return (
        pooled.withColumn("volatility", volatility)
        .withColumn("avg_annual_return", annual)
        .select(
            "portfolio_id",
            "volatility",
            _positive_or_zero(
                F.col("volatility") > 0,
                F.try_divide(F.col("avg_annual_return") - F.lit(RISK_FREE_RATE), F.col("volatility")),
            ).alias("sharpe_ratio"),
            F.coalesce("max_drawdown", F.lit(0.0)).alias("max_drawdown"),
            "avg_annual_return",
        )
    )


def portfolio_metrics(
    values: DataFrame, risk: DataFrame, realized: DataFrame, calculated_at: str, last_returns: DataFrame | None = None
) -> DataFrame:
    """Rows of the ``portfolio_metrics`` table from totals, risk figures, realised gains and the last daily returns."""
    if last_returns is None:
        values = values.withColumn("daily_return_pct", F.lit(None).cast("double"))
    else:
        values = values.join(last_returns.select("portfolio_id", "daily_return_pct"), "portfolio_id", "left")
    return (
        values.join(risk, "portfolio_id", "left")
        .join(realized.select("portfolio_id", "realized_gains"), "portfolio_id", "left")
        .select(
            "portfolio_id",
            F.lit(calculated_at).cast("timestamp").alias("calculation_date"),
            "total_value",
            "total_cost",
            F.coalesce("realized_gains", F.lit(0.0)).alias("realized_gains"),
            F.col("unrealized_gain").alias("unrealized_gains"),
            F.col("unrealized_gain_pct").alias("total_return_pct"),
            "daily_return_pct",
            "volatility",
            "sharpe_ratio",
            F.col("max_drawdown").alias("max_drawdown_pct"),
        )
    )
