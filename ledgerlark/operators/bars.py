"""OHLCV bars by time bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.predicates import utc_day


def bar_columns(open_: str = "open", high: str = "high", low: str = "low", close: str = "close") -> list[Column]:
    """First, highest, lowest, last and total by time. All buffers are fixed-width, so the rollup is a
    hash aggregate combined on the map side."""
    return [
        F.min_by(open_, "timestamp").alias("open"),
        F.max(high).alias("high"),
        F.min(low).alias("low"),
        F.max_by(close, "timestamp").alias("close"),
        F.sum("volume").alias("volume"),
    ]


def rollup_bars(prices: DataFrame, interval: str = "1 day") -> DataFrame:
    """Bars of every symbol and ``interval``-wide bucket."""
    return (
        prices.groupBy("stock_symbol", F.window("timestamp", interval).alias("_window"))
        .agg(*bar_columns())
        .select(
            F.col("_window.start").alias("bucket"), "stock_symbol", "open", "high", "low", "close", "volume"
        )
    )


def refresh_bars(
    prices: DataFrame,
    now: str,
    start_offset: str = "3 days",
    end_offset: str = "1 hour",
    interval: str = "1 day",
) -> DataFrame:
    """Bars to recompute at ``now``: buckets lying wholly within [now - start_offset, now - end_offset].

    The same bounds on the raw rows and on a table's days reach the scan: a refresh reads days, not the history.
    """
    at = F.lit(now).cast("timestamp")
    since, until = at - F.expr(f"INTERVAL {start_offset}"), at - F.expr(f"INTERVAL {end_offset}")
    bucket = F.col("bucket")
    recent = prices.where((F.col("timestamp") >= since) & (F.col("timestamp") < until))
    if "day" in prices.columns:
        recent = recent.where((F.col("day") >= utc_day(since)) & (F.col("day") <= utc_day(until)))
    return rollup_bars(recent, interval).where(
        (bucket >= since) & (bucket + F.expr(f"INTERVAL {interval}") <= until)
    )
