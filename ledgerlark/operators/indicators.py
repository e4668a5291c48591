"""Rolling technical indicators over price series.

Means over long frames come from running totals: the sum of the last p rows is the total now minus
the total p rows ago. Prices are DECIMAL, so the difference is exact, and a 200-row mean costs as
much as a 5-row one. Frames at the start of a series are partial, as many rows as there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.money import ratio
from ledgerlark.operators.latest import latest_n
from ledgerlark.operators.series import Series, windowed
from ledgerlark.schemas import TECHNICAL_INDICATORS, conform

SMA_PERIODS = (20, 50, 200)
EMA_PERIODS = (12, 26)
RSI_PERIOD = 14
BAND_PERIOD = 20
BAND_WIDTH = 2
SIGNAL_PERIOD = 9


def _last(by_time: WindowSpec, rows: int) -> WindowSpec:
    return by_time.rowsBetween(-rows + 1, 0)


def _so_far(by_time: WindowSpec) -> WindowSpec:
    return by_time.rowsBetween(Window.unboundedPreceding, 0)


def _with_totals(df: DataFrame, by_time: WindowSpec, column: str) -> DataFrame:
    """Running total and count of a DECIMAL column, skipping NULLs."""
    return df.withColumn("_total", F.coalesce(F.sum(column).over(_so_far(by_time)), F.lit(0))).withColumn(
        "_count", F.count(column).over(_so_far(by_time))
    )


def _mean_of_last(by_time: WindowSpec, period: int) -> Column:
    earlier_total = F.coalesce(F.lag("_total", period).over(by_time), F.lit(0))
    earlier_count = F.coalesce(F.lag("_count", period).over(by_time), F.lit(0))
    return ratio(F.col("_total") - earlier_total, F.col("_count") - earlier_count)


def _rolling_means(df: DataFrame, by_time: WindowSpec, column: str, periods: dict[str, int]) -> DataFrame:
    if df.schema[column].dataType.typeName() == "decimal":
        means = {name: _mean_of_last(by_time, p) for name, p in periods.items()}
        return _with_totals(df, by_time, column).withColumns(means).drop("_total", "_count")
    return df.withColumns({name: F.avg(column).over(_last(by_time, p)) for name, p in periods.items()})


def sma(
    prices: DataFrame, column: str = "close", periods: Sequence[int] = SMA_PERIODS, series: Series = Series()
) -> DataFrame:
    """``sma_<p>``: mean of the last p rows."""
    names = {f"sma_{p}": p for p in periods}
    return windowed(prices, series, max(periods) - 1, lambda df, w: _rolling_means(df, w, column, names))


def ema(
    prices: DataFrame, column: str = "close", periods: Sequence[int] = EMA_PERIODS, series: Series = Series()
) -> DataFrame:
    """``ema_<p>`` in the simplified form without recursive weights: the mean of the last p rows."""
    names = {f"ema_{p}": p for p in periods}
    return windowed(prices, series, max(periods) - 1, lambda df, w: _rolling_means(df, w, column, names))


def _add_rsi(df: DataFrame, by_time: WindowSpec, period: int, zero_loss: str) -> DataFrame:
    change = F.col("close") - F.lag("close").over(by_time)
    zero = F.lit(0).cast(df.schema["close"].dataType)
    rise = F.when(F.col("_change") > 0, F.col("_change")).otherwise(zero)
    fall = F.when(F.col("_change") < 0, -F.col("_change")).otherwise(zero)
    # Both means run over the same rows, so their quotient is that of the sums.
    strength = ratio(F.sum("_rise").over(_last(by_time, period)), F.sum("_fall").over(_last(by_time, period)))
    rsi = F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.col("_strength"))
    if zero_loss == "hundred":
        rsi = F.coalesce(rsi, F.lit(100.0))
    return (
        df.withColumn("_change", change)
        .withColumns({"_rise": rise, "_fall": fall})
        .withColumn("_strength", strength)
        .withColumn("rsi_14", rsi)
        .drop("_change", "_rise", "_fall", "_strength")
    )


def rsi(
    prices: DataFrame, period: int = RSI_PERIOD, zero_loss: str = "null", series: Series = Series()
) -> DataFrame:
    """``rsi_14`` from mean gains and losses of the last ``period`` rows.

    Frames without a loss give NULL, or 100 with ``zero_loss="hundred"``. A first row counts as no change.
    """
    if zero_loss not in ("null", "hundred"):
        raise ValueError("zero_loss is 'null' or 'hundred'")
    return windowed(prices, series, period, lambda df, w: _add_rsi(df, w, period, zero_loss))


def _add_bands(df: DataFrame, by_time: WindowSpec, period: int, width: float) -> DataFrame:
    spread = F.stddev_samp("close").over(_last(by_time, period)) * F.lit(float(width))
    return (
        _rolling_means(df, by_time, "close", {"_middle": period})
        .withColumn("_spread", spread)
        .withColumn("bollinger_upper", F.col("_middle") + F.col("_spread"))
        .withColumn("bollinger_lower", F.col("_middle") - F.col("_spread"))
        .drop("_middle", "_spread")
    )


def bollinger_bands(
    prices: DataFrame, period: int = BAND_PERIOD, std_dev: float = BAND_WIDTH, series: Series = Series()
) -> DataFrame:
    """Mean of the last ``period`` rows plus and minus ``std_dev`` sample deviations; NULL on one row."""
    return windowed(prices, series, period - 1, lambda df, w: _add_bands(df, w, period, std_dev))


def _add_macd(df: DataFrame, by_time: WindowSpec) -> DataFrame:
    return df.withColumn("macd", F.col("ema_12") - F.col("ema_26")).withColumn(
        "macd_signal", F.avg("macd").over(_last(by_time, SIGNAL_PERIOD))
    )


_EMA_COLUMNS = {f"ema_{p}": p for p in EMA_PERIODS}
_MACD_LOOKBACK = max(EMA_PERIODS) + SIGNAL_PERIOD - 2


def macd(prices: DataFrame, series: Series = Series()) -> DataFrame:
    """``ema_12``, ``ema_26``, their difference ``macd`` and its 9-row mean ``macd_signal``."""

    def compute(df: DataFrame, by_time: WindowSpec) -> DataFrame:
        return _add_macd(_rolling_means(df, by_time, "close", _EMA_COLUMNS), by_time)

    return windowed(prices, series, _MACD_LOOKBACK, compute)


def all_indicators(prices: DataFrame, zero_loss: str = "null", series: Series = Series()) -> DataFrame:
    """Every indicator of every symbol in the columns of ``technical_indicators``: one shuffle and sort."""
    means = {f"sma_{p}": p for p in SMA_PERIODS} | _EMA_COLUMNS | {"_middle": BAND_PERIOD}

    def compute(df: DataFrame, by_time: WindowSpec) -> DataFrame:
        out = _rolling_means(df, by_time, "close", means)
        out = _add_rsi(out, by_time, RSI_PERIOD, zero_loss)
        spread = F.stddev_samp("close").over(_last(by_time, BAND_PERIOD)) * F.lit(float(BAND_WIDTH))
        out = _add_macd(out.withColumn("_spread", spread), by_time)
        return out.withColumns(
            {
                "bollinger_upper": F.col("_middle") + F.col("_spread"),
                "bollinger_lower": F.col("_middle") - F.col("_spread"),
            }
        )

    lookback = max(*SMA_PERIODS, RSI_PERIOD + 1, BAND_PERIOD, _MACD_LOOKBACK + 1) - 1
    closes = prices.select("stock_symbol", "timestamp", "close")
    return windowed(closes, series, lookback, compute).select(*TECHNICAL_INDICATORS.fieldNames())


def indicator_rows(prices: DataFrame, series: Series = Series()) -> DataFrame:
    """``all_indicators`` cast to the declared table schema, ready for a keyed write."""
    return conform(all_indicators(prices, series=series), TECHNICAL_INDICATORS)


def indicator_snapshot(
    prices: DataFrame, rows: int = 30, period: int = RSI_PERIOD, bucket: str | None = None
) -> DataFrame:
    """Latest price with mean, RSI and population-deviation bands of each symbol's last ``period`` closes.

    Looks at the latest ``rows`` closes; symbols with fewer than ``period`` are left out. RSI is 100
    without losses and 50 while there are fewer than ``period`` changes.
    """
    recent = latest_n(prices.select("stock_symbol", "timestamp", "close"), rows, bucket=bucket)
    newest_first = Window.partitionBy("stock_symbol").orderBy("rn")
    change = F.col("close") - F.lead("close").over(newest_first)
    in_frame = F.col("rn") <= period
    per_symbol = (
        recent.withColumn("_change", change)
        .groupBy("stock_symbol")
        .agg(
            F.max("timestamp").alias("timestamp"),
            F.max(F.when(F.col("rn") == 1, F.col("close"))).cast("double").alias("current_price"),
            F.count(F.lit(1)).alias("_closes"),
            F.count("_change").alias("_changes"),
            F.sum(F.when(in_frame, F.col("close"))).alias("_sum"),
            F.stddev_pop(F.when(in_frame, F.col("close"))).alias("_deviation"),
            F.sum(F.when(in_frame & (F.col("_change") > 0), F.col("_change")).otherwise(F.lit(0))).alias("_gain"),
            F.sum(F.when(in_frame & (F.col("_change") < 0), -F.col("_change")).otherwise(F.lit(0))).alias("_loss"),
        )
        .where(F.col("_closes") >= period)
    )
    strength = ratio(F.col("_gain"), F.col("_loss"))
    rsi_value = (
        F.when(F.col("_changes") < period, F.lit(50.0))
        .when(F.col("_loss") == 0, F.lit(100.0))
        .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength))
    )
    return (
        per_symbol.withColumn("sma", F.col("_sum").cast("double") / F.lit(float(period)))
        .withColumn("rsi", rsi_value)
        .withColumn("bb_upper", F.col("sma") + 2 * F.col("_deviation"))
        .withColumn("bb_lower", F.col("sma") - 2 * F.col("_deviation"))
        .withColumn("bb_width_pct", F.try_divide(F.col("bb_upper") - F.col("bb_lower"), F.col("sma")) * 100)
        .select(
            "stock_symbol", "timestamp", "current_price", "sma", "rsi", "bb_upper", "bb_lower", "bb_width_pct"
        )
    )


def signals(snapshot: DataFrame) -> DataFrame:
    """Momentum, band and trend labels of ``indicator_snapshot`` rows."""
    price = F.col("current_price")
    return snapshot.select(
        "stock_symbol",
        "timestamp",
        F.when(F.col("rsi") > 70, "overbought").when(F.col("rsi") < 30, "oversold").otherwise("neutral").alias(
            "rsi_signal"
        ),
        F.when(price > F.col("bb_upper"), "above_upper")
        .when(price < F.col("bb_lower"), "below_lower")
        .otherwise("within")
        .alias("band_signal"),
        F.when(price > F.col("sma"), "bullish").otherwise("bearish").alias("trend_signal"),
    )
