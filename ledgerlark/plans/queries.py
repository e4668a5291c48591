"""Every operator as a named query over the supplied files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.predicates import filter_range
from ledgerlark.functions.scratch import scratch_dir
from ledgerlark.operators.blocks import stored
from ledgerlark.functions.symbols import MARKETS, SECTORS, fx_pair, infer_market, sector_code
from ledgerlark.operators import allocation, bars, currency, daily, drawdown, holdings, indicators, latest, quality
from ledgerlark.operators import recursive, reports, risk, upsert, valuation
from ledgerlark.operators.series import DAILY_BARS, QUANTILES, Series
from ledgerlark.plans import etl, export
from ledgerlark.schemas import TRANSACTIONS
from ledgerlark.sources import feeds, landed, watchlist
from ledgerlark.sources import fixtures as data
from ledgerlark.sources.tables import Lake
from ledgerlark.streaming import bars as stream_bars
from ledgerlark.streaming import holdings as stream_holdings
from ledgerlark.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START, END = "1997-01-01", "1999-06-30"
MID = "2000-01-01"
FX_CUT = "2024-01-20"
NOW = "2024-01-20 12:00:00"
# Ticks are dense: series are cut at quantiles of their times, however many rows a day holds.
TICKS = Series(bucket=QUANTILES, block_rows=200_000)
SHORT_BLOCKS = Series(bucket=QUANTILES, block_rows=2_000)
# The days of all trades and prices.
FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, zoned timestamps and dates as plain timestamps, small integers as bigint."""

    def cast(field: T.StructField):
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(kind, (T.TimestampType, T.DateType)):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(kind, (T.IntegerType, T.ShortType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: plain(build(spark, sf_dir))
    return build


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round inexact outputs, so that engines that add doubles in another order agree."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in digits.items()})


def _holdings(spark: SparkSession, sf: str) -> DataFrame:
    return holdings.net_holdings(data.transactions(spark, sf))


def _weighted(spark: SparkSession, sf: str) -> DataFrame:
    return holdings.weighted_holdings(data.transactions(spark, sf), bucket="month")


def _positions(spark: SparkSession, sf: str, as_of: str | None = None) -> DataFrame:
    return valuation.position_values(_holdings(spark, sf), data.stock_prices(spark, sf), as_of)


def _base_value(spark: SparkSession, sf: str, base: str = "AUD") -> DataFrame:
    return allocation.holdings_base_value(
        _holdings(spark, sf),
        data.stock_prices(spark, sf),
        data.securities(spark, sf),
        data.exchange_rates(spark, sf),
        base,
    )


def _closes(spark: SparkSession, sf: str) -> DataFrame:
    return data.stock_prices(spark, sf).select("stock_symbol", "timestamp", "close")


def _tick_closes(spark: SparkSession, sf: str) -> DataFrame:
    return data.tick_prices(spark, sf).select("stock_symbol", "timestamp", "close")


# Positions and valuation


@query
def current_holdings(spark, sf):
    return _holdings(spark, sf)


@query
def holdings_strict(spark, sf):
    """Returned lines count as sales, fresh ones as purchases, other flags not at all."""
    trades = data.transactions(spark, sf)
    flag = F.substring_index("transaction_id", "-", -1)
    kind = F.when(flag == "R", "SELL").when(flag == "N", "BUY").otherwise("TRANSFER")
    return holdings.net_holdings(trades.withColumn("transaction_type", kind), strict=True)


@query
def position_values(spark, sf):
    return _positions(spark, sf, MID)


@query
def portfolio_value(spark, sf):
    return valuation.portfolio_value(_positions(spark, sf), data.portfolios(spark, sf))


@query
def portfolio_returns(spark, sf):
    return valuation.portfolio_returns(
        _holdings(spark, sf), data.stock_prices(spark, sf), START, END, data.portfolios(spark, sf)
    )


def _daily_values(spark: SparkSession, sf: str, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return daily.daily_values(data.transactions(spark, sf), data.stock_prices(spark, sf), first, last)


@query
def daily_portfolio_values(spark, sf):
    """Every portfolio on every day, from all trades and closes."""
    return rounded(_daily_values(spark, sf), total_value=2, net_flow=2, daily_return_pct=6)


@query
def portfolio_drawdowns(spark, sf):
    return rounded(drawdown.max_drawdown(_daily_values(spark, sf), ["portfolio_id"], "day", "total_value"), max_drawdown=6)


@query
def tick_drawdowns(spark, sf):
    """Dense series in blocks of about a thousand rows."""
    out = drawdown.max_drawdown(_tick_closes(spark, sf), ["stock_symbol"], "timestamp", "close", block_rows=1_000)
    return rounded(out, max_drawdown=6)


@query
def risk_metrics(spark, sf):
    falls = drawdown.max_drawdown(_daily_values(spark, sf, START, END), ["portfolio_id"], "day", "total_value")
    out = risk.risk_metrics(
        _holdings(spark, sf), data.stock_prices(spark, sf), START, END, series=DAILY_BARS, drawdowns=falls
    )
    return rounded(out, volatility=6, sharpe_ratio=6, avg_annual_return=6, max_drawdown=6)


@query
def risk_metrics_annualized(spark, sf):
    out = risk.risk_metrics(
        _holdings(spark, sf), data.stock_prices(spark, sf), annualize=True, series=DAILY_BARS, portfolios=data.portfolios(spark, sf)
    )
    return rounded(out, volatility=6, sharpe_ratio=6, avg_annual_return=6)


@query
def daily_returns(spark, sf):
    return risk.daily_returns(_closes(spark, sf), DAILY_BARS)


@query
def tick_returns(spark, sf):
    return risk.daily_returns(_tick_closes(spark, sf), TICKS)


@query
def latest_prices(spark, sf):
    return latest.latest_prices(data.stock_prices(spark, sf))


@query
def latest_prices_asof(spark, sf):
    return latest.latest_prices(data.stock_prices(spark, sf), MID)


@query
def latest_fx(spark, sf):
    return latest.latest_fx(data.exchange_rates(spark, sf))


@query
def fx_multiplier(spark, sf):
    """Towards a base quoted directly and one quoted only the other way round."""
    listed = allocation.securities_view(data.securities(spark, sf)).select("stock_symbol", "quote_currency")
    rates = data.exchange_rates(spark, sf)
    direct, inverse = (
        allocation.with_fx_multiplier(listed, rates, base).select(
            F.lit(base).alias("base_currency"), "stock_symbol", "quote_currency", "fx_multiplier"
        )
        for base in ("AUD", "USD")
    )
    return direct.unionByName(inverse)


@query
def cross_rates(spark, sf):
    """Every ordered pair of currencies that quotes connect, over as few quotes as possible."""
    crossed = currency.cross_rates(data.exchange_rates(spark, sf))
    return crossed.withColumn("path", F.array_join("path", ">"))


@query
def fx_multiplier_cross(spark, sf):
    """Towards two bases; a currency that no quotes connect has no multiplier."""
    listed = allocation.securities_view(data.securities(spark, sf)).select("stock_symbol", "quote_currency")
    listed = listed.union(spark.range(1).select(F.lit("UNQUOTED"), F.lit("XAU")))
    crossed = currency.cross_rates(data.exchange_rates(spark, sf))
    towards = [
        currency.with_cross_multiplier(listed, crossed, base).withColumn("base_currency", F.lit(base)) for base in ("SGD", "USD")
    ]
    return towards[0].unionByName(towards[1])


@query
def holdings_base_value(spark, sf):
    return rounded(_base_value(spark, sf), market_value_base=4)


@query
def sector_allocation(spark, sf):
    out = allocation.sector_allocation(_base_value(spark, sf))
    return rounded(out, market_value_base=2, weight_pct=6, avg_fx_rate=8)


@query
def region_allocation(spark, sf):
    out = allocation.region_allocation(_base_value(spark, sf, "USD"))
    return rounded(out, market_value_base=2, weight_pct=6)


@query
def securities_view(spark, sf):
    return allocation.securities_view(data.securities(spark, sf))


@query
def weighted_holdings(spark, sf):
    return rounded(_weighted(spark, sf).drop("realized_gain", "last_updated"), average_cost=6)


@query
def verify_holdings(spark, sf):
    out = valuation.verify_holdings(_weighted(spark, sf), data.stock_prices(spark, sf))
    return rounded(out, average_cost=6, total_cost=2, pnl_pct=6)


@query
def verified_totals(spark, sf):
    verified = valuation.verify_holdings(_weighted(spark, sf), data.stock_prices(spark, sf))
    return rounded(valuation.verified_totals(verified), total_cost=2, current_value=2, pnl=2, pnl_pct=6)


@query
def holdings_report(spark, sf):
    return valuation.holdings_report(
        holdings.net_holdings(data.transactions(spark, sf), strict=True), data.stock_prices(spark, sf)
    )


@query
def holdings_totals_rollup(spark, sf):
    return rounded(valuation.report_with_totals(holdings_report(spark, sf)), pnl_pct=6)


@query
def holdings_listing(spark, sf):
    out = holdings.holdings_listing(_weighted(spark, sf), data.portfolios(spark, sf), data.stocks(spark, sf))
    return rounded(out, average_cost=6, total_cost=2)


@query
def equal_allocation(spark, sf):
    return allocation.equal_cash_purchases(data.stock_prices(spark, sf), None, 2_000_000.0)


@query
def portfolio_metrics(spark, sf):
    # Positions, daily values and realised gains all start from the trades and closes, which are joined once.
    trades = stored(spark, data.transactions(spark, sf).drop("commission", "ingestion_timestamp"), "trades")
    prices = stored(spark, _closes(spark, sf), "closes")
    held = holdings.net_holdings(trades)
    values = valuation.portfolio_value(valuation.position_values(held, prices), data.portfolios(spark, sf))
    values_by_day = stored(spark, daily.daily_values(trades, prices, FIRST_DAY, LAST_DAY), "daily-values")
    falls = drawdown.max_drawdown(values_by_day, ["portfolio_id"], "day", "total_value")
    risks = risk.risk_metrics(held, prices, series=DAILY_BARS, drawdowns=falls, portfolios=data.portfolios(spark, sf))
    realized = (
        holdings.weighted_holdings(trades, bucket="month", keep_closed=True)
        .groupBy("portfolio_id")
        .agg(F.sum("realized_gain").alias("realized_gains"))
    )
    out = risk.portfolio_metrics(values, risks, realized, "2002-01-01", daily.latest_return(values_by_day))
    digits = {"realized_gains": 2, "volatility": 6, "sharpe_ratio": 6, "max_drawdown_pct": 6, "daily_return_pct": 6}
    return rounded(out, **digits)


# Indicators


@query
def sma(spark, sf):
    return indicators.sma(_closes(spark, sf), series=DAILY_BARS)


@query
def ema_simple(spark, sf):
    return indicators.ema(_closes(spark, sf), series=DAILY_BARS)


@query
def ema_recursive(spark, sf):
    """With weights that decay for ever, over daily bars."""
    return rounded(recursive.ema_recursive(_closes(spark, sf)), ema_12=4, ema_26=4)


@query
def macd_recursive_ticks(spark, sf):
    """Over dense series in blocks of about a thousand rows, each continued from the one before."""
    out = recursive.macd_recursive(_tick_closes(spark, sf), block_rows=1_000)
    return rounded(out, ema_12=4, ema_26=4, macd=4, macd_signal=4)


@query
def rsi(spark, sf):
    return indicators.rsi(_closes(spark, sf), zero_loss="hundred", series=DAILY_BARS)


@query
def bollinger(spark, sf):
    out = indicators.bollinger_bands(_closes(spark, sf), series=DAILY_BARS)
    return rounded(out, bollinger_upper=3, bollinger_lower=3)


@query
def macd(spark, sf):
    return rounded(indicators.macd(_closes(spark, sf), series=DAILY_BARS), macd_signal=4)


@query
def all_indicators(spark, sf):
    out = indicators.all_indicators(_closes(spark, sf), series=DAILY_BARS)
    return rounded(out, macd_signal=4, bollinger_upper=3, bollinger_lower=3)


@query
def all_indicators_ticks(spark, sf):
    """The same over dense series cut into overlapping blocks."""
    out = indicators.all_indicators(_tick_closes(spark, sf), series=TICKS)
    return rounded(out, macd_signal=4, bollinger_upper=3, bollinger_lower=3)


@query
def indicator_snapshot(spark, sf):
    out = indicators.indicator_snapshot(data.stock_prices(spark, sf))
    return rounded(out, bb_upper=4, bb_lower=4, bb_width_pct=4)


@query
def signals(spark, sf):
    return indicators.signals(indicators.indicator_snapshot(data.tick_prices(spark, sf), bucket="day"))


@query
def store_indicators(spark, sf):
    """Stored twice: the second write changes nothing."""
    lake = Lake(scratch_dir(spark, "indicators"))
    table = lake["technical_indicators"]
    rows = indicators.indicator_rows(data.tick_prices(spark, sf), SHORT_BLOCKS)
    table.upsert(spark, rows)
    table.upsert(spark, table.read(spark).drop("day"))
    return rounded(table.read(spark).drop("day"), macd_signal=3, bollinger_upper=3, bollinger_lower=3)


# Bars, latest rows, as-of


@query
def daily_bars(spark, sf):
    return bars.rollup_bars(data.tick_prices(spark, sf))


@query
def bars_refresh_window(spark, sf):
    return bars.refresh_bars(data.tick_prices(spark, sf), NOW)


def _event_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query
def stream_daily_bars(spark, sf):
    ticks = stream_bars.bars_from_stream_files(data.ticks_of(_event_stream(spark, sf, "events")))
    root = scratch_dir(spark, "bars")
    stream_bars.maintain_bars(ticks, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return stream_bars.bars_table(f"{root}/table").read(spark).drop("day")


@query
def stream_holdings_state(spark, sf):
    trades = data.transactions_of(spark, sf, _event_stream(spark, sf, "lineitem"))
    root = scratch_dir(spark, "positions")
    state = stream_holdings.PositionState(f"{root}/state")
    run = stream_holdings.maintain_holdings(trades, state, f"{root}/checkpoint")
    run.awaitTermination()
    return rounded(state.latest(spark, run).drop("realized_gain", "last_updated"), average_cost=6)


@query
def stream_upsert_prices(spark, sf):
    ticks = data.ticks_of(_event_stream(spark, sf, "events"))
    prices = stream_bars.bars_from_stream_files(ticks).withColumns(
        {"adjusted_close": F.col("close"), "ingestion_timestamp": F.col("timestamp")}
    )
    root = scratch_dir(spark, "ticks")
    table = Lake(root)["stock_prices"]
    sinks.stream_upsert(prices, table, f"{root}/checkpoint", "ingestion_timestamp").awaitTermination()
    return table.read(spark).select("stock_symbol", "timestamp", "close", "volume")


@query
def stream_dedup_prices(spark, sf):
    """A stream in which every tick comes twice and some are corrected: the merge sees each of them once."""
    ticks = data.ticks_of(_event_stream(spark, sf, "events"))
    prices = stream_bars.bars_from_stream_files(ticks).withColumns(
        {"adjusted_close": F.col("close"), "ingestion_timestamp": F.col("timestamp")}
    )
    later = F.col("ingestion_timestamp") + F.expr("INTERVAL 1 MINUTE")
    again = prices.withColumn("ingestion_timestamp", later)
    corrected = again.where("volume % 7 = 1").withColumn("close", (F.col("close") + 1).cast("decimal(20,6)")).withColumn("ingestion_timestamp", later)
    fresh = sinks.without_repeats(prices.union(again).union(corrected), "timestamp", "400 days")
    root = scratch_dir(spark, "ticks")
    table = Lake(root)["stock_prices"]
    sinks.stream_upsert(fresh, table, f"{root}/checkpoint", "ingestion_timestamp").awaitTermination()
    return table.read(spark).select("stock_symbol", "timestamp", "close", "volume")


@query
def asof_join(spark, sf):
    """Each trade with the last close of an earlier day."""
    trades = data.transactions(spark, sf).select(
        "transaction_id",
        "stock_symbol",
        "transaction_date",
        (F.col("transaction_date") - F.expr("INTERVAL 1 SECOND")).alias("before"),
    )
    found = latest.asof_join(
        trades,
        data.stock_prices(spark, sf),
        ["stock_symbol"],
        "before",
        "timestamp",
        {"previous_close": "close", "previous_date": "timestamp"},
    )
    return found.drop("before")


@query
def asof_join_events(spark, sf):
    """Each event with its user's last purchase value so far."""
    events = data.raw(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    bought = events.where(F.col("event_type") == "purchase")
    return latest.asof_join(events.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "ts", {"last_purchase": "value"})


@query
def asof_join_one_key(spark, sf):
    """Each tick with the last close of a symbol's own day before, all rows under one key cut into blocks."""
    one = F.lit("all").alias("market")
    ticks = data.raw(spark, sf, "events").select(one, "event_id", "ts")
    errors = data.raw(spark, sf, "events").where(F.col("event_type") == "error").select(one, "ts", "event_id", "value")
    found = {"error_id": "event_id", "error_value": "value"}
    return latest.asof_join(ticks, errors, ["market"], "ts", "ts", found, block_rows=1_000).drop("market")


@query
def latest_n_prices(spark, sf):
    return latest.latest_n(_closes(spark, sf), 10, bucket="year")


@query
def portfolio_transactions(spark, sf):
    trades = holdings.portfolio_transactions(data.transactions(spark, sf), "7")
    return trades.drop("commission", "ingestion_timestamp")


@query
def prices_range(spark, sf):
    prices = filter_range(data.stock_prices(spark, sf), "timestamp", START, END)
    wanted = prices.where(F.col("stock_symbol").isin("Brand#3", "Brand#12", "Brand#21"))
    return wanted.drop("adjusted_close", "ingestion_timestamp").orderBy("stock_symbol", "timestamp")


@query
def held_prices(spark, sf):
    """Prices of the symbols some portfolio holds, without listing them on the driver."""
    held = _holdings(spark, sf).select("stock_symbol").distinct()
    return _closes(spark, sf).join(held, "stock_symbol", "left_semi")


# Reports


@query
def price_summary(spark, sf):
    return reports.price_summary(data.stock_prices(spark, sf))


@query
def coverage_summary(spark, sf):
    listed = data.stocks(spark, sf).select(F.col("symbol").alias("stock_symbol"))
    return reports.coverage_summary(listed, data.stock_prices(spark, sf))


@query
def portfolio_invested(spark, sf):
    return holdings.portfolio_activity(data.portfolios(spark, sf), data.transactions(spark, sf))


@query
def top_portfolio(spark, sf):
    return holdings.most_active_portfolio(data.portfolios(spark, sf), data.transactions(spark, sf))


@query
def table_counts(spark, sf):
    names = (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations"
    ).split()
    return reports.table_counts({n: spark.read.parquet(f"{sf}/{n}.parquet") for n in names})


@query
def load_totals(spark, sf):
    """Ticks loaded per listed symbol: most listed symbols have none."""
    ticks = data.tick_prices(spark, sf)
    listed = ticks.select("stock_symbol").unionByName(data.securities(spark, sf).select("stock_symbol"))
    return reports.load_totals(listed, ticks, data.exchange_rates(spark, sf))


# Feeds, symbols, watchlists


def _tickers(spark: SparkSession, sf: str) -> DataFrame:
    """A ticker per part; sizes decide the suffix, one in five has none."""
    suffixes = F.array(*[F.lit(s) for s in (*MARKETS, "")])
    return data.raw(spark, sf, "part").select(
        "p_partkey",
        "p_brand",
        "p_name",
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), suffixes[F.col("p_size") % 5]).alias("ticker"),
    )


@query
def infer_market_codes(spark, sf):
    return _tickers(spark, sf).select("p_partkey", "ticker", infer_market(F.col("ticker")).alias("m")).select(
        "p_partkey", "ticker", "m.*"
    )


@query
def sector_codes(spark, sf):
    return data.raw(spark, sf, "part").select("p_partkey", sector_code(F.col("p_name")).alias("sector_code"))


@query
def fx_pair_split(spark, sf):
    """Event types and market segments as pair tickers; those of fewer than six letters drop out."""
    tickers = data.raw(spark, sf, "events").select(F.concat("event_type", F.lit("=x")).alias("ticker")).unionByName(
        data.raw(spark, sf, "customer").select(F.col("c_mktsegment").alias("ticker"))
    )
    split = tickers.withColumn("pair", fx_pair(F.col("ticker"))).where(F.col("pair").isNotNull())
    return split.groupBy("pair.base_currency", "pair.quote_currency").agg(F.count(F.lit(1)).alias("tickers"))


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a raw feed: small volumes are missing, some closes and some opens too."""
    ticks = data.tick_prices(spark, sf)
    price, volume = F.col("close").cast("double"), F.col("volume")
    return ticks.select(
        "stock_symbol",
        "timestamp",
        F.when(volume % 17 != 3, price).alias("open"),
        price.alias("high"),
        price.alias("low"),
        F.when(volume % 13 != 5, price).alias("close"),
        F.when(volume >= 10, volume.cast("double")).alias("volume"),
    )


@query
def normalize_ohlcv(spark, sf):
    return feeds.normalize_ohlcv(_feed(spark, sf))


@query
def rejected_rows(spark, sf):
    return feeds.rejected_rows(_feed(spark, sf)).select("stock_symbol", "timestamp", "close", "volume")


def _landed(spark: SparkSession, sf: str) -> str:
    """Every tick as a line of a landed file, some of them broken, and the folder they are in."""
    shown = F.format_string("%s,%s,%s,%s,%s,%s,%d", "stock_symbol", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), *["close"] * 4, "volume")
    line = (
        F.when(F.col("volume") % 19 == 3, F.replace(shown, F.concat(F.lit(","), F.col("volume").cast("string")), F.lit(",many")))
        .when(F.col("volume") % 23 == 5, F.concat_ws(",", "stock_symbol", F.lit("x")))
        .when(F.col("volume") % 29 == 2, F.concat(F.lit(","), F.substring_index(shown, ",", -6)))
        .otherwise(shown)
    )
    folder = scratch_dir(spark, "landed")
    ticks = data.tick_prices(spark, sf).withColumn("close", F.col("close").cast("decimal(12,2)"))
    ticks.select(line.alias("value")).write.text(folder)
    return folder


@query
def landed_feed(spark, sf):
    """What of the landed lines can be loaded, at the precision of the feed."""
    rows, _ = feeds.read_landed(spark, _landed(spark, sf))
    return rows


@query
def quarantined_feed(spark, sf):
    """What can't, by symbol and reason."""
    _, broken = feeds.read_landed(spark, _landed(spark, sf))
    return broken.groupBy("stock_symbol", "reason").agg(F.count(F.lit(1)).alias("records"))


def _landed_parquet(spark: SparkSession, sf: str) -> str:
    folder = scratch_dir(spark, "landed")
    ticks = data.tick_prices(spark, sf)
    ticks.select(*[F.col(f.name).cast(f.dataType) for f in feeds.FEED.fields]).repartition(4, "stock_symbol").write.parquet(folder)
    return folder


@query
def landed_source(spark, sf):
    """Landed files through the data source, with two filters that reach it."""
    landed.register(spark)
    rows = spark.read.format("landed_prices").load(_landed_parquet(spark, sf))
    return rows.where((F.col("stock_symbol") == "click") & (F.col("close") >= 20.0))


@query
def landed_source_stream(spark, sf):
    """The same files as a stream, merged into a table."""
    landed.register(spark)
    rows = spark.readStream.format("landed_prices").load(_landed_parquet(spark, sf))
    root = scratch_dir(spark, "ticks")
    table = Lake(root)["stock_prices"]
    prices = feeds.normalize_ohlcv(rows).withColumn("ingestion_timestamp", F.col("timestamp"))
    sinks.stream_upsert(prices, table, f"{root}/checkpoint", "ingestion_timestamp").awaitTermination()
    return table.read(spark).select("stock_symbol", "timestamp", "close", "volume")


@query
def wide_feed(spark, sf):
    """Daily bars spread to a column per ticker and field, then back to rows."""
    daily = bars.rollup_bars(data.tick_prices(spark, sf))
    names = list(data.PAIRS)
    wide = (
        daily.groupBy(F.col("bucket").alias("timestamp"))
        .pivot("stock_symbol", names)
        .agg(*[F.first(f.lower()).alias(f) for f in feeds.FEED_FIELDS])
    )
    return feeds.wide_to_long(wide, [*names, "absent"])


@query
def normalize_fx(spark, sf):
    rates = data.exchange_rates(spark, sf)
    ticker = F.concat(F.lower("base_currency"), "quote_currency", F.lit("=X"))
    return feeds.normalize_fx(rates.select(ticker.alias("stock_symbol"), "timestamp", F.col("rate").alias("close")))


def _watchlists(spark: SparkSession, sf: str) -> DataFrame:
    """A nested watchlist for every 100 parts."""
    n = F.substring_index("p_brand", "#", -1).cast("int")
    regions = [country for _, country, _ in MARKETS.values()]
    listed = _tickers(spark, sf).select(
        F.floor(F.col("p_partkey") / 100).alias("watchlist_id"),
        F.array(*[F.lit(s) for s in (*SECTORS, "New Energy")])[n % 12].alias("sector"),
        F.array(*[F.lit(r) for r in (*regions, "XX")])[n % 5].alias("region"),
        "ticker",
    )

    tickers = listed.groupBy("watchlist_id", "sector", "region").agg(
        F.sort_array(F.collect_list("ticker")).alias("tickers")
    )
    by_region = (
        tickers.groupBy("watchlist_id", "sector")
        .agg(F.sort_array(F.collect_list(F.struct("region", "tickers"))).alias("pairs"))
        .select("watchlist_id", "sector", F.map_from_entries("pairs").alias("by_region"))
    )
    known = F.create_map(
        *[
            x
            for suffix, (market, country, currency) in MARKETS.items()
            for x in (
                F.lit(country),
                F.struct(
                    F.lit(country).alias("name"),
                    F.lit(market).alias("market_code"),
                    F.lit(country).alias("country_code"),
                    F.lit(currency).alias("quote_currency"),
                    F.lit(suffix).alias("suffix"),
                ),
            )
        ]
    )
    # Maps cannot be sorted, so sectors are ordered by name alone before they are nested.
    in_order = F.array_sort(
        F.collect_list(F.struct("sector", "by_region")),
        lambda a, b: F.when(a["sector"] < b["sector"], -1).when(a["sector"] > b["sector"], 1).otherwise(0),
    )
    return by_region.groupBy("watchlist_id").agg(
        F.map_from_entries(in_order).alias("sectors"), F.first(known).alias("regions")
    )


@query
def watchlist_flat(spark, sf):
    return watchlist.flatten_watchlist(_watchlists(spark, sf), ids=["watchlist_id"])


@query
def watchlist_regions(spark, sf):
    return watchlist.flatten_watchlist(_watchlists(spark, sf), regions=["au", "Sg"], ids=["watchlist_id"])


@query
def dq_watchlist(spark, sf):
    flat = watchlist.flatten_watchlist(_watchlists(spark, sf), ids=["watchlist_id"])
    found = quality.watchlist_violations(flat)
    return found.select("watchlist_id", "stock_symbol", F.concat_ws(",", "problems").alias("problems"))


# Keyed writes


def _corrections(prices: DataFrame) -> DataFrame:
    """Prices from MID on sent twice, the second time one higher, and once more 3652 days on."""
    recent = filter_range(prices, "timestamp", start=MID)
    stamp = F.col("ingestion_timestamp")
    again = recent.withColumns({"close": F.col("close") + 1, "ingestion_timestamp": stamp + F.expr("INTERVAL 1 DAY")})
    later = recent.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 3652 DAYS"))
    return recent.unionByName(again).unionByName(later)


@query
def upsert_prices(spark, sf):
    prices = data.stock_prices(spark, sf)
    key = ["stock_symbol", "timestamp"]
    merged = upsert.merge_latest(prices, _corrections(prices), key, "ingestion_timestamp")
    return merged.select("stock_symbol", "timestamp", "close", "volume")


@query
def lake_upsert_prices(spark, sf):
    """The same merge of all bars in a table partitioned by year, as days are a few rows, replayed once."""
    prices = data.stock_prices(spark, sf)
    table = Lake(scratch_dir(spark, "prices"), "year")["stock_prices"]
    table.replace(prices)
    for _ in range(2):
        table.upsert(spark, _corrections(prices), "ingestion_timestamp")
    return table.read(spark).select("stock_symbol", "timestamp", "close", "volume")


FX_KEY = ["base_currency", "quote_currency", "timestamp"]


@query
def upsert_fx(spark, sf):
    rates = data.exchange_rates(spark, sf)
    stored = rates.where(F.col("timestamp") < F.lit(FX_CUT).cast("timestamp"))
    merged = upsert.merge_latest(stored, rates.withColumn("rate", F.col("rate") * 2), FX_KEY)
    return merged.select(*FX_KEY, "rate")


@query
def insert_if_absent(spark, sf):
    rates = data.exchange_rates(spark, sf)
    stored = rates.where(F.col("timestamp") < F.lit(FX_CUT).cast("timestamp"))
    return upsert.insert_if_absent(stored, rates.withColumn("rate", F.col("rate") * 2), FX_KEY).select(*FX_KEY, "rate")


@query
def coalesce_update(spark, sf):
    updates = data.securities(spark, sf).select(
        F.col("stock_symbol").alias("symbol"), "quote_currency", "gics_sector", "gics_sector_override"
    )
    columns = {"quote_currency": "quote_currency", "sector": "gics_sector", "gics_sector_override": "gics_sector"}
    return upsert.coalesce_update(data.stocks(spark, sf), updates, "symbol", columns, "2024-03-01").select(
        "id", "symbol", "sector", "quote_currency", "gics_sector_override", "updated_at"
    )


@query
def register_securities(spark, sf):
    """Tickers of all parts and brands with metadata for some, against the known brands."""
    n = F.substring_index("p_brand", "#", -1).cast("int")
    tickers = _tickers(spark, sf).select(F.col("ticker").alias("stock_symbol")).distinct()
    none = F.lit(None).cast("string")
    bare = tickers.select(
        "stock_symbol", *[none.alias(c) for c in ("market_code", "country_code", "quote_currency")],
        F.lit("energy").alias("gics_sector_code"), none.alias("gics_sector_override"),
    )
    described = data.raw(spark, sf, "part").select("p_brand").distinct().select(
        F.when(n % 2 == 0, F.upper("p_brand")).otherwise(F.concat(F.upper("p_brand"), F.lit(".NEW"))).alias("stock_symbol"),
        F.lit("SGX").alias("market_code"),
        F.lit("SG").alias("country_code"),
        F.lit("SGD").alias("quote_currency"),
        F.lit("utilities").alias("gics_sector_code"),
        F.lit("Utilities").alias("gics_sector_override"),
    )
    known = data.stocks(spark, sf).withColumn("symbol", F.upper("symbol")).withColumn("industry", F.lit(""))
    registered = upsert.register_securities(
        known.drop("industry"),
        bare.unionByName(described),
        data.sector_dimension(spark),
        data.market_dimension(spark),
        "2024-03-01",
    )
    return registered.drop("id")


@query
def delete_by_ids(spark, sf):
    trades = data.transactions(spark, sf)
    ids = trades.where(F.col("transaction_type") == "SELL").select("transaction_id")
    return upsert.delete_by_ids(trades, ids, "transaction_id").select("transaction_id", "portfolio_id", "quantity")


@query
def update_by_ids(spark, sf):
    """Every third stock gets a new sector and loses its currency; some updates come twice, some for unknown ids."""
    stocks = data.stocks(spark, sf)
    number = F.substring_index("id", "-", -1).cast("int")
    changed = stocks.where(number % 3 == 0).select("id", F.lit("Changed").alias("sector"), F.lit(None).cast("string").alias("quote_currency"))
    updates = changed.union(changed).union(spark.range(1).select(F.lit("stk-none"), F.lit("x"), F.lit("y")))
    out = upsert.update_by_ids(stocks, updates, "id", "2024-03-01")
    return out.select("id", "symbol", "sector", "quote_currency", "updated_at")


@query
def stored_writes(spark, sf):
    """Rates appended, others inserted if absent, some deleted: the table's contents and the rows each write counted."""
    table = Lake(scratch_dir(spark, "rates"), "month")["exchange_rates"]
    rates = data.exchange_rates(spark, sf)
    early = F.col("timestamp") < F.lit(FX_CUT).cast("timestamp")
    appended = table.append(rates.where(early))
    inserted = table.insert_absent(spark, rates.withColumn("rate", F.col("rate") * 2))
    table.delete(spark, rates.where(F.col("base_currency") == "NZD"))
    whole = table.verify_count(spark, appended + inserted)
    counts = [("appended", appended), ("inserted", inserted), ("all left", int(whole))]
    written = spark.createDataFrame(counts, "base_currency string, n bigint").select(
        "base_currency", F.lit(None).cast("string").alias("quote_currency"), F.lit(None).cast("timestamp").alias("timestamp"), F.col("n").cast("double").alias("rate")
    )
    return table.read(spark).select(*FX_KEY, "rate").union(written.select(*FX_KEY, "rate"))


# Published tables


@query
def export_prices(spark, sf):
    out = export.export_prices(data.operational(spark, sf), START, END)
    return out.drop("adjusted_close", "ingestion_timestamp")


@query
def export_transactions(spark, sf):
    return export.export_transactions(data.operational(spark, sf), end=END).drop("commission", "ingestion_timestamp")


@query
def export_securities(spark, sf):
    return export.export_securities(data.operational(spark, sf)).drop("ingestion_timestamp")


@query
def export_fx(spark, sf):
    return export.export_fx(data.operational(spark, sf), start=FX_CUT).drop("ingestion_timestamp")


def _published(spark: SparkSession, lake: Lake) -> DataFrame:
    """The contents of the four published tables as one table of comparable columns."""
    none, text = F.lit(None), F.lit
    cents = lambda c: F.rint(F.col(c).cast("double") * 100).cast("bigint")
    prices = lake["stock_prices"].read(spark).select(
        text("stock_prices").alias("table_name"), F.col("stock_symbol").alias("id"), F.col("timestamp").alias("at"),
        cents("close").alias("amount"), F.col("volume").alias("units"), none.cast("string").alias("label"),
    )
    trades = lake["transactions"].read(spark).select(
        text("transactions"), "transaction_id", "transaction_date", cents("price"), F.col("quantity").cast("bigint"),
        F.concat_ws("/", "portfolio_id", "stock_symbol", "transaction_type"),
    )
    listed = lake["securities"].read(spark).select(
        text("securities"), "stock_symbol", none.cast("timestamp"), none.cast("bigint"), none.cast("bigint"),
        F.concat_ws("/", "name", "gics_sector", "gics_sector_code", "market_code", "quote_currency"),
    )
    rates = lake["exchange_rates"].read(spark).select(
        text("exchange_rates"), F.concat("base_currency", "quote_currency"), "timestamp", F.rint(F.col("rate") * 1e6).cast("bigint"),
        none.cast("bigint"), none.cast("string"),
    )
    return prices.union(trades).union(listed).union(rates)


@query
def incremental_export(spark, sf):
    """The job over all four tables of a lake: what arrived by MID first, then what arrived since each table's mark."""
    lake = Lake(scratch_dir(spark, "lake"), "year")
    source = data.operational(spark, sf)
    early = replace(
        source, **{t: getattr(source, t).where(F.col("created_at") < F.lit(MID).cast("timestamp")) for t in ("stock_prices", "transactions")}
    )
    export.incremental_export(spark, early, lake)
    export.incremental_export(spark, source, lake)
    return _published(spark, lake)


@query
def full_export_counts(spark, sf):
    """Everything published to a lake at its real times, the export run twice, rows counted per table."""
    lake = Lake(scratch_dir(spark, "lake"), "year")
    source = data.operational(spark, sf)
    source = replace(source, **{t: stored(spark, getattr(source, t), t) for t in ("stock_prices", "transactions")})
    for _ in range(2):
        export.full_export(spark, source, lake)
    names = ("stock_prices", "transactions", "securities", "exchange_rates")
    return reports.table_counts({n: lake[n].read(spark) for n in names})


@query
def full_export(spark, sf):
    """The same lake's contents."""
    lake = Lake(scratch_dir(spark, "lake"), "year")
    export.full_export(spark, data.operational(spark, sf), lake)
    return _published(spark, lake)


@query
def etl_run(spark, sf):
    """The whole load of every tick: feed to tables, equal-cash purchases, weighted holdings, totals."""
    ticks = data.tick_prices(spark, sf)
    pair_of = F.create_map(*[F.lit(x) for kv in data.PAIRS.items() for x in kv])
    rates = ticks.select(
        F.concat(F.try_element_at(pair_of, F.col("stock_symbol")), F.lit("=X")).alias("stock_symbol"),
        "timestamp",
        F.col("close").cast("double").alias("close"),
    )
    out = etl.run_load(
        spark,
        Lake(scratch_dir(spark, "load")),
        ticks.select(F.upper("stock_symbol").alias("stock_symbol")),
        ticks.withColumn("stock_symbol", F.upper("stock_symbol")),
        rates,
        etl.LoadConfig("p1", "Automated"),
        "2024-02-01",
    )
    return rounded(out, amount=2)


# Data quality


@query
def dq_nulls(spark, sf):
    """The trades of the holdings feed without prices: every price is reported missing."""
    broken = data.transactions(spark, sf).withColumn(
        "price", F.when(F.col("transaction_type") == "BUY", F.col("price"))
    )
    return quality.missing_required(broken, TRANSACTIONS)


@query
def dq_domain(spark, sf):
    return quality.outside_domain(data.raw(spark, sf, "lineitem"), "l_returnflag", ["A", "R"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
    )


@query
def dq_unique(spark, sf):
    return quality.duplicate_keys(data.raw(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_orphans(spark, sf):
    """Trades in brands that have no security row."""
    lost = quality.orphans(data.transactions(spark, sf), data.securities(spark, sf), "stock_symbol", "stock_symbol")
    return lost.select("transaction_id", "portfolio_id", "stock_symbol")


@query
def dq_defaults(spark, sf):
    filled = quality.with_defaults(
        data.securities(spark, sf).select("stock_symbol", "quote_currency", "gics_sector"), {"quote_currency": "USD"}
    )
    return filled


@query
def dq_empty_feed(spark, sf):
    """Of all symbols that are listed or ticked, those without a daily price."""
    listed = data.securities(spark, sf).select("stock_symbol")
    listed = listed.unionByName(data.tick_prices(spark, sf).select("stock_symbol"))
    return quality.empty_feeds(listed, data.stock_prices(spark, sf))


@query
def dq_reconcile(spark, sf):
    return quality.reconcile_holdings(_weighted(spark, sf), _holdings(spark, sf))
