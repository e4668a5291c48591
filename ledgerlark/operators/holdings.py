"""Positions from trades: net-cash cost and running weighted-average cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlark.functions.money import notional, ratio, signed
from ledgerlark.functions.predicates import filter_range

POSITION = ["portfolio_id", "stock_symbol"]
# Quantities stay exact, so that a position sold off completely ends at exactly 0.
UNITS = T.DecimalType(28, 6)


def portfolio_transactions(transactions: DataFrame, portfolio_id: str) -> DataFrame:
    """One portfolio's trades in date order."""
    return transactions.where(F.col("portfolio_id") == portfolio_id).orderBy("transaction_date")


def net_holdings(transactions: DataFrame, strict: bool = False, tx_as_of: str | None = None) -> DataFrame:
    """Open positions with net quantity, net cash paid and their quotient as average cost.

    ``strict`` ignores trade types other than BUY and SELL instead of counting them as sales.
    ``tx_as_of`` also limits the trades counted; by default all are.
    """
    return (
        filter_range(transactions, "transaction_date", end=tx_as_of)
        .groupBy(*POSITION)
        .agg(
            F.sum(signed(F.col("quantity"), strict=strict)).alias("total_quantity"),
            F.sum(signed(notional(), strict=strict)).alias("total_cost"),
        )
        .where(F.col("total_quantity") > 0)
        .withColumn("average_cost", ratio(F.col("total_cost"), F.col("total_quantity")))
    )


def portfolio_activity(portfolios: DataFrame, transactions: DataFrame) -> DataFrame:
    """Trades and money spent on purchases per portfolio; portfolios without trades count 0."""
    spent = F.when(F.col("transaction_type") == "BUY", notional()).otherwise(F.lit(0))
    activity = transactions.groupBy("portfolio_id").agg(
        F.count("transaction_id").alias("transactions"), F.sum(spent).alias("invested")
    )
    return portfolios.join(activity, "portfolio_id", "left").select(
        "portfolio_id",
        "name",
        F.coalesce("transactions", F.lit(0)).alias("transactions"),
        F.coalesce("invested", F.lit(0)).alias("invested"),
    )


def most_active_portfolio(portfolios: DataFrame, transactions: DataFrame) -> DataFrame:
    """The portfolio with most trades; equal counts go to the smaller id."""
    counted = portfolio_activity(portfolios, transactions).select("portfolio_id", "name", "transactions")
    return counted.orderBy(F.col("transactions").desc(), "portfolio_id").limit(1)


def _fold_trades(trades: Column, opening_quantity: Column) -> Column:
    """Walk one block's trades in order from a known opening quantity.

    The average cost after the block is ``a * opening average + b``: a purchase mixes its price into
    the average by quantity, a sale leaves it alone, and a purchase into an empty position weighs the
    past with 0. The realised gain is likewise ``g + h * opening average``. So blocks can be walked
    apart and joined up afterwards.
    """
    start = F.struct(
        opening_quantity.alias("quantity"),
        F.lit(1.0).alias("a"),
        F.lit(0.0).alias("b"),
        F.lit(0.0).alias("g"),
        F.lit(0.0).alias("h"),
    )

    def step(state: Column, trade: Column) -> Column:
        held, traded, price = state["quantity"], trade["quantity"], trade["price"]
        after_buy = held + traded
        keep = F.coalesce(ratio(held, after_buy), F.lit(0.0))
        mix = F.coalesce(ratio(traded, after_buy), F.lit(0.0))
        bought = F.struct(
            after_buy.cast(UNITS).alias("quantity"),
            (state["a"] * keep).alias("a"),
            (state["b"] * keep + price * mix).alias("b"),
            state["g"].alias("g"),
            state["h"].alias("h"),
        )
        sold = F.least(held, traded)
        closed = F.struct(
            (held - sold).cast(UNITS).alias("quantity"),
            state["a"].alias("a"),
            state["b"].alias("b"),
            (state["g"] + sold.cast("double") * (price - state["b"])).alias("g"),
            (state["h"] - sold.cast("double") * state["a"]).alias("h"),
        )
        kind = trade["kind"]
        return F.when(kind == "BUY", bought).when(kind == "SELL", closed).otherwise(state)

    return F.aggregate(trades, start, step)


def _compose(folds: Column) -> Column:
    """One fold equal to ``folds`` applied one after another, given as sorted (place, fold) structs."""
    start = F.struct(
        F.lit(0).cast(UNITS).alias("quantity"),
        F.lit(1.0).alias("a"),
        F.lit(0.0).alias("b"),
        F.lit(0.0).alias("g"),
        F.lit(0.0).alias("h"),
    )

    def step(done: Column, placed: Column) -> Column:
        then = placed["fold"]
        return F.struct(
            then["quantity"].alias("quantity"),
            (then["a"] * done["a"]).alias("a"),
            (then["a"] * done["b"] + then["b"]).alias("b"),
            (done["g"] + then["g"] + then["h"] * done["b"]).alias("g"),
            (done["h"] + then["h"] * done["a"]).alias("h"),
        )

    return F.aggregate(folds, start, step)


def weighted_holdings(
    transactions: DataFrame,
    opening: DataFrame | None = None,
    bucket: str = "day",
    keep_closed: bool = False,
    block_rows: int = 10_000,
) -> DataFrame:
    """Positions under the running weighted-average rule, trade by trade in (date, id) order.

    BUY mixes into the average, SELL only lowers the quantity, a quantity of 0 or less closes the
    position so that the next BUY starts afresh, and SELL without a position does nothing.
    ``opening`` continues from earlier positions; ``keep_closed`` also returns closed ones.
    ``realized_gain`` sums (sale price - average cost) * quantity sold.

    A hot position is spread over its ``bucket`` times (a ``date_trunc`` unit), and inside a bucket
    lists hold at most ``block_rows`` trades. Quantities need only each block's net change and lowest
    running sum; with the opening quantities known, blocks fold independently and the folds compose,
    first within buckets and then within positions.
    """
    nothing = F.lit(0).cast(UNITS)
    change = signed(F.col("quantity").cast(UNITS), strict=True).cast(UNITS)
    trade = F.struct(
        F.col("_rank").alias("rank"),
        F.col("transaction_type").alias("kind"),
        F.col("quantity").cast(UNITS).alias("quantity"),
        F.col("price").alias("price"),
        F.coalesce(change, nothing).alias("change"),
    )
    block = [*POSITION, "_bucket", "_chunk"]
    in_order = Window.partitionBy(*POSITION, "_bucket").orderBy("transaction_date", "transaction_id")
    # Numbering sorts with spilling, and its partitioning serves the grouping after it. The filter is
    # stated here so that both readers of the blocks plan the same exchange and share it.
    blocks = (
        transactions.select(
            *POSITION,
            "transaction_date",
            "transaction_id",
            "transaction_type",
            "quantity",
            F.col("price").cast("double").alias("price"),
            F.date_trunc(bucket, F.col("transaction_date")).alias("_bucket"),
        )
        .where(F.col("_bucket").isNotNull())
        .withColumn("_rank", F.row_number().over(in_order))
        .withColumn("_chunk", F.expr(f"_rank div {int(block_rows)}"))
        .groupBy(*block)
        .agg(F.sort_array(F.collect_list(trade)).alias("_trades"), F.max("transaction_date").alias("_at"))
    )

    # Net change and lowest running sum per block, then the quantity each block opens with.
    def swing_step(state: Column, trade: Column) -> Column:
        total = (state["sum"] + trade["change"]).cast(UNITS)
        return F.struct(total.alias("sum"), F.least(state["low"], total).alias("low"))

    swing = F.aggregate("_trades", F.struct(nothing.alias("sum"), nothing.alias("low")), swing_step)
    swings = blocks.select(*block, swing.alias("_swing"))
    if opening is None:
        carried = None
        swings = swings.withColumn("_held", nothing)
    else:
        carried = opening.select(
            *POSITION,
            F.col("quantity").cast(UNITS).alias("_held"),
            F.col("average_cost").cast("double").alias("_average"),
            F.col("realized_gain").alias("_gain"),
        )
        swings = swings.join(carried.drop("_average", "_gain"), POSITION, "left")
    before = Window.partitionBy(*POSITION).orderBy("_bucket", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.col("_held"), nothing)
    openings = (
        swings.withColumn("_sum", F.coalesce(F.sum("_swing.sum").over(before), nothing))
        .withColumn("_dip", F.col("_sum") + F.col("_swing.low"))
        .withColumn("_lowest", F.coalesce(F.min("_dip").over(before), nothing))
        .select(*block, (F.col("_sum") + F.greatest(held, -F.col("_lowest"))).cast(UNITS).alias("_opening"))
    )

    def composed(folds: DataFrame, by: list[str], place: str) -> DataFrame:
        return (
            folds.groupBy(*by)
            .agg(
                F.sort_array(F.collect_list(F.struct(F.col(place).alias("place"), F.col("_fold").alias("fold"))))
                .alias("_folds"),
                F.max("_at").alias("_at"),
            )
            .select(*by, "_at", _compose(F.col("_folds")).alias("_fold"))
        )

    folded = blocks.join(openings, block).select(
        *block,
        _fold_trades(F.col("_trades"), F.col("_opening")).alias("_fold"),
        "_at",
    )
    ends = composed(composed(folded, [*POSITION, "_bucket"], "_chunk"), POSITION, "_bucket")
    average, gain = F.lit(0.0), F.lit(0.0)
    if carried is not None:
        ends = ends.join(carried.drop("_held"), POSITION, "left")
        average, gain = F.coalesce("_average", F.lit(0.0)), F.coalesce("_gain", F.lit(0.0))
    out = ends.select(
        *POSITION,
        F.col("_fold.quantity").alias("quantity"),
        (F.col("_fold.a") * average + F.col("_fold.b")).alias("average_cost"),
        (gain + F.col("_fold.g") + F.col("_fold.h") * average).alias("realized_gain"),
        F.col("_at").alias("last_updated"),
    )
    if opening is not None:
        untouched = opening.select(*out.columns).join(out, POSITION, "left_anti")
        out = out.unionByName(untouched)
    return out if keep_closed else out.where(F.col("quantity") > 0)


def holdings_listing(holdings: DataFrame, portfolios: DataFrame, stocks: DataFrame | None = None) -> DataFrame:
    """Stored positions with portfolio names and quantity * average cost, by name and symbol.

    With ``stocks`` (symbol, name) also the stock's name; positions in symbols that aren't listed drop out.
    """
    listed, stock_name = holdings.join(portfolios, "portfolio_id"), []
    if stocks is not None:
        names = stocks.select(F.col("symbol").alias("stock_symbol"), F.col("name").alias("stock_name"))
        listed, stock_name = listed.join(names, "stock_symbol"), ["stock_name"]
    return (
        listed.select(
            "name",
            *stock_name,
            "stock_symbol",
            "quantity",
            "average_cost",
            (F.col("quantity") * F.col("average_cost")).alias("total_cost"),
        )
        .orderBy("name", "stock_symbol")
    )
