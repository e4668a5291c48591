"""Exponential means with recursive weights, as a segmented scan over ordered series.

A mean y = w * x + (1 - w) * y_before is linear in y_before: over a run of n rows it is decay^n times the mean before
the run plus the run's own contribution. Runs are scanned by windows in closed form, each from zero, and the
means that precede them follow from the few runs before, as the decay of older ones is below a double's precision.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.operators.blocks import beside, cut_into_blocks, stored

EMA_PERIODS = (12, 26)
SIGNAL_PERIOD = 9
#: A contribution that has decayed to this share no longer changes a double.
GONE = 1e-19
#: Weights inside a run grow up to this, well inside a double's range.
GROWN = 1e80


def decay_of(period: int) -> float:
    return 1 - 2 / (period + 1)


def run_rows(decay: float) -> int:
    """Rows of a run: 1,024, or fewer where weights would grow beyond GROWN."""
    return max(1, min(1_024, int(math.log(GROWN) / -math.log(decay)))) if decay > 0 else 1_024


def _over_block(decay: float) -> Callable[[Column, Column], Column]:
    return lambda done, block: block["end"] + F.pow(F.lit(decay), block["_rows"].cast("double")) * done


class Scan:
    """The recursive means of one column in windows that share the partitioning (keys, block)."""

    def __init__(self, keys: Sequence[str], order: Sequence[str]):
        self.keys, self.order = list(keys), list(order)
        self.block: WindowSpec = Window.partitionBy(*keys, "_block").orderBy(*order)

    def local(self, df: DataFrame, column: str, out: str, period: int) -> DataFrame:
        """Add ``out``, the mean of the block's rows so far with nothing before the block but, in block 0, the first row itself."""
        decay = decay_of(period)
        if decay <= 0:
            return df.withColumn(out, F.col(column))
        rows = run_rows(decay)
        at, run = F.expr(f"(_row - 1) % {rows}"), F.expr(f"(_row - 1) div {rows}")
        seed = (F.col("_row") == 1) & (F.col("_block") == 0)
        weight = F.when(seed, F.lit(1.0)).otherwise(F.lit(1 - decay))
        term = weight * F.col(column) * F.pow(F.lit(decay), -F.col("_at").cast("double"))
        in_run = Window.partitionBy(*self.keys, "_block", "_run").orderBy(*self.order).rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumns({"_at": at, "_run": run})
        df = df.withColumn("_own", F.sum(term).over(in_run) * F.pow(F.lit(decay), F.col("_at").cast("double")))
        # The mean before a run: what its predecessors ended with, as far back as it matters.
        ended = F.when(F.col("_at") == rows - 1, F.col("_own"))
        before: Column = F.lit(0.0)
        by_run = Window.partitionBy(*self.keys, "_block").orderBy("_run")
        back = max(1, math.ceil(math.log(GONE) / (rows * math.log(decay))))
        for k in range(1, back + 1):
            end = F.max(ended).over(by_run.rangeBetween(-k, -k))
            before = before + F.coalesce(end, F.lit(0.0)) * F.lit(decay ** (rows * (k - 1)))
        whole = F.col("_own") + F.pow(F.lit(decay), (F.col("_at") + 1).cast("double")) * before
        return df.withColumn(out, whole).drop("_at", "_run", "_own")

    def carried(self, df: DataFrame, outs: dict[str, int], name: str) -> DataFrame:
        """``df`` with what earlier blocks add to the means ``outs`` (name -> period), from one row per block."""
        last = F.struct("_row")
        ends = df.groupBy(*self.keys, "_block").agg(F.max("_row").alias("_rows"), *[F.max_by(o, last).alias(o) for o in outs])
        earlier = Window.partitionBy(*self.keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        adds = {}
        for o, period in outs.items():
            listed = F.collect_list(F.struct("_rows", F.col(o).alias("end"))).over(earlier)
            adds[f"_add_{o}"] = F.aggregate(listed, F.lit(0.0), _over_block(decay_of(period)))
        before = stored(df.sparkSession, ends.select(*self.keys, "_block", *[c.alias(n) for n, c in adds.items()]), name)
        joined = beside(df, before.where("_block > 0"), [*self.keys, "_block"], "left", before.count())
        for o, period in outs.items():
            more = F.pow(F.lit(decay_of(period)), F.col("_row").cast("double")) * F.coalesce(f"_add_{o}", F.lit(0.0))
            joined = joined.withColumn(o, F.col(o) + more).drop(f"_add_{o}")
        return joined


def _scanned(prices: DataFrame, column: str, keys: Sequence[str], order: Sequence[str], block_rows: int) -> tuple[DataFrame, Scan, bool]:
    rows = prices.where(F.col(column).isNotNull()).withColumn("_x", F.col(column).cast("double"))
    placed, cut = cut_into_blocks(prices.sparkSession, rows, keys, order[0], block_rows)
    scan = Scan(keys, order)
    return placed.withColumn("_row", F.row_number().over(scan.block)), scan, cut


def ema_recursive(
    prices: DataFrame,
    column: str = "close",
    periods: Sequence[int] = EMA_PERIODS,
    keys: Sequence[str] = ("stock_symbol",),
    order: Sequence[str] = ("timestamp",),
    block_rows: int = 250_000,
) -> DataFrame:
    """``ema_<p>`` per row: 2 / (p + 1) of the row's value and the rest of the mean before; the first row is its own mean.

    Rows without a value drop out and leave the mean alone. ``order`` has to decide the order of a series; the first of it cuts
    series longer than ``block_rows`` into blocks, whose means follow from one row per block.
    """
    outs = {f"ema_{p}": p for p in periods}
    df, scan, cut = _scanned(prices, column, keys, order, block_rows)
    for out, period in outs.items():
        df = scan.local(df, "_x", out, period)
    if cut:
        df = scan.carried(df, outs, "ema-blocks")
    return df.select(*prices.columns, *outs)


def macd_recursive(
    prices: DataFrame,
    keys: Sequence[str] = ("stock_symbol",),
    order: Sequence[str] = ("timestamp",),
    block_rows: int = 250_000,
) -> DataFrame:
    """``ema_12``, ``ema_26``, ``macd`` and ``macd_signal``, the recursive mean of ``macd`` over 9 rows; else as ``ema_recursive``."""
    fast, slow = EMA_PERIODS
    outs = {f"ema_{fast}": fast, f"ema_{slow}": slow}
    df, scan, cut = _scanned(prices, "close", keys, order, block_rows)
    for out, period in outs.items():
        df = scan.local(df, "_x", out, period)
    if cut:
        df = scan.carried(df, outs, "ema-blocks")
    df = df.withColumn("macd", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))
    df = scan.local(df, "macd", "macd_signal", SIGNAL_PERIOD)
    if cut:
        df = scan.carried(df, {"macd_signal": SIGNAL_PERIOD}, "signal-blocks")
    return df.select(*prices.columns, *outs, "macd", "macd_signal")
