"""Ordered series per key, split so that no window partition holds a whole hot key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlark.operators.blocks import in_blocks

QUANTILES = "quantiles"


@dataclass(frozen=True)
class Series:
    """How rows form series and how long series are cut.

    ``bucket`` is a ``date_trunc`` unit small enough that one key's rows in it fit a task, or ``QUANTILES``, which cuts a
    key with more than an eighth of ``block_rows`` rows at quantiles of its order, however dense. Consecutive
    buckets of a key are put together until a block has about ``block_rows`` rows. ``bucket=None``
    keeps each key in one window partition; use it only where the calendar bounds a series, as with
    one bar per day.
    """

    keys: tuple[str, ...] = ("stock_symbol",)
    order: str = "timestamp"
    bucket: str | None = "day"
    block_rows: int = 250_000


DAILY_BARS = Series(bucket=None)


def _block_plan(df: DataFrame, series: Series, lookback: int) -> DataFrame:
    """Per (key, bucket): the blocks that need its rows, the first being the block that owns them.

    Works on row counts only: one pre-aggregated row per key and bucket. Blocks after the own one are
    those that start within ``lookback`` rows of the bucket's end.
    """
    counts = df.groupBy(*series.keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    by_time = Window.partitionBy(*series.keys).orderBy("_bucket")
    to_here = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("_begin", F.sum("_rows").over(to_here) - F.col("_rows")).withColumn(
        "_block", F.expr(f"_begin div {int(series.block_rows)}")
    )
    own = F.array("_block")
    if lookback == 0:
        return placed.select(*series.keys, "_bucket", own.alias("_blocks"))
    first = F.when(F.lag("_block", 1, -1).over(by_time) != F.col("_block"), F.col("_block"))
    starts_ahead = F.collect_list("_first").over(
        Window.partitionBy(*series.keys).orderBy("_begin").rangeBetween(0, lookback - 1)
    )
    return (
        placed.withColumn("_first", first)
        .withColumn("_ahead", starts_ahead)
        .withColumn("_next", F.lead("_ahead").over(by_time))
        .select(
            *series.keys,
            "_bucket",
            F.concat(own, F.coalesce("_next", F.array().cast(T.ArrayType(T.LongType())))).alias("_blocks"),
        )
    )


def split(df: DataFrame, series: Series, lookback: int) -> DataFrame:
    """Add ``_part`` (block) and ``_own``; rows within ``lookback`` of a later block are repeated there
    with ``_own`` false, so frames of up to ``lookback`` preceding rows are complete in every block."""
    if series.bucket == QUANTILES:
        piece = max(1, series.block_rows // 8)
        cut = in_blocks(df.sparkSession, df, series.keys, series.order, piece, "_bucket")
    else:
        cut = df.withColumn("_bucket", F.date_trunc(series.bucket, F.col(series.order)))
    plan = _block_plan(cut, series, lookback)
    return (
        cut.join(plan, [*series.keys, "_bucket"])
        .withColumn("_part", F.explode("_blocks"))
        .withColumn("_own", F.col("_part") == F.col("_blocks")[0])
        .drop("_bucket", "_blocks")
    )


def windowed(
    df: DataFrame,
    series: Series,
    lookback: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Apply ``compute(df, window)``, whose frames reach back at most ``lookback`` rows, to every series.

    All window columns of one ``compute`` share partitioning and order: one exchange, one sort.
    """
    if series.bucket is None:
        return compute(df, Window.partitionBy(*series.keys).orderBy(series.order))
    parts = split(df, series, lookback)
    window = Window.partitionBy(*series.keys, "_part").orderBy(series.order)
    return compute(parts, window).where("_own").drop("_part", "_own")
