"""Maximum drawdown as an ordered scan: (peak, trough, worst fall) per block, composed over blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.operators.blocks import cut_into_blocks


def max_drawdown(
    values: DataFrame, keys: Sequence[str], order: str, value: str, tie: str | None = None, block_rows: int = 1_000_000
) -> DataFrame:
    """keys, ``max_drawdown``: the largest fall from a running peak, as a percentage of the peak, per group.

    Falls from peaks of 0 or less don't count; a group that never falls has 0. Null values drop out, and a
    group without any has no row. Rows of one ``order`` go by ``tie``, if given, and by value. A long
    group is cut into blocks: a block's own worst fall, and its trough against the highest peak of earlier
    blocks, together are the worst fall that ends in it.
    """
    rows = values.select(*keys, order, *([tie] if tie else []), F.col(value).cast("double").alias("_value")).where("_value is not null")
    placed, _ = cut_into_blocks(values.sparkSession, rows, keys, order, block_rows)
    so_far = Window.partitionBy(*keys, "_block").orderBy(order, *([tie] if tie else []), "_value")
    fall = F.when(F.col("_peak") > 0, (F.col("_peak") - F.col("_value")) / F.col("_peak")).otherwise(F.lit(0.0))
    blocks = (
        placed.withColumn("_peak", F.max("_value").over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_block")
        .agg(F.max("_value").alias("_high"), F.min("_value").alias("_low"), F.max(fall).alias("_worst"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("_high").over(earlier)
    across = F.when(F.col("_before") > 0, (F.col("_before") - F.col("_low")) / F.col("_before"))
    return (
        blocks.withColumn("_before", before)
        .groupBy(*keys)
        .agg((F.greatest(F.lit(0.0), F.max(F.greatest("_worst", across))) * 100).alias("max_drawdown"))
    )
