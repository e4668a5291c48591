"""Cut long ordered groups into blocks at quantiles of their order, so that no task holds a whole group.

A scan over an ordered group then runs in two steps: windows inside (key, block), and a window over one
summary row per block, whose result is joined back. Only the blocks travel, never a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.scratch import scratch_dir

#: Quantiles taken of a long group: the shortest block is about this share of it.
GRID = 2_048
#: Rows of a summary table up to which it is broadcast.
BROADCAST_ROWS = 50_000


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read again, so that every later use sees the same rows."""
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def beside(df: DataFrame, small: DataFrame, on: Sequence[str], how: str, rows: int) -> DataFrame:
    """``df`` joined with ``small``, broadcast if its counted ``rows`` are few and else shuffled."""
    return df.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, list(on), how)


def in_blocks(
    spark: SparkSession, rows: DataFrame, keys: Sequence[str], order: str, block_rows: int, block: str = "_block"
) -> DataFrame:
    """The first part of ``cut_into_blocks``."""
    return cut_into_blocks(spark, rows, keys, order, block_rows, block)[0]


def cut_into_blocks(
    spark: SparkSession, rows: DataFrame, keys: Sequence[str], order: str, block_rows: int, block: str = "_block"
) -> tuple[DataFrame, bool]:
    """``rows`` with ``block``: 0, 1, ... in ascending ``order`` within each group of equal ``keys``; whether any was cut.

    Groups of at most ``block_rows`` rows are one block. Longer ones are cut at quantiles of ``order``
    into blocks of about ``block_rows`` rows; rows of one group and one value of ``order`` share a block,
    and null values are in block 0. Groups are counted first, with partial counts per task, and
    quantiles are taken of the long groups only; they are written once, so that every evaluation cuts
    alike. Null keys form a group.
    """
    keys = list(keys)
    names = [f"__cut_{i}" for i in range(len(keys))]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > block_rows)
    sizes = sizes.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__rows")
    found = sizes.count()
    if not found:
        return rows.withColumn(block, F.lit(0)), False
    long_groups = stored(spark, sizes, "long-groups")
    same = [rows[k].eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    small = F.broadcast(long_groups) if found <= BROADCAST_ROWS else long_groups
    quantiles = F.percentile_approx(order, [i / GRID for i in range(1, GRID)], F.lit(20 * GRID))
    cuts = rows.join(small, condition).groupBy(*names, "__rows").agg(quantiles.alias("__all"))
    step = F.greatest(F.lit(1), F.floor(F.lit(GRID) * block_rows / F.col("__rows"))).cast("int")
    cuts = cuts.withColumn("__step", step)
    cuts = cuts.select(*names, F.filter("__all", lambda x, i: (i + 1) % F.col("__step") == 0).alias("__cuts"))
    cuts = stored(spark, cuts.withColumn("__cuts", F.array_distinct("__cuts")), "cuts")
    small = F.broadcast(cuts) if found <= BROADCAST_ROWS else cuts
    placed = rows.join(small, condition, "left")
    return placed.withColumn(block, F.coalesce(_passed(F.col("__cuts"), F.col(order)), F.lit(0))).drop(*names, "__cuts"), True


def _passed(cuts: Column, value: Column) -> Column:
    """How many of the ascending ``cuts`` are less than ``value`` (0 for a null one), by bisection: each of the steps looks at
    one cut, however many there are."""

    def step(at: Column, width: Column) -> Column:
        ahead = at + width
        return F.when((ahead <= F.size(cuts)) & (F.get(cuts, ahead - 1) < value), ahead).otherwise(at)

    widths = [2**i for i in reversed(range((GRID - 1).bit_length()))]
    passed = F.aggregate(F.array(*[F.lit(w) for w in widths]), F.lit(0), step)
    return F.when(cuts.isNotNull(), passed)


def before_block(
    summaries: DataFrame, keys: Sequence[str], block: str, carried: dict[str, Column], reverse: bool = False
) -> DataFrame:
    """keys, block and, for each of ``carried``, that aggregate over the group's earlier (or later) blocks.

    ``summaries`` holds a row per (keys, block), so the window is as long as a group has blocks.
    """
    by = F.col(block).desc() if reverse else F.col(block)
    earlier = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return summaries.select(*keys, block, *[value.over(earlier).alias(name) for name, value in carried.items()])
