"""Latest row per key, latest N rows per key, as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.predicates import filter_range
from ledgerlark.operators.blocks import before_block, beside, cut_into_blocks, stored


def latest_by(
    df: DataFrame, keys: Sequence[str], order: str, values: dict[str, str], tie: str | None = None
) -> DataFrame:
    """Values of the row with the greatest ``order`` per key, named by ``values`` (output -> column).

    ``max_by`` combines on the map side, so a hot key costs one row per input partition. Where
    (key, order) is not unique, ``tie`` names a column whose greatest value decides.
    """
    by = F.col(order) if tie is None else F.struct(order, tie)
    return df.groupBy(*keys).agg(*[F.max_by(F.col(c), by).alias(out) for out, c in values.items()])


def latest_prices(prices: DataFrame, as_of: str | None = None, tie: str | None = None) -> DataFrame:
    """Last close per symbol at or before ``as_of``."""
    return latest_by(
        filter_range(prices, "timestamp", end=as_of), ["stock_symbol"], "timestamp", {"current_price": "close"}, tie
    )


def latest_fx(rates: DataFrame, tie: str | None = None) -> DataFrame:
    """Last rate per currency pair."""
    return latest_by(rates, ["base_currency", "quote_currency"], "timestamp", {"rate": "rate"}, tie)


def latest_n(
    df: DataFrame,
    n: int,
    keys: Sequence[str] = ("stock_symbol",),
    order: str = "timestamp",
    bucket: str | None = None,
) -> DataFrame:
    """The ``n`` latest rows of every key, with ``rn`` = 1 for the newest.

    With ``bucket`` the rows to rank are first cut to each key's newest buckets that hold ``n`` rows,
    found from counts, so long histories are neither sorted nor shuffled.
    """
    rows = df
    if bucket is not None:
        rows = df.withColumn("_bucket", F.date_trunc(bucket, F.col(order)))
        newer = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
        needed = (
            rows.groupBy(*keys, "_bucket")
            .agg(F.count(F.lit(1)).alias("_rows"))
            .withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
            .where(F.col("_newer") < n)
        )
        rows = rows.join(needed.select(*keys, "_bucket"), [*keys, "_bucket"], "left_semi").drop("_bucket")
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc())))
    return ranked.where(F.col("rn") <= n)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_order: str,
    right_order: str,
    values: dict[str, str],
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before its time (else NULL).

    Of right rows at one time the one with the greatest ``values`` counts. Both sides are sorted together by key
    and time; a key with more than ``block_rows`` rows is cut at quantiles of its time, and each block
    starts from the last right row of the blocks before it, so a key that holds all rows is spread over all
    tasks. Both sides are written once, so that counting, cutting and matching don't compute them again each. Right rows
    without a time match nothing, left rows without one get NULL, and null keys don't meet.
    """
    payload = F.struct(*[F.col(c).alias(out) for out, c in values.items()])
    lefts = left.withColumn("_time", F.col(left_order)).withColumn("_side", F.lit(2))
    rights = right.select(*keys, F.col(right_order).alias("_time"), payload.alias("_found")).where(F.col("_time").isNotNull())
    for key in keys:
        rights = rights.where(F.col(key).isNotNull())
    # Side orders equal times: right rows, then left rows.
    both = lefts.unionByName(rights.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    both = stored(left.sparkSession, both, "asof-sides")
    placed, cut = cut_into_blocks(left.sparkSession, both, keys, "_time", block_rows)
    so_far = Window.partitionBy(*keys, "_block").orderBy("_time", "_side", "_found").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    matched = placed.withColumn("_match", F.last("_found", ignorenulls=True).over(so_far))
    if cut:
        latest_first = F.struct("_time", "_found")
        closing = placed.where(F.col("_side") == 1).groupBy(*keys, "_block").agg(F.max(latest_first).alias("_last"))
        # A block without right rows hands on what it was given.
        closing = placed.select(*keys, "_block").distinct().join(closing, [*keys, "_block"], "left")
        carried = before_block(closing, keys, "_block", {"_before": F.last("_last", ignorenulls=True)})
        carried = stored(left.sparkSession, carried.where(F.col("_before").isNotNull()), "asof-blocks")
        matched = beside(matched, carried, [*keys, "_block"], "left", carried.count())
        inherited = F.when(F.col("_time").isNotNull(), F.col("_before._found"))
        matched = matched.withColumn("_match", F.coalesce("_match", inherited))
    return matched.where(F.col("_side") == 2).select(*left.columns, *[F.col("_match")[out].alias(out) for out in values])
