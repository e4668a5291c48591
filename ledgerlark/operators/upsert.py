"""Keyed merges as pure DataFrame transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.symbols import DEFAULT_CURRENCY, infer_market
from ledgerlark.operators.blocks import BROADCAST_ROWS


def newest_per_key(batch: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the remaining columns.

    A maximum of structs combines on the map side, so replays of one key cost a row per partition.
    """
    rest = [c for c in batch.columns if c not in key and c != order]
    ranked = ([order] if order is not None and order not in key else []) + rest
    if not ranked:
        return batch.select(*key).distinct()
    best = batch.groupBy(*key).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*key, *[F.col("_best")[c].alias(c) for c in ranked]).select(*batch.columns)


def repeated_digests(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``_digest`` of every key that occurs more than once, and of keys that share one: a number a row is shuffled."""
    counted = rows.select(F.xxhash64(*key).alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    return counted.where("_n > 1").select("_digest")


def newest_of_repeated(rows: DataFrame, key: Sequence[str], order: str | None, repeats: int) -> DataFrame:
    """``newest_per_key`` of stored ``rows`` of which ``repeated_digests`` gave ``repeats``; while those are few, other rows stay where they are."""
    if repeats > BROADCAST_ROWS:
        return newest_per_key(rows, key, order)
    again = F.broadcast(repeated_digests(rows, key))
    marked = rows.withColumn("_digest", F.xxhash64(*key))
    several = marked.join(again, "_digest", "left_semi").drop("_digest")
    return marked.join(again, "_digest", "left_anti").drop("_digest").unionByName(newest_per_key(several, key, order))


def merge_latest(existing: DataFrame, batch: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """Upsert: batch rows replace existing ones of their key; within the batch the last write wins."""
    newest = newest_per_key(batch, key, order)
    kept = existing.join(newest.select(*key), list(key), "left_anti")
    return kept.unionByName(newest.select(*existing.columns))


def absent_rows(existing: DataFrame, batch: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """Batch rows, one per key, whose key does not exist yet."""
    fresh = batch.join(existing.select(*key), list(key), "left_anti")
    return newest_per_key(fresh, key, order)


def insert_if_absent(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], order: str | None = None
) -> DataFrame:
    """Existing rows untouched plus batch rows with new keys."""
    return existing.unionByName(absent_rows(existing, batch, key, order).select(*existing.columns))


def coalesce_update(
    existing: DataFrame,
    updates: DataFrame,
    key: str,
    columns: dict[str, str],
    now: str | None = None,
    touched: str = "updated_at",
    only_with_values: bool = False,
) -> DataFrame:
    """Per matched row, non-NULL update values win and the ``touched`` time moves.

    ``columns`` maps target columns to update columns. Updates that repeat a key are one: of each column the
    greatest value. Updates with a null key match nothing. With ``only_with_values`` an update
    without any value doesn't count as one.
    """
    stamp = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    if only_with_values:
        updates = updates.dropna(how="all", subset=list(set(columns.values())))
    new = updates.groupBy(key).agg(
        *[F.max(c).alias(f"_new_{target}") for target, c in columns.items()], F.lit(True).alias("_hit")
    )
    changes = {t: F.coalesce(F.col(f"_new_{t}"), F.col(t)) for t in columns}
    if touched in existing.columns:
        changes[touched] = F.when(F.col("_hit"), stamp).otherwise(F.col(touched))
    return existing.join(new, key, "left").withColumns(changes).select(*existing.columns)


def delete_by_ids(existing: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``ids``."""
    return existing.join(ids.select(key), key, "left_anti")


def update_by_ids(existing: DataFrame, updates: DataFrame, key: str, now: str | None = None) -> DataFrame:
    """Rows whose key is among ``updates`` with all columns that ``updates`` has, NULLs included; the newest by all columns of updates that repeat a key."""
    columns = [c for c in updates.columns if c != key]
    stamp = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    new = newest_per_key(updates, [key]).select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    changes = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    if "updated_at" in existing.columns and "updated_at" not in columns:
        changes["updated_at"] = F.when(F.col("_hit"), stamp).otherwise(F.col("updated_at"))
    return existing.join(new, key, "left").withColumns(changes).select(*existing.columns)


def first_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest keys."""
    return df.orderBy(key).limit(rows)


def select_by_id(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


METADATA_COLUMNS = {
    "country_code": "country_code",
    "quote_currency": "quote_currency",
    "gics_sector_id": "gics_sector_id",
    "market_id": "market_id",
    "gics_sector_override": "gics_sector_override",
    "sector": "gics_sector_override",
}


def register_securities(
    stocks: DataFrame,
    requested: DataFrame,
    sectors: DataFrame,
    markets: DataFrame,
    now: str | None = None,
) -> DataFrame:
    """Get-or-create: the stocks table with a row for every requested symbol.

    ``requested`` has stock_symbol plus optional market_code, country_code, quote_currency,
    gics_sector_code and gics_sector_override. For new symbols without a market code, market,
    country and currency come from the ticker suffix; the currency defaults to USD. Known symbols
    take over the non-NULL metadata; those without any stay as they are. ``sectors`` and ``markets`` map codes to ids.
    """
    stamp = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    asked = requested.select(
        F.upper("stock_symbol").alias("symbol"),
        "market_code",
        "country_code",
        "quote_currency",
        "gics_sector_code",
        "gics_sector_override",
    )
    asked = newest_per_key(asked, ["symbol"])
    sector_ids = sectors.select(F.col("code").alias("gics_sector_code"), F.col("id").alias("gics_sector_id"))
    market_ids = markets.select(F.col("code").alias("market_code"), F.col("id").alias("market_id"))

    known = asked.join(sector_ids, "gics_sector_code", "left").join(market_ids, "market_code", "left")
    updated = coalesce_update(stocks, known, "symbol", METADATA_COLUMNS, now, only_with_values=True)

    inferred = infer_market(F.col("symbol"))
    has_market = F.col("market_code").isNotNull()
    new = (
        asked.join(stocks.select("symbol"), "symbol", "left_anti")
        .withColumn("_inferred", inferred)
        .withColumns(
            {
                c: F.when(has_market, F.col(c)).otherwise(F.col("_inferred")[c])
                for c in ("country_code", "quote_currency", "market_code")
            }
        )
        .join(sector_ids, "gics_sector_code", "left")
        .join(market_ids, "market_code", "left")
        .select(
            F.expr("uuid()").alias("id"),
            "symbol",
            F.col("symbol").alias("name"),
            F.coalesce("market_code", F.lit("")).alias("exchange"),
            F.coalesce("gics_sector_override", F.lit("")).alias("sector"),
            "country_code",
            F.coalesce("quote_currency", F.lit(DEFAULT_CURRENCY)).alias("quote_currency"),
            "gics_sector_id",
            "market_id",
            "gics_sector_override",
            stamp.alias("updated_at"),
        )
    )
    return updated.unionByName(new)
