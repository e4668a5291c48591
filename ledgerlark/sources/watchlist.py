"""Sector watchlists: a nested configuration flattened to rows."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.symbols import sector_code

_REGION = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("name", "market_code", "country_code", "quote_currency", "suffix")]
)
WATCHLIST = T.StructType(
    [
        T.StructField("base_currency", T.StringType()),
        T.StructField("regions", T.MapType(T.StringType(), _REGION)),
        T.StructField("fx_pairs", T.ArrayType(T.StringType())),
        T.StructField(
            "sectors", T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(T.StringType())))
        ),
    ]
)


def read_watchlist(spark: SparkSession, path: str) -> DataFrame:
    """One nested row from a JSON file, or from a YAML file where a YAML reader is installed."""
    if path.endswith((".yaml", ".yml")):
        import yaml

        # By way of JSON text, since a Python mapping would not keep its order as a Spark map.
        text = json.dumps(yaml.safe_load(spark.read.text(path, wholetext=True).first().value))
        return spark.range(1).select(F.from_json(F.lit(text), WATCHLIST).alias("w")).select("w.*")
    return spark.read.schema(WATCHLIST).json(path, multiLine=True)


def flatten_watchlist(
    config: DataFrame, regions: Sequence[str] | None = None, ids: Sequence[str] = ()
) -> DataFrame:
    """One row per symbol with sector and region attributes.

    A symbol listed twice keeps its first place by sector, region and position. ``regions`` filters
    without regard to case; ``ids`` are columns that tell several watchlists apart.
    """
    by_sector = config.select(*ids, "regions", F.posexplode("sectors").alias("_s", "sector", "_by_region"))
    by_region = by_sector.select(
        *ids, "regions", "_s", "sector", F.posexplode("_by_region").alias("_r", "region", "_tickers")
    )
    if regions is not None:
        by_region = by_region.where(F.upper("region").isin([r.upper() for r in regions]))
    listed = by_region.withColumn("_region", F.try_element_at("regions", "region")).select(
        *ids, "_s", "sector", "_r", "_region", F.posexplode("_tickers").alias("_t", "ticker")
    )
    entry = F.struct(
        "_s",
        "_r",
        "_t",
        sector_code(F.col("sector")).alias("gics_sector_code"),
        F.col("sector").alias("gics_sector_override"),
        *[F.col("_region")[c].alias(c) for c in ("country_code", "quote_currency", "market_code")],
    )
    return (
        listed.groupBy(*ids, F.upper("ticker").alias("stock_symbol"))
        .agg(F.min(entry).alias("_first"))
        .select(
            *ids,
            "stock_symbol",
            *[
                F.col("_first")[c].alias(c)
                for c in (
                    "gics_sector_code",
                    "gics_sector_override",
                    "country_code",
                    "quote_currency",
                    "market_code",
                )
            ],
        )
    )


def watchlist_pairs(config: DataFrame) -> DataFrame:
    """Currency pair tickers of a watchlist."""
    return config.select(F.explode("fx_pairs").alias("ticker"))
