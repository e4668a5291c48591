"""Declared schemas, keys and partition columns of the lake tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(20, 6)
TOTAL = T.DecimalType(20, 2)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, not required) for name, dtype, required in fields])


STOCK_PRICES = _struct(
    ("stock_symbol", T.StringType(), True),
    ("timestamp", T.TimestampType(), True),
    ("open", MONEY, True),
    ("high", MONEY, True),
    ("low", MONEY, True),
    ("close", MONEY, True),
    ("volume", T.LongType(), True),
    ("adjusted_close", MONEY, False),
    ("ingestion_timestamp", T.TimestampType(), True),
)

TRANSACTIONS = _struct(
    ("transaction_id", T.StringType(), True),
    ("portfolio_id", T.StringType(), True),
    ("stock_symbol", T.StringType(), True),
    ("transaction_type", T.StringType(), True),
    ("quantity", MONEY, True),
    ("price", MONEY, True),
    ("commission", MONEY, True),
    ("transaction_date", T.TimestampType(), True),
    ("ingestion_timestamp", T.TimestampType(), True),
)

PORTFOLIO_METRICS = _struct(
    ("portfolio_id", T.StringType(), True),
    ("calculation_date", T.TimestampType(), True),
    ("total_value", TOTAL, True),
    ("total_cost", TOTAL, True),
    ("realized_gains", TOTAL, True),
    ("unrealized_gains", TOTAL, True),
    ("total_return_pct", T.DoubleType(), True),
    ("daily_return_pct", T.DoubleType(), False),
    ("volatility", T.DoubleType(), False),
    ("sharpe_ratio", T.DoubleType(), False),
    ("max_drawdown_pct", T.DoubleType(), False),
)

TECHNICAL_INDICATORS = _struct(
    ("stock_symbol", T.StringType(), True),
    ("timestamp", T.TimestampType(), True),
    ("sma_20", MONEY, False),
    ("sma_50", MONEY, False),
    ("sma_200", MONEY, False),
    ("ema_12", MONEY, False),
    ("ema_26", MONEY, False),
    ("rsi_14", T.DoubleType(), False),
    ("macd", MONEY, False),
    ("macd_signal", MONEY, False),
    ("bollinger_upper", MONEY, False),
    ("bollinger_lower", MONEY, False),
)

SECURITIES = _struct(
    ("stock_symbol", T.StringType(), True),
    ("name", T.StringType(), True),
    ("exchange", T.StringType(), False),
    ("country_code", T.StringType(), False),
    ("quote_currency", T.StringType(), False),
    ("gics_sector", T.StringType(), False),
    ("gics_sector_code", T.StringType(), False),
    ("market_code", T.StringType(), False),
    ("gics_sector_override", T.StringType(), False),
    ("ingestion_timestamp", T.TimestampType(), True),
)

EXCHANGE_RATES = _struct(
    ("base_currency", T.StringType(), True),
    ("quote_currency", T.StringType(), True),
    ("timestamp", T.TimestampType(), True),
    ("rate", T.DoubleType(), True),
    ("ingestion_timestamp", T.TimestampType(), True),
)


@dataclass(frozen=True)
class TableSpec:
    """A lake table: its schema, natural key, the column its day partition comes from and the
    identity partition column that catalogs with hidden partitioning add to it."""

    schema: T.StructType
    key: tuple[str, ...]
    day_of: str | None = None
    identity: str | None = None


TABLES: dict[str, TableSpec] = {
    "stock_prices": TableSpec(STOCK_PRICES, ("stock_symbol", "timestamp"), "timestamp", "stock_symbol"),
    "transactions": TableSpec(TRANSACTIONS, ("transaction_id",), "transaction_date", "portfolio_id"),
    "portfolio_metrics": TableSpec(
        PORTFOLIO_METRICS, ("portfolio_id", "calculation_date"), "calculation_date", "portfolio_id"
    ),
    "technical_indicators": TableSpec(
        TECHNICAL_INDICATORS, ("stock_symbol", "timestamp"), "timestamp", "stock_symbol"
    ),
    "securities": TableSpec(SECURITIES, ("stock_symbol",), None, "market_code"),
    "exchange_rates": TableSpec(
        EXCHANGE_RATES, ("base_currency", "quote_currency", "timestamp"), "timestamp", None
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast ``df`` to ``schema``; optional columns it lacks become NULL."""
    missing = [f.name for f in schema.fields if not f.nullable and f.name not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
