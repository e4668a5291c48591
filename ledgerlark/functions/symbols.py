"""Ticker, market, sector and currency-pair expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market suffix -> market code, country, quote currency.
MARKETS = {
    ".AX": ("ASX", "AU", "AUD"),
    ".NZ": ("NZX", "NZ", "NZD"),
    ".KL": ("BURSA", "MY", "MYR"),
    ".SI": ("SGX", "SG", "SGD"),
}

# Market names and exchange identifiers, by market code.
MARKET_NAMES = {
    "ASX": ("Australian Securities Exchange", "XASX"),
    "NZX": ("New Zealand Exchange", "XNZE"),
    "BURSA": ("Bursa Malaysia", "XKLS"),
    "SGX": ("Singapore Exchange", "XSES"),
}

# The standard sectors in display order; the code is the slug of the name.
SECTORS = (
    "Energy",
    "Materials",
    "Industrials",
    "Utilities",
    "Healthcare",
    "Financials",
    "Consumer Discretionary",
    "Consumer Staples",
    "Information Technology",
    "Communication Services",
    "Real Estate",
)

DEFAULT_CURRENCY = "USD"


def sector_code(name: Column) -> Column:
    """Every standard sector code equals the slug of its name, and so does the fallback for others."""
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def infer_market(symbol: Column) -> Column:
    """struct(market_code, country_code, quote_currency) from the ticker suffix, else (NULL, NULL, USD)."""
    known = F.create_map(
        *chain.from_iterable(
            (
                F.lit(suffix),
                F.struct(
                    F.lit(market).alias("market_code"),
                    F.lit(country).alias("country_code"),
                    F.lit(currency).alias("quote_currency"),
                ),
            )
            for suffix, (market, country, currency) in MARKETS.items()
        )
    )
    unknown = F.struct(
        F.lit(None).cast("string").alias("market_code"),
        F.lit(None).cast("string").alias("country_code"),
        F.lit(DEFAULT_CURRENCY).alias("quote_currency"),
    )
    return F.coalesce(F.try_element_at(known, F.upper(F.right(symbol, F.lit(3)))), unknown)


def fx_pair(ticker: Column) -> Column:
    """struct(base_currency, quote_currency) of a pair ticker such as ``AUDUSD=X``; NULL if too short."""
    clean = F.replace(F.upper(ticker), F.lit("=X"), F.lit(""))
    return F.when(
        F.length(clean) >= 6,
        F.struct(
            F.substring(clean, 1, 3).alias("base_currency"),
            F.substring(clean, 4, 3).alias("quote_currency"),
        ),
    )
