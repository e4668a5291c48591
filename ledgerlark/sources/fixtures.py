"""The logical tables derived from the supplied star-schema and event files."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.symbols import MARKET_NAMES, MARKETS, SECTORS, sector_code
from ledgerlark.plans.export import Operational
from ledgerlark.schemas import EXCHANGE_RATES, MONEY, SECURITIES, STOCK_PRICES, TRANSACTIONS, conform

FIXED_TIME = "2024-02-01 00:00:00"
# Event type -> currency pair that its values stand for.
PAIRS = {"click": "AUDUSD", "error": "AUDNZD", "purchase": "AUDMYR", "signup": "AUDSGD", "view": "NZDUSD"}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied file; its zone-less timestamps become session-zone timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def ticks_of(events: DataFrame) -> DataFrame:
    """Events as price ticks: the type is the symbol, ``props.k`` the volume."""
    return events.select(
        F.col("event_type").alias("stock_symbol"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").cast(MONEY).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )


def tick_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = ticks_of(raw(spark, sf_dir, "events"))
    prices = ticks.withColumns({c: F.col("price") for c in ("open", "high", "low", "close", "adjusted_close")})
    return conform(prices.withColumn("ingestion_timestamp", F.col("timestamp")), STOCK_PRICES)


def _branded(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    brands = raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return lines.join(brands, "l_partkey")


def stock_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per brand from order lines; lines of a day follow each other by order, line and price.

    That sequence is packed into one number and prices are counted in cents, which keeps the rollup a
    hash aggregate over fixed-width buffers.
    """
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast(T.DecimalType(20, 0))
    lines = _branded(spark, sf_dir, raw(spark, sf_dir, "lineitem")).select(
        F.col("p_brand").alias("stock_symbol"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        cents.alias("cents"),
        (line * 10**10 + cents).cast(T.DecimalType(38, 0)).alias("sequence"),
    )
    bars = lines.groupBy("stock_symbol", "timestamp").agg(
        F.min_by("cents", "sequence").alias("open"),
        F.max("cents").alias("high"),
        F.min("cents").alias("low"),
        F.max_by("cents", "sequence").alias("close"),
        F.sum("quantity").alias("volume"),
    )
    money = {c: (F.col(c).cast(T.DecimalType(20, 2)) / 100).cast(MONEY) for c in ("open", "high", "low", "close")}
    return conform(
        bars.withColumns(money).withColumns(
            {"adjusted_close": F.col("close"), "ingestion_timestamp": F.col("timestamp")}
        ),
        STOCK_PRICES,
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(spark, sf_dir, raw(spark, sf_dir, "lineitem"))


def transactions_of(spark: SparkSession, sf_dir: str, order_lines: DataFrame) -> DataFrame:
    """Order lines, as a batch or a stream, as trades of the customer's nation in the part's brand;
    returned lines are sales."""
    orders = raw(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = raw(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    # Orders meet their customers first, so that lines, which are the most, are not dealt out for those again.
    owners = orders.join(customers, "o_custkey").drop("o_custkey")
    lines = _branded(spark, sf_dir, order_lines).join(owners, "l_orderkey")
    identity = F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.rint(F.col("l_extendedprice") * 100).cast("bigint"),
        F.col("l_quantity").cast("bigint"),
        "l_returnflag",
    )
    return conform(
        lines.select(
            identity.alias("transaction_id"),
            F.col("c_nationkey").cast("string").alias("portfolio_id"),
            F.col("p_brand").alias("stock_symbol"),
            F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("transaction_type"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            F.lit(0).alias("commission"),
            F.col("l_shipdate").alias("transaction_date"),
            F.col("l_shipdate").alias("ingestion_timestamp"),
        ),
        TRANSACTIONS,
    )


def portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as portfolios, plus one that never trades."""
    nations = raw(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("portfolio_id"), F.col("n_name").alias("name")
    )
    idle = spark.range(1).select(F.lit("idle").alias("portfolio_id"), F.lit("IDLE").alias("name"))
    return nations.unionByName(idle)


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = raw(spark, sf_dir, "part").select(F.col("p_brand").alias("stock_symbol")).distinct()
    return brands.withColumn("n", F.substring_index("stock_symbol", "#", -1).cast("int"))


def _pick(values: list[str], index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index]


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as securities: sector and market by number, some without sector, currency or any row."""
    n = F.col("n")
    markets = list(MARKETS.values())
    market = (n % 4).cast("int")
    sector = F.when(n % 5 != 0, _pick(list(SECTORS), (n % 11).cast("int")))
    rows = _brands(spark, sf_dir).where(n % 13 != 0)
    return conform(
        rows.withColumns(
            {
                "name": F.concat(F.lit("Company "), n.cast("string")),
                "exchange": _pick([m[0] for m in markets], market),
                "country_code": _pick([m[1] for m in markets], market),
                "quote_currency": F.when(n % 9 != 0, _pick([m[2] for m in markets], market)),
                "gics_sector": sector,
                "gics_sector_code": sector_code(sector),
                "market_code": _pick([m[0] for m in markets], market),
                "gics_sector_override": F.when(n % 7 == 0, F.lit("Special Situations")),
                "ingestion_timestamp": F.lit(FIXED_TIME),
            }
        ),
        SECURITIES,
    )


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair_of = F.create_map(*[F.lit(x) for x in chain.from_iterable(PAIRS.items())])
    rows = raw(spark, sf_dir, "events").withColumn("pair", F.try_element_at(pair_of, F.col("event_type")))
    return conform(
        rows.where(F.col("pair").isNotNull()).select(
            F.substring("pair", 1, 3).alias("base_currency"),
            F.substring("pair", 4, 3).alias("quote_currency"),
            F.col("ts").alias("timestamp"),
            (F.col("value") / 1000 + 1).alias("rate"),
            F.col("ts").alias("ingestion_timestamp"),
        ),
        EXCHANGE_RATES,
    )


def sector_dimension(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, name, i + 1) for i, name in enumerate(SECTORS)]
    df = spark.createDataFrame(rows, "id int, name string, display_order int")
    return df.withColumn("code", sector_code(F.col("name")))


def market_dimension(spark: SparkSession) -> DataFrame:
    rows = [
        (i + 1, code, MARKET_NAMES[code][0], country, MARKET_NAMES[code][1], currency, suffix)
        for i, (suffix, (code, country, currency)) in enumerate(MARKETS.items())
    ]
    return spark.createDataFrame(
        rows,
        "id int, code string, name string, country_code string, exchange_mic string, quote_currency string, "
        "suffix string",
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operational stock rows: ids in place of sector and market codes, the raw sector text beside."""
    n = F.col("n")
    market = (n % 4).cast("int")
    markets = list(MARKETS.values())
    return _brands(spark, sf_dir).select(
        F.concat(F.lit("stk-"), n.cast("string")).alias("id"),
        F.col("stock_symbol").alias("symbol"),
        F.concat(F.lit("Company "), n.cast("string")).alias("name"),
        _pick([m[0] for m in markets], market).alias("exchange"),
        F.concat(F.lit("raw "), n.cast("string")).alias("sector"),
        _pick([m[1] for m in markets], market).alias("country_code"),
        F.when(n % 9 != 0, _pick([m[2] for m in markets], market)).alias("quote_currency"),
        F.when(n % 5 != 0, (n % 11).cast("int") + 1).alias("gics_sector_id"),
        F.when(n % 6 != 0, market + 1).alias("market_id"),
        F.when(n % 7 == 0, F.lit("Special Situations")).alias("gics_sector_override"),
        F.lit(FIXED_TIME).cast("timestamp").alias("updated_at"),
    )


def operational(spark: SparkSession, sf_dir: str) -> Operational:
    stock_id = F.concat(F.lit("stk-"), F.substring_index("stock_symbol", "#", -1)).alias("stock_id")
    prices, trades = stock_prices(spark, sf_dir), transactions(spark, sf_dir)
    return Operational(
        stocks=stocks(spark, sf_dir),
        stock_prices=prices.select(
            stock_id,
            "timestamp",
            "open",
            "high",
            "low",
            "close",
            "volume",
            "adjusted_close",
            F.col("ingestion_timestamp").alias("created_at"),
        ),
        transactions=trades.select(
            F.col("transaction_id").alias("id"),
            "portfolio_id",
            stock_id,
            "transaction_type",
            "quantity",
            "price",
            "commission",
            "transaction_date",
            F.col("ingestion_timestamp").alias("created_at"),
        ),
        gics_sectors=sector_dimension(spark),
        markets=market_dimension(spark),
        exchange_rates=exchange_rates(spark, sf_dir).withColumnRenamed("ingestion_timestamp", "created_at"),
    )
