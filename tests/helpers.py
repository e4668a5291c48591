from datetime import datetime

from pyspark.sql import functions as F


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def prices(spark, rows):
    """(symbol, time, close) rows as a price table with equal OHLC."""
    df = spark.createDataFrame(rows, "stock_symbol string, timestamp timestamp, close double")
    close = F.col("close").cast("decimal(20,6)")
    return df.withColumns(
        {
            "close": close,
            "open": close,
            "high": close,
            "low": close,
            "volume": F.lit(1).cast("bigint"),
            "adjusted_close": close,
            "ingestion_timestamp": F.col("timestamp"),
        }
    )


def trades(spark, rows):
    """(id, portfolio, symbol, type, quantity, price, time) rows as transactions."""
    df = spark.createDataFrame(
        rows,
        "transaction_id string, portfolio_id string, stock_symbol string, transaction_type string, quantity double, "
        "price double, transaction_date timestamp",
    )
    return df.withColumns(
        {
            "quantity": F.col("quantity").cast("decimal(20,6)"),
            "price": F.col("price").cast("decimal(20,6)"),
            "commission": F.lit(0).cast("decimal(20,6)"),
            "ingestion_timestamp": F.col("transaction_date"),
        }
    )


def sample_trades(spark):
    bought = [("AAPL", 100, 170.5), ("MSFT", 50, 365.0), ("GOOGL", 75, 138.0), ("AMZN", 60, 148.0), ("TSLA", 40, 235.0)]
    sold = [("AAPL", 20, 173.0), ("TSLA", 10, 238.0)]
    rows = [(f"b{i}", "p", s, "BUY", float(q), p, day(1)) for i, (s, q, p) in enumerate(bought)]
    rows += [(f"s{i}", "p", s, "SELL", float(q), p, day(5)) for i, (s, q, p) in enumerate(sold)]
    return trades(spark, rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
