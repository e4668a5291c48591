"""Price and currency feeds landed as files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.symbols import fx_pair
from ledgerlark.schemas import MONEY

# The fields a feed gives per ticker.
FEED_FIELDS = ("Open", "High", "Low", "Close", "Volume")

FEED = T.StructType(
    [T.StructField("stock_symbol", T.StringType()), T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(f.lower(), T.DoubleType()) for f in FEED_FIELDS]
)


def read_feed(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Long feed files of declared schema, as a batch."""
    reader = spark.read.schema(FEED)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def stream_feed(spark: SparkSession, path: str, fmt: str = "csv", files_per_batch: int = 1000) -> DataFrame:
    """The same files as a stream of arrivals."""
    reader = spark.readStream.schema(FEED).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def read_landed(spark: SparkSession, path: str, fmt: str = "csv", header: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of landed feed files, in which a broken record costs itself only.

    Rows have the columns of FEED. The quarantine has file, stock_symbol (as far as it can be read, in upper case), reason
    and record: ``malformed`` for a record that isn't of the declared form, which is too short or long, or holds
    what isn't a number or time; ``no symbol``, ``no time`` and ``no close`` for well-formed ones that can't be used. Every
    record is in one of the two. Empty lines are none; files without records give nothing.
    """
    corrupt = "_record"
    schema = T.StructType([*FEED.fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    reader = reader.option("header", header) if fmt == "csv" else reader
    landed = reader.format(fmt).load(path).withColumn("file", F.col("_metadata.file_name"))
    # A record is malformed by any of its fields, so all are read, whichever are asked for: no field holds a NUL.
    whole = F.concat(*[F.col(c).cast("string") for c in FEED.fieldNames()])
    reason = (
        F.when(F.col(corrupt).isNotNull() | (whole == "\0"), "malformed")
        .when(F.trim("stock_symbol").isNull() | (F.trim("stock_symbol") == ""), "no symbol")
        .when(F.col("timestamp").isNull(), "no time")
        .when(F.col("close").isNull() | F.isnan("close"), "no close")
    )
    judged = landed.withColumn("reason", reason)
    record = F.coalesce(corrupt, F.to_json(F.struct(*FEED.fieldNames())))
    broken = judged.where("reason is not null").select("file", F.when(F.trim("stock_symbol") != "", F.upper("stock_symbol")).alias("stock_symbol"), "reason", record.alias("record"))
    return judged.where("reason is null").select(*FEED.fieldNames()), broken


def wide_to_long(wide: DataFrame, symbols: Sequence[str], separator: str = "_") -> DataFrame:
    """One row per time and ticker from columns named ``<ticker><separator><field>``.

    Tickers without columns give no rows, nor do times at which all of a ticker's fields are NULL.
    """
    present = [s for s in symbols if f"{s}{separator}Close" in wide.columns]
    if not present:
        return wide.sparkSession.createDataFrame([], FEED)
    records = F.array(
        *[
            F.struct(
                F.lit(s).alias("stock_symbol"),
                *[F.col(f"`{s}{separator}{f}`").cast("double").alias(f.lower()) for f in FEED_FIELDS],
            )
            for s in present
        ]
    )
    fields = [f.lower() for f in FEED_FIELDS]
    return wide.select("timestamp", F.inline(records)).dropna(how="all", subset=fields)


def _priced(feed: DataFrame) -> DataFrame:
    money = {c: F.col(c).try_cast(MONEY) for c in ("open", "high", "low", "close")}
    return feed.withColumns(
        {
            "stock_symbol": F.upper("stock_symbol"),
            **money,
            "volume": F.coalesce(F.col("volume").try_cast("bigint"), F.lit(0).cast("bigint")),
        }
    )


def normalize_ohlcv(feed: DataFrame) -> DataFrame:
    """Canonical price columns: upper-case symbol, decimals, missing volume 0, adjusted close = close.

    Rows without a close are skipped; rows with a close but another price missing or unreadable are
    left to ``rejected_rows``.
    """
    return (
        _priced(feed)
        .dropna(subset=["stock_symbol", "timestamp", "open", "high", "low", "close"])
        .select(
            "stock_symbol",
            "timestamp",
            "open",
            "high",
            "low",
            "close",
            "volume",
            F.col("close").alias("adjusted_close"),
        )
    )


def rejected_rows(feed: DataFrame) -> DataFrame:
    """Feed rows with a close that cannot be loaded, for quarantine instead of a failed run."""
    gaps = F.greatest(*[F.col(c).isNull() for c in ("stock_symbol", "timestamp", "open", "high", "low")])
    return _priced(feed).where(F.col("close").isNotNull() & gaps)


def normalize_fx(feed: DataFrame) -> DataFrame:
    """Currency, time and rate of a feed of pair tickers; unreadable pairs and missing closes drop out."""
    return (
        feed.withColumn("_pair", fx_pair(F.col("stock_symbol")))
        .where(F.col("_pair").isNotNull() & F.col("close").isNotNull())
        .select(
            "_pair.base_currency", "_pair.quote_currency", "timestamp", F.col("close").cast("double").alias("rate")
        )
    )
