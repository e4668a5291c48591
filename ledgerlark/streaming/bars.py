"""Daily bars kept up to date from a stream of prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.functions.predicates import utc_day
from ledgerlark.operators.bars import rollup_bars
from ledgerlark.schemas import MONEY, TableSpec
from ledgerlark.sources.tables import LakeTable, folder_exists

LATENESS = "3 days"

BARS = TableSpec(
    T.StructType(
        [
            T.StructField("bucket", T.TimestampType(), False),
            T.StructField("stock_symbol", T.StringType(), False),
            *[T.StructField(c, MONEY, True) for c in ("open", "high", "low", "close")],
            T.StructField("volume", T.LongType(), True),
        ]
    ),
    ("stock_symbol", "bucket"),
    "bucket",
)


def bars_table(path: str) -> LakeTable:
    return LakeTable(BARS, path)


def _newest(spark: SparkSession, folder: str):
    """The newest time noted in ``folder``; None without any."""
    return spark.read.parquet(folder).agg(F.max("newest")).first()[0] if folder_exists(spark, folder) else None


def maintain_bars(
    prices: DataFrame, path: str, checkpoint: str, interval: str = "1 day", lateness: str = LATENESS, once: bool = True
) -> StreamingQuery:
    """Materialise the bars at ``path`` from all rows that have arrived, in any order and any micro-batches.

    The first run takes the whole history. Runs after it leave aside rows more than ``lateness`` older than the
    newest row of the runs that have ended before; these go to the folder ``path`` + "-late", where they can be
    counted. A run that fails leaves no such mark, so it is gone on with as it began: the result is the same
    for any point of failure and any number of files a batch. With ``once`` the call returns when the run has ended; a
    continuous query takes as mark what it has stored in earlier batches, once a first run has ended.

    A micro-batch stores its rows beside the table in a folder per day their bucket begins and, in it, per batch, and
    recomputes those days' bars from everything stored for them, reading no other day; a replayed batch
    replaces its own rows. The days of a batch, all that reaches the driver, are as few as the calendar has.
    """
    spark, arrivals, marks, seen = prices.sparkSession, f"{path}-arrivals", f"{path}-marks", f"{path}-seen"
    mark = _newest(spark, marks)

    def merge(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        spark, bound = batch.sparkSession, mark
        if not once and mark is not None:
            bound = max(filter(None, (mark, _newest(spark, f"{seen}/before={number}"))))
        begun = F.window("timestamp", interval)["start"]
        if bound is not None:
            late = F.col("timestamp") < F.lit(bound) - F.expr(f"INTERVAL {lateness}")
            batch.where(late).write.mode("overwrite").parquet(f"{path}-late/batch={number}")
            batch = batch.where(~late | F.col("timestamp").isNull())
        newest = batch.agg(F.max("timestamp").alias("newest"))
        kept = _newest(spark, f"{seen}/before={number}")
        newest.select(F.greatest("newest", F.lit(kept).cast("timestamp")).alias("newest")).write.mode("overwrite").parquet(f"{seen}/before={number + 1}")
        dated = batch.withColumn("begun", utc_day(begun)).withColumn("batch", F.lit(number)).where("begun is not null")
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("begun", "batch").parquet(arrivals)
        days = [row.begun.isoformat() for row in dated.select("begun").distinct().collect()]
        if days:
            near = spark.read.option("basePath", arrivals).parquet(*[f"{arrivals}/begun={day}" for day in days])
            bars_table(path).upsert(spark, rollup_bars(near.select(*prices.columns), interval))

    writer = prices.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if once else writer).start()
    if once:
        query.awaitTermination()
        if folder_exists(spark, seen):
            spark.read.parquet(seen).agg(F.max("newest").alias("newest")).write.mode("append").parquet(marks)
    return query


def bars_from_stream_files(stream: DataFrame) -> DataFrame:
    """A tick stream (symbol, time, price, volume) in bar-input columns."""
    return stream.select(
        "stock_symbol", "timestamp", *[F.col("price").alias(c) for c in ("open", "high", "low", "close")], "volume"
    )
