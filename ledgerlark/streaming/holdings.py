"""Weighted-average positions kept up to date from a stream of trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.operators.holdings import UNITS, weighted_holdings
from ledgerlark.sources.tables import drop_folder, folder_exists

POSITIONS = T.StructType(
    [
        T.StructField("portfolio_id", T.StringType()),
        T.StructField("stock_symbol", T.StringType()),
        T.StructField("quantity", UNITS),
        T.StructField("average_cost", T.DoubleType()),
        T.StructField("realized_gain", T.DoubleType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)


class PositionState:
    """Positions after each micro-batch, one folder per batch id."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _at(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def after(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], POSITIONS)
        return spark.read.schema(POSITIONS).parquet(self._at(batch_id))

    def apply(self, trades: DataFrame, batch_id: int, bucket: str) -> None:
        """Fold the batch onto the state before it. A replayed batch starts from the same state, so its
        trades count once. Closed positions stay while they carry a realised gain."""
        spark = trades.sparkSession
        opening = self.after(spark, batch_id - 1)
        state = weighted_holdings(trades, opening, bucket, keep_closed=True)
        state.write.mode("overwrite").parquet(self._at(batch_id))
        if folder_exists(spark, self._at(batch_id - 2)):
            drop_folder(spark, self._at(batch_id - 2))

    def latest(self, spark: SparkSession, query: StreamingQuery) -> DataFrame:
        """Open positions after the last batch the query finished."""
        done = query.lastProgress["batchId"] if query.lastProgress else -1
        while done >= 0 and not folder_exists(spark, self._at(done)):
            done -= 1
        return self.after(spark, done).where("quantity > 0")


def maintain_holdings(
    trades: DataFrame, state: PositionState, checkpoint: str, bucket: str = "month", once: bool = True
) -> StreamingQuery:
    """Apply trades as they arrive: in (date, id) order inside a micro-batch, in arrival order across.

    The fold is the batch operator's, so a position that receives most of a batch is still spread over
    its time buckets instead of being walked by one task.
    """
    writer = trades.writeStream.foreachBatch(lambda batch, batch_id: state.apply(batch, batch_id, bucket))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
