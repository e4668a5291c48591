"""Streaming merges into lake tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.sources.tables import LakeTable


def stream_upsert(
    stream: DataFrame, table: LakeTable, checkpoint: str, order: str | None = None, once: bool = True
) -> StreamingQuery:
    """Merge every micro-batch into ``table`` by its key, so replayed batches and rows change nothing.

    With ``once`` all waiting input is taken and the query ends; the checkpoint is the high-water mark
    from which the next run goes on.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        # A batch of nothing but repeats leaves every day as it is.
        if not batch.isEmpty():
            table.upsert(batch.sparkSession, batch, order)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).outputMode("update")
    return (writer.trigger(availableNow=True) if once else writer).start()


def without_repeats(stream: DataFrame, time: str, lateness: str, ignored: Sequence[str] = ("ingestion_timestamp",)) -> DataFrame:
    """``stream`` without rows that repeat an earlier one in all columns but ``ignored``, while that one is within ``lateness``.

    State holds a digest per distinct row of the watermark's reach and no older ones. A correction, which differs in a value, passes.
    Rows older than the watermark are dropped and counted by ``rows_too_late``; rows without a time are never held back.
    """
    columns = [c for c in stream.columns if c not in ignored]
    marked = stream.withColumn("_row", F.sha2(F.to_json(F.struct(*columns)), 256))
    return marked.withWatermark(time, lateness).dropDuplicatesWithinWatermark(["_row"]).drop("_row")


def rows_too_late(query: StreamingQuery) -> int:
    """Rows that the run's watermarks have dropped, over the progress reports that the query still has."""
    return sum(int(state["numRowsDroppedByWatermark"]) for report in query.recentProgress for state in report["stateOperators"])
