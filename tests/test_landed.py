"""Landed files: the data source, broken records, repeats in a stream."""

import os
from datetime import datetime

from helpers import day, plan, prices
from pyspark.sql import functions as F

from ledgerlark.schemas import STOCK_PRICES
from ledgerlark.sources import feeds, landed
from ledgerlark.sources.tables import Lake
from ledgerlark.streaming import sinks


def land(spark, folder, name, rows):
    df = spark.createDataFrame([(s, t, c, c, c, c, v) for s, t, c, v in rows], feeds.FEED)
    df.coalesce(1).write.parquet(f"{folder}/{name}")


def test_batch_source_pushes_comparisons(spark, tmp_path):
    landed.register(spark)
    rows = [("A", day(d), float(d), 1.0) for d in range(1, 20)] + [("B", day(3), None, 2.0), (None, day(4), 4.0, None), ("A", None, 5.0, 1.0)]
    land(spark, tmp_path, "1", rows[:10])
    land(spark, tmp_path, "2", rows[10:])
    df = spark.read.format("landed_prices").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 2
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.stock_symbol, r.timestamp, r.close, r.volume) for r in df.collect()), key=key) == sorted(rows, key=key)
    some = df.where((F.col("stock_symbol") == "A") & (F.col("timestamp") >= F.lit(datetime(2024, 1, 15))) & (F.col("close") < 18) & F.col("volume").isNotNull())
    assert sorted(r.close for r in some.collect()) == [15.0, 16.0, 17.0]
    # What the source has taken over isn't filtered again.
    text = plan(some)
    filters = [line for line in text.splitlines() if "Filter" in line]
    assert not any("stock_symbol#" in line and "= A" in line for line in filters), text
    assert df.where("upper(stock_symbol) = 'B'").count() == 1
    assert spark.read.format("landed_prices").load(str(tmp_path / "none")).count() == 0


def test_stream_source_goes_on_from_its_offset(spark, tmp_path):
    landed.register(spark)
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    os.makedirs(source)

    def run():
        stream = spark.readStream.format("landed_prices").load(str(source))
        query = stream.writeStream.format("parquet").option("checkpointLocation", marks).option("path", out)
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(r.close for r in spark.read.schema(feeds.FEED).parquet(out).collect())

    land(spark, source, "1", [("A", day(1), 1.0, 1.0)])
    assert run() == [1.0]
    assert run() == [1.0]
    land(spark, source, "2", [("A", day(2), 2.0, 1.0), ("B", day(2), 3.0, 1.0)])
    assert run() == [1.0, 2.0, 3.0]


def test_broken_records_cost_themselves_only(spark, tmp_path):
    good = "A,2024-01-01T00:00:00,1,1,1,1,5"
    lines = {
        "one.csv": [good, "a,2024-01-02T00:00:00,1,1,1,oops,5", "B,2024-01-01T00:00:00", "", "C,not a time,1,1,1,1,1"],
        "two.csv": [",2024-01-01T00:00:00,1,1,1,1,1", "D,,1,1,1,1,1", "E,2024-01-01T00:00:00,1,1,1,,1", "F,2024-01-01T00:00:00,1,1,1,NaN,1", good + ",9", "  ,2024-01-01T00:00:00,1,1,1,2,"],
        "empty.csv": [],
    }
    for name, text in lines.items():
        (tmp_path / name).write_text("".join(line + "\n" for line in text))
    rows, broken = feeds.read_landed(spark, str(tmp_path))
    assert [(r.stock_symbol, r.close, r.volume) for r in rows.collect()] == [("A", 1.0, 5.0)]
    got = sorted((r.file, r.stock_symbol or "", r.reason) for r in broken.collect())
    assert got == [
        ("one.csv", "A", "malformed"), ("one.csv", "B", "malformed"), ("one.csv", "C", "malformed"), ("two.csv", "", "no symbol"),
        ("two.csv", "", "no symbol"), ("two.csv", "A", "malformed"), ("two.csv", "D", "no time"), ("two.csv", "E", "no close"), ("two.csv", "F", "no close"),
    ]
    # Counting alone reads no field; it must see the same records.
    assert rows.count() == 1 and broken.count() == 9
    assert {r.record for r in broken.where("stock_symbol = 'B'").collect()} == {"B,2024-01-01T00:00:00"}


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_repeats_write_no_day(spark, tmp_path):
    source, marks = str(tmp_path / "in"), str(tmp_path / "marks")
    table = Lake(str(tmp_path / "lake"))["stock_prices"]

    def run():
        stream = spark.readStream.schema(STOCK_PRICES).option("recursiveFileLookup", True).parquet(source)
        query = sinks.stream_upsert(sinks.without_repeats(stream, "timestamp", "5 days"), table, marks, "ingestion_timestamp")
        query.awaitTermination()
        return query

    def arrive(name, rows, hour):
        df = prices(spark, rows).withColumn("ingestion_timestamp", F.lit(day(20, hour)))
        df.coalesce(1).write.parquet(f"{source}/{name}")

    first = [("A", day(10), 1.0), ("A", day(11), 2.0), ("A", day(12), 3.0)]
    arrive("1", first + first[:1], 1)
    run()
    before = files_of(table.path)
    arrive("2", first, 2)
    run()
    assert files_of(table.path) == before
    arrive("3", [("A", day(11), 2.5), ("B", day(12), 1.0)], 3)
    run()
    want = {("A", day(10)): 1.0, ("A", day(11)): 2.5, ("A", day(12)): 3.0, ("B", day(12)): 1.0}
    assert {(r.stock_symbol, r.timestamp): float(r.close) for r in table.read(spark).collect()} == want
    # Older than the watermark: dropped and counted.
    arrive("4", [("A", day(1), 9.0)], 4)
    assert sinks.rows_too_late(run()) == 1
    assert table.read(spark).count() == 4
