import random
from datetime import datetime, timedelta

import pytest
from helpers import day, prices, trades

from ledgerlark.operators import bars, holdings
from ledgerlark.schemas import STOCK_PRICES, TRANSACTIONS
from ledgerlark.sources.tables import Lake
from ledgerlark.streaming import bars as stream_bars
from ledgerlark.streaming import holdings as stream_holdings
from ledgerlark.streaming import sinks


def land(df, folder, name):
    df.coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, schema, folder, files=1):
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files)
    return reader.option("latestFirst", False).parquet(str(folder))


def bar_set(df):
    return {(r.stock_symbol, r.bucket, float(r.open), float(r.high), float(r.low), float(r.close), r.volume) for r in df.collect()}


def test_bars_follow_late_ticks_and_drop_too_late_ones(spark, tmp_path):
    source, table, marks = tmp_path / "ticks", str(tmp_path / "bars"), str(tmp_path / "marks")
    first = [("A", day(10, 9), 5.0), ("A", day(10, 15), 7.0), ("B", day(10, 10), 1.0)]
    land(prices(spark, first), source, "1")

    def refresh():
        stream_bars.maintain_bars(stream(spark, STOCK_PRICES, source), table, marks).awaitTermination()
        return stream_bars.bars_table(table).read(spark).drop("day")

    assert bar_set(refresh()) == bar_set(bars.rollup_bars(prices(spark, first)))
    second = [("A", day(12, 9), 8.0)]
    land(prices(spark, second), source, "2")
    assert bar_set(refresh()) == bar_set(bars.rollup_bars(prices(spark, first + second)))
    # Two days late changes its bar; four days late and past the watermark does not.
    late, too_late = [("A", day(10, 20), 9.0)], [("A", day(5, 9), 99.0)]
    land(prices(spark, late), source, "3")
    land(prices(spark, too_late), source, "4")
    assert bar_set(refresh()) == bar_set(bars.rollup_bars(prices(spark, first + second + late)))


def test_refresh_window(spark):
    rows = [("A", day(n, h), float(n + h)) for n in range(1, 12) for h in (1, 13)]
    got = bars.refresh_bars(prices(spark, rows), "2024-01-10 00:30:00").collect()
    # [Jan 7 00:30, Jan 9 23:30] holds the whole of Jan 8 only.
    assert [(r.bucket, float(r.open), float(r.close)) for r in got] == [(day(8), 9.0, 21.0)]
    weekly = bars.rollup_bars(prices(spark, rows), "12 hours")
    assert weekly.count() == 22


def test_holdings_in_many_batches_equal_one(spark, tmp_path):
    rng, at, rows = random.Random(1), datetime(2024, 1, 1), []
    for i in range(400):
        at += timedelta(hours=rng.choice([0, 5, 40]))
        rows.append((f"{i:04d}", "p", rng.choice(["HOT", "HOT", "HOT", "B"]), rng.choice(["BUY", "SELL"]),
                     float(rng.randint(1, 30)), round(rng.uniform(1, 9), 2), at))
    source = tmp_path / "trades"
    state = stream_holdings.PositionState(str(tmp_path / "state"))

    def run():
        query = stream_holdings.maintain_holdings(
            stream(spark, TRANSACTIONS, source), state, str(tmp_path / "marks"), bucket="day"
        )
        query.awaitTermination()
        return state.latest(spark, query)

    land(trades(spark, rows[:150]), source, "1")
    land(trades(spark, rows[150:170]), source, "2")
    run()
    land(trades(spark, rows[170:]), source, "3")
    got = {r.stock_symbol: r for r in run().collect()}
    want = {r.stock_symbol: r for r in holdings.weighted_holdings(trades(spark, rows)).collect()}
    assert set(got) == set(want)
    for symbol, row in want.items():
        assert got[symbol].quantity == row.quantity
        assert got[symbol].average_cost == pytest.approx(row.average_cost, rel=1e-9)
        assert got[symbol].realized_gain == pytest.approx(row.realized_gain, rel=1e-9)


def test_replayed_batch_counts_once(spark, tmp_path):
    state = stream_holdings.PositionState(str(tmp_path / "state"))
    batch = trades(spark, [("a", "p", "X", "BUY", 10.0, 5.0, day(1))])
    state.apply(batch, 0, "day")
    state.apply(batch, 0, "day")
    state.apply(trades(spark, [("b", "p", "X", "SELL", 4.0, 6.0, day(2))]), 1, "day")
    row = state.after(spark, 1).first()
    assert (float(row.quantity), row.average_cost, row.realized_gain) == (6.0, 5.0, 4.0)


def test_price_stream_merges_replays(spark, tmp_path):
    source = tmp_path / "prices"
    table = Lake(str(tmp_path / "lake"))["stock_prices"]

    def run():
        ticks = stream(spark, STOCK_PRICES, source, files=10)
        sinks.stream_upsert(ticks, table, str(tmp_path / "marks"), "ingestion_timestamp").awaitTermination()
        return {(r.stock_symbol, r.timestamp): float(r.close) for r in table.read(spark).collect()}

    land(prices(spark, [("A", day(1), 1.0), ("A", day(2), 2.0)]), source, "1")
    land(prices(spark, [("A", day(1), 1.0)]), source, "2")
    assert run() == {("A", day(1)): 1.0, ("A", day(2)): 2.0}
    land(prices(spark, [("A", day(2), 5.0), ("B", day(3), 3.0)]), source, "3")
    assert run() == {("A", day(1)): 1.0, ("A", day(2)): 5.0, ("B", day(3)): 3.0}
    assert table.read(spark).count() == 3


def test_bars_are_the_same_for_any_number_of_files_per_batch(spark, tmp_path):
    source, times = str(tmp_path / "in"), [20, 1, 9]
    for n, d in enumerate(times):
        prices(spark, [("A", day(d, 3), 10.0 + d), ("A", day(9, 4 + n), 5.0 + n)]).write.mode("append").parquet(source)
    got = {}
    for files in (1, 3, 1000):
        reader = spark.readStream.schema(STOCK_PRICES).option("maxFilesPerTrigger", files)
        table, marks = str(tmp_path / f"bars{files}"), str(tmp_path / f"marks{files}")
        stream_bars.maintain_bars(reader.parquet(source), table, marks).awaitTermination()
        bars = stream_bars.bars_table(table).read(spark).drop("day").select("bucket", "open", "close", "volume")
        got[files] = sorted(map(tuple, bars.collect()))
    assert len(got[1]) == 3 and got[1] == got[3] == got[1000]


def test_upsert_from_another_time_zone_meets_its_row(spark, tmp_path):
    table = stream_bars.bars_table(str(tmp_path / "bars"))
    table.upsert(spark, spark.sql("SELECT timestamp_seconds(1704164400) bucket, 'A' stock_symbol, 1D open, 1D high, 1D low, 1D close, 1L volume"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        table.upsert(spark, spark.sql("SELECT timestamp_seconds(1704164400) bucket, 'A' stock_symbol, 1D open, 1D high, 1D low, 2D close, 1L volume"))
        assert [float(r.close) for r in table.read(spark).collect()] == [2.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("fail_at", [1, 2, 3])
def test_backfill_goes_on_after_a_crash(spark, tmp_path, monkeypatch, fail_at):
    """Days 20, 1 and 9 in a batch each; whichever batch fails, the run that follows has all three bars."""
    source, table, marks = str(tmp_path / "in"), str(tmp_path / "bars"), str(tmp_path / "marks")
    for n, d in enumerate((20, 1, 9)):
        land(prices(spark, [("A", day(d, 3), 10.0 + n)]), source, str(n))
    merges, upsert = [], stream_bars.LakeTable.upsert

    def failing(self, *given, **named):
        merges.append(1)
        if len(merges) == fail_at:
            raise RuntimeError("lost")
        return upsert(self, *given, **named)

    monkeypatch.setattr(stream_bars.LakeTable, "upsert", failing)
    with pytest.raises(Exception):
        stream_bars.maintain_bars(stream(spark, STOCK_PRICES, source), table, marks)
    stream_bars.maintain_bars(stream(spark, STOCK_PRICES, source), table, marks)
    got = {r.bucket for r in stream_bars.bars_table(table).read(spark).collect()}
    assert got == {day(1), day(9), day(20)}
    # The backfill has ended: what is later than the bound is left aside and can be counted.
    land(prices(spark, [("A", day(2, 3), 7.0), ("A", day(19, 3), 7.0)]), source, "late")
    stream_bars.maintain_bars(stream(spark, STOCK_PRICES, source), table, marks)
    got = {r.bucket for r in stream_bars.bars_table(table).read(spark).collect()}
    assert got == {day(1), day(9), day(19), day(20)}
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{table}-late").count() == 1
