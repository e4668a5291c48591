import random
import statistics
from datetime import datetime, timedelta

import pytest
from helpers import day, plan, prices

from pyspark.sql import functions as F

from ledgerlark.operators import indicators, latest, risk
from ledgerlark.operators.series import DAILY_BARS, Series


@pytest.fixture(scope="module")
def walk():
    """Uneven series: one symbol has most rows, with bursts and gaps of weeks."""
    rng = random.Random(3)
    rows = []
    for symbol, n in (("HOT", 900), ("A", 60), ("B", 1), ("C", 15)):
        at, close = datetime(2024, 1, 1), 100.0
        for _ in range(n):
            at += timedelta(seconds=rng.choice([1, 60, 3600, 86400, 86400 * 20]))
            close = round(max(1.0, close + rng.uniform(-3, 3)), 2)
            rows.append((symbol, at, close))
    return rows


def mean(xs):
    return sum(xs) / len(xs)


def expected(closes, i):
    """Indicator values of row i by their definitions."""

    def last(p, end=i):
        return closes[max(0, end - p + 1) : end + 1]

    changes = [0.0] + [b - a for a, b in zip(closes, closes[1:])]
    window = changes[max(0, i - 13) : i + 1]
    gain, loss = sum(c for c in window if c > 0), sum(-c for c in window if c < 0)
    macd = [mean(last(12, j)) - mean(last(26, j)) for j in range(max(0, i - 8), i + 1)]
    spread = statistics.stdev(last(20)) if i else None
    return {
        "sma_20": mean(last(20)),
        "sma_50": mean(last(50)),
        "sma_200": mean(last(200)),
        "ema_12": mean(last(12)),
        "ema_26": mean(last(26)),
        "rsi_14": 100 - 100 / (1 + gain / loss) if loss > 1e-9 else None,
        "macd": macd[-1],
        "macd_signal": mean(macd),
        "bollinger_upper": mean(last(20)) + 2 * spread if i else None,
        "bollinger_lower": mean(last(20)) - 2 * spread if i else None,
    }


@pytest.mark.parametrize(
    "series",
    [
        DAILY_BARS,
        Series(),
        Series(bucket="day", block_rows=1),
        Series(bucket="hour", block_rows=10),
        Series(bucket="month", block_rows=40),
        Series(bucket="year", block_rows=300),
    ],
)
def test_indicators_of_cut_series_follow_definitions(spark, walk, series):
    got = {(r.stock_symbol, r.timestamp): r for r in indicators.all_indicators(prices(spark, walk), series=series).collect()}
    assert len(got) == len(walk)
    for symbol in ("HOT", "A", "B", "C"):
        rows = [r for r in walk if r[0] == symbol]
        closes = [r[2] for r in rows]
        for i, (_, at, _) in enumerate(rows):
            row = got[(symbol, at)]
            for name, value in expected(closes, i).items():
                assert row[name] == (None if value is None else pytest.approx(value, rel=1e-6, abs=1e-6)), (symbol, i, name)


@pytest.mark.parametrize("series", [DAILY_BARS, Series(bucket="day", block_rows=5)])
def test_single_indicators_agree_with_all(spark, walk, series):
    df = prices(spark, walk).select("stock_symbol", "timestamp", "close")
    whole = {(r.stock_symbol, r.timestamp): r for r in indicators.all_indicators(df, series=series).collect()}
    parts = [
        (indicators.sma(df, series=series), ["sma_20", "sma_50", "sma_200"]),
        (indicators.ema(df, series=series), ["ema_12", "ema_26"]),
        (indicators.rsi(df, series=series), ["rsi_14"]),
        (indicators.macd(df, series=series), ["macd", "macd_signal"]),
        (indicators.bollinger_bands(df, series=series), ["bollinger_upper", "bollinger_lower"]),
    ]
    for part, names in parts:
        rows = part.collect()
        assert len(rows) == len(whole)
        for r in rows:
            for name in names:
                want = whole[(r.stock_symbol, r.timestamp)][name]
                assert r[name] == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9))


def test_rsi_without_losses(spark):
    rising = prices(spark, [("X", day(i), 10.0 + i) for i in range(1, 10)])
    assert all(r.rsi_14 is None for r in indicators.rsi(rising).collect())
    last = indicators.rsi(rising, zero_loss="hundred").orderBy("timestamp").collect()
    assert all(r.rsi_14 == 100.0 for r in last)
    with pytest.raises(ValueError):
        indicators.rsi(rising, zero_loss="zero")


def test_double_columns_average_too(spark):
    df = prices(spark, [("X", day(i), float(i)) for i in range(1, 7)])
    df = df.withColumn("close", df.close.cast("double"))
    got = [r.sma_3 for r in indicators.sma(df, periods=[3], series=Series(block_rows=2)).orderBy("timestamp").collect()]
    assert got == [1.0, 1.5, 2.0, 3.0, 4.0, 5.0]


def test_snapshot_needs_fourteen_closes(spark):
    rows = [("SHORT", day(i), 10.0) for i in range(1, 14)]
    rows += [("FLAT", day(i), 10.0) for i in range(1, 15)]
    rows += [("UP", day(i), 10.0 + i) for i in range(1, 31)]
    for bucket in (None, "day"):
        got = {r.stock_symbol: r for r in indicators.indicator_snapshot(prices(spark, rows), bucket=bucket).collect()}
        assert set(got) == {"FLAT", "UP"}
        assert got["FLAT"].rsi == 50.0 and got["FLAT"].bb_width_pct == 0.0
        assert got["UP"].rsi == 100.0 and got["UP"].sma == mean([10.0 + i for i in range(17, 31)])
        assert got["UP"].bb_upper == pytest.approx(got["UP"].sma + 2 * statistics.pstdev(range(14)))
        labels = {r.stock_symbol: r for r in indicators.signals(indicators.indicator_snapshot(prices(spark, rows))).collect()}
        assert (labels["UP"].rsi_signal, labels["UP"].band_signal, labels["UP"].trend_signal) == ("overbought", "within", "bullish")
        assert (labels["FLAT"].rsi_signal, labels["FLAT"].trend_signal) == ("neutral", "bearish")


@pytest.mark.parametrize("series", [DAILY_BARS, Series(block_rows=3), Series(bucket="month", block_rows=100), Series(bucket="quantiles", block_rows=80)])
def test_returns(spark, walk, series):
    got = {(r.stock_symbol, r.timestamp): r.daily_return for r in risk.daily_returns(prices(spark, walk), series).collect()}
    want = {}
    for symbol in ("HOT", "A", "B", "C"):
        rows = [r for r in walk if r[0] == symbol]
        for before, now in zip(rows, rows[1:]):
            want[(symbol, now[1])] = (now[2] - before[2]) / before[2]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("block_rows", [1_000_000, 300, 10])
def test_asof_join_by_brute_force(spark, walk, block_rows):
    rng = random.Random(5)
    asks = [(i, rng.choice(["HOT", "A", "B", "Z"]), datetime(2023, 12, 25) + timedelta(hours=rng.randint(0, 40000))) for i in range(300)]
    asks += [(1000 + i, s, at) for i, (s, at, _) in enumerate(walk[::50])]
    left = spark.createDataFrame(asks, "id int, stock_symbol string, at timestamp")
    got = {
        r.id: (r.close, r.seen)
        for r in latest.asof_join(
            left, prices(spark, walk), ["stock_symbol"], "at", "timestamp", {"close": "close", "seen": "timestamp"}, block_rows
        ).collect()
    }
    assert len(got) == len(asks)
    for i, symbol, at in asks:
        known = [(t, c) for s, t, c in walk if s == symbol and t <= at]
        want = max(known) if known else None
        found, seen = got[i]
        assert (seen is None) if want is None else (seen == want[0] and float(found) == want[1])


def test_asof_join_computes_its_sides_once(spark, walk):
    """However many blocks there are, each input row is computed once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(symbol):
        seen.add(1)
        return symbol

    left = spark.createDataFrame([(s, at) for s, at, _ in walk], "stock_symbol string, at timestamp")
    left = left.withColumn("stock_symbol", F.udf(counted)("stock_symbol"))
    found = latest.asof_join(left, prices(spark, walk), ["stock_symbol"], "at", "timestamp", {"seen": "timestamp"}, 50)
    assert all(r["at"] == r["seen"] for r in found.collect())
    assert seen.value == len(walk)


@pytest.mark.parametrize("bucket", [None, "day", "month"])
def test_latest_n(spark, walk, bucket):
    rows = latest.latest_n(prices(spark, walk), 7, bucket=bucket).collect()
    for symbol, n in (("HOT", 7), ("A", 7), ("B", 1), ("C", 7)):
        times = sorted((r[1] for r in walk if r[0] == symbol), reverse=True)[:7]
        got = sorted((r.rn, r.timestamp) for r in rows if r.stock_symbol == symbol)
        assert [t for _, t in got] == times and len(got) == n


def test_latest_tie_break(spark):
    df = prices(spark, [("X", day(1), 5.0), ("X", day(1), 9.0), ("X", day(1), 7.0)])
    assert float(latest.latest_prices(df, tie="close").first().current_price) == 9.0


def test_all_indicators_shuffle_the_rows_once(spark, walk):
    text = plan(indicators.all_indicators(prices(spark, walk), series=DAILY_BARS))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Python" not in text
