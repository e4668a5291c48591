"""Daily values, drawdowns, recursive means, cross rates and blocks against plain Python."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from helpers import day, plan, prices, trades

from pyspark.sql import functions as F

from ledgerlark.operators import blocks, currency, daily, drawdown, recursive, risk, valuation
from ledgerlark.plans import queries
from ledgerlark.sources import fixtures as data


@pytest.fixture(scope="module")
def walk():
    rng = random.Random(4)
    rows = []
    for symbol, n in (("HOT", 2_500), ("A", 40), ("ONE", 1)):
        close = 100.0
        for i in range(n):
            close = max(1.0, close + rng.gauss(0, 2))
            rows.append((symbol, datetime(2024, 1, 1) + timedelta(minutes=i), close if rng.random() > 0.02 or i == 0 else None))
    return rows + [(None, datetime(2024, 1, 1), 5.0), ("NONE", datetime(2024, 1, 1), None)]


def closes(spark, walk):
    return spark.createDataFrame(walk, "stock_symbol string, timestamp timestamp, close double")


def means(values, period):
    out, weight = [], 2 / (period + 1)
    for x in values:
        out.append(x if not out else weight * x + (1 - weight) * out[-1])
    return out


@pytest.mark.parametrize("block_rows", [250_000, 400, 50])
def test_recursive_means(spark, walk, block_rows):
    rows = recursive.macd_recursive(closes(spark, walk), block_rows=block_rows).orderBy("timestamp").collect()
    got = defaultdict(list)
    for r in rows:
        got[r.stock_symbol].append((r.ema_12, r.ema_26, r.macd, r.macd_signal))
    want = {}
    for symbol in ("HOT", "A", "ONE", None):
        x = [c for s, _, c in walk if s == symbol and c is not None]
        fast, slow = means(x, 12), means(x, 26)
        gap = [a - b for a, b in zip(fast, slow)]
        want[symbol] = list(zip(fast, slow, gap, means(gap, 9)))
    assert set(got) == set(want)
    for symbol, values in want.items():
        assert len(got[symbol]) == len(values)
        for g, w in zip(got[symbol], values):
            assert g == pytest.approx(w, abs=1e-9)


def test_slow_mean_and_no_rows(spark, walk):
    """A period whose weights outlive a run, one of 1, and an empty table."""
    df = closes(spark, walk).where("stock_symbol = 'HOT'")
    x = [c for s, _, c in walk if s == "HOT" and c is not None]
    got = [(r.ema_1, r.ema_2000) for r in recursive.ema_recursive(df, periods=(1, 2000), block_rows=600).orderBy("timestamp").collect()]
    assert [g[0] for g in got] == pytest.approx(x) and [g[1] for g in got] == pytest.approx(means(x, 2000))
    assert recursive.ema_recursive(df.where("false")).count() == 0


def test_uncut_series_are_shuffled_once(spark, walk):
    text = plan(recursive.ema_recursive(closes(spark, walk)))
    assert text.count("Exchange hashpartitioning") == 1 and "Python" not in text


@pytest.mark.parametrize("block_rows", [1_000_000, 100, 7])
def test_drawdown(spark, walk, block_rows):
    extra = walk + [("DEBT", day(1), -5.0), ("DEBT", day(2), -9.0), ("UP", day(1), 1.0), ("UP", day(2), 2.0)]
    got = drawdown.max_drawdown(closes(spark, extra), ["stock_symbol"], "timestamp", "close", block_rows=block_rows)
    want = {}
    for symbol in {s for s, _, c in extra if c is not None}:
        peak = worst = 0.0
        for _, _, c in (r for r in extra if r[0] == symbol and r[2] is not None):
            peak = max(peak, c)
            worst = max(worst, (peak - c) / peak if peak > 0 else 0.0)
        want[symbol] = 100 * worst
    assert {r.stock_symbol: r.max_drawdown for r in got.collect()} == pytest.approx(want)


def test_blocks_of_odd_groups(spark):
    rows = [("a", i) for i in range(500)] + [("a", None)] * 30 + [("a", 7)] * 100 + [(None, i) for i in range(200)] + [("b", 1)]
    df, cut = blocks.cut_into_blocks(spark, spark.createDataFrame(rows, "k string, at int"), ["k"], "at", 50)
    got = df.collect()
    assert cut and len(got) == len(rows)
    spans = defaultdict(list)
    for r in got:
        spans[r.k, r["_block"]].append(r.at)
    for k in ("a", None):
        ends = [(max(x for x in v if x is not None), b) for (key, b), v in spans.items() if key == k and any(x is not None for x in v)]
        assert ends == sorted(ends) or sorted(ends) == sorted(ends, key=lambda e: e[1])
        assert len(ends) > 3
    assert all(b == 0 for (k, b), v in spans.items() if None in v or k == "b")
    # Equal times share a block.
    assert len({b for (k, b), v in spans.items() if k == "a" and 7 in v}) == 1


def test_daily_values(spark):
    rng = random.Random(9)
    start = date(2024, 1, 1)
    deals = [
        (f"t{i}", rng.choice("pq"), rng.choice("ABC"), rng.choice(["BUY", "BUY", "SELL"]), float(rng.randint(1, 9)), float(rng.randint(1, 50)),
         datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 99), hours=rng.randint(0, 23)))
        for i in range(120)
    ] + [("late", "p", "A", "BUY", 1.0, 1.0, None), ("r", "r", "NOPRICE", "BUY", 1.0, 1.0, day(3))]
    quotes = {(s, start + timedelta(days=rng.randint(0, 99))): float(rng.randint(5, 90)) for s in "ABC" for _ in range(25)}
    df = prices(spark, [(s, datetime(d.year, d.month, d.day, 5), c) for (s, d), c in quotes.items()])
    first, last = "2024-01-11", "2024-04-20"
    got = {(r.portfolio_id, r.day): r for r in daily.daily_values(trades(spark, deals), df, first, last).collect()}
    want = {}
    for p in "pqr":
        for n in range((date(2024, 4, 20) - start).days + 1):
            today = start + timedelta(days=n)
            value, open_positions = 0.0, False
            for s in "ABC":
                q = sum(t[4] * (1 if t[3] == "BUY" else -1) for t in deals if t[1] == p and t[2] == s and t[6] and t[6].date() <= today)
                known = [(d, c) for (x, d), c in quotes.items() if x == s and d <= today]
                if q > 0 and known:
                    value, open_positions = value + q * max(known)[1], True
            if open_positions and today >= date(2024, 1, 11):
                flow = sum(t[4] * t[5] * (1 if t[3] == "BUY" else -1) for t in deals if t[1] == p and t[6] and t[6].date() == today)
                want[p, today] = (value, flow)
    assert {k: (float(r.total_value), float(r.net_flow)) for k, r in got.items()} == want
    for (p, today), (value, flow) in want.items():
        before = want.get((p, today - timedelta(days=1)))
        pct = got[p, today].daily_return_pct
        assert pct is None if before is None else pct == pytest.approx((value - flow - before[0]) / before[0] * 100)
    assert daily.daily_values(trades(spark, deals).where("false"), df, first, last).count() == 0


def test_cross_rates(spark):
    rows = [("AUD", "USD", day(1), 0.5), ("AUD", "USD", day(2), 0.66), ("AUD", "NZD", day(1), 1.1), ("NZD", "SGD", day(1), 0.8),
            ("USD", "SGD", day(1), 1.3), ("SGD", "MYR", day(1), 3.5), ("X", "Y", day(1), 2.0), ("Y", "X", day(1), 0.4), ("A", "A", day(1), 2.0),
            ("Q", "AUD", day(1), 0.0), (None, "AUD", day(1), 1.0), ("AUD", "Z", day(1), None)]
    rates = spark.createDataFrame(rows, "base_currency string, quote_currency string, timestamp timestamp, rate double")
    got = {(r.from_currency, r.to_currency): r for r in currency.cross_rates(rates).collect()}
    # Of two paths with two quotes, the one whose currencies come first.
    assert got["AUD", "SGD"].path == ["AUD", "NZD", "SGD"] and got["AUD", "SGD"].rate == pytest.approx(1.1 * 0.8)
    assert got["MYR", "AUD"].hops == 3 and got["MYR", "USD"].rate == pytest.approx(1 / 3.5 / 1.3)
    assert (got["X", "Y"].rate, got["Y", "X"].rate) == (2.0, 0.4)
    assert len(got) == 5 * 4 + 2
    listed = spark.createDataFrame([("AUD",), ("MYR",), ("X",), (None,)], "quote_currency string")
    crossed = currency.cross_rates(rates)
    towards = {r.quote_currency: r.fx_multiplier for r in currency.with_cross_multiplier(listed, crossed, "AUD").collect()}
    assert towards["AUD"] == 1.0 and towards["MYR"] == pytest.approx(got["MYR", "AUD"].rate) and towards["X"] is None and towards[None] is None
    assert {r.fx_multiplier for r in currency.with_cross_multiplier(listed.where("quote_currency = 'X'"), crossed, "AUD", 1.0).collect()} == {1.0}
    assert currency.cross_rates(rates.where("false")).count() == 0


def test_empty_portfolios_show_zeros(spark):
    held = spark.createDataFrame([("p", "A", 2.0)], "portfolio_id string, stock_symbol string, total_quantity double")
    people = spark.createDataFrame([("p",), ("idle",)], "portfolio_id string")
    df = prices(spark, [("A", day(1), 10.0), ("A", day(2), 5.0)])
    back = {r.portfolio_id: tuple(r)[1:] for r in valuation.portfolio_returns(held, df, "2024-01-01", "2024-01-03", people).collect()}
    assert back == {"p": (20.0, 10.0, -10.0, -50.0), "idle": (0.0, 0.0, 0.0, 0.0)}
    falls = spark.createDataFrame([("p", 50.0)], "portfolio_id string, max_drawdown double")
    got = {r.portfolio_id: r for r in risk.risk_metrics(held, df, drawdowns=falls, portfolios=people).collect()}
    assert got["p"].max_drawdown == 50.0 and tuple(got["idle"])[1:] == (0.0, 0.0, 0.0, 0.0)


def test_pooled_deviation_of_large_means(spark):
    """Returns that differ in the ninth digit: sums of squares would lose them."""
    rows = [("A", day(i + 1), c) for i, c in enumerate([1.0, 1e6, 1e12])] + [("B", day(i + 1), c) for i, c in enumerate([1.0, 1e6 + 1, (1e6 + 1) ** 2])]
    df = spark.createDataFrame(rows, "stock_symbol string, timestamp timestamp, close double")
    held = spark.createDataFrame([("p", "A"), ("p", "B")], "portfolio_id string, stock_symbol string")
    got = risk.risk_metrics(held, df).first().volatility / 100
    assert got == pytest.approx((4 * 0.25 / 3) ** 0.5, rel=1e-6)


def test_rows_find_their_block_by_bisection(spark):
    """The block equals the number of cuts below a value, for any number of cuts, and no cut list is filtered per row."""
    lists = [None, [], [1.0], [1.0, 2.0], [float(i) for i in range(13)], [i / 2 for i in range(blocks.GRID - 1)]]
    values = [None, -1.0, 0.0, 0.5, 1.0, 1.5, 12.0, 1022.9, 1023.0, 5000.0, float("nan")]
    rows = spark.createDataFrame([(c, v) for c in lists for v in values], "cuts array<double>, v double")
    slow = F.size(F.filter("cuts", lambda x: x < F.col("v")))
    got = rows.select(blocks._passed(F.col("cuts"), F.col("v")).alias("fast"), F.when(F.col("cuts").isNotNull(), slow).alias("slow")).collect()
    assert len(got) == len(lists) * len(values) and all(r.fast == r.slow for r in got)
    series = spark.range(3_000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    placed = blocks.in_blocks(spark, series, ["k"], "v", 100)
    assert "filter(__cuts" not in plan(placed)
    sizes = [r["count"] for r in placed.groupBy("_block").count().collect()]
    assert sum(sizes) == 3_000 and len(sizes) >= 25 and max(sizes) <= 200


def test_portfolio_metrics_joins_trades_and_closes_once(spark, sf_dir, monkeypatch):
    made = []
    for name in ("transactions", "stock_prices"):
        build = getattr(data, name)
        monkeypatch.setattr(data, name, lambda *a, n=name, f=build: made.append(n) or f(*a))
    assert queries.QUERIES["portfolio_metrics"](spark, sf_dir).count() == 26
    assert sorted(made) == ["stock_prices", "transactions"]
