import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import day, prices, sample_trades, trades

from ledgerlark.operators import holdings, quality, valuation

# Quantity, net cash cost and weighted average of the sample trades.
EXPECTED = {
    "AAPL": (80, 13590.0, 169.875, 170.5),
    "MSFT": (50, 18250.0, 365.0, 365.0),
    "GOOGL": (75, 10350.0, 138.0, 138.0),
    "AMZN": (60, 8880.0, 148.0, 148.0),
    "TSLA": (30, 7020.0, 234.0, 235.0),
}


def walk(rows):
    """Trade-by-trade rule on one position: quantity, average and realised gain."""
    quantity, average, gain = Decimal(0), 0.0, 0.0
    for kind, units, price in rows:
        units = Decimal(str(units))
        if kind == "BUY":
            average = (float(quantity) * average + float(units) * price) / float(quantity + units)
            quantity += units
        elif kind == "SELL":
            sold = min(quantity, units)
            gain += float(sold) * (price - average)
            quantity -= sold
    return quantity, average, gain


def test_sample_trades_have_hand_computed_costs(spark):
    net = {r.stock_symbol: r for r in holdings.net_holdings(sample_trades(spark)).collect()}
    weighted = {r.stock_symbol: r for r in holdings.weighted_holdings(sample_trades(spark)).collect()}
    for symbol, (quantity, cost, net_average, average) in EXPECTED.items():
        assert float(net[symbol].total_quantity) == quantity
        assert float(net[symbol].total_cost) == cost
        assert net[symbol].average_cost == net_average
        assert float(weighted[symbol].quantity) == quantity
        assert weighted[symbol].average_cost == pytest.approx(average, rel=1e-12)
    assert sum(float(r.total_cost) for r in net.values()) == 58090.0


def test_report_total_sums_rounded_average_costs(spark):
    last = prices(spark, [(s, day(9), 100.0) for s in EXPECTED])
    report = valuation.holdings_report(holdings.net_holdings(sample_trades(spark), strict=True), last)
    total = valuation.report_with_totals(report).where("symbol = 'TOTAL'").first()
    assert float(total.cost) == 58090.40
    assert float(total.value) == 29500.0


def test_closing_and_restarting_a_position(spark):
    steps = [("SELL", 5, 9), ("BUY", 10, 10), ("BUY", 10, 20), ("SELL", 5, 9), ("SELL", 15, 9), ("BUY", 4, 7)]
    rows = [(f"t{i}", "p", "X", kind, float(q), float(p), day(1, i)) for i, (kind, q, p) in enumerate(steps)]
    row = holdings.weighted_holdings(trades(spark, rows)).first()
    assert (float(row.quantity), row.average_cost) == (4.0, 7.0)
    assert row.realized_gain == pytest.approx(5 * (9 - 15) + 15 * (9 - 15))
    assert holdings.weighted_holdings(trades(spark, rows[:-1])).count() == 0


def test_fractions_close_exactly(spark):
    rows = [("a", "p", "X", "BUY", 0.1, 5.0, day(1)), ("b", "p", "X", "BUY", 0.2, 5.0, day(2)),
            ("c", "p", "X", "SELL", 0.3, 5.0, day(3))]
    assert holdings.weighted_holdings(trades(spark, rows)).count() == 0


def test_unknown_types(spark):
    rows = [("a", "p", "X", "BUY", 10.0, 5.0, day(1)), ("b", "p", "X", "GIFT", 4.0, 5.0, day(2))]
    assert float(holdings.net_holdings(trades(spark, rows)).first().total_quantity) == 6
    assert float(holdings.net_holdings(trades(spark, rows), strict=True).first().total_quantity) == 10
    assert float(holdings.weighted_holdings(trades(spark, rows)).first().quantity) == 10


@pytest.fixture(scope="module")
def random_trades():
    rng = random.Random(7)
    at = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        at += timedelta(minutes=rng.choice([0, 1, 30, 2000]))
        # Position (p, HOT) takes most of the rows.
        symbol = "HOT" if rng.random() < 0.7 else rng.choice("ABC")
        kind = rng.choice(["BUY", "BUY", "SELL"])
        quantity = rng.randint(1, 40) if kind == "BUY" else rng.randint(1, 90)
        rows.append((f"{i:05d}", "p", symbol, kind, float(quantity), round(rng.uniform(5, 50), 2), at))
    return rows


@pytest.mark.parametrize("bucket,block_rows", [("year", 10_000), ("day", 10_000), ("year", 7), ("hour", 2)])
def test_split_fold_equals_walking(spark, random_trades, bucket, block_rows):
    got = {
        r.stock_symbol: r
        for r in holdings.weighted_holdings(
            trades(spark, random_trades).repartition(5), bucket=bucket, block_rows=block_rows, keep_closed=True
        ).collect()
    }
    for symbol in ("HOT", "A", "B", "C"):
        quantity, average, gain = walk([r[3:6] for r in random_trades if r[2] == symbol])
        assert got[symbol].quantity == quantity
        assert got[symbol].average_cost == pytest.approx(average, rel=1e-9)
        assert got[symbol].realized_gain == pytest.approx(gain, rel=1e-9, abs=1e-6)


def test_opening_positions_continue(spark, random_trades):
    whole = holdings.weighted_holdings(trades(spark, random_trades), keep_closed=True)
    first = holdings.weighted_holdings(trades(spark, random_trades[:1700]), keep_closed=True)
    then = holdings.weighted_holdings(trades(spark, random_trades[1700:]), first, keep_closed=True)
    want = {r.stock_symbol: r for r in whole.collect()}
    for row in then.collect():
        assert row.quantity == want[row.stock_symbol].quantity
        assert row.average_cost == pytest.approx(want[row.stock_symbol].average_cost, rel=1e-9)
        assert row.realized_gain == pytest.approx(want[row.stock_symbol].realized_gain, rel=1e-9)


def test_opening_positions_without_new_trades_stay(spark):
    opening = holdings.weighted_holdings(sample_trades(spark))
    more = trades(spark, [("n", "p", "AAPL", "BUY", 20.0, 180.5, day(8))])
    got = {r.stock_symbol: r for r in holdings.weighted_holdings(more, opening).collect()}
    assert len(got) == 5
    assert got["AAPL"].average_cost == pytest.approx((80 * 170.5 + 20 * 180.5) / 100)
    assert got["TSLA"].average_cost == pytest.approx(235.0)


def test_listing_activity_and_reconciliation(spark):
    portfolios = spark.createDataFrame([("p", "Growth"), ("q", "Idle")], "portfolio_id string, name string")
    all_trades = sample_trades(spark)
    activity = {r.portfolio_id: r for r in holdings.portfolio_activity(portfolios, all_trades).collect()}
    assert (activity["p"].transactions, float(activity["p"].invested)) == (7, 63930.0)
    assert (activity["q"].transactions, float(activity["q"].invested)) == (0, 0.0)
    assert holdings.most_active_portfolio(portfolios, all_trades).first().name == "Growth"
    weighted = holdings.weighted_holdings(all_trades)
    listing = holdings.holdings_listing(weighted, portfolios).collect()
    assert [r.stock_symbol for r in listing] == sorted(EXPECTED)
    assert quality.reconcile_holdings(weighted, holdings.net_holdings(all_trades)).count() == 0
    assert [r.transaction_id for r in holdings.portfolio_transactions(all_trades, "p").take(5)][0].startswith("b")


def test_trades_are_shuffled_once_for_both_passes(spark, tmp_path):
    sample_trades(spark).write.parquet(str(tmp_path / "t"))
    df = holdings.weighted_holdings(spark.read.parquet(str(tmp_path / "t")))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 1
