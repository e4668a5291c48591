import statistics

import pytest
from helpers import day, prices, sample_trades, trades

from ledgerlark.operators import allocation, holdings, risk, valuation


def held(spark, rows):
    return holdings.net_holdings(trades(spark, [(f"t{i}", p, s, "BUY", q, c, day(1)) for i, (p, s, q, c) in enumerate(rows)]))


def test_position_and_portfolio_values(spark):
    df = prices(spark, [("A", day(1), 10.0), ("A", day(3), 12.0), ("B", day(2), 5.0)])
    mine = held(spark, [("p", "A", 10.0, 9.0), ("p", "B", 4.0, 6.0), ("p", "NOPRICE", 1.0, 1.0), ("q", "A", 1.0, 20.0)])
    got = {(r.portfolio_id, r.stock_symbol): r for r in valuation.position_values(mine, df).collect()}
    assert set(got) == {("p", "A"), ("p", "B"), ("q", "A")}
    assert float(got["p", "A"].market_value) == 120 and float(got["p", "A"].unrealized_gain) == 30
    assert got["p", "A"].unrealized_gain_pct == pytest.approx(100 / 3)
    early = valuation.position_values(mine, df, "2024-01-02").where("portfolio_id = 'q'").first()
    assert float(early.current_price) == 10
    people = spark.createDataFrame([("p", "P"), ("q", "Q"), ("idle", "I")], "portfolio_id string, name string")
    totals = {r.portfolio_id: r for r in valuation.portfolio_value(valuation.position_values(mine, df), people).collect()}
    assert (totals["p"].total_value, totals["p"].total_cost, totals["p"].unrealized_gain) == (140.0, 114.0, 26.0)
    assert (totals["idle"].total_value, totals["idle"].unrealized_gain_pct) == (0.0, 0.0)


def test_zero_cost_does_not_fail(spark):
    rows = [("a", "p", "A", "BUY", 2.0, 5.0, day(1)), ("b", "p", "A", "SELL", 1.0, 10.0, day(2))]
    mine = holdings.net_holdings(trades(spark, rows))
    row = valuation.position_values(mine, prices(spark, [("A", day(1), 3.0)])).first()
    assert row.unrealized_gain_pct is None
    assert valuation.portfolio_value(valuation.position_values(mine, prices(spark, [("A", day(1), 3.0)]))).first().unrealized_gain_pct == 0.0


def test_empty_holdings_keep_the_schema(spark):
    none = held(spark, [("p", "A", 1.0, 1.0)]).where("false")
    df = prices(spark, [("A", day(1), 3.0)])
    values = valuation.position_values(none, df)
    assert values.count() == 0 and "unrealized_gain_pct" in values.columns
    totals = valuation.portfolio_value(values)
    assert totals.count() == 0 and totals.columns[0] == "portfolio_id"


def test_returns_between_dates(spark):
    df = prices(spark, [("A", day(1), 10.0), ("A", day(9), 15.0), ("B", day(5), 7.0)])
    mine = held(spark, [("p", "A", 2.0, 1.0), ("p", "B", 1.0, 1.0), ("q", "B", 3.0, 1.0)])
    got = {r.portfolio_id: r for r in valuation.portfolio_returns(mine, df, "2024-01-02", "2024-01-10").collect()}
    assert (got["p"].start_value, got["p"].end_value, got["p"].total_return, got["p"].total_return_pct) == (20.0, 37.0, 17.0, 85.0)
    assert (got["q"].start_value, got["q"].end_value, got["q"].total_return_pct) == (0.0, 21.0, 0.0)


@pytest.mark.parametrize("annualize", [False, True])
def test_pooled_risk(spark, annualize):
    closes = {"A": [10.0, 11.0, 10.5, 12.0], "B": [50.0, 49.0, 53.0], "C": [1.0]}
    df = prices(spark, [(s, day(i + 1), c) for s, cs in closes.items() for i, c in enumerate(cs)])
    mine = held(spark, [("p", "A", 1.0, 1.0), ("p", "B", 1.0, 1.0), ("q", "B", 1.0, 1.0), ("r", "C", 1.0, 1.0)])
    got = {r.portfolio_id: r for r in risk.risk_metrics(mine, df, annualize=annualize).collect()}
    moves = {s: [(b - a) / a for a, b in zip(cs, cs[1:])] for s, cs in closes.items()}
    for portfolio, pooled in (("p", moves["A"] + moves["B"]), ("q", moves["B"])):
        deviation = statistics.stdev(pooled)
        volatility = deviation * (252**0.5 if annualize else 100)
        annual = statistics.mean(pooled) * 252
        assert got[portfolio].volatility == pytest.approx(volatility)
        assert got[portfolio].avg_annual_return == pytest.approx(annual)
        assert got[portfolio].sharpe_ratio == pytest.approx((annual - 0.02) / volatility)
    assert (got["r"].volatility, got["r"].sharpe_ratio, got["r"].max_drawdown, got["r"].avg_annual_return) == (0, 0, 0, 0)


def securities(spark, rows):
    return spark.createDataFrame(
        rows,
        "stock_symbol string, gics_sector_override string, gics_sector string, gics_sector_code string, "
        "country_code string, quote_currency string, market_code string",
    )


def rates(spark, rows):
    return spark.createDataFrame(rows, "base_currency string, quote_currency string, timestamp timestamp, rate double")


def test_fx_paths(spark):
    df = spark.createDataFrame([(c,) for c in ("AUD", "USD", "NZD", "SGD", "EUR", None)], "quote_currency string")
    fx = rates(
        spark,
        [
            ("AUD", "USD", day(1), 0.5),
            ("AUD", "USD", day(2), 0.8),
            ("NZD", "AUD", day(1), 0.9),
            ("AUD", "SGD", day(1), 0.4),
            ("SGD", "AUD", day(1), 7.0),
            ("USD", "EUR", day(1), 3.0),
        ],
    )
    got = {r.quote_currency: r.fx_multiplier for r in allocation.with_fx_multiplier(df, fx, "AUD").collect()}
    assert got == {"AUD": 1.0, "USD": 1.25, "NZD": 0.9, "SGD": 2.5, "EUR": 1.0, None: 1.0}


def test_allocations(spark):
    df = prices(spark, [("A", day(1), 10.0), ("B", day(1), 20.0), ("C", day(1), 5.0), ("D", day(1), 1.0)])
    listed = securities(
        spark,
        [
            ("A", None, "Energy", "energy", "AU", "AUD", "ASX"),
            ("B", "Special", "Energy", "energy", "AU", "USD", "ASX"),
            ("C", None, None, None, None, None, None),
        ],
    )
    mine = held(spark, [("p", "A", 6.0, 1.0), ("p", "B", 1.0, 1.0), ("p", "C", 2.0, 1.0), ("p", "D", 5.0, 1.0)])
    valued = allocation.holdings_base_value(mine, df, listed, rates(spark, [("AUD", "USD", day(1), 0.8)]), "AUD")
    sectors = allocation.sector_allocation(valued).collect()
    by_name = {r.gics_sector: r for r in sectors}
    # C has no currency, so USD applies; D has no security row at all.
    assert {k: r.market_value_base for k, r in by_name.items()} == {"Energy": 60.0, "Special": 25.0, "Unknown": 12.5, None: 5.0}
    assert sum(r.weight_pct for r in sectors) == pytest.approx(100)
    assert [r.gics_sector for r in sectors] == ["Energy", "Special", "Unknown", None]
    assert by_name["Special"].avg_fx_rate == 1.25 and float(by_name["Energy"].total_quantity) == 6
    regions = {(r.country_code, r.market_code): r for r in allocation.region_allocation(valued).collect()}
    assert set(regions) == {("AU", "ASX"), ("Unknown", "Unknown"), (None, None)}
    assert regions["AU", "ASX"].weight_pct == pytest.approx(85 / 102.5 * 100)


def test_weights_of_worthless_portfolios_are_zero(spark):
    df = prices(spark, [("A", day(1), 0.0)])
    valued = allocation.holdings_base_value(
        held(spark, [("p", "A", 6.0, 1.0)]), df, securities(spark, []), rates(spark, []), "AUD"
    )
    assert allocation.sector_allocation(valued).first().weight_pct == 0.0


def test_equal_cash_purchases(spark):
    df = prices(
        spark,
        [("A", day(1), 30.0), ("A", day(12), 40.0), ("B", day(5), 900.0), ("C", day(11), 2.0), ("D", day(2), 7.0), ("A", day(20), 50.0)],
    )
    wanted = spark.createDataFrame([("A",), ("B",), ("C",), ("MISSING",)], "stock_symbol string")
    got = {r.stock_symbol: r for r in allocation.equal_cash_purchases(df, wanted, 1000.0).collect()}
    # Three symbols have prices, so each gets 333.33 on January 13; one share of B costs more.
    assert set(got) == {"A", "C"}
    assert (got["A"].quantity, float(got["A"].price), got["A"].transaction_date) == (8, 40.0, day(13))
    assert got["C"].quantity == 166


def test_verified_totals(spark):
    stored = holdings.weighted_holdings(sample_trades(spark))
    last = prices(spark, [(s, day(9), 200.0) for s in ("AAPL", "MSFT", "GOOGL", "AMZN", "TSLA")])
    rows = {r.stock_symbol: r for r in valuation.verify_holdings(stored, last).collect()}
    assert rows["AAPL"].pnl_pct == pytest.approx((200 - 170.5) / 170.5 * 100)
    total = valuation.verified_totals(valuation.verify_holdings(stored, last)).first()
    assert total.total_cost == pytest.approx(80 * 170.5 + 18250 + 10350 + 8880 + 30 * 235)
    assert total.current_value == 59000.0


def test_metrics_row(spark):
    mine = held(spark, [("p", "A", 2.0, 5.0)])
    df = prices(spark, [("A", day(1), 5.0), ("A", day(2), 6.0)])
    values = valuation.portfolio_value(valuation.position_values(mine, df))
    realized = spark.createDataFrame([("p", 3.5)], "portfolio_id string, realized_gains double")
    row = risk.portfolio_metrics(values, risk.risk_metrics(mine, df), realized, "2024-02-01").first()
    assert (row.total_value, row.total_cost, row.realized_gains, row.unrealized_gains) == (12.0, 10.0, 3.5, 2.0)
    assert row.total_return_pct == 20.0 and row.daily_return_pct is None
