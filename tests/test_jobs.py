import glob
import os
import sys

import pytest
from helpers import day, prices
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlark.plans import etl, export
from ledgerlark.sources import feeds
from ledgerlark.sources import fixtures as data
from ledgerlark.sources.tables import Lake

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
check_oracle = pytest.importorskip("check_oracle")


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.ORACLE))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    assert check_oracle.compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "market_value" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture()
def source(spark):
    """Two stocks with three prices each, as operational tables."""
    stocks = data.stocks(spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")).where("symbol in ('Brand#1', 'Brand#5')")
    rows = prices(spark, [(f"stk-{n}", day(d), float(10 * n + d)) for n in (1, 5) for d in (1, 2, 3)])
    rows = rows.withColumnsRenamed({"stock_symbol": "stock_id", "ingestion_timestamp": "created_at"})
    trades = spark.createDataFrame(
        [("t1", "p", "stk-1", "BUY", 2.0, 5.0, 0.0, day(1), day(1)), ("t2", "p", "stk-5", "BUY", 1.0, 5.0, 0.0, day(3), day(3))],
        "id string, portfolio_id string, stock_id string, transaction_type string, quantity double, price double, "
        "commission double, transaction_date timestamp, created_at timestamp",
    )
    fx = spark.createDataFrame(
        [("AUD", "USD", day(d), 0.6 + d / 100, day(d)) for d in (1, 2)],
        "base_currency string, quote_currency string, timestamp timestamp, rate double, created_at timestamp",
    )
    return export.Operational(stocks, rows, trades, data.sector_dimension(spark), data.market_dimension(spark), fx)


def counts(spark, lake):
    return {n: lake[n].read(spark).count() for n in ("stock_prices", "transactions", "securities", "exchange_rates")}


def test_full_export_twice(spark, source, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    want = {"stock_prices": 6, "transactions": 2, "securities": 2, "exchange_rates": 2}
    for _ in range(2):
        assert export.full_export(spark, source, lake) == want
        assert counts(spark, lake) == want
    rows = {r.stock_symbol: r for r in lake["securities"].read(spark).collect()}
    assert (rows["Brand#1"].gics_sector, rows["Brand#1"].gics_sector_code) == ("Materials", "materials")
    assert rows["Brand#5"].gics_sector == "raw 5" and rows["Brand#5"].gics_sector_code is None


def test_incremental_export_keeps_history(spark, source, tmp_path):
    from dataclasses import replace

    lake = Lake(str(tmp_path / "lake"))
    early = replace(
        source,
        stock_prices=source.stock_prices.where(F.col("created_at") < F.lit(day(3))),
        transactions=source.transactions.where(F.col("created_at") < F.lit(day(3))),
    )
    export.incremental_export(spark, early, lake)
    assert counts(spark, lake) == {"stock_prices": 4, "transactions": 1, "securities": 2, "exchange_rates": 2}
    written = export.incremental_export(spark, source, lake)
    # Rows at the mark are taken again and merged.
    assert (written["stock_prices"], written["transactions"], written["exchange_rates"]) == (4, 2, 1)
    assert counts(spark, lake) == {"stock_prices": 6, "transactions": 2, "securities": 2, "exchange_rates": 2}


def test_range_of_an_export(spark, source):
    rows = export.export_prices(source, "2024-01-02", "2024-01-02").collect()
    assert {(r.stock_symbol, r.timestamp) for r in rows} == {("Brand#1", day(2)), ("Brand#5", day(2))}


def test_load_job_can_be_repeated(spark, tmp_path):
    rows = [(s, day(d), 10.0, 11.0, 9.0, p, 5.0) for s, p in (("AAA", 10.0), ("BBB", 20.0)) for d in range(1, 16)]
    rows += [("AAA", day(20), None, 1.0, 1.0, 3.0, 1.0), ("OTHER", day(1), 1.0, 1.0, 1.0, 1.0, 1.0)]
    feed = spark.createDataFrame(rows, feeds.FEED)
    fx = spark.createDataFrame([("AUDUSD=X", day(1), 1.0, 1.0, 1.0, 0.7, 0.0)], feeds.FEED)
    wanted = spark.createDataFrame([("AAA",), ("BBB",), ("EMPTY",)], "stock_symbol string")
    lake = Lake(str(tmp_path / "lake"))
    config = etl.LoadConfig("p1", "Automated", initial_cash=1000.0)
    want = {
        "AAA": (15, None), "BBB": (15, None), "EMPTY": (0, None), "__fx__": (1, None), "__total__": (30, None),
        "__rejected__": (1, None), "__transactions__": (2, None), "__value__p1": (1, 1000.0),
    }
    for _ in range(2):
        out = etl.run_load(spark, lake, wanted, feed, fx, config, "2024-02-01")
        assert {r["item"]: (r["records"], r["amount"]) for r in out.collect()} == want
    assert etl.create_portfolio(spark, "a", "b", "AUD").first().currency == "AUD"


def test_every_supplied_table_is_counted(spark, sf_dir):
    names = {os.path.basename(p)[:-8] for p in glob.glob(f"{sf_dir}/*.parquet")}
    assert {r.table_name for r in entry.queries()["table_counts"](spark, sf_dir).collect()} == names
