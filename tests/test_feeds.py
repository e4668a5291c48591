import json
import math

import pytest
from helpers import day
from pyspark.sql import functions as F

from ledgerlark.functions.scratch import scratch_dir
from ledgerlark.functions.symbols import SECTORS, fx_pair, infer_market, sector_code
from ledgerlark.operators import quality, reports, upsert
from ledgerlark.sources import feeds, watchlist
from ledgerlark.sources import fixtures as data


def test_market_from_suffix(spark):
    df = spark.createDataFrame([(s,) for s in ("BHP.AX", "air.nz", "PPB.KL", "D05.SI", "AAPL", "X", "")], "s string")
    got = {r.s: (r.m.market_code, r.m.country_code, r.m.quote_currency) for r in df.select("s", infer_market(F.col("s")).alias("m")).collect()}
    assert got == {
        "BHP.AX": ("ASX", "AU", "AUD"),
        "air.nz": ("NZX", "NZ", "NZD"),
        "PPB.KL": ("BURSA", "MY", "MYR"),
        "D05.SI": ("SGX", "SG", "SGD"),
        "AAPL": (None, None, "USD"),
        "X": (None, None, "USD"),
        "": (None, None, "USD"),
    }


def test_sector_codes_and_pairs(spark):
    df = spark.createDataFrame([("Real Estate",), ("Space Tourism",)], "s string")
    assert [r[0] for r in df.select(sector_code(F.col("s"))).collect()] == ["real_estate", "space_tourism"]
    assert len(SECTORS) == 11
    df = spark.createDataFrame([("AUDUSD=X",), ("nzdusd=x",), ("AUDUS=X",), ("USDMYRX",)], "t string")
    got = [r.p and tuple(r.p) for r in df.select(fx_pair(F.col("t")).alias("p")).collect()]
    assert got == [("AUD", "USD"), ("NZD", "USD"), None, ("USD", "MYR")]


def test_wide_feed(spark):
    names = ["A_Open", "A_High", "A_Low", "A_Close", "A_Volume", "B.X_Open", "B.X_High", "B.X_Low", "B.X_Close", "B.X_Volume"]
    rows = [(day(1), 1.0, 2.0, 0.5, 1.5, 10.0, None, None, None, None, None), (day(2), 1.0, 2.0, 0.5, None, 10.0, 5.0, 6.0, 4.0, 5.5, None)]
    wide = spark.createDataFrame(rows, "timestamp timestamp, " + ", ".join(f"`{n}` double" for n in names))
    got = {(r.stock_symbol, r.timestamp): r for r in feeds.wide_to_long(wide, ["A", "B.X", "NONE"]).collect()}
    assert set(got) == {("A", day(1)), ("A", day(2)), ("B.X", day(2))}
    assert feeds.wide_to_long(wide, ["NONE"]).count() == 0
    loaded = {(r.stock_symbol, r.timestamp): r for r in feeds.normalize_ohlcv(feeds.wide_to_long(wide, ["A", "B.X"])).collect()}
    assert set(loaded) == {("A", day(1)), ("B.X", day(2))}
    assert loaded["B.X", day(2)].volume == 0 and float(loaded["B.X", day(2)].adjusted_close) == 5.5


def test_bad_rows_are_set_aside(spark):
    rows = [("a", day(1), 1.0, 1.0, 1.0, 1.0, 5.0), ("b", day(1), None, 1.0, 1.0, 1.0, 5.0), ("c", day(1), 1.0, 1.0, 1.0, math.nan, 5.0),
            ("d", day(1), 1e30, 1.0, 1.0, 1.0, 5.0), ("e", day(1), 1.0, 1.0, 1.0, None, None)]
    feed = spark.createDataFrame(rows, feeds.FEED)
    assert [r.stock_symbol for r in feeds.normalize_ohlcv(feed).collect()] == ["A"]
    assert sorted(r.stock_symbol for r in feeds.rejected_rows(feed).collect()) == ["B", "D"]


def test_feed_files(spark, tmp_path):
    path = str(tmp_path / "feed")
    feed = spark.createDataFrame([("AUDUSD=X", day(1), 1.0, 1.0, 1.0, 0.7, 0.0), ("SHORT", day(1), 1.0, 1.0, 1.0, 0.7, 0.0)], feeds.FEED)
    feed.write.option("header", True).csv(path)
    assert feeds.read_feed(spark, path).count() == 2
    assert [tuple(r) for r in feeds.normalize_fx(feeds.read_feed(spark, path)).collect()] == [("AUD", "USD", day(1), 0.7)]
    assert feeds.stream_feed(spark, path).isStreaming


CONFIG = {
    "base_currency": "AUD",
    "regions": {
        "AU": {"name": "Australia", "market_code": "ASX", "country_code": "AU", "quote_currency": "AUD", "suffix": ".AX"},
        "SG": {"name": "Singapore", "market_code": "SGX", "country_code": "SG", "quote_currency": "SGD", "suffix": ".SI"},
    },
    "fx_pairs": ["AUDUSD=X", "AUDSGD=X"],
    "sectors": {
        "Materials": {"AU": ["bhp.ax", "RIO.AX"], "SG": ["S63.SI"]},
        "Energy": {"SG": ["S63.SI", "BN4.SI"], "XX": ["ZZZ"]},
    },
}


@pytest.fixture()
def config(spark, tmp_path):
    path = tmp_path / "watchlist.json"
    path.write_text(json.dumps(CONFIG))
    return watchlist.read_watchlist(spark, str(path))


def test_watchlist(spark, config, tmp_path):
    flat = {r.stock_symbol: r for r in watchlist.flatten_watchlist(config).collect()}
    assert set(flat) == {"BHP.AX", "RIO.AX", "S63.SI", "BN4.SI", "ZZZ"}
    assert flat["S63.SI"].gics_sector_code == "materials"
    assert (flat["BN4.SI"].gics_sector_override, flat["BN4.SI"].market_code) == ("Energy", "SGX")
    assert flat["ZZZ"].market_code is None
    some = watchlist.flatten_watchlist(config, regions=["sg"]).collect()
    assert {r.stock_symbol for r in some} == {"S63.SI", "BN4.SI"}
    assert [r.ticker for r in watchlist.watchlist_pairs(config).collect()] == CONFIG["fx_pairs"]
    bad = {r.stock_symbol: r.problems for r in quality.watchlist_violations(watchlist.flatten_watchlist(config)).collect()}
    assert bad == {"ZZZ": ["market"]}
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "watchlist.yaml"
    path.write_text(yaml.safe_dump(CONFIG, sort_keys=False))
    again = watchlist.flatten_watchlist(watchlist.read_watchlist(spark, str(path))).collect()
    assert {r.stock_symbol: tuple(r) for r in again} == {s: tuple(r) for s, r in flat.items()}


def test_registration(spark, config):
    stocks = spark.createDataFrame(
        [("1", "BHP.AX", "BHP", "", "Old", None, "USD", None, None, None, day(1)), ("2", "AAPL", "Apple", "", "Tech", "US", "USD", None, None, None, day(1))],
        "id string, symbol string, name string, exchange string, sector string, country_code string, quote_currency string, "
        "gics_sector_id int, market_id int, gics_sector_override string, updated_at timestamp",
    )
    requested = watchlist.flatten_watchlist(config).unionByName(
        spark.createDataFrame([("AIR.NZ",)], "stock_symbol string"), allowMissingColumns=True
    )
    out = upsert.register_securities(stocks, requested, data.sector_dimension(spark), data.market_dimension(spark), "2024-01-09")
    got = {r.symbol: r for r in out.collect()}
    assert len(got) == 7 and len({r.id for r in got.values()}) == 7
    assert (got["BHP.AX"].id, got["BHP.AX"].country_code, got["BHP.AX"].quote_currency, got["BHP.AX"].sector) == ("1", "AU", "AUD", "Materials")
    assert got["BHP.AX"].updated_at == day(9) and got["AAPL"].updated_at == day(1)
    assert (got["S63.SI"].gics_sector_id, got["S63.SI"].market_id, got["S63.SI"].exchange) == (2, 4, "SGX")
    assert (got["AIR.NZ"].country_code, got["AIR.NZ"].quote_currency, got["AIR.NZ"].sector) == ("NZ", "NZD", "")
    assert (got["ZZZ"].country_code, got["ZZZ"].quote_currency, got["ZZZ"].market_id) == (None, "USD", None)


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", "BUY", None), ("a", "SWAP", 1), ("b", None, 2)], "k string, t string, v int")
    assert {r.t for r in quality.outside_domain(df, "t", ["BUY", "SELL"]).collect()} == {"SWAP"}
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    parents = spark.createDataFrame([("a",)], "id string")
    assert [r.k for r in quality.orphans(df, parents, "k", "id").collect()] == ["b"]
    assert [r.v for r in quality.with_defaults(df, {"v": 0}).collect()] == [0, 1, 2]
    asked = spark.createDataFrame([("A",), ("B",)], "stock_symbol string")
    loaded = spark.createDataFrame([("A", 1), ("A", 2)], "stock_symbol string, x int")
    assert [r.stock_symbol for r in quality.empty_feeds(asked, loaded).collect()] == ["B"]
    totals = {r.stock_symbol: r.records for r in reports.load_totals(asked, loaded, df).collect()}
    assert totals == {"A": 2, "B": 0, "__fx__": 3, "__total__": 2}


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second
