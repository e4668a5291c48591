"""Time the headline queries on a no-op sink; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per query
(after one untimed run); the median counts. Query names as arguments replace the headline ones, and
``all`` stands for every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerlark.plans.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = """
current_holdings position_values portfolio_value portfolio_returns risk_metrics daily_returns tick_returns
latest_prices latest_fx sector_allocation region_allocation weighted_holdings verify_holdings holdings_report
equal_allocation sma rsi bollinger macd all_indicators all_indicators_ticks indicator_snapshot signals daily_bars
asof_join latest_n_prices price_summary portfolio_invested upsert_prices export_transactions export_securities
normalize_ohlcv watchlist_flat dq_unique dq_orphans
""".split()


def run(spark: SparkSession, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name)
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "warm_query_seconds_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
