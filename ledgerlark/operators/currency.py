"""Cross rates between currencies that are not quoted against each other: shortest paths over the quoted pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.blocks import stored
from ledgerlark.operators.latest import latest_fx


def quoted_edges(rates: DataFrame) -> DataFrame:
    """from_currency, to_currency, rate in both directions of every quoted pair; a pair's own quote outranks the reciprocal."""
    latest = latest_fx(rates.where("rate is not null"), tie="rate").where("rate > 0 and base_currency != quote_currency")
    own = latest.select(F.col("base_currency").alias("from_currency"), F.col("quote_currency").alias("to_currency"), F.lit(1).alias("own"), "rate")
    turned = latest.select(F.col("quote_currency").alias("from_currency"), F.col("base_currency").alias("to_currency"), F.lit(0).alias("own"), (F.lit(1.0) / F.col("rate")).alias("rate"))
    best = own.union(turned).groupBy("from_currency", "to_currency").agg(F.max_by("rate", "own").alias("rate"))
    return best.where("from_currency is not null and to_currency is not null")


def cross_rates(rates: DataFrame) -> DataFrame:
    """from_currency, to_currency, rate, hops, path for every ordered pair that quotes connect.

    ``rate`` units of ``to_currency`` are one of ``from_currency``: the product along the path with fewest quotes, of equally
    long ones the one whose currencies come first in order. Each round extends the pairs found last by one quote and keeps, per new
    pair, the best; it ends when nothing is new, after as many rounds as the longest of the shortest paths. Quotes of 0 or less, of a currency
    against itself and with nulls don't count. No quotes give no rows.
    """
    spark = rates.sparkSession
    edges = stored(spark, quoted_edges(rates), "quotes")
    reached = stored(spark, edges.select("from_currency", "to_currency", "rate", F.lit(1).alias("hops"), F.array("from_currency", "to_currency").alias("path")), "pairs")
    last, hops = reached, 1
    step = edges.select(F.col("from_currency").alias("to_currency"), F.col("to_currency").alias("next"), F.col("rate").alias("more"))
    while last.limit(1).count():
        hops += 1
        further = last.join(step, "to_currency").where("next != from_currency").select(
            "from_currency", F.col("next").alias("to_currency"), (F.col("rate") * F.col("more")).alias("rate"),
            F.lit(hops).alias("hops"), F.concat("path", F.array("next")).alias("path"),
        )
        new = further.join(reached.select("from_currency", "to_currency"), ["from_currency", "to_currency"], "left_anti")
        best = new.groupBy("from_currency", "to_currency").agg(F.min_by(F.struct("rate", "hops", "path"), "path").alias("b"))
        last = stored(spark, best.select("from_currency", "to_currency", "b.*"), "pairs")
        reached = reached.union(last)
    return reached


def with_cross_multiplier(df: DataFrame, crossed: DataFrame, base_currency: str, unreachable: float | None = None) -> DataFrame:
    """Add ``fx_multiplier`` from ``quote_currency`` to the base over ``cross_rates``.

    1 for the base itself; ``unreachable``, NULL by default, where no quotes lead to the base or the currency is null.
    """
    to_base = crossed.where(F.col("to_currency") == base_currency).select(F.col("from_currency").alias("quote_currency"), F.col("rate").alias("_cross"))
    own = F.when(F.col("quote_currency") == base_currency, F.lit(1.0))
    joined = df.join(to_base, "quote_currency", "left")
    return joined.withColumn("fx_multiplier", F.coalesce(own, "_cross", F.lit(unreachable).cast("double"))).select(*df.columns, "fx_multiplier")
