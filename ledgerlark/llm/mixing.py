"""Mixing sources to target weights by nested hash thresholds, without sorting documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.llm.graph import written

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the hash that one histogram level resolves: 4096 buckets for each source.
LEVEL = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Add ``target`` to rows (source, source_size), one for each source.

    Targets are in proportion to the weights, dealt in the order of the sources by code point (null
    last), and sum to ``share`` of all sizes; none exceeds ``most`` times its size. What a capped source
    leaves is dealt again by weight until none is above: the level at which the others stand is found
    from running sums over the sources in the order of their capacity for a unit of weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    filling = Window.orderBy("reach", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    cap = most * F.col("source_size")
    ranked = sources.withColumn("weight", weight.cast("double")).withColumn("reach", cap / F.col("weight"))
    levelled = ranked.withColumn(
        "level",
        (share * F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    # The first source, by reach, that lies above the level left to it and its successors fixes that level.
    fixed = F.min(F.when(F.col("reach") >= F.col("level"), F.struct("reach", "source", "level"))).over(every)["level"]
    level = F.coalesce(fixed, F.lit(float("inf")))
    return levelled.select("source", "source_size", F.least(level * F.col("weight"), cap).alias("target"))


def hash_of(doc_id: Column) -> Column:
    """32 hex digits, equal for equal doc_id, spread evenly."""
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def thresholds(spark: SparkSession, sized: DataFrame, budgets: DataFrame, levels: int) -> DataFrame:
    """(source, bound): the documents whose hash is below the bound have sizes that sum up to the budget.

    A histogram of sizes by source and LEVEL hash digits gives the bucket in which the running sum passes
    the budget; only that bucket's documents are divided by the next digits, and so on. The hash that
    passes the budget is taken with those before it if that comes closer.
    """
    done = budgets.select("source", F.col("budget"), F.lit("").alias("prefix"))
    for level in range(1, levels + 1):
        digits = LEVEL * level
        inside = sized.join(done, sized["source"].eqNullSafe(done["source"])).drop(done["source"])
        inside = inside.where(F.col("prefix").isNotNull() & F.col("hash").startswith(F.col("prefix")))
        bucket = F.substring("hash", 1, digits).alias("bucket")
        histogram = inside.groupBy("source", "budget", bucket).agg(F.sum("size").alias("size"))
        running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        summed = histogram.withColumn("upto", running)
        passed = summed.where(F.col("upto") > F.col("budget")).groupBy("source").agg(
            F.min(F.struct("bucket", "budget", "upto", "size")).alias("at")
        )
        done = written(
            spark,
            passed.select(
                "source",
                (F.col("at.budget") - F.col("at.upto") + F.col("at.size")).alias("budget"),
                F.col("at.bucket").alias("prefix"),
                F.col("at.size").alias("bucket_size"),
            ),
            "thresholds",
        )
    nearer = F.col("bucket_size") - F.col("budget") < F.col("budget")
    return done.select("source", F.when(nearer, F.concat("prefix", F.lit("g"))).otherwise(F.col("prefix")).alias("bound"))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    levels: int = 4,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs``.

    A document's size is its number of words. A source takes its documents whole: each as often as
    the target holds the source, and once more those whose hash lies below the source's threshold, so that
    their sizes sum up to the rest of the target to within a document. The hash depends on doc_id alone:
    reruns agree and a document's rank in its source never changes. A null or empty text has size 0; it
    is taken as often as its hash says, with 0 words. A null source is a source of its own, last in
    order. Rows that repeat a doc_id share its hash and are taken together. Sources without words have
    target 0 and take nothing. Columns other than those named are ignored; empty input gives no rows.

    The number of histogram rows is bounded by 16 ** LEVEL for each source; each level after the first
    reads one bucket a source. Hot sources combine on the map side.
    """
    sized = written(
        spark,
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            hash_of(F.col(doc_id)).alias("hash"),
        ),
        "sized",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = written(spark, targets(sources, weights, share, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    planned = planned.withColumn("whole", F.least(whole, F.lit(most)))
    budgets = planned.where("source_size > 0").select(
        "source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget")
    )
    bounds = thresholds(spark, sized, budgets, levels)
    planned = planned.join(bounds, planned["source"].eqNullSafe(bounds["source"]), "left").drop(bounds["source"])
    planned = written(spark, planned, "plan")
    extra = (F.col("hash") < F.coalesce("bound", F.lit(""))).cast("int")
    copies = F.least(F.col("whole") + extra, F.lit(most))
    taken = sized.join(planned, sized["source"].eqNullSafe(planned["source"])).drop(planned["source"])
    return taken.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )
