"""Shards of near equal size by minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.llm.graph import written

#: Hex digits of a text's digest that name its group: at most 65,536 groups, whatever the number of documents.
DIGITS = 4
#: Rows that are numbered together in one task.
BLOCK = 4096


def cuts(sizes: Sequence[int], shards: int, capacity: int) -> list[int] | None:
    """Starts of the shards when each takes groups in order until ``capacity``; None if that needs more shards."""
    starts, filled = [0], 0
    for at, size in enumerate(sizes):
        if size > capacity:
            return None
        if filled + size > capacity:
            starts.append(at)
            filled = 0
            if len(starts) > shards:
                return None
        filled += size
    return starts


def minimax(sizes: Sequence[int], shards: int) -> list[int]:
    """The shard of each group: contiguous in order, with the largest shard as small as it can be.

    Binary search over the capacity, each step checked greedily. Of the partitions with that capacity one
    is taken that also leaves no shard short: greedy filling would leave the last ones empty, so each
    shard but the last stops at the average of what is left where capacity allows.
    """
    if not sizes:
        return []
    lo, hi = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while lo < hi:
        middle = (lo + hi) // 2
        if cuts(sizes, shards, middle) is None:
            lo = middle + 1
        else:
            hi = middle
    # need[i]: shards of that capacity that the groups from i on take at least.
    end, upto = len(sizes), [0]
    for size in sizes:
        upto.append(upto[-1] + size)
    need = [0] * (end + 1)
    reach = end
    for at in range(end - 1, -1, -1):
        while upto[reach] - upto[at] > lo:
            reach -= 1
        need[at] = 1 + need[reach]
    out, at = [], 0
    for shard in range(shards):
        left = shards - shard
        goal = (upto[end] - upto[at]) / left
        stop = at
        while stop < end and upto[stop + 1] - upto[at] <= lo:
            over = upto[stop + 1] - upto[at] - goal
            if need[stop] <= left - 1 and (over >= 0 and over > goal - (upto[stop] - upto[at])):
                break
            stop += 1
        out += [shard] * (stop - at)
        at = stop
    return out


def dealt(sizes: Sequence[int], shards: int) -> list[int]:
    """As ``minimax``, but groups above the average get a shard of their own, so that the rest stay even."""
    order, rest, left = [], list(range(len(sizes))), shards
    while left > 1 and rest:
        average = sum(sizes[i] for i in rest) / left
        large = [i for i in rest if sizes[i] > average]
        if not large or len(large) >= left:
            break
        order += large
        taken = set(large)
        rest = [i for i in rest if i not in taken]
        left -= len(large)
    out = [0] * len(sizes)
    for shard, i in enumerate(order):
        out[i] = shard
    for i, shard in zip(rest, minimax([sizes[i] for i in rest], left)):
        out[i] = len(order) + shard
    return out


def shard(
    spark: SparkSession, docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``: shards hold near equal bytes.

    A row's size is its text's UTF-8 bytes plus 16. Equal texts are never parted: rows are grouped by
    the first digits of their text's digest, and these at most 16 ** DIGITS ordered groups are what
    is partitioned, so the plan is as large for any number of documents. A group that outweighs an average
    shard, such as the copies of one text, has a shard to itself and the others are evened out.

    Slots number a shard's rows from 0 without gaps. Rows are numbered in blocks of about BLOCK, split
    by a hash of doc_id within a hot group, so no task holds a shard or a group.

    Null texts are a group of their own, with size 16 and a null text_crc32; a null doc_id is numbered
    like any other, rows alike in every column in either order. With fewer groups than shards some shards
    stay empty. Columns other than the two named are ignored; empty input gives no rows.
    """
    digest = F.substring(F.md5(F.coalesce(F.col(text).cast("binary"), F.lit(b"\x00null"))), 1, DIGITS)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.conv(digest, 16, 10).cast("int").alias("group"),
    )
    rows = written(spark, rows, "sized")
    groups = sorted(tuple(r) for r in rows.groupBy("group").agg(F.sum("size"), F.count("*")).collect())
    placed = dealt([size for _, size, _ in groups], shards)
    offsets, plan = {}, []
    for (group, _, count), target in zip(groups, placed):
        plan.append((group, target, offsets.get(target, 0), -(-count // BLOCK)))
        offsets[target] = offsets.get(target, 0) + count
    # Bounded by 16 ** DIGITS rows of four numbers.
    plan = F.broadcast(spark.createDataFrame(plan, "group int, shard int, at long, blocks long"))
    split = rows.join(plan, "group").withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("blocks")))
    blocks = split.groupBy("group", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("group", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("group", "block").orderBy("doc_id", "text_crc32", "size")) - 1
    return (
        split.withColumn("place", place)
        .join(blocks, ["group", "block"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("before") + F.col("place")).alias("slot"))
    )
