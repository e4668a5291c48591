"""The trie of conversation prefixes as node tables with minimal perfect hashes, one table per shard of conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.graph import written
from ledgerlark.llm.text import mixed
from ledgerlark.operators.blocks import before_block, beside, in_blocks

FAMILY = 20
HEADS = 4
WORD = r"[^\x20\x09-\x0D]+"
#: Turns of one conversation that are scanned together, and about as many rows make a shard.
BLOCK_ROWS = 50_000
SHARD_ROWS = 200_000
NODE = ["depth", "x", "y"]
UP = ["up_x", "up_y"]


def turns_of(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, said (digest of role and text), words for every turn that has a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), said.alias("said"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    return rows.where("conv is not null")


def scanned(spark: SparkSession, rows: DataFrame, order: list[Column], values: dict[str, Column], total: dict[str, Column], join: dict) -> DataFrame:
    """``rows`` (conv, block) with running ``values`` over each conversation, in blocks joined by ``join(inside, before)``."""
    inside = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({name: value.over(inside) for name, value in values.items()})
    blocks = rows.where("many").groupBy("conv", "block").agg(*[v.alias(f"__{n}") for n, v in total.items()])
    carried = before_block(blocks, ["conv"], "block", {f"__{n}": combine for n, (combine, _) in join.items()})
    carried = written(spark, carried, "carried")
    local = beside(local, carried, ["conv", "block"], "left", carried.count())
    return local.withColumns({n: both(F.col(n), F.col(f"__{n}")) for n, (_, both) in join.items()}).drop(*(f"__{n}" for n in join))


def placed(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """conv, block, many, at, said, words: ``at`` is the turn's place in its conversation, from 1."""
    cut = in_blocks(spark, turns, ["conv"], "turn", BLOCK_ROWS, "block")
    cut = cut.withColumn("many", F.col("block") > 0)
    longer = cut.where("many").select("conv").distinct()
    longer = written(spark, longer, "long-conversations")
    n = longer.count()
    if n:
        cut = beside(cut.drop("many"), longer.withColumn("many", F.lit(True)), ["conv"], "left", n)
        cut = cut.withColumn("many", F.coalesce("many", F.lit(False)))
    order = [F.col("turn").asc_nulls_first(), F.col("said")]
    count = F.count(F.lit(1))
    out = scanned(spark, cut, order, {"at": count}, {"at": count}, {"at": (F.sum("__at"), lambda a, b: a + F.coalesce(b, F.lit(0)))})
    return out.select("conv", "block", "many", "at", "said", "words")


def lanes(depth: Column, said: Column) -> list[Column]:
    return [F.xxhash64(F.lit(lane), depth.cast("long"), said) for lane in (1, 2)]


def rebuilt(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv, block, many, depth, said, words) of their turns, and (conv, length) of all.

    Conversation c has the first h turns of c - c % FAMILY, h being crc32(c) % HEADS, then its own after its first h.
    """
    at = written(spark, placed(spark, turns), "placed")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h")
    convs = at.groupBy("conv").agg(F.count(F.lit(1)).alias("own"), F.max("many").alias("many"))
    convs = convs.withColumn("h", h).withColumn("donor", F.expr(f"conv - conv % {FAMILY}"))
    heads = at.where(f"conv % {FAMILY} = 0 and at < {HEADS}").select(F.col("conv").alias("donor"), "at", "said", "words")
    heads = heads.groupBy("donor").agg(F.sort_array(F.collect_list(F.struct("at", "said", "words"))).alias("heads"))
    convs = convs.join(heads, "donor", "left").withColumn("heads", F.expr("filter(coalesce(heads, array()), x -> x.at <= h)"))
    convs = written(spark, convs.select("conv", "own", "many", "h", "heads", F.size("heads").alias("taken")), "conversations")
    given = convs.select("conv", F.lit(0).alias("block"), "many", F.explode("heads").alias("t"))
    given = given.select("conv", "block", "many", F.col("t.at").alias("depth"), "t.said", "t.words")
    own = at.drop("many").join(convs.select("conv", "many", "h", "taken"), "conv").where("at > h")
    own = own.select("conv", "block", "many", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "said", "words")
    lengths = convs.select("conv", "many", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return given.union(own), lengths


def perfect_slots(keys: np.ndarray) -> tuple[list[tuple[np.ndarray, int]], int]:
    """A minimal perfect hash of distinct uint64 ``keys``: per level the ranks of the keys alone in their cell.

    Keys that share a cell go on to the next level; a level has a cell and a quarter for each of its keys.
    """
    levels, placed_so_far, left = [], 0, keys
    while len(left):
        size = len(left) + len(left) // 4 + 1
        cell = cells(left, len(levels), size)
        alone = np.bincount(cell, minlength=size) == 1
        ranks = np.where(alone, np.cumsum(alone) - 1 + placed_so_far, -1)
        levels.append((ranks, size))
        placed_so_far += int(alone.sum())
        left = left[~alone[cell]]
    return levels, placed_so_far


def cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def slots_of(levels: list[tuple[np.ndarray, int]], keys: np.ndarray) -> np.ndarray:
    """Slots of ``keys``; a key that the table wasn't built for gets some slot or -1."""
    slots, open_keys = np.full(len(keys), -1, np.int64), np.arange(len(keys))
    for level, (ranks, size) in enumerate(levels):
        found = ranks[cells(keys[open_keys], level, size)]
        slots[open_keys] = found
        open_keys = open_keys[found < 0]
    return slots


def key_of(depth: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return mixed(x.view(np.uint64) ^ mixed(y.view(np.uint64) + depth.astype(np.uint64)))


def subtree_sums(rows: pa.Table) -> pa.Table:
    """For the distinct nodes of a shard's rows the leaves and saved tokens that the shard owns below each.

    Rows are (depth, x, y, up_x, up_y, leaves, saved), leaves and saved counting once per node over all shards. Every
    node gets a slot of the shard's minimal perfect hash, checked against the stored digests; counts are scattered into
    flat arrays by slot and added to the parents' slots, the deepest nodes first.
    """
    depth, x, y, up_x, up_y, leaves, saved = (rows.column(c).to_numpy() for c in [*NODE, *UP, "leaves", "saved"])
    key = key_of(depth, x, y)
    levels, n = perfect_slots(np.unique(key))
    slot = slots_of(levels, key)
    node_depth, node_x, node_y, parent = (np.zeros(n, np.int64) for _ in range(4))
    node_depth[slot], node_x[slot], node_y[slot] = depth, x, y
    if not (np.array_equal(node_depth[slot], depth) and np.array_equal(node_x[slot], x) and np.array_equal(node_y[slot], y)):
        raise ValueError("two prefix digests share a slot")
    # The first turn of a block has its parent in another shard, if it isn't the root.
    up = slots_of(levels, key_of(depth - 1, up_x, up_y))
    known = up >= 0
    known[known] = (node_depth[up[known]] == depth[known] - 1) & (node_x[up[known]] == up_x[known]) & (node_y[up[known]] == up_y[known])
    parent[slot] = -1
    parent[slot[known]] = up[known]
    totals = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
    for total, amount in zip(totals, (leaves, saved)):
        np.add.at(total, slot, amount)
    order = np.argsort(-node_depth, kind="stable")
    order = order[parent[order] >= 0]
    ends = np.flatnonzero(np.diff(node_depth[order])) + 1
    for level in np.split(order, ends):
        for total in totals:
            np.add.at(total, parent[level], total[level])
    return pa.table({"depth": node_depth, "x": node_x, "y": node_y, "n_leaves": totals[0], "saved_tokens": totals[1]})


def end_hashes(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """NODE and the SHA-256 of the ascending ids, comma-joined, of the conversations (NODE, conv) that end there.

    Ids of one node are joined in blocks, and the blocks pass by the hash in order, one at a time.
    """
    cut = in_blocks(spark, ends, NODE, "conv", BLOCK_ROWS, "block")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = cut.groupBy(*NODE, "block").agg(ids.alias("ids")).repartition(*NODE).sortWithinPartitions(*NODE, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*NODE, "ends_sha256"])

        for batch in batches:
            for depth, x, y, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if node == (depth, x, y):
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (depth, x, y), hashlib.sha256()
                state.update(text.encode())
            yield out()
            done.clear()
        if node is not None:
            done.append((*node, state.hexdigest()))
            yield out()

    return chunks.select(*NODE, "ids").mapInArrow(run, "depth long, x long, y long, ends_sha256 string")


def trie(
    spark: SparkSession,
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every prefix node.

    Turns go by ``turn``, null first, ties by a digest of role and text; null roles and texts are empty. Rows without
    conversation belong to none and are left out. Each conversation is rebuilt as ``rebuilt`` says; a node is a distinct sequence
    of first turns, the root the empty one. ``conv_id`` is its smallest member, ``parent_conv_id`` its
    parent's, null at the root; ``n_leaves`` counts the childless nodes of its subtree and ``saved_tokens`` sums there the words of
    each node's last turn times its members but one; ``ends_sha256`` hashes the members that end at it. Repeated rows are turns of their own. An
    empty table has no nodes. Other columns are ignored.

    A prefix is named by its depth and 128 bits that combine a digest of each (place, turn), so that long
    conversations are scanned in blocks. Nodes come from sums with partial counts per task; that all
    members of one have the same last turn is checked, so by induction equal names are equal prefixes, and
    a collision ends the job. Conversations are dealt to shards of bounded size; a node's own
    counts go to the shard of its smallest member, which holds all nodes above it, every shard adds up its part of the trie,
    and the parts are summed. A turn sequence that millions share is thus one row per shard.
    """
    turns, lengths = rebuilt(spark, turns_of(conversations, conv_id, turn, role, text))
    x, y = lanes(F.col("depth"), F.col("said"))
    turns = turns.withColumns({"own_x": x, "own_y": y})
    xor = {n: F.bit_xor(f"own_{n}") for n in "xy"}
    join = {n: (F.bit_xor(f"__{n}"), lambda a, b: a.bitwiseXOR(F.coalesce(b, F.lit(0)))) for n in "xy"}
    paths = scanned(spark, turns, [F.col("depth")], xor, xor, join)
    paths = paths.withColumns({f"up_{n}": F.col(n).bitwiseXOR(F.col(f"own_{n}")) for n in "xy"}).drop("own_x", "own_y")
    zero = F.lit(0).cast("long")
    root = lengths.select("conv", F.lit(0).alias("block"), "many", *[zero.alias(c) for c in ("depth", "words", "x", "y", "up_x", "up_y")], "length", F.lit("").alias("said"))
    paths = paths.join(lengths.drop("many"), "conv").withColumn("depth", F.col("depth").cast("long")).unionByName(root)
    paths = written(spark, paths, "paths")

    check = F.xxhash64(F.lit(3), "said")
    nodes = paths.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv").alias("owner"),
        F.min("words").alias("words"),
        F.sum((F.col("depth") == F.col("length")).cast("long")).alias("ends"),
        *[F.min(c).alias(c) for c in UP],
        F.min(check).alias("least"),
        F.max(check).alias("most"),
    )
    nodes = written(spark, nodes, "nodes")
    if nodes.where("least != most").limit(1).count():
        raise ValueError("two prefixes share a name")
    shared = nodes.select(*NODE, "owner", "n_convs", (F.col("ends") == F.col("n_convs")).alias("leaf"), F.col("words").alias("node_words"))
    owned = F.col("owner") == F.col("conv")
    counted = paths.join(shared, NODE).select(
        "conv", "block", "many", *NODE, *UP, (owned & F.col("leaf")).cast("long").alias("leaves"),
        F.when(owned, (F.col("n_convs") - 1) * F.col("node_words")).otherwise(F.lit(0)).alias("saved"),
    )
    counted = written(spark, counted, "counted")
    total = counted.count()
    # What later blocks of a long conversation own counts at the last turn of each earlier block; each block is a shard.
    own = {"leaves": F.sum("leaves"), "saved": F.sum("saved")}
    blocks = counted.where("many").groupBy("conv", "block").agg(*[v.alias(n) for n, v in own.items()], F.max("depth").alias("depth"))
    blocks = written(spark, blocks, "block-totals")
    later = before_block(blocks, ["conv"], "block", {f"later_{n}": F.sum(n) for n in own}, reverse=True).dropna()
    later = written(spark, later.join(blocks.select("conv", "block", "depth"), ["conv", "block"]), "later")
    counted = beside(counted, later, ["conv", "block", "depth"], "left", later.count())
    counted = counted.withColumns({n: F.col(n) + F.coalesce(f"later_{n}", F.lit(0)) for n in own})
    shards = max(1, -(-total // SHARD_ROWS))
    shard = {
        "shard": F.when(~F.col("many"), F.pmod(F.xxhash64("conv"), F.lit(shards))),
        "alone": F.when(F.col("many"), F.col("conv")),
        "piece": F.when(F.col("many"), F.col("block")),
    }
    dealt = counted.withColumns(shard).select(*shard, *NODE, *UP, "leaves", "saved").groupBy(*shard)
    schema = "depth long, x long, y long, n_leaves long, saved_tokens long"
    parts = dealt.applyInArrow(subtree_sums, schema)
    sums = parts.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("owner").alias("parent_conv_id"))
    ends = end_hashes(spark, paths.where("depth = length").select(*NODE, "conv"))
    out = nodes.join(sums, NODE).join(children, NODE, "left").join(ends, NODE, "left").join(parents, ["depth", *UP], "left")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
