"""Distributed union-find over an edge table, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.functions.scratch import scratch_dir


def written(spark: SparkSession, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written below the shared scratch folder and read again: cuts lineage, survives executors."""
    path = scratch_dir(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long) except a component's smallest node.

    The component is its smallest node. Large-star and small-star steps alternate until nothing moves:
    each links a node's neighbours to the smallest of them. Minima combine on the map side, and a hub's
    neighbours meet its minimum in a join that adaptive execution may split.

    Null ends and loops are ignored; repeated and reversed edges count once; no edges give no rows.
    """
    a, b = F.col("a"), F.col("b")
    plain = edges.where((a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = written(spark, plain, "edges")
    seen = state(now)
    while seen[0]:
        both = now.union(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        now = written(spark, linked.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, seen = seen, state(now)
        if before == seen:
            break
    return now.select(a.alias("node"), b.alias("component"))


def beside(df: DataFrame, small: DataFrame, on: str, rows: int, most: int = 1_000_000) -> DataFrame:
    """``df`` joined with ``small``, which is broadcast if its counted rows are at most ``most`` and else shuffled."""
    return df.join(F.broadcast(small) if rows <= most else small, on)


#: Times that the members of open keys meet a leader before they meet one another.
LEADERS = 3
#: Members up to which an open key's pairs are compared outright: at most (FEW - 1) / 2 for each of its rows.
FEW = 6


def clusters(
    spark: SparkSession,
    rows: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    sets: Callable[[DataFrame], DataFrame],
    percent: int,
    once: bool = False,
) -> DataFrame:
    """(node, component), as ``components``, of the nodes that share a key in ``rows`` (key, node) and are confirmed.

    ``confirm`` takes distinct candidate pairs (a, b) and returns those that are linked, written: those whose sets
    have a Jaccard similarity of ``percent`` per cent or more. ``sets`` takes nodes (node) and returns (node,
    hashes), their sets without repeats. First each node meets one leader in each key it has, the node that meets most others over
    all its keys: among the copies of one original that is the original, or the copy closest to the rest. So
    a key with thousands of alike nodes costs a pair for each. Keys that still hold more than one component are
    open. A key of two nodes never is, as its one pair has been compared; open keys of up to FEW nodes compare all pairs
    across components. In larger ones nodes outside the leader's component meet a leader of their own, LEADERS times
    at most, and what is then open meets by the rare elements of its sets (``open_pairs``). Every pair that shares a key
    and can be linked is thus joined or compared; none is capped.
    ``once`` deals ``rows`` out a single time and counts over windows, where rows are costly to make or
    many, and they may repeat; otherwise counts combine on the map side and adaptive execution may split the join with them.
    """
    if once:
        same = Window.partitionBy("key")
        ends = rows.select("key", "node", F.min("node").over(same).alias("lo"), F.max("node").over(same).alias("hi"))
        # Few rows are left here, and they lie by key already.
        shared = ends.where("lo < hi").select("key", "node").distinct()
        counted = shared.select("key", "node", F.count("*").over(same).alias("met"))
    else:
        met = rows.groupBy("key").agg(F.count("*").alias("met")).where("met > 1")
        counted = rows.join(met, "key")
    counted = written(spark, counted, "members")
    hubs = counted.groupBy("node").agg(F.sum("met").alias("hub"))
    members = counted.select("key", "node").join(hubs, "node")
    links = tried = first = None
    for turn in range(LEADERS):
        if turn:
            # Members outside the last leader's component, in keys that have such.
            members = members.where("part != top").select("key", "node", "hub")
        leaders = members.groupBy("key").agg(F.max_by("node", "hub").alias("leader"))
        members = written(spark, members.select("key", "node", "hub").join(leaders, "key"), "led")
        pairs = members.where("node != leader").select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))
        if turn == 1:
            pairs = pairs.union(pairs_across(first.where(F.col("met") <= FEW)))
        pairs = pairs.distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(spark, pairs, "tried")
        tried = pairs if tried is None else tried.union(pairs)
        new = confirm(pairs)
        if links is None or not new.isEmpty():
            links = new if links is None else links.union(new)
            joined = components(spark, links)
        members = members.drop("part", "top").join(joined, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
        tops = members.where("node = leader").select("key", F.col("part").alias("top"))
        members = written(spark, members.join(tops, "key"), "placed")
        if turn == 0:
            mixed_keys = members.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("met"))
            mixed_keys = mixed_keys.where("lo < hi and met > 2").select("key", "met")
            first = written(spark, members.join(mixed_keys, "key"), "open")
            members = first.where(F.col("met") > FEW)
            if first.isEmpty():
                return joined
        elif members.where("part != top").isEmpty():
            break
    # A larger key is open if it was after the first leaders and has more than one component now.
    part = F.coalesce("component", "node")
    parts = first.where(F.col("met") > FEW).select("key", "node").join(joined, "node", "left").select("key", "node", part.alias("part"))
    spread = parts.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.mode("part").alias("top")).where("lo < hi")
    parts = parts.join(spread.select("key", "top"), "key")
    # Of two nodes of different parts in a key, one at least is outside its commonest part.
    nodes = parts.groupBy("node").agg(F.first("part").alias("part"), F.max((F.col("part") != F.col("top")).cast("int")).alias("outer"))
    nodes = written(spark, nodes, "open-nodes")
    across = open_pairs(spark, nodes, sets(nodes.select("node")), percent)
    more = confirm(across.join(tried, ["a", "b"], "left_anti"))
    return joined if more.isEmpty() else components(spark, links.union(more))


def pairs_across(members: DataFrame) -> DataFrame:
    """The pairs (a > b) of nodes of different parts that share a key in ``members`` (key, node, part)."""
    x, y = (members.select("key", F.col("node").alias(end), F.col("part").alias(f"part_{end}")) for end in "ab")
    return x.join(y, "key").where("a > b and part_a != part_b").select("a", "b")


def open_pairs(spark: SparkSession, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a > b) of ``nodes`` (node, part, outer), of different parts and one at least outer, that may be linked.

    Each set of ``sets`` (node, hashes) is ordered from its rarest to its commonest element. Two sets of n >= m
    elements with a Jaccard similarity of t = ``percent`` per cent share t / (1 + t) * (n + m) elements, so their
    first common element has at most that much less than n and m elements before it. An element at a place with r
    elements from it on admits partners of at most r * (1 + t) / t - n elements. Elements with their places meet by equal
    element and by a step of sizes, of which the larger set takes all that its place admits. So the members of a
    family, who differ from it each in their own elements, don't meet at what the family shares, and no
    pair that can be linked is left out. Elements that only one set has are counted, not joined.
    """
    step = "cast(floor(20 * ln({})) as int)"
    tokens = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("met")).where("met > 1")
    common = tokens.join(counts, "token").groupBy("node", "n")
    common = common.agg(F.sort_array(F.collect_list(F.struct("met", "token"))).alias("common"))
    least = F.expr(f"cast(ceil(n * {percent} / 100) as int)")
    # Places count from 0; an element later than n - least can't be the first of enough.
    common = common.withColumn("single", F.col("n") - F.size("common")).withColumn("least", least)
    prefix = F.slice("common", F.lit(1), F.greatest(F.lit(0), F.col("n") - F.col("least") + 1 - F.col("single")))
    places = common.select("node", "n", "single", "least", F.posexplode(prefix).alias("at", "element"))
    most = F.floor((F.col("n") - F.col("single") - F.col("at")) * ((100 + percent) / percent) - F.col("n") + 1e-6)
    places = places.select("node", "n", "least", F.col("element.token").alias("token"), most.alias("most")).where("most >= least")
    places = written(spark, places.join(nodes, "node"), "places")
    # The smaller set's place must admit sets of its own size at least, the larger one takes the steps below it.
    small = places.where("most >= n").selectExpr("token", f"{step.format('n')} AS size", "node AS y", "part AS q", "n AS m", "most AS most_y", "outer AS outer_y")
    sizes = f"explode(sequence({step.format('least')}, {step.format('least(n, most)')}))"
    large = places.selectExpr("token", f"{sizes} AS size", "node AS x", "part AS p", "n", "least", "most", "outer")
    fits = "p != q and m <= n and m >= least and m <= most and n <= most_y and (m < n or x != y)"
    ends = [F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")]
    one = large.join(small.where("outer_y = 1"), ["token", "size"]).where(fits).select(*ends)
    other = large.where("outer = 1").join(small.where("outer_y = 0"), ["token", "size"]).where(fits).select(*ends)
    return one.union(other).distinct()
