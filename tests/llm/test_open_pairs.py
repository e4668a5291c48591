"""Pairs that leaders leave open, against brute force, and their number in a family whose members differ each in their own way."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm.graph import FEW, clusters, open_pairs, written


def alike(x, y, percent):
    return 100 * len(x & y) >= percent * len(x | y)


@pytest.mark.parametrize("percent", [75, 80])
def test_open_pairs_lose_no_link(spark, percent):
    rnd = random.Random(5)
    origin, poor = list(range(60)), list(range(1000, 1060))
    sets = {0: set(origin), 1: set(poor)}
    for node in range(2, 150):
        base = list(rnd.choice((origin, origin, poor)))
        for at in rnd.sample(range(60), rnd.choice((2, 5, 7, 9, 14))):
            base[at] = rnd.choice((at * 10 + 5000, at * 10 + 5001, rnd.randrange(10_000, 90_000)))
        sets[node] = set(base[rnd.randrange(30) :])
    parts = {n: 0 if alike(s, sets[0], percent) else n for n, s in sets.items()}
    outer = {n: int(p != 0) for n, p in parts.items()}
    nodes = spark.createDataFrame([(n, parts[n], outer[n]) for n in sets], "node long, part long, outer int")
    table = spark.createDataFrame([(n, sorted(s)) for n, s in sets.items()], "node long, hashes array<long>")
    got = {tuple(r) for r in open_pairs(spark, nodes, table, percent).collect()}
    pairs = {(a, b) for a in sets for b in sets if a > b and parts[a] != parts[b]}
    links = {p for p in pairs if alike(sets[p[0]], sets[p[1]], percent)}
    assert links and links <= got <= pairs


def test_family_of_thousands_makes_few_pairs(spark):
    """3,000 variants of one text, a third of them too far from it to be linked, none linked with one another."""
    rnd = random.Random(6)
    origin = set(range(200))
    sets = {0: origin}
    for node in range(1, 3_000):
        gone = rnd.choice((10, 15, 40))
        sets[node] = origin - set(rnd.sample(range(200), gone)) | {node * 1_000 + 10_000 + i for i in range(gone)}
    table = spark.createDataFrame([(n, sorted(s)) for n, s in sets.items()], "node long, hashes array<long>")
    table = written(spark, table, "sets")
    compared = []

    def confirm(pairs):
        pairs = written(spark, pairs, "pairs")
        compared.append(pairs.count())
        met = pairs.join(table.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
        met = met.join(table.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return written(spark, met.where(100 * common >= 75 * (F.size("x") + F.size("y") - common)).select("a", "b"), "links")

    rows = table.select(F.explode(F.array(F.lit("k"), F.lit("m"))).alias("key"), "node")
    found = clusters(spark, rows, confirm, lambda wanted: table.join(wanted, "node"), 75).collect()
    near = {n for n, s in sets.items() if alike(s, origin, 75)}
    assert {r.node for r in found} == near - {0} and {r.component for r in found} == {0}
    assert sum(compared) < 12 * len(sets)


@pytest.mark.parametrize("once", [False, True])
def test_few_nodes_of_a_key_are_compared_without_their_elements(spark, once):
    """Keys of two nodes are done after one pair, keys of up to FEW after all; only larger ones need sets."""
    rnd = random.Random(7)
    origin = set(range(100))
    sets, rows = {}, []
    for key in range(60):
        size = rnd.choice((2, 2, 3, 4, FEW))
        for node in range(10 * key, 10 * key + size):
            gone = rnd.sample(range(100), rnd.choice((5, 11, 30)))
            sets[node] = (origin - set(gone)) | {10_000 + 100 * node + i for i in range(len(gone))}
            rows += [(key, node)] * (1 + once * rnd.randrange(3))
    sets[999], rows = {1}, rows + [(99, 999)] * (1 + 2 * once)
    table = written(spark, spark.createDataFrame([(n, sorted(s)) for n, s in sets.items()], "node long, hashes array<long>"), "sets")
    asked = []

    def confirm(pairs):
        pairs = written(spark, pairs, "pairs")
        met = pairs.join(table.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
        met = met.join(table.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return written(spark, met.where(100 * common >= 80 * (F.size("x") + F.size("y") - common)).select("a", "b"), "links")

    def wanted_sets(wanted):
        asked.append(wanted.count())
        return table.join(wanted, "node")

    found = clusters(spark, spark.createDataFrame(rows, "key long, node long"), confirm, wanted_sets, 80, once=once)
    got = {r.node: r.component for r in found.collect()}
    part = {n: n for n in sets}
    for _ in sets:
        for a in sets:
            for b in range(a // 10 * 10, a):
                if b in sets and alike(sets[a], sets[b], 80):
                    part[a] = part[b] = min(part[a], part[b])
    assert {n: got.get(n, n) for n in sets} == part and any(n != p for n, p in part.items())
    assert sum(asked) == 0
