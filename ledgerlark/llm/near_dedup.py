"""Near-copies of documents by HyperMinHash sketches, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.scratch import scratch_dir
from ledgerlark.llm.graph import clusters, written
from ledgerlark.llm.text import Minima, factors, mixed, shingle_sets
from ledgerlark.sources.tables import drop_folder

BANDS, ROWS = 64, 6
MANTISSA_BITS = 10
SHINGLE = 5

SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("registers", T.BinaryType()),
    ]
)


def compressed(minima: np.ndarray) -> np.ndarray:
    """Registers of 32-bit minima: the count of leading zeros, then the MANTISSA_BITS bits after the first one."""
    fraction, exponent = np.frexp(minima.astype(np.float64))
    zeros = (32 - exponent).astype(np.uint16)
    mantissa = np.maximum((2 * fraction - 1) * (1 << MANTISSA_BITS), 0).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA_BITS)) | mantissa


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) for each band of the rows (node, registers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS)
            keys = mixed((grid * factors(ROWS)).sum(axis=2, dtype=np.uint64) + factors(BANDS)).view(np.int64)
            node = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["key", "node"])

    return nodes.select("node", "registers").mapInArrow(run, "key long, node long")


def node_of(hashes: np.ndarray) -> int:
    """A 64-bit name of a shingle set; equal sets share it."""
    name = mixed(np.array([mixed(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64))
    return int(name.view(np.int64)[0])


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, node (name of the shingle set) and registers; the last two null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = Minima(BANDS * ROWS)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes, nodes, registers = [], [], []
                for hashes in shingle_sets(batch.column(1), SHINGLE):
                    sizes.append(len(hashes))
                    if not len(hashes):
                        nodes.append(None)
                        registers.append(None)
                        continue
                    nodes.append(node_of(hashes))
                    registers.append(compressed(minima(hashes)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.array(registers, pa.binary()),
                    ],
                    names=SKETCH.fieldNames(),
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SKETCH)


def collision_chance(n: float | np.ndarray, m: float | np.ndarray) -> float | np.ndarray:
    """Chance that a register of two disjoint sets of n and m elements is equal.

    A minimum in octave [2**-k-1, 2**-k) falls into a cell of width 2**-k-1-MANTISSA_BITS; for minima with
    rates n and m the chance of a common cell, averaged over octaves, is n * m / (n + m)**2 / (2 * ln 2 * 2**r).
    """
    return n * m / (n + m) ** 2 / (2 * np.log(2) * (1 << MANTISSA_BITS))


def estimates(pairs: DataFrame) -> DataFrame:
    """Add ``estimate``, the collision-corrected Jaccard estimate, to pairs with both sides' registers and sizes."""
    out = T.StructType([*pairs.select("a", "b", "n_a", "n_b").schema.fields, T.StructField("estimate", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                for c in ("r_a", "r_b")
            )
            n, m = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
            chance = collision_chance(n, m)
            found = ((left == right).mean(axis=1) - chance) / (1 - chance)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("a", "b", "n_a", "n_b")] + [pa.array(found)], names=out.fieldNames()
            )

    return pairs.mapInArrow(run, out)


def linked(percent: int) -> Column:
    """100 * intersection >= percent * union, on the full sets."""
    common = F.size(F.array_intersect("h_a", "h_b"))
    return 100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)


def near_copies(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Documents whose sets of five-word shingles have a Jaccard similarity of ``percent`` per cent or more
    are linked, and a component is everything that links connect. Equal sets meet first, so copies cost
    one row each afterwards. The sketches of the different sets are HyperMinHash registers; ROWS of them
    form each of BANDS band keys, which makes a missed pair at 0.75 a matter of 3 in a million. Sets of
    one bucket are compared with a leader of the bucket; then, only in buckets that still hold more than
    one component, with leaders of the rest and at last by the rare shingles of their full sets. So a bucket of
    thousands of near copies yields a row each, and no pair that shares a bucket is left out. Pairs whose corrected estimate is more than five standard
    errors below the threshold go; the others are decided on their full sets.

    Texts without words have no shingles and link with nothing: they are their own component. A null text
    counts as empty. Rows without doc_id link with nothing, and have a null component and kept true.
    Rows that repeat a doc_id each get a row; equal texts share a component. ``kept`` marks the rows whose
    doc_id is their component's smallest. Columns other than the two named are ignored. Empty input
    gives no rows.
    """
    folder = scratch_dir(spark, "sketches")
    sketches(docs, doc_id, text).write.parquet(folder)
    sketched = spark.read.schema(SKETCH).parquet(folder)
    usable = sketched.where("doc_id is not null and node is not null")
    nodes = written(
        spark,
        usable.groupBy("node").agg(
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"),
        ),
        "nodes",
    )
    # From here on registers are read by node, so those by document need no disk.
    sketched = written(spark, sketched.select("doc_id", "n_shingles", "node"), "members")
    drop_folder(spark, folder)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = clusters(
        spark,
        band_rows(nodes),
        lambda pairs: confirmed(spark, pairs, nodes, texts, percent),
        lambda wanted: sets_of(wanted, nodes, texts),
        percent,
    )
    parts = nodes.join(joined, "node", "left").select(
        "node", F.coalesce("component", "node").alias("part"), "first_id"
    )
    smallest = parts.groupBy("part").agg(F.min("first_id").alias("smallest"))
    named = parts.join(smallest, "part").select("node", "smallest")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return (
        sketched.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
        .join(named, "node", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def confirmed(
    spark: SparkSession, pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int
) -> DataFrame:
    """The pairs (a, b) of nodes that are linked, written: estimated on registers, then decided on full sets."""
    sides = {
        s: nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))
        for s in "ab"
    }
    share = percent / 100
    slack = 5 * (share * (1 - share) / (BANDS * ROWS)) ** 0.5
    likely = written(
        spark,
        estimates(pairs.join(sides["a"], "a").join(sides["b"], "b"))
        .where((F.col("estimate") >= share - slack) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
        .drop("estimate"),
        "likely",
    )
    wanted = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
    sets = written(spark, sets_of(wanted, nodes, texts), "shingle_sets")
    compared = likely.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("h_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("hashes").alias("h_b")), "b"
    )
    return written(spark, compared.where(linked(percent)).select("a", "b"), "links")


def sets_of(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, hashes) of the nodes ``wanted``, from a text that has each."""
    holders = wanted.join(nodes.select("node", "first_id"), "node").select("node", F.col("first_id").alias("doc_id"))
    # A repeated doc_id may bring other texts: the set must have the node's own name.
    return own_sets(texts.join(holders, "doc_id").select("node", "text"))


def own_sets(named: DataFrame) -> DataFrame:
    """(node, hashes), one row per node, of the texts whose set has that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                names, sets = [], []
                for name, hashes in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), SHINGLE)):
                    if len(hashes) and node_of(hashes) == name:
                        names.append(name)
                        sets.append(hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"]
                )

    return named.mapInArrow(run, "node long, hashes array<long>").dropDuplicates(["node"])
