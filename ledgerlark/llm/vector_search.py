"""Approximate nearest neighbours by an inverted multi-index: two halves quantised separately."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.llm.graph import written

#: Vectors that the centroids are fitted on, at most about this many; every vector is indexed.
SAMPLE = 32_768
#: Centroids of each half, at most; so there are at most MOST ** 2 cells.
MOST = 1_024
#: Entries a cell has on average.
OCCUPANCY = 32
#: Share of the true neighbours that trial queries must find; and their number, at most about this.
RECALL, TRIALS = 0.95, 128
#: Vectors of one cell that are kept together, and vectors of one task's group.
BLOCK, REGION = 2_048, 8_192


def usable(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v: array<double>) of the vectors that take part: of the commonest length, finite and not zero."""
    rows = table.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where("id is not null and v is not null and size(v) > 0")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    longest = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "d").first()
    rows = rows.where(F.size("v") == (longest["d"] if longest else 0))
    # The index needs two halves; a component of 0 leaves inner products as they are.
    return rows.withColumn("v", F.concat("v", F.array(F.lit(0.0)))) if longest and longest["d"] == 1 else rows


def centroids(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from a deterministic start."""
    random = np.random.default_rng(3)
    found = points[random.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, found)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(found)
        np.add.at(total, near, points)
        found[count > 0] = total[count > 0] / count[count > 0, None]
    return found


def nearest(points: np.ndarray, found: np.ndarray) -> np.ndarray:
    size, parts = (found**2).sum(axis=1), range(0, max(len(points), 1), BLOCK)
    return np.concatenate([(size - 2 * points[i : i + BLOCK] @ found.T).argmin(axis=1) for i in parts])


def stacked(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


class MultiIndex:
    """Centroids of both halves and the number of entries of each cell."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.first = centroids(np.ascontiguousarray(sample[:, : self.half]), k)
        self.second = centroids(np.ascontiguousarray(sample[:, self.half :]), k)
        self.count = np.zeros((k, k), dtype=np.int64)

    def cells(self, points: np.ndarray) -> np.ndarray:
        a, b = nearest(points[:, : self.half], self.first), nearest(points[:, self.half :], self.second)
        return a * len(self.second) + b

    def traverse(self, query: np.ndarray, visits: int, least: int) -> list[int]:
        """Cells with entries in order of the summed distance of both halves: ``visits``, or more until they hold ``least``.

        Distance is the negative inner product, so the sum is that of the query and the cell's centroid. A
        heap holds the next pairs of both halves' centroids, each half sorted by its own distance.
        """
        near, far = -(self.first @ query[: self.half]), -(self.second @ query[self.half :])
        rows, columns = near.argsort(kind="stable"), far.argsort(kind="stable")
        heap, seen, out, held = [(near[rows[0]] + far[columns[0]], 0, 0)], {(0, 0)}, [], 0
        while heap and (len(out) < visits or held < least):
            _, i, j = heapq.heappop(heap)
            count = int(self.count[rows[i], columns[j]])
            if count:
                out.append(int(rows[i] * len(columns) + columns[j]))
                held += count
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(rows) and y < len(columns) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (near[rows[x]] + far[columns[y]], x, y))
        return out


    def visits_to(self, query: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The number of cells that ``traverse`` has visited when it has been to each of ``cells``, ties last."""
        near, far = -(self.first @ query[: self.half]), -(self.second @ query[self.half :])
        distance = (near[:, None] + far[None, :]).ravel()
        held = np.sort(distance[self.count.ravel() > 0])
        return np.searchsorted(held, distance[cells], side="right")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def visits_needed(entries: DataFrame, index: MultiIndex, asked: DataFrame, k: int, recall: float) -> int:
    """Cells that a query must visit so that of the trials from ``asked`` (id, v) the share ``recall`` find that share of their k neighbours.

    The trials are compared with all ``entries``; each task keeps its k best a trial, the driver gets k a trial.
    """
    order = F.xxhash64(F.lit("trial"), "id")
    trials = asked.orderBy(order, "id").limit(TRIALS).toPandas()
    if not len(trials):
        return 1
    own, queries = trials["id"].to_numpy(), np.stack(trials["v"].to_numpy())

    def nearby(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64))] * len(own)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                ids, cells = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                scores = stacked(batch.column(1)) @ queries.T
                for t in range(len(own)):
                    other = np.flatnonzero(ids != own[t])
                    other = other[best(scores[other, t], ids[other], k)]
                    parts = zip(held[t], (scores[other, t], ids[other], cells[other]))
                    score, name, cell = (np.concatenate(p) for p in parts)
                    top = best(score, name, k)
                    held[t] = score[top], name[top], cell[top]
        trial = np.repeat(np.arange(len(own)), [len(h[0]) for h in held])
        score, name, cell = (np.concatenate([h[i] for h in held]) for i in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (trial, score, name, cell)], names=["trial", "score", "id", "cell"])

    found = entries.mapInArrow(nearby, "trial long, score double, id long, cell long")
    ranked = F.row_number().over(Window.partitionBy("trial").orderBy(F.desc("score"), "id"))
    found = found.withColumn("rank", ranked).where(F.col("rank") <= k).select("trial", "cell").toPandas()
    if not len(found):
        return 1
    needed = [share_of(index.visits_to(queries[t], cells.to_numpy()), recall) for t, cells in found.groupby("trial")["cell"]]
    return share_of(np.array(needed), recall)


def share_of(needed: np.ndarray, share: float) -> int:
    """The least number that ``share`` of ``needed`` don't exceed."""
    return int(np.sort(needed)[max(0, int(np.ceil(share * len(needed))) - 1)])


def search(
    spark: SparkSession,
    table: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k found with the largest inner product.

    Candidates are all rows that take part but the query's own id; ``is_query`` is a condition on the
    column ``id``. A query visits distinct cells of the multi-index, in order; for their number about TRIALS of the
    queries are tried, whose neighbours are also found exactly, and the share ``recall`` of these find that share of
    them; so the number grows with the table, and a cell of many copies counts as one. All entries of these
    cells are scored in double precision. Each vector is indexed; centroids are fitted on a sample of about
    SAMPLE. Cells with many vectors are split into blocks, so no task holds a
    cell; blocks and the queries that want them meet in groups of about REGION vectors.

    Vectors that are null, zero, of another length than most, or hold a null, NaN or infinity take no
    part, neither do rows without id. Ties go to the smaller id. Rows that repeat an id are candidates
    each; as queries they count once, with the first of their vectors. Too few vectors for an index make
    one cell. Columns other than the two named are ignored; an empty table gives no rows.
    """
    rows = written(spark, usable(table, vec_id, vector), "vectors")
    total = rows.count()
    size = int(min(MOST, max(1, round((total / OCCUPANCY) ** 0.5))))
    share = min(1.0, SAMPLE / max(total, 1))
    sampled = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20)).select("v").toPandas()
    if not len(sampled):
        sampled = rows.limit(1).select("v").toPandas()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = np.stack(sampled["v"].to_numpy())
    index = MultiIndex(points, min(size, len(points)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = pa.array(index.cells(stacked(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["id", "v", "cell"])

    entries = written(spark, rows.mapInArrow(assign, "id long, v array<double>, cell long"), "entries")
    counts = entries.groupBy("cell").count().toPandas()  # at most MOST ** 2
    index.count.flat[counts["cell"].to_numpy()] = counts["count"].to_numpy()
    asked = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    visits = visits_needed(entries, index, asked, k, recall)
    blocks = np.maximum(1, -(-index.count.ravel() // BLOCK))
    regions = max(1, -(-total // REGION))
    shared = spark.sparkContext.broadcast((index, blocks))

    def region(cell: np.ndarray, block: np.ndarray) -> np.ndarray:
        return (cell * 7919 + block * 104729) % regions

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, blocks = shared.value
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            block = (ids * 2654435761 % 1_000_003) % blocks[cell]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region(cell, block))], names=["id", "v", "cell", "region"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, blocks = shared.value
        for batch in batches:
            owner, wanted, at = [], [], []
            for row, query in enumerate(stacked(batch.column(1)) if batch.num_rows else ()):
                cells = np.array(index.traverse(query, visits, k + 1))
                spread = np.repeat(cells, blocks[cells])
                number = np.arange(len(spread)) - np.repeat(np.cumsum(blocks[cells]) - blocks[cells], blocks[cells])
                to = region(spread, number)
                for r in np.unique(to).tolist():
                    owner.append(row)
                    wanted.append(np.unique(spread[to == r]))
                    at.append(r)
            chosen = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(chosen), batch.column(1).take(chosen), pa.array(wanted, pa.list_(pa.int64())), pa.array(at, pa.int64())],
                names=["query_id", "q", "cells", "region"],
            )

    def score(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("cell")
            ids, cell, points = vectors["id"].to_numpy(), vectors["cell"].to_numpy(), np.stack(vectors["v"].to_numpy())
            for query_id, q, cells in zip(queries["query_id"], queries["q"], queries["cells"]):
                starts, ends = np.searchsorted(cell, cells), np.searchsorted(cell, cells, side="right")
                some = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)])
                some = some[ids[some] != query_id]
                scores = points[some] @ np.asarray(q)
                top = best(scores, ids[some], k)
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[some][top], "score": scores[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    placed = entries.mapInArrow(place, "id long, v array<double>, cell long, region long")
    asked = asked.mapInArrow(visit, "query_id long, q array<double>, cells array<long>, region long")
    found = (
        placed.groupBy("region")
        .cogroup(asked.groupBy("region"))
        .applyInPandas(score, "query_id long, vec_id long, score double")
    )
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
