"""Recall of the vector index on a table of which a query visits a small share, with a hot cell of copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlark.llm import vector_search


def test_recall_where_the_index_prunes(spark, monkeypatch):
    random = np.random.default_rng(6)
    n, hot, d = 104_000, 8_000, 16
    centres = random.normal(size=(400, d))
    points = centres[random.integers(0, 400, n)] + 0.25 * random.normal(size=(n, d))
    points /= np.linalg.norm(points, axis=1)[:, None]
    ids = np.arange(n)
    copies = random.choice(n, hot, replace=False)
    points[copies] = points[copies[0]]
    # Queries beside the hot cell, whose true neighbours partly lie in the next cells, and others.
    asked = np.setdiff1d(ids[ids % 400 == 0], copies)
    beside = asked[:60]
    points[beside] = points[copies[0]] + 0.25 * random.normal(size=(60, d))
    points[beside] /= np.linalg.norm(points[beside], axis=1)[:, None]
    # Some that score above the copies for these queries, yet are not in their cell.
    near = np.setdiff1d(ids, np.concatenate([copies, asked]))[: 60 * 12]
    points[near] = np.repeat(points[beside], 12, axis=0) + 0.05 * random.normal(size=(720, d))
    points[near] /= np.linalg.norm(points[near], axis=1)[:, None]

    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d), pa.int32()), pa.array(points.ravel()))
    table = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": flat})).repartition(8)
    visited = []
    real = vector_search.visits_needed
    monkeypatch.setattr(vector_search, "visits_needed", lambda e, i, *a: visited.append((real(e, i, *a), i.count)) or visited[-1][0])
    got = vector_search.search(spark, table, F.col("id").isin(asked.tolist()), k=20).toPandas()
    found = {q: set(part) for q, part in got.groupby("query_id")["vec_id"]}
    shares = []
    for q in asked:
        scores = points @ points[q]
        top = [i for i in vector_search.best(scores, ids, 21) if i != q][:20]
        shares.append(len(found[q] & set(top)) / 20)
    cells, count = visited[0]
    print("recall", np.mean(shares), "beside", np.mean(shares[:60]), "cells", cells, "of", (count > 0).sum())
    assert np.mean(shares) >= 0.9 and np.mean(shares[:60]) >= 0.9
    assert cells < 0.25 * (count > 0).sum()
