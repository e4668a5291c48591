"""Texts are indexed once whatever the number of query blocks, and tiles of queries find what brute force finds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import text_search

EVERY = np.full((1 << text_search.FILTER) // 8, 255, np.uint8)


def random_texts(random, rows, words):
    share = 1 / np.arange(1, words + 1)
    return [random.choice(words, random.integers(1, 60), p=share / share.sum()) for _ in range(rows)]


def test_rows_are_read_once_for_all_blocks_of_queries(spark, monkeypatch):
    read, inner = spark.sparkContext.accumulator(0), text_search.word_hashes

    def counted(column):
        read.add(len(column))
        return inner(column)

    texts = random_texts(np.random.default_rng(1), 60, 30)
    rows = [(i, " ".join(f"w{w}" for w in t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    whole = text_search.search(spark, docs, F.col("doc_id") % 5 == 0).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(text_search, "word_hashes", counted)
    monkeypatch.setattr(text_search, "QUERIES", 2)
    monkeypatch.setattr(text_search, "FIRST", 1)
    monkeypatch.setattr(text_search, "SHARD", 7)
    parts = text_search.search(spark, docs, F.col("doc_id") % 5 == 0).orderBy("query_id", "rank").collect()
    assert read.value == 60 + 12
    assert len(whole) == 120
    assert [r[:3] for r in parts] == [r[:3] for r in whole]


@pytest.mark.parametrize("common", [0, 3, 40])
def test_tiles_equal_brute_force(monkeypatch, common):
    for name, value in (("COMMON", common), ("TILE", 5), ("FEW", 2), ("BLOCK", 4), ("ORDERING", 3)):
        monkeypatch.setattr(text_search, name, value)
    random = np.random.default_rng(common)
    texts = random_texts(random, 150, 200)
    # Many copies of one text, and ids that come twice.
    texts[20:60] = [texts[20]] * 40
    ids = np.arange(150)
    ids[100:110] = ids[40:50]
    hashed = random.integers(0, 1 << 64, 200, dtype=np.uint64)
    lengths = np.array([len(t) for t in texts])
    count = np.array([np.bincount(t, minlength=200) for t in texts])
    df = (count > 0).sum(0)
    idf = np.log(1 + (150 - df + 0.5) / (df + 0.5))
    norm = text_search.K1 * (1 - text_search.B + text_search.B * lengths / lengths.mean())
    impact = count * (text_search.K1 + 1) / (count + norm[:, None])
    asked = np.arange(0, 150, 6)
    asked = asked[asked < 100]
    row, term = np.nonzero(count[asked])
    weight = count[asked][row, term] * idf[term]
    laid_out = text_search.laid_out(ids[asked][row], hashed[term].view(np.int64), weight, df[term], 150)
    assert len(laid_out[-1]) <= common
    queries = text_search.Queries(*[laid_out[i] for i in (1, 0, 2, 3, 4, 5)], np.zeros(len(asked)), 5)
    postings = 0
    for at in range(0, 150, 50):
        part = slice(at, at + 50)
        bounds = np.concatenate([[0], np.cumsum(lengths[part])])
        record = text_search.indexed(ids[part], hashed[np.concatenate(texts[part])], bounds, EVERY)
        shard = text_search.Shard.read({n: record.column(n)[0] for n in record.schema.names}, queries.wanted, lengths.mean(), 5)
        postings += len(shard.row)
        queries.ask(shard)
    # Copies beyond those that can be among the best are not searched.
    assert postings < (count[:, df > 0] > 0).sum() - 20 * (count[20] > 0).sum()
    assert sorted(queries.names) == sorted(ids[asked])
    for name, found, scores in zip(queries.names, queries.ids, queries.scores):
        score = np.where(ids == name, 0, impact @ (count[asked[ids[asked] == name][0]] * idf))
        best = [i for i in np.lexsort((ids, -score.round(9)))[:5] if score[i] > 0]
        assert found.tolist() == ids[best].tolist()
        assert np.allclose(scores, score[best], rtol=1e-12)


def test_words_alike_but_for_their_last_bits_stay_apart():
    words = np.array([5, 4, 5, 1 << 40, (1 << 40) + 1, 4], np.uint64)
    row, terms, count = text_search.term_rows(words, np.array([0, 3, 4, 6]))
    assert list(zip(row.tolist(), terms.tolist(), count.tolist())) == [
        (0, 4, 1), (2, 4, 1), (0, 5, 2), (1, 1 << 40, 1), (2, (1 << 40) + 1, 1),
    ]
