"""Postings of blocks that cannot reach the threshold are not read, and the others give the same best rows."""

from __future__ import annotations

import numpy as np

from ledgerlark.llm import text_search


def test_only_blocks_that_reach_the_threshold_are_read(monkeypatch):
    random = np.random.default_rng(8)
    wanted = np.arange(1, 41, dtype=np.uint64)
    # Every row has common words; those of one block have the rare ones too.
    texts = [random.choice(wanted[:30], 25) for _ in range(text_search.SHARD)]
    own = range(5 * text_search.BLOCK, 6 * text_search.BLOCK)
    for row in own:
        texts[row] = np.concatenate([texts[row], wanted[30:][random.random(10) < 0.9]])
    bounds = np.cumsum([0] + [len(t) for t in texts])
    shard = text_search.Shard(np.arange(len(texts)), np.concatenate(texts), bounds, wanted, 25.0)
    terms, weights = np.arange(40), np.where(np.arange(40) < 30, 0.1, 5.0)
    query, k = own[3], 10
    places, scores = shard.top(terms, weights, query, len(texts), 0.0)
    best = np.lexsort((places, -scores))[:k]
    assert query not in places and set(places[best]) <= set(own)

    read, inner = [], text_search.places_in

    def counted(starts, ends):
        found = inner(starts, ends)
        read.append(len(found))
        return found

    monkeypatch.setattr(text_search, "places_in", counted)
    again, found = shard.top(terms, weights, query, k, float(scores[best].min()))
    order = np.lexsort((again, -found))[:k]
    assert again[order].tolist() == places[best].tolist() and found[order].tolist() == scores[best].tolist()
    # The entries of the blocks and the postings of one of them.
    blocks = len(shard.block)
    assert sum(read) - blocks < len(shard.row) / 10
    read.clear()
    nothing, _ = shard.top(terms, weights, query, k, 1e9)
    assert len(nothing) == 0 and sum(read) == blocks
