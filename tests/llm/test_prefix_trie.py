"""op12 against a brute-force trie, with conversations cut into many blocks and shards."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerlark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node long, depth string"


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [v[3:] for v in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole = own.get(donor, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, len(whole)))
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = sum(saved[x] for x in children[k]) + (len(members[k]) - 1) * words
    first = {k: min(c for c, _ in v) for k, v in members.items()}
    out = []
    for k, v in members.items():
        ends = ",".join(map(str, sorted(c for c, n in v if n == len(k))))
        parent = first[k[:-1]] if k else None
        out.append((first[k], len(k), parent, len(v), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


ODD = (
    [(c, t, r, x) for c in range(60) for t, (r, x) in enumerate([("u", "hi there you"), (None, "a b"), ("u", None), ("a", "z z")][: 1 + c % 4])]
    + [(None, 1, "u", "q"), (5, None, "u", "first"), (5, 1, "u", "dup"), (5, 1, "u", "dup"), (-7, 1, "a", "neg"), (-7, 2, "a", "n")]
    + [(1000, 0, "", ""), (77, 0, "u", "long " * 20_000), (78, None, None, None)]
    + [(c, 100 + i, "u", f"w {i}") for c in (40, 41, 81) for i in range(50)]
)


@pytest.mark.parametrize("block,shard", [(50_000, 200_000), (3, 40)])
def test_equals_brute_force(spark, sf_dir, monkeypatch, block, shard):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", shard)
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    rows = [(*r, 1, "x") for r in given + [(2000 + (r[0] or 0), *r[1:]) for r in ODD]]
    got = sorted((tuple(r) for r in prefix_trie.trie(spark, spark.createDataFrame(rows, SCHEMA)).collect()), key=lambda r: r[:2])
    assert got == brute(rows)


def test_no_conversations(spark):
    assert prefix_trie.trie(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_slots_are_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 10_000).astype(np.uint64))
    levels, n = prefix_trie.perfect_slots(keys)
    assert n == len(keys) and np.array_equal(np.sort(prefix_trie.slots_of(levels, keys)), np.arange(n))
