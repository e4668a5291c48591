"""op13 against brute-force counts, with spans so short that phrases reach over them."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlark.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for d in (1, 2, 3):
                for i in range(len(w) - d + 1):
                    f[(lang, *w[i : i + d])] += 1
    candidates = {k: a for k, a in f.items() if len(k) > 2 and a >= 10}
    inside = {(k[0], *s) for k, a in candidates.items() if len(k) == 4 for s in (k[1:3], k[2:4]) if 100 * a >= 50 * f[(k[0], *s)]}
    best = defaultdict(list)
    for k, a in candidates.items():
        if k not in inside:
            cuts = [(f[k[: 1 + c]], f[(k[0], *k[1 + c :])]) for c in range(1, len(k) - 1)]
            score, _, l, r = min((10**6 * a * a // (l * r), c, l, r) for c, (l, r) in enumerate(cuts))
            best[k[0]].append((-score, -a, " ".join(k[1:]).encode(), l, r))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in best.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:2000])
    )


ODD = [
    (None, "A b C. a b c\ta b"),
    ("und", "a b c a b c"),
    ("x", ""),
    ("x", None),
    ("y", "q " * 16),
    ("z", "one two three " * 900 + "é ü é ü, " * 30 + " \x01 w " * 20),
    ("z", "x" * 20_000 + "  \t \n. y"),
    ("z", ("new york" + " " * 90) * 3 + "new york! " + "." * 80 + "york new"),
] * 12


@pytest.mark.parametrize("span", [1 << 22, 40])
def test_equals_brute_force(spark, sf_dir, monkeypatch, span):
    monkeypatch.setattr(phrases, "SPAN", span)
    own = [(r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").limit(40).collect()]
    rows = own + ODD
    df = spark.createDataFrame([(*r, "p", 3) for r in rows], "lang string, text string, phrase string, n long").repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(spark, df).collect())
    assert got == brute(rows)


def test_no_documents(spark):
    assert phrases.collocations(spark, spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark, spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0


@pytest.mark.parametrize("short", [1, 8, 1 << 12])
def test_three_way_sorts(monkeypatch, short):
    monkeypatch.setattr(phrases, "SHORT", short)
    ids = np.random.default_rng(3).integers(0, 6, 3_000)
    depth_words = [ids[:-2], ids[1:-1], ids[2:]]
    out, starts = phrases.three_way(np.arange(len(ids) - 2), depth_words)
    sizes = np.diff(np.append(starts, len(out)))
    got = {tuple(int(w[out[s]]) for w in depth_words): int(n) for s, n in zip(starts, sizes)}
    assert got == Counter(zip(*(w.tolist() for w in depth_words)))
    assert list(got) == sorted(got)
