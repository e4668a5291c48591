"""The pipeline's deduplicating stages on rows whose doc_id is null or repeated, against brute force."""

from __future__ import annotations

import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, source string"


def test_rows_without_or_with_repeated_ids_keep_their_own_lines(spark):
    rnd = random.Random(3)
    pool = [" ".join("".join(rnd.choices("abcdefghijkl", k=6)) for _ in range(9)) for _ in range(14)]
    some = lambda: "\n".join(rnd.sample(pool, 4))
    rows = [(rnd.choice((None, None, 1, 1, 2, 3)), some(), rnd.choice("ab")) for _ in range(9)]
    rows += [rows[0], rows[0], (*rows[1][:2], "z"), (7, " \n\t", "a"), (7, " \n\t", "a"), (None, None, "a")]
    # An unshared line beside each shared one.
    rows = [(i, t and t + f"\nonly {n} {rnd.random()}" if n < 9 else t, s) for n, (i, t, s) in enumerate(rows)]
    rows += [rows[2], (*rows[3][:2], "z")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = corpus_pipeline.distinct_lines(spark, docs, "").collect()
    lines = [x for r in left for x in (r.text or "").split("\n") if x.strip()]
    assert sorted(lines) == sorted({x for _, t, _ in rows for x in (t or "").split("\n") if x.strip()})
    assert sum(not (r.text or "").strip() for r in left) == 3


def test_one_row_of_each_group_of_copies_stays(spark):
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choices("abcdefghijkl", k=6)) for _ in range(60)) for _ in range(6)]
    a, b, c, d, e, f = texts
    near = lambda t: t + " end"
    rows = [
        (1, a, "x"), (1, a, "x"), (1, a, "y"), (1, b, "x"), (2, near(b), "x"), (None, near(a), "x"),
        (None, c, "x"), (None, c, "x"), (None, near(c), "x"), (None, d, "x"), (5, e, "x"), (5, f, "x"), (4, near(f), "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = corpus_pipeline.distinct_documents(spark, docs, "").collect()
    group = {t: i for i, own in enumerate(texts) for t in (own, near(own))}
    assert sorted(group[r.text] for r in left) == list(range(6))
    got = {group[r.text]: (r.doc_id, r.source) for r in left}
    assert got == {0: (1, "x"), 1: (1, "x"), 2: (None, "x"), 3: (None, "x"), 4: (5, "x"), 5: (4, "x")}
