"""The numbered operators against brute force, on small fixtures with nulls, empties, ties and repeats."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import (
    language_id,
    license_scan,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    packing,
    sharding,
    text,
    text_search,
    vector_search,
)
from ledgerlark.llm.graph import components
from ledgerlark.llm.queries import OP10_SQL, tokenizer_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, node long, key string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return [w for w in re.split("[ \t-\r]+", (t or "").translate(LOWER)) if w]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    """Real documents, and the odd cases: null and empty text, null id and source, copies, near copies, long words."""
    own = [(r[0], r[1], r[2], r[3]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]
    base = own[0][1]
    odd = [
        (9001, None, "en", None),
        (9002, "", None, "b"),
        (9003, " \n\t ", "en", "b"),
        (9004, base, "en", "b"),
        (9004, base, "en", "b"),
        (9005, base + " one more end", "en", None),
        (None, base, "en", "b"),
        (9006, "two words", "en", "c"),
        (9007, "Two  words", "en", "c"),
        (9008, "x" * 70_000 + " " + "y z " * 50, None, "c"),
        (9009, "ÉTÉ été 12 !? <|endoftext|> a b  c", "fr", "c"),
        (9010, "All rights reserved.\nAll rights reserved.", "en", "c"),
    ]
    return own + odd


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, lang, s, 7, "clash", 1, "clash") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def grouped(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_words_are_cut_as_defined_even_in_segments(monkeypatch, rows):
    texts = [t for _, t, _, _ in rows]
    column = pa.array(texts, pa.string())
    hashes, bounds = text.word_hashes(column)
    names = {}
    for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert b - a == len(words(t))
        for word, h in zip(words(t), hashes[a:b].tolist()):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    monkeypatch.setattr(text, "SEGMENT", 512)
    again, cut = text.word_hashes(column)
    assert (cut == bounds).all() and (again == hashes).all()


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (7, 6)]
    got = {r[0]: r[1] for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    want = grouped(edges, {x for e in edges for x in e})
    assert got == {n: c for n, c in want.items() if n != c}


def test_near_copies_equal_brute_force(spark, docs, none, rows):
    sets = defaultdict(list)
    for i, t, _, _ in rows:
        w = words(t)
        sets[i].append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    ids = sorted(i for i in sets if i is not None)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[:x]
        for s in sets[a][:1]
        for u in sets[b][:1]
        if s and u and 100 * len(s & u) >= 75 * len(s | u)
    ]
    want = grouped(links, ids)
    found = near_dedup.near_copies(spark, docs).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id][0]), want[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)
    assert near_dedup.near_copies(spark, none).count() == 0


def test_register_estimate_is_corrected():
    random = np.random.default_rng(1)
    common, a, b = (random.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 200, 200))
    minima = text.Minima(near_dedup.BANDS * near_dedup.ROWS)
    x, y = (near_dedup.compressed(minima(np.concatenate([common, s]))) for s in (a, b))
    chance = near_dedup.collision_chance(800, 800)
    assert abs(((x == y).mean() - chance) / (1 - chance) - 0.6) < 0.1


def test_fuzzy_lines_keep_one_of_each_component(spark, none):
    line = "The quick brown fox jumps over the lazy dog and then walks home again in the evening"
    texts = [
        (1, line + "\n\nshort"),
        (2, "  " + line.upper() + "\nshort\nother"),
        (3, line + "!\n" + line.replace("lazy", "tired old grey and slow")),
        (None, "other"),
        (4, None),
        (5, ""),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    decided = line_dedup.fuzzy_lines(spark, docs)
    kept = {(r.doc_id, r.line_no): r.kept for r in decided.collect()}
    assert kept == {
        (1, 0): True, (1, 2): True, (2, 0): False, (2, 1): False, (2, 2): False,
        (3, 0): False, (3, 1): True, (None, 0): True,
    }
    left = {r.doc_id: r.text for r in line_dedup.drop_lines(docs, decided).collect()}
    assert set(left) == {1, 3, None, 4, 5} and left[4] is None and left[1] == texts[0][1]
    assert line_dedup.fuzzy_lines(spark, none).count() == 0


def test_line_links_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {}
    for r in docs.select("doc_id", "text").collect():
        for n, raw in enumerate(r.text.split("\n")):
            if line := raw.strip(" \t\r\x0b\x0c").lower():
                lines[r.doc_id, n] = line
    sets = {x: frozenset(x[j : j + 8] for j in range(max(1, len(x) - 7))) for x in set(lines.values())}
    by_shingle = defaultdict(list)
    for x, s in sets.items():
        for h in s:
            by_shingle[h].append(x)
    common = Counter((a, b) for group in by_shingle.values() for i, a in enumerate(group) for b in group[:i])
    size = {x: max(1, len(x) - 7) for x in sets}
    links = [
        (a, b)
        for (a, b), n in common.items()
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n) and min(size[a], size[b]) >= 0.8 * max(size[a], size[b])
    ]
    part = grouped(links, sets)
    first = {}
    for place, line in sorted(lines.items()):
        first.setdefault(part[line], place)
    want = {place: first[part[line]] == place for place, line in lines.items()}
    got = {(r.doc_id, r.line_no): r.kept for r in line_dedup.fuzzy_lines(spark, docs).collect()}
    assert got.keys() == want.keys()
    assert sum(got[k] != want[k] for k in want) <= 1  # banding is approximate


def least_capacity(sizes, shards):
    capacity = max(sizes)
    while sharding.cuts(sizes, shards, capacity) is None:
        capacity += 1
    return capacity


def test_minimax_is_the_least_capacity():
    random = np.random.default_rng(2)
    for _ in range(300):
        sizes = random.integers(0, 30, random.integers(1, 25)).tolist()
        shards = int(random.integers(1, 7))
        placed = sharding.minimax(sizes, shards)
        assert placed == sorted(placed) and placed[-1] < shards
        assert max(np.bincount(placed, sizes)) == least_capacity(sizes, shards)


def test_shards_hold_equal_texts_and_gapless_slots(spark, docs, none, rows):
    found = sharding.shard(spark, docs, shards=5).collect()
    assert len(found) == len(rows)
    slots, homes, sizes = defaultdict(list), defaultdict(set), Counter()
    for r in found:
        slots[r["shard"]].append(r.slot)
        homes[r.text_crc32].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    want = Counter((len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for _, t, _, _ in rows)
    assert Counter((r["size"], r.text_crc32) for r in found) == want
    assert sharding.shard(spark, none).count() == 0


def test_mix_equals_its_sql(spark, docs, none, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s in rows])
    shape = lambda r: (str(r[0]), r[1], r[2], round(r[3], 6), r[4])
    want = sorted(shape(r) for r in con.execute(OP10_SQL).fetchall())
    found = mixing.mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(shape(r) for r in found) == want
    assert abs(sum({r.source: r.target for r in mixing.mix(spark, docs).collect()}.values()) - 1.5 * sum(r[1] for r in found)) < 1
    assert mixing.mix(spark, none).count() == 0


def test_word_by_word_ids_equal_the_tokenizers(rows):
    encoder = packing.Encoder(*tokenizer_files())
    texts = [t or "" for _, t, _, _ in rows]
    texts += ["a  b", " a", "a ", "\n a", "a\n b", "a\n\nb c", "it's 's ' s", "a\x1fb c", "1 2,3 !? ...\t.", "x\ny z", "w.\nV"]
    assert encoder.batch(texts) == encoder.whole(texts)


def test_packing_is_whole(docs, none, rows):
    found = packing.pack(docs, *tokenizer_files()).collect()
    encoder = packing.Encoder(*tokenizer_files())
    want = Counter()
    for (i, *_), ids in zip(rows, encoder.whole([t or "" for _, t, _, _ in rows])):
        ids += b"\x01\x00\x00\x00"
        for start, length in packing.pieces(len(ids) // 4):
            want[i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), len(ids) // 4] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    windows = defaultdict(list)
    for r in found:
        windows[r.sequence_id].append((r.offset, r.length))
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack(none, *tokenizer_files()).count() == 0


def test_differencing_fills_windows():
    sizes = np.random.default_rng(3).integers(1, 512, 2000)
    window = packing.dealt(sizes, 2048)
    filled = np.bincount(window, sizes)
    assert filled.max() <= 2048 and sizes.sum() / (len(filled) * 2048) > 0.98


def test_language_is_right_on_held_out_documents(spark, sf_dir, docs, none):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fitted = language_id.fit(spark, table.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(spark, table, fitted).join(table.select("doc_id", "lang"), "doc_id")
    kept = found.where(language_id.held_out(F.col("doc_id"))).collect()
    assert len(kept) > 20 and sum(r.lang == r.lang_pred for r in kept) >= 0.97 * len(kept)
    odd = {r.doc_id: r for r in language_id.identify(spark, docs, fitted).collect()}
    for i in (9001, 9002, 9003):
        assert odd[i].lang_pred == "und" and odd[i].score == 0 and odd[i].rejected
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert language_id.identify(spark, none, fitted).count() == 0
    assert language_id.fit(spark, none) is None
    assert {r.lang_pred for r in language_id.identify(spark, docs, None).collect()} == {"und"}


def test_model_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([("abab cab abc", "x"), ("dede fed", "y")], "text string, lang string")
    model = language_id.fit(spark, docs).model
    for start in ("abab", "zzzz"):
        letters = " abcdef"
        points = [np.array([ord(c) for c in start + x], dtype=np.uint32) for x in letters]
        total = sum(np.exp(model.log_probabilities(p)[0]) for p in points)
        assert (total < 1 + 1e-6).all() and (total > 0.5).all()


def test_vector_search_recall_and_odd_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    real = [(r.vec_id, list(r.embedding)) for r in table.select("vec_id", "embedding").limit(300).collect()]
    d = len(real[0][1])
    odd = [(1000020, None), (1000040, [0.0] * d), (1000060, [float("nan")] * d), (1000080, [1.0]), (None, real[0][1])]
    odd += [(1000001, [None] + real[0][1][1:]), (1000002, real[0][1]), (1000003, real[0][1])]
    docs = spark.createDataFrame(real + odd, "vec_id long, embedding array<double>").withColumn("cell", F.lit("clash"))
    found = defaultdict(list)
    for r in vector_search.search(spark, docs, F.col("id") % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    good = real + odd[-2:]
    ids, points = np.array([i for i, _ in good]), np.array([v for _, v in good])
    hits = 0
    for q, v in real:
        if q % 20 == 0:
            scores = points @ np.array(v)
            best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:10]
            assert len(found[q]) == 10
            hits += len({ids[i] for i in best} & {i for i, _ in found[q]})
            del found[q][:]
    assert not any(found.values()) and hits >= 0.9 * 10 * len(found)
    assert vector_search.search(spark, docs.where("false"), F.col("id") % 20 == 0).count() == 0


def test_license_statements_are_found_wherever_they_stand(spark, docs, none, rows):
    plain = lambda t: " ".join(re.findall("[a-z0-9\x80-\U0010ffff]+", (t or "").translate(LOWER)))
    filler = [f"w{i}" for i in range(400)]
    placed = []
    for n, (name, statement) in enumerate(sorted(license_scan.STATEMENTS.items())):
        for at in (0, 1, 7, 200, 400):
            placed.append((10_000 + n * 1000 + at, " ".join(filler[:at] + [statement] + filler[at:])))
    table = docs.select("doc_id", "text").union(spark.createDataFrame(placed, "doc_id long, text string"))
    found = {(r.doc_id, r.license) for r in license_scan.scan(table).where("containment = 1").collect()}
    want = {
        (i, name)
        for i, t in [(i, t) for i, t, _, _ in rows] + placed
        for name, statement in license_scan.STATEMENTS.items()
        if f" {plain(statement)} " in f" {plain(t)} "
    }
    assert found == want
    assert license_scan.scan(none).count() == 0


def test_search_equals_brute_force(spark, docs, none, rows, monkeypatch):
    monkeypatch.setattr(text_search, "QUERIES", 3)
    found = defaultdict(list)
    for r in text_search.search(spark, docs, F.col("doc_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.doc_id, r.score))
    held = [(i, Counter(words(t))) for i, t, _, _ in rows if i is not None]
    df = Counter(w for _, c in held for w in c)
    average = sum(c.total() for _, c in held) / len(held)
    for q, query in {i: c for i, c in held if i % 20 == 0 and c}.items():
        scores = []
        for i, c in held:
            norm = text_search.K1 * (1 - text_search.B + text_search.B * c.total() / average)
            s = sum(
                n * math.log(1 + (len(held) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (text_search.K1 + 1) / (c[w] + norm)
                for w, n in query.items()
                if w in c
            )
            if i != q and s > 0:
                scores.append((-round(s, 6), i))
        assert [(i, round(s, 6)) for i, s in found[q]] == [(i, -s) for s, i in sorted(scores)[:5]]
    assert text_search.search(spark, none, F.col("doc_id") % 20 == 0).count() == 0


def test_scrambled_text_scores_lower(spark, sf_dir, docs, none):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    random = np.random.default_rng(4)
    some = [(r.doc_id, r.text) for r in table.where("length(text) > 2000").limit(40).collect()]
    mixed = [(100_000 + i, "".join(random.permutation(list(t)).tolist())) for i, t in some]
    both = table.union(spark.createDataFrame(mixed, "doc_id long, text string"))
    score = {r.doc_id: r.mean_log_likelihood for r in lm_scoring.score(spark, both).collect()}
    assert sum(score[i] > score[100_000 + i] for i, _ in some) >= 0.9 * len(some)
    odd = {r.doc_id: r for r in lm_scoring.score(spark, docs).collect()}
    assert odd[9001].n_words == 0 and odd[9001].log_likelihood == 0 and odd[9001].mean_log_likelihood is None
    assert lm_scoring.score(spark, none).count() == 0


def test_pipeline_stages_keep_columns(spark, docs):
    import corpus_pipeline

    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "").cache()
        assert now.columns == docs.columns, name
        assert now.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() >= now.count()
