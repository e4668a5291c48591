"""Collocations: word sequences counted by sorting suffix pointers, one depth at a time, and scored by their weakest cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlark.llm.graph import written
from ledgerlark.llm.text import LOWER, mixed, segments, text_bytes, word_hashes

LEAST, HIGHEST, WORDS, SHARE = 10, 2_000, 3, 50
#: Bytes of text whose suffixes are sorted together.
SPAN = 1 << 21
#: Runs of pointers up to this length are finished by numpy's own sort.
SHORT = 1 << 12
#: Bits of the filter of frequent phrases: a bound, 8 MB, whatever the corpus; false hits only cost time.
FILTER_BITS = 26

#: Bytes that end a piece, and all that are in no word.
ENDS = np.zeros(256, dtype=bool)
ENDS[[46, 44, 59, 58, 33, 63, *range(10, 14)]] = True
IN_WORD = ~ENDS
IN_WORD[[9, 32]] = False

COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()), T.StructField("n", T.LongType())])


def span_words(data: np.ndarray, rows: np.ndarray, first: int, last: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of data[first:last], the row of each, and whether each follows the one before in its piece."""
    part = LOWER[data[first:last]]
    word = IN_WORD[part]
    at = np.searchsorted(rows, first, side="right")
    cuts = rows[at : np.searchsorted(rows, last)] - first
    cuts = cuts[(cuts > 0) & (cuts < len(part))]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    opens[cuts] = word[cuts]
    closes[cuts - 1] = word[cuts - 1]
    opens, closes = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    row = np.searchsorted(rows, opens + first, side="right") - 1
    ended = np.searchsorted(np.flatnonzero(ENDS[part]), opens)
    joined = np.zeros(len(opens), bool)
    joined[1:] = (ended[1:] == ended[:-1]) & (row[1:] == row[:-1])
    offsets = np.concatenate([[0], np.cumsum(closes - opens)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(opens), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(part[word])))
    return words, row, joined


def three_way(pointers: np.ndarray, depth_words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix pointers sorted by multikey three-way quicksort, and where runs with equal words at all depths begin.

    ``depth_words[d][p]`` is the word at depth d of the suffix at p. A run is parted into smaller, equal and greater
    pointers by the word at its depth; the equal ones go on one depth deeper, and at the last depth their
    number is a count. Short runs are finished by numpy's sort over the remaining depths.
    """
    out, starts, place = np.empty_like(pointers), [], 0
    stack = [(pointers, 0)]
    while stack:
        run, depth = stack.pop()
        if not len(run):
            continue
        if depth == len(depth_words):
            starts.append(np.array([place]))
            out[place : place + len(run)] = run
            place += len(run)
        elif len(run) <= SHORT:
            keys = [words[run] for words in depth_words[depth:]]
            order = np.lexsort(keys[::-1])
            run = run[order]
            new = np.zeros(len(run), bool)
            new[0] = True
            for key in keys:
                key = key[order]
                new[1:] |= key[1:] != key[:-1]
            starts.append(np.flatnonzero(new) + place)
            out[place : place + len(run)] = run
            place += len(run)
        else:
            key = depth_words[depth][run]
            some = key[:: max(1, len(key) // 31)]
            pivot = np.partition(some, len(some) // 2)[len(some) // 2]
            less, equal = key < pivot, key == pivot
            stack.append((run[~(less | equal)], depth))
            stack.append((run[equal], depth + 1))
            stack.append((run[less], depth))
    return out, np.concatenate(starts) if starts else np.empty(0, np.int64)


def phrase_hash(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of a language and a sequence of words, each given by its own hash."""
    h = mixed(lang + np.uint64(len(words)))
    for w in words:
        h = mixed(h * np.uint64(3) + w)
    return h


def string_hashes(column: pa.Array) -> np.ndarray:
    """A hash per row, whose rows are single words or any other strings."""
    whole = np.zeros(256, dtype=bool)
    whole[:] = True
    hashes, bounds = word_hashes(column, whole)
    # Empty strings have no word.
    out = np.zeros(len(column), np.uint64)
    full = bounds[1:] > bounds[:-1]
    out[full] = hashes[bounds[:-1][full]]
    return out


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def counted(docs: DataFrame, depth: int, frequent: Broadcast | None) -> DataFrame:
    """(lang, phrase, n): occurrences of the phrases of ``depth`` words, summed over all rows.

    With ``frequent``, the filter of frequent phrases of a word less, pointers are left out whose first or last
    ``depth`` - 1 words are not frequent, as no frequent phrase can begin there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        for batch in batches:
            data, rows = text_bytes(batch.column(1))
            langs = batch.column(0).dictionary_encode()
            names, codes = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            salts = string_hashes(names)
            tail = None  # the last words of a row that goes on in the next span
            for first, last in segments(data, rows, IN_WORD, SPAN):
                words, row, joined = span_words(data, rows, first, last)
                if not len(words):
                    if ENDS[LOWER[data[first:last]]].any() or first in rows:
                        tail = None
                    continue
                kept = 0
                if tail is not None and tail[1] == row[0] and first != rows[row[0]]:
                    before, _, broken = tail
                    gap = np.flatnonzero(IN_WORD[LOWER[data[first:last]]])[0]
                    if not broken and not ENDS[LOWER[data[first : first + gap]]].any():
                        kept = len(before)
                        words = pa.concat_arrays([before, words])
                        row = np.concatenate([np.full(kept, row[0]), row])
                        joined = np.concatenate([[False], np.ones(kept, bool), joined[1:]])
                # What the next span needs: the words at the end that one piece holds.
                open_words = 1
                while open_words < min(WORDS - 1, len(words)) and joined[-open_words]:
                    open_words += 1
                end = np.flatnonzero(IN_WORD[LOWER[data[first:last]]])[-1] + 1
                tail = (words[len(words) - open_words :], row[-1], bool(ENDS[LOWER[data[first + end : last]]].any()))
                yield counts_of(words, codes[row], joined, kept, depth, names, salts, bits)

    texts = docs.select("lang", "text").where("text is not null").mapInArrow(run, COUNTS)
    return texts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def counts_of(words, lang, joined, kept, depth, names, salts, bits) -> pa.RecordBatch:
    """Counts of the phrases that begin in ``words`` and end after the first ``kept`` of them."""
    encoded = words.dictionary_encode()
    ids, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    p = np.arange(max(len(words) - depth + 1, 0))
    p = p[p + depth - 1 >= kept]
    for d in range(1, depth):
        p = p[joined[p + d]]
    if bits is not None and len(p):
        hashes = string_hashes(distinct)[ids]
        for d in (0, 1):
            part = [hashes[p + d + k] for k in range(depth - 1)]
            p = p[passes(bits, phrase_hash(salts[lang[p]], part))]
    shifted = [lang * len(distinct) + ids] + [np.concatenate([ids[d:], np.zeros(d, ids.dtype)]) for d in range(1, depth)]
    order, starts = three_way(p, shifted)
    sizes = np.diff(np.append(starts, len(order)))
    heads = order[starts]
    parts = [distinct.take(pa.array(ids[heads + d])) for d in range(depth)]
    phrase = parts[0] if depth == 1 else pc.binary_join_element_wise(*parts, " ")
    return pa.RecordBatch.from_arrays([names.take(pa.array(lang[heads])), phrase, pa.array(sizes.astype(np.int64))], schema=pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())]))


def filter_of(spark: SparkSession, phrases: DataFrame) -> Broadcast:
    """The bits of the hashes of ``phrases`` (lang, phrase): at most 2**FILTER_BITS, however many phrases there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = pc.split_pattern(batch.column(1), " ")
            sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
            hashes, begins = string_hashes(split.flatten()), np.cumsum(sizes) - sizes
            depth = int(sizes[0]) if len(sizes) else 0
            h = phrase_hash(string_hashes(batch.column(0)), [hashes[begins + d] for d in range(depth)])
            at = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at + 1)], names=["at"])

    at = phrases.select("lang", "phrase").mapInArrow(run, "at long")
    chunks = at.groupBy(F.bitmap_bucket_number("at").alias("chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits = bytearray(1 << (FILTER_BITS - 3))
    for chunk, part in zip(*chunks.toArrow().to_pydict().values()):
        bits[(chunk - 1) * len(part) : chunk * len(part)] = part
    return spark.sparkContext.broadcast(bytes(bits))


def collocations(
    spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, highest: int = HIGHEST
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``highest`` best phrases of two or three words.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, and these at spaces and tabs into words. Phrases
    that occur at least ``least`` times in a language, overlaps included, are scored by their cut with the smallest
    floor(1000000 * a * a / (l * r)), the first of equal ones: a, l and r are the counts of the phrase, of what stands
    before and of what stands after the cut. Phrases inside a longer one with at least SHARE per cent of their count
    drop out. Best is the higher score, then the higher count, then the smaller phrase in byte order. n is the
    number of words of the language.

    Every depth is one pass: suffixes are sorted by multikey quicksort in spans, equal runs are partial counts,
    and these are summed over all tasks by phrase, so a hot word or phrase is one row per task. Phrases below ``least`` are abandoned:
    the next depth looks only at suffixes that pass a filter of the frequent ones, of fixed size. It never
    loses one; sums decide. Null texts have no words and null languages are ``und``. Repeated rows count as often. Very
    long texts are read in spans with the words that reach over. Other columns are ignored; no rows give none.
    """
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    levels, frequent = [], None
    for depth in range(1, WORDS + 1):
        found = counted(docs, depth, frequent)
        if depth == 1:
            found = written(spark, found, "words")
            totals = found.groupBy("lang").agg(F.sum("n").alias("n"))
            found = found.where(F.col("n") >= least)
        else:
            found = written(spark, found.where(F.col("n") >= least), f"phrases-{depth}")
        if frequent is not None:
            frequent.destroy()
        levels.append(found)
        frequent = filter_of(spark, found) if depth < WORDS else None
    words, pairs, triples = levels
    triples = triples.withColumn("w", F.split("phrase", " "))
    triples = triples.select("lang", "phrase", F.col("n").alias("a"), F.col("w")[0].alias("w1"), F.col("w")[2].alias("w3"), F.concat_ws(" ", F.col("w")[0], F.col("w")[1]).alias("p12"), F.concat_ws(" ", F.col("w")[1], F.col("w")[2]).alias("p23"))
    pairs = pairs.withColumn("w", F.split("phrase", " ")).select("lang", "phrase", F.col("n").alias("a"), F.col("w")[0].alias("w1"), F.col("w")[1].alias("w2"))

    def count_of(table: DataFrame, column: str, name: str, count: str) -> DataFrame:
        return table.select("lang", F.col(column).alias(name), F.col(count).alias(f"f_{name}"))

    two = pairs.join(count_of(words, "phrase", "w1", "n"), ["lang", "w1"]).join(count_of(words, "phrase", "w2", "n"), ["lang", "w2"])
    ends = triples.select("lang", F.explode(F.array("p12", "p23")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = two.join(ends, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {SHARE} * a")
    two = two.select("lang", "phrase", "a", F.array(F.struct(F.col("f_w1").alias("l"), F.col("f_w2").alias("r"))).alias("cuts"))
    three = triples
    for name, table, column, count in (("w1", words, "phrase", "n"), ("w3", words, "phrase", "n"), ("p12", pairs, "phrase", "a"), ("p23", pairs, "phrase", "a")):
        three = three.join(count_of(table, column, name, count), ["lang", name])
    cuts = [F.struct(F.col("f_w1").alias("l"), F.col("f_p23").alias("r")), F.struct(F.col("f_p12").alias("l"), F.col("f_w3").alias("r"))]
    both = two.union(three.select("lang", "phrase", "a", F.array(*cuts).alias("cuts")))
    # Exact: a fits 16 digits, so both products fit 38; the quotient is at most a million.
    score = "(1000000BD * cast(a as decimal(16,0)) * cast(a as decimal(16,0))) div (cast(c.l as decimal(19,0)) * cast(c.r as decimal(19,0)))"
    scored = both.withColumn("best", F.expr(f"array_min(transform(cuts, (c, k) -> struct({score} as score, k as k, c.l as l, c.r as r)))"))
    scored = scored.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").cast("long").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= highest)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
