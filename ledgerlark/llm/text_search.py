"""Exact BM25 top-k over sharded inverted indexes with block-max pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.llm.graph import written
from ledgerlark.llm.text import BASE, distinct, mixed, word_hashes

#: Documents of a shard, and its words but for a document's, at most; documents of the blocks whose maxima prune.
SHARD, WORDS, BLOCK = 10_240, 6_000_000, 128
#: Queries that are broadcast at once, that go through a shard together, and that are at least worth a matrix.
QUERIES, TILE, FEW = 4_096, 128, 8
#: Terms of a broadcast that are multiplied as a matrix; others go by their postings. Commonest terms that order documents.
COMMON, ORDERING = 512, 16
#: One shard of so many, if there are twice as many, is searched first and gives the others a threshold.
FIRST = 16
#: Bits of the filter of query terms, as a power of two.
FILTER = 26
#: Above the relative error of float32 sums of COMMON terms that are not negative.
MARGIN = 2e-4
K1, B = 1.2, 0.75
INDEX = "ids binary, lengths binary, texts binary, terms binary, sizes binary, row binary, count binary, docs long, words long"


def postings(words: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, place of the term, row, frequency): distinct terms in order, and each one's rows in order.

    ``row`` has the number of each word's row, below ``rows``, as an unsigned integer.
    """
    bits = np.uint64(int(rows).bit_length())
    terms = distinct(words)
    # Hashes without their last bits leave room for the row; two words that differ only there would be seen as one.
    for values in (lambda: words, lambda: np.searchsorted(terms, words).astype(np.uint64) << bits):
        key = values() >> bits << bits
        key |= row
        key.sort()
        first = np.flatnonzero(changes(key))
        key = key[first]
        place = numbered(key >> bits)
        if not len(place) or place[-1] + 1 == len(terms):
            break
    return terms, place, (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), np.diff(np.append(first, len(words)))


def changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it; the first does."""
    differs = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=differs[1:])
    return differs


def numbered(values: np.ndarray) -> np.ndarray:
    """The number of each of the values, in order, among the distinct ones."""
    return np.cumsum(changes(values)) - 1


def term_rows(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, frequency) for each distinct word of each row, in the order of terms and then rows."""
    rows = len(bounds) - 1
    terms, place, row, count = postings(words, np.repeat(np.arange(rows, dtype=np.uint32), np.diff(bounds)), rows)
    return row, terms[place], count


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, qtf) for rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, terms, count = term_rows(*word_hashes(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(terms.view(np.int64)), pa.array(count)],
                names=["query_id", "term", "qtf"],
            )

    return queries.select("doc_id", "text").mapInArrow(run, "query_id long, term long, qtf long")


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bits, eight a byte, that are set at the first FILTER bits of each of ``terms`` (term)."""
    place = F.shiftrightunsigned("term", 64 - FILTER)
    rows = terms.select(F.shiftright(place, 15).alias("at"), place.bitwiseAND(F.lit(32767)).alias("bit"))
    # Rows of 4,096 bytes, 8 MB in all whatever the number of terms.
    found = rows.groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    bits = np.zeros((1 << FILTER) // 8, dtype=np.uint8)
    for at, part in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
        bits[at * 4096 : (at + 1) * 4096] = np.frombuffer(part, dtype=np.uint8)
    return bits


def arranged(place: np.ndarray, row: np.ndarray, sizes: np.ndarray, rows: int) -> np.ndarray:
    """The place of each row when rows are ordered by which of the ORDERING commonest terms they have.

    Rows with the same common words come to lie in the same blocks, so that these have lower maxima.
    """
    name, start = np.zeros(rows, np.int64), np.concatenate([[0], np.cumsum(sizes)])
    for term in np.argsort(-sizes, kind="stable")[:ORDERING]:
        name <<= 1
        name[row[start[term] : start[term + 1]]] |= 1
    rank = np.empty(rows, np.int64)
    rank[np.argsort(name, kind="stable")] = np.arange(rows)
    return rank


def index(docs: DataFrame, wanted) -> DataFrame:
    """The inverted index of rows (doc_id, text), a row a shard: terms that pass the filter ``wanted``, a broadcast.

    ids, lengths and ``texts``, a hash of each document's words, are by document; terms and sizes, their numbers of
    documents, by term; row and count by posting, in the order of terms and then rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (words, bounds) = batch.column(0).to_numpy(), word_hashes(batch.column(1))
            # Shards with about as many words each.
            share, at = max(1, -(-len(words) // max(1, -(-len(words) // WORDS)))), 0
            while at < len(ids):
                end = max(at + 1, min(int(np.searchsorted(bounds, bounds[at] + share)), at + SHARD, len(ids)))
                yield indexed(ids[at:end], words[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at], wanted.value)
                at = end

    return docs.select("doc_id", "text").mapInArrow(run, INDEX)


def indexed(ids: np.ndarray, words: np.ndarray, bounds: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    rows, lengths = len(ids), np.diff(bounds)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words + BASE))])
    texts = sums[bounds[1:]] - sums[bounds[:-1]]
    del sums
    bit = (words >> np.uint64(64 - FILTER)).astype(np.uint32)
    kept = (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    del bit
    terms, place, row, count = postings(words[kept], np.repeat(np.arange(rows, dtype=np.uint32), lengths)[kept], rows)
    sizes = np.bincount(place, minlength=len(terms))
    rank = arranged(place, row, sizes, rows)
    # Terms stay where they are, their rows are in the new order.
    row_bits, count_bits = rows.bit_length(), int(count.max(initial=0)).bit_length()
    key = ((place << row_bits | rank[row]) << count_bits) | count
    key.sort()
    by_row = np.argsort(rank)
    arrays = [
        ids[by_row], lengths[by_row], texts[by_row], terms, sizes.astype(np.int32),
        ((key >> count_bits) & ((1 << row_bits) - 1)).astype(np.uint16),
        (key & ((1 << count_bits) - 1)).astype(np.min_scalar_type((1 << count_bits) - 1)),
    ]
    columns = [pa.array([a.tobytes()], pa.binary()) for a in arrays] + [pa.array([n], pa.int64()) for n in (rows, len(words))]
    return pa.RecordBatch.from_arrays(columns, names=[name.split()[0] for name in INDEX.split(", ")])


def document_frequencies(indexes: DataFrame) -> DataFrame:
    """(term, df) over an index: the sizes of its shards, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, sizes in zip(batch.column(0), batch.column(1)):
                terms, sizes = np.frombuffer(terms.as_buffer(), np.int64), np.frombuffer(sizes.as_buffer(), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(sizes.astype(np.int64))], names=["term", "df"])

    return indexes.select("terms", "sizes").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Shard:
    """Postings by term of some documents, with each block's largest impact for each term."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, average: float):
        lengths = np.diff(bounds)
        terms, place, row, count = postings(words, np.repeat(np.arange(len(ids), dtype=np.uint32), lengths), len(ids))
        self.fill(ids, lengths, terms, np.bincount(place, minlength=len(terms)), row, count, wanted, average)

    @classmethod
    def read(cls, record: dict[str, pa.Scalar], wanted: np.ndarray, average: float, k: int) -> Shard:
        """A shard of the index, without copies that can't be among the k best."""
        kinds = {"ids": np.int64, "lengths": np.int64, "texts": np.uint64, "terms": np.uint64, "sizes": np.int32, "row": np.uint16}
        ids, lengths, texts, terms, sizes, row = (np.frombuffer(record[name].as_buffer(), kind) for name, kind in kinds.items())
        count = record["count"].as_buffer()
        count = np.frombuffer(count, f"u{count.size // max(len(row), 1) or 1}")
        shard = cls.__new__(cls)
        shard.fill(ids, lengths, terms, sizes, row, count, wanted, average, first_copies(ids, texts, lengths, k))
        return shard

    def fill(self, ids, lengths, terms, sizes, row, count, wanted, average, left=None) -> None:
        """``left`` tells which rows are kept, if not all."""
        self.ids = ids
        at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
        known = wanted[at] == terms
        kept = np.repeat(known, sizes)
        if left is not None and not left.all():
            kept &= left[row]
        place, row, count = np.repeat(at.astype(np.int32), sizes)[kept], row[kept], count[kept].astype(np.int64)
        norm = K1 * (1 - B + B * lengths / average)
        impact = count * (K1 + 1) / (count + norm[row])
        # Row and rounded impact lie side by side, so that a posting is read at once.
        pairs = np.empty((len(row), 2), np.int32)
        pairs[:, 0], pairs.view(np.float32)[:, 1] = row, impact
        self.row, self.pairs = pairs[:, 0], pairs.view(np.int64).ravel()
        self.start = starts_of(place, len(wanted))
        block = row // BLOCK
        first = np.flatnonzero(changes(place) | changes(block))
        # Postings of a term in a block lie from one entry of ``first`` to the next.
        self.first = np.append(first, len(row))
        self.block, self.most = block[first], np.maximum.reduceat(impact, first) if len(first) else impact
        self.head = starts_of(place[first], len(wanted))
        self.blocks = -(-len(ids) // BLOCK)
        # The postings by row, for exact scores.
        order = np.argsort(row.astype(np.min_scalar_type(len(ids))), kind="stable")
        self.own, self.own_place, self.own_impact = starts_of(row, len(ids)), place[order], impact[order]

    def multiply(self, common: np.ndarray) -> None:
        """Lay out the impacts of the terms ``common`` as a matrix by row, and their maxima by block."""
        at, owner = ranges(self.start[common], self.start[common + 1])
        self.matrix = np.zeros((self.blocks * BLOCK, len(common)), np.float32)
        read = self.pairs[at].view(np.int32)
        self.matrix[read[::2], owner] = read.view(np.float32)[1::2]
        self.matrix = self.matrix.reshape(self.blocks, BLOCK, len(common))
        self.highest = self.matrix.max(axis=1)

    def partial(self, terms: np.ndarray, weights: np.ndarray, least: float, others: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(blocks that may reach ``least``, scores of ``terms`` by row in these blocks at least, but for rounding).

        Blocks are bounded by the sum of their largest impacts, and ``others``, their bounds for further terms. Postings
        are read only in blocks whose bound reaches the threshold, each of them once. Where ``others`` alone reach it
        in most blocks, all postings are read.
        """
        starts, ends = self.start[terms], self.start[terms + 1]
        if 2 * np.count_nonzero(others * (1 + MARGIN) >= least) < self.blocks:
            spans, owner = ranges(self.head[terms], self.head[terms + 1])
            bound = np.bincount(self.block[spans], self.most[spans] * weights[owner], minlength=self.blocks) + others
            # Bounds and scores are sums in different orders; the margin covers their rounding.
            chosen = (bound > 0) & (bound * (1 + MARGIN) >= least)
            if not chosen.any():
                return chosen, np.empty(0)
            if 2 * chosen.sum() < self.blocks:
                here = chosen[self.block[spans]]
                spans, weights = spans[here], weights[owner[here]]
                starts, ends = self.first[spans], self.first[spans + 1]
        read = self.pairs[places_in(starts, ends)].view(np.int32)
        gain = read.view(np.float32)[1::2] * np.repeat(weights, ends - starts)
        score = np.bincount(read[::2], gain, minlength=self.blocks * BLOCK).astype(float, copy=False)
        bound = score.reshape(self.blocks, BLOCK).max(axis=1) + others
        return (bound > 0) & (bound * (1 + MARGIN) >= least), score

    def top(self, terms: np.ndarray, weights: np.ndarray, query: int, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of documents that may be among the k best and score at least ``least``."""
        chosen, score = self.partial(terms, weights, least)
        if not chosen.any():
            return np.empty(0, np.int64), np.empty(0)
        score = score[: len(self.ids)]
        score[self.ids == query] = 0
        room = np.zeros(len(self.start) - 1)
        room[terms] = weights
        return self.scored(np.flatnonzero(reaches(score, least)), score, k, room, least)

    def scored(self, places: np.ndarray, score: np.ndarray, k: int, room: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of those of ``places`` that may be among the k best; ``score`` is by row, but for rounding."""
        places = best_of(score, places, k)
        found = self.exact(places, room)
        reached = (found > 0) & (found >= least)
        return places[reached], found[reached]

    def exact(self, places: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Scores of the documents at ``places``, each summed by terms in order; ``room`` has the weights by term."""
        at, owner = ranges(self.own[places], self.own[places + 1])
        return np.bincount(owner, self.own_impact[at] * room[self.own_place[at]], minlength=len(places))


def first_copies(ids: np.ndarray, texts: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """Whether each row may be among the k best: of rows with the same words, only so many with the smallest ids may.

    They score the same for every query, which leaves out the rows of one id, its own.
    """
    order = np.lexsort((ids, lengths, texts))
    opens = changes(texts[order]) | changes(lengths[order])
    head = np.maximum.accumulate(np.where(opens, np.arange(len(ids)), 0))
    repeats = int(np.unique(ids, return_counts=True)[1].max(initial=1))
    left = np.empty(len(ids), dtype=bool)
    left[order] = np.arange(len(ids)) - head < k + repeats
    return left


def reaches(score: np.ndarray, least: float) -> np.ndarray:
    return score >= least * (1 - MARGIN) if least > 0 else score > 0


def best_of(score: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Those of ``places`` that score as much as the k-th best of them, but for rounding of either."""
    if len(places) <= k:
        return places
    found = score[places]
    return places[found >= np.partition(found, len(found) - k)[len(found) - k] * (1 - 3 * MARGIN)]


def starts_of(place: np.ndarray, places: int) -> np.ndarray:
    """Where each place's entries start in ``place``, in order; the last is the number of all."""
    return np.concatenate([[0], np.cumsum(np.bincount(place, minlength=places))])


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices of all ranges one after the other, number of the range of each)."""
    return places_in(starts, ends), np.repeat(np.arange(len(starts)), ends - starts)


def places_in(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The indices of all ranges one after the other."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    places = np.repeat(starts - before, sizes)
    places += np.arange(len(places))
    return places


class Queries:
    """A broadcast of queries, their terms parted into common ones and others, with the k best rows so far of each.

    ``wanted`` are all terms in order; the query ``names[q]`` has the terms ``places[first[q]:first[q + 1]]`` of them,
    with ``weights``; ``common`` are places in ``wanted``, and only scores of ``least[q]`` or more count.
    """

    def __init__(self, wanted, names, first, places, weights, common, least, k: int):
        self.wanted, self.names, self.first, self.places, self.weights = wanted, names, first, places, weights
        self.common, self.least, self.k = common, least.copy(), k
        owner, column = np.repeat(np.arange(len(names)), np.diff(first)), np.full(len(wanted), -1)
        column[common] = np.arange(len(common))
        column = column[places]
        shared = column >= 0
        self.matrix = np.zeros((len(names), len(common)), np.float32)
        self.matrix[owner[shared], column[shared]] = weights[shared]
        self.others, self.other_weights = places[~shared], weights[~shared]
        self.other_first = starts_of(owner[~shared], len(names))
        self.room = np.zeros(len(wanted))
        self.ids = [np.empty(0, np.int64) for _ in names]
        self.scores = [np.empty(0) for _ in names]

    def ask(self, shard: Shard) -> None:
        """Put the best rows of ``shard`` to those held.

        Queries go through in tiles. The matrix product of their common terms with the blocks' maxima and the block
        maxima of the other terms tell which blocks may reach a query's threshold; only these are multiplied and
        have their postings read. Rows that reach it but for the rounding of the product get their exact score.
        A few queries are not worth a matrix.
        """
        if len(self.names) < FEW:
            for q, name in enumerate(self.names.tolist()):
                span = slice(self.first[q], self.first[q + 1])
                places, scores = shard.top(self.places[span], self.weights[span], name, self.k, self.least[q])
                self.keep(q, shard.ids[places], scores)
            return
        shard.multiply(self.common)
        for at in range(0, len(self.names), TILE):
            weights = self.matrix[at : at + TILE]
            asked = []
            for i, bound in enumerate((weights @ shard.highest.T).astype(float)):
                span = slice(self.other_first[at + i], self.other_first[at + i + 1])
                chosen, score = shard.partial(self.others[span], self.other_weights[span], self.least[at + i], bound)
                if chosen.any():
                    asked.append((i, chosen, score))
            if not asked:
                continue
            blocks = np.flatnonzero(np.any([chosen for _, chosen, _ in asked], axis=0))
            # Most blocks are rather multiplied than copied.
            if 4 * len(blocks) > 3 * shard.blocks:
                blocks = np.arange(shard.blocks)
            matrix = shard.matrix if len(blocks) == shard.blocks else shard.matrix[blocks]
            products = weights[[i for i, _, _ in asked]] @ matrix.reshape(len(blocks) * BLOCK, -1).T
            for (i, _, score), product in zip(asked, products):
                score = score if len(blocks) == shard.blocks else score.reshape(-1, BLOCK)[blocks].ravel()
                score += product
                self.score(at + i, shard, blocks, score)

    def score(self, q: int, shard: Shard, blocks: np.ndarray, score: np.ndarray) -> None:
        """Keep the best rows of ``blocks``, with their scores but for rounding."""
        near = np.flatnonzero(reaches(score, self.least[q]))
        if not len(near):
            return
        places = blocks[near // BLOCK] * BLOCK + near % BLOCK
        others = shard.ids[places] != self.names[q]
        span = slice(self.first[q], self.first[q + 1])
        self.room[self.places[span]] = self.weights[span]
        by_place = np.zeros(shard.blocks * BLOCK)
        by_place[places] = score[near]
        places, scores = shard.scored(places[others], by_place, self.k, self.room, self.least[q])
        self.room[self.places[span]] = 0
        if len(places):
            self.keep(q, shard.ids[places], scores)

    def keep(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[q], ids]), np.concatenate([self.scores[q], scores])
        best = np.lexsort((ids, -scores))[: self.k]
        self.ids[q], self.scores[q] = ids[best], scores[best]
        if len(best) == self.k:
            self.least[q] = max(self.least[q], float(scores[best[-1]]))


def search(
    spark: SparkSession, docs: DataFrame, is_query: Column, k: int = 10, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """query_id, rank, doc_id, score: for each query row the k other rows with the largest BM25 score.

    A query is the whole text of a row for which ``is_query``, a condition on the column ``doc_id``,
    holds; it is compared with all rows but those of its own id. Words count as often as the query has them,
    and only rows that share a word are found. Scores use the number of rows, their average length and the
    document frequencies of the whole table, so shards' results merge exactly. The table is indexed and written once, in
    shards. Queries go out in blocks of QUERIES, each a broadcast of that size, and every shard answers each block with
    block-max pruning; a task keeps the k best of its shards, and the merge takes the k best of the tasks. The
    results of one shard in FIRST bound those of the others from below.

    Ties go to the smaller doc_id. Null and empty texts match nothing and ask nothing; rows without doc_id
    are left out. Rows that repeat a doc_id are found each; as queries they count once, with the first of their texts.
    Other columns are ignored; without queries or rows there are no results.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.where("doc_id is not null")
    asked = rows.where(is_query).groupBy("doc_id").agg(F.min("text").alias("text"))
    asked = written(spark, query_terms(asked), "query_terms")
    schema = "query_id long, doc_id long, score double"
    found = spark.createDataFrame([], schema)
    wanted = spark.sparkContext.broadcast(term_filter(asked))
    # Pages are as large as a shard's columns: uncompressed, as Snappy keeps buffers of their size beside the heap.
    indexes = written(spark, index(rows, wanted), "index", "uncompressed")
    wanted.destroy()
    shards, count, words = indexes.agg(F.count("*"), F.sum("docs"), F.sum("words")).first()
    frequencies = document_frequencies(indexes).join(asked.select("term").distinct(), "term")
    idf = F.log(1 + (F.lit(count) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = asked.join(frequencies, "term").select("query_id", "term", (F.col("qtf") * idf).alias("weight"), "df")
    weighted = written(spark, weighted, "weights")
    # Blocks by a hash of the query's id: about QUERIES each, without listing the ids.
    blocks = -(-weighted.select("query_id").distinct().count() // QUERIES)
    weighted = weighted.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(max(blocks, 1))))
    early = F.pmod(F.xxhash64("ids"), F.lit(FIRST)) == 0
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")).cast("int")
    for at in range(blocks):
        block = weighted.where(F.col("block") == at).select("query_id", "term", "weight", "df").toArrow()
        if not block.num_rows:
            continue
        names, *asking = laid_out(*(block.column(i).to_numpy() for i in range(4)), count)
        del block
        least = np.zeros(len(names))
        for part in [early, ~early] if shards >= 2 * FIRST else [F.lit(True)]:
            shared = spark.sparkContext.broadcast((names, *asking, least))
            answers = written(spark, indexes.where(part).mapInArrow(answered(shared, words / count, k), schema), "found")
            found = found.union(answers)
            shared.destroy()
            if part is early:
                last = answers.withColumn("rank", ranked).where(F.col("rank") == k).select("query_id", "score").toArrow()
                order = np.argsort(names)
                least[order[np.searchsorted(names, last.column(0).to_numpy(), sorter=order)]] = last.column(1).to_numpy()
    return found.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def laid_out(query: np.ndarray, term: np.ndarray, weight: np.ndarray, df: np.ndarray, count: int) -> tuple[np.ndarray, ...]:
    """(names, wanted, first, places, weights, common) as Queries has them, alike queries beside each other."""
    wanted, some, places = np.unique(term.view(np.uint64), return_index=True, return_inverse=True)
    names, owner = np.unique(query, return_inverse=True)
    asked, df = np.bincount(places), df[some]
    key = np.zeros(len(names), np.int64)
    for common in np.argsort(-df, kind="stable")[:ORDERING]:
        key <<= 1
        key[owner[places == common]] |= 1
    alike = np.argsort(key, kind="stable")
    rank = np.empty(len(names), np.int64)
    rank[alike] = np.arange(len(names))
    order = np.lexsort((places, rank[owner]))
    first = starts_of(rank[owner], len(names))
    # A term is worth a column if enough pairs of a query and a row have it.
    share = asked / len(names) * (df / count)
    common = np.argsort(-share, kind="stable")[:COMMON]
    common = np.sort(common[share[common] >= 0.001])
    return names[alike], wanted, first, places[order], weight[order], common


def answered(shared, average: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = None
        for batch in batches:
            for i in range(batch.num_rows):
                if queries is None:
                    names, wanted, *rest = shared.value
                    queries = Queries(wanted, names, *rest, k)
                record = {name: batch.column(name)[i] for name in batch.schema.names}
                queries.ask(Shard.read(record, queries.wanted, average, k))
        if queries is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(queries.names, [len(i) for i in queries.ids])),
                    pa.array(np.concatenate(queries.ids)),
                    pa.array(np.concatenate(queries.scores)),
                ],
                names=["query_id", "doc_id", "score"],
            )

    return run
