"""Masked pseudo-likelihood of documents: a window network predicts every word from both sides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.text import word_hashes

#: Words are told apart by their hash modulo this; the last number stands beyond a text's ends.
BUCKETS = 1 << 18
EDGE = BUCKETS
#: Words predicted one by one, the most frequent of the corpus; the others are predicted by class.
ALONE, CLASSES = 63, 64
#: Rows of the input table, half of them for the most frequent words.
INPUTS = 4096
WINDOW, WIDTH, HIDDEN = 2, 16, 32
BATCH, RATE, ROUNDS = 2048, 0.2, 2


class Vocabulary:
    """Corpus counts of word buckets, and from them input rows, output classes and chances within a class."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        self.inputs = np.arange(BUCKETS + 1) % (INPUTS // 2 - 1) + INPUTS // 2
        self.inputs[order[: INPUTS // 2]] = np.arange(INPUTS // 2)
        self.inputs[EDGE] = INPUTS - 1
        self.classes = np.arange(BUCKETS) % CLASSES + ALONE
        self.classes[order[:ALONE]] = np.arange(ALONE)
        smoothed = counts + 0.5
        total = np.bincount(self.classes, smoothed, minlength=ALONE + CLASSES)
        self.within = np.log(smoothed / total[self.classes])


class Network:
    """tanh layer over the embeddings of WINDOW words on both sides, softmax over ALONE + CLASSES."""

    SHAPES = ((INPUTS, WIDTH), (2 * WINDOW * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, ALONE + CLASSES), (ALONE + CLASSES,))

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            random = np.random.default_rng(5)
            self.parts = [
                (random.standard_normal(s) * (0.3 if len(s) > 1 else 0) / (1 if s[0] == INPUTS else s[0] ** 0.5 * 0.3)).astype(np.float32)
                for s in self.SHAPES
            ]
        else:
            sizes = np.cumsum([int(np.prod(s)) for s in self.SHAPES])[:-1]
            self.parts = [p.reshape(s).astype(np.float32) for p, s in zip(np.split(flat, sizes), self.SHAPES)]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(input, hidden, log-probabilities) for rows of 2 * WINDOW input numbers."""
        table, first, shift, second, bias = self.parts
        x = table[around].reshape(len(around), -1)
        hidden = np.tanh(x @ first + shift)
        out = hidden @ second + bias
        out -= out.max(axis=1, keepdims=True)
        out -= np.log(np.exp(out).sum(axis=1, keepdims=True))
        return x, hidden, out

    def learn(self, around: np.ndarray, wanted: np.ndarray) -> None:
        """One step of gradient descent on the mean loss."""
        table, first, shift, second, bias = self.parts
        x, hidden, out = self.forward(around)
        slope = np.exp(out)
        slope[np.arange(len(wanted)), wanted] -= 1
        slope *= np.float32(1 / len(wanted))
        back = (slope @ second.T) * (1 - hidden * hidden)
        inward = (back @ first.T).reshape(-1, WIDTH)
        second -= RATE * (hidden.T @ slope)
        bias -= RATE * slope.sum(axis=0)
        first -= RATE * (x.T @ back)
        shift -= RATE * back.sum(axis=0)
        # Rows of the table are rare in a batch: their steps are larger.
        np.add.at(table, around.ravel(), np.float32(-RATE * 50) * inward)


def windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, buckets around it, bounds of the rows' words)."""
    words, bounds = word_hashes(column)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = np.arange(len(words)) + WINDOW * (row + 1)
    wide = np.full(len(words) + WINDOW * len(bounds), EDGE, dtype=np.int32)
    buckets = (words % np.uint64(BUCKETS)).astype(np.int32)
    wide[places] = buckets
    around = np.stack([wide[places + k] for k in range(-WINDOW, WINDOW + 1) if k], axis=1)
    return buckets, around, bounds


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def vocabulary(rows: DataFrame) -> Vocabulary:
    """Counts over every word of the corpus; each task sends its buckets' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in slices(batches):
            words, _ = word_hashes(batch.column(1))
            total += np.bincount((words % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    found = rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS)
    counts[found["bucket"].to_numpy(dtype=np.int64)] = found["n"]
    return Vocabulary(counts)


def train(spark: SparkSession, rows: DataFrame, words: Vocabulary) -> Network:
    """Each round trains on its share of all documents: every task from the common network, then the mean.

    Tasks send weighted parameters, which are summed by parameter before the driver gets one row each; the
    mean weighs a task by its words.
    """
    network = Network()
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((words, network.flat()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, flat = shared.value
            own, seen = Network(flat), 0
            random = np.random.default_rng(17)
            for batch in slices(batches):
                buckets, around, _ = windows(batch.column(1))
                around, wanted = words.inputs[around], words.classes[buckets]
                order = random.permutation(len(buckets))
                for at in range(0, len(order), BATCH):
                    some = order[at : at + BATCH]
                    own.learn(around[some], wanted[some])
                seen += len(buckets)
            if seen:
                value = own.flat().astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(value))), pa.array(value), pa.array(np.full(len(value), seen))],
                    names=["place", "value", "seen"],
                )

        share = rows.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn)
        sums = share.mapInArrow(run, "place long, value double, seen long").groupBy("place")
        sums = sums.agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")).toPandas().sort_values("place")
        if len(sums):
            network = Network((sums["value"] / sums["seen"]).to_numpy())
    return network


def score(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, log_likelihood, mean_log_likelihood for every row of ``docs``.

    The network is trained on all of ``docs``. A document's pseudo-log-likelihood sums, over all its words,
    the log-probability of the word given WINDOW words on each side: that of its class by the network, times
    that of the word within its class by its corpus count. Frequent words are classes of their own.

    Null and empty texts have no words, sum 0 and a null mean. Rows that repeat are scored each and alike;
    a null doc_id is carried along. Other columns are ignored; empty input gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    words = vocabulary(rows)
    network = train(spark, rows, words)
    # Bounded: BUCKETS numbers and the network's parameters.
    shared = spark.sparkContext.broadcast((words, network.flat()))
    doc_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, flat = shared.value
        own = Network(flat)
        for batch in slices(batches):
            buckets, around, bounds = windows(batch.column(1))
            found = np.empty(len(buckets))
            for at in range(0, len(buckets), BATCH):
                part = slice(at, at + BATCH)
                wanted = words.classes[buckets[part]]
                _, _, out = own.forward(words.inputs[around[part]])
                found[part] = out[np.arange(len(wanted)), wanted] + words.within[buckets[part]]
            running = np.concatenate([[0.0], np.cumsum(found)])
            total, n = running[bounds[1:]] - running[bounds[:-1]], np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1), mask=n == 0)],
                names=["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"],
            )

    return rows.mapInArrow(
        run, f"doc_id {doc_type}, n_words long, log_likelihood double, mean_log_likelihood double"
    )
