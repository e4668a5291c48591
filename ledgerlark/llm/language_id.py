"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.text import mixed

ORDER = 5
#: Characters of labelled text that a language's model and its calibration are fitted on, at most about this many.
SAMPLE_CHARS = 400_000
#: Share of the sampled documents that calibrate rejection and are not fitted.
CALIBRATION = 0.2
UNKNOWN = "und"
WEIGHTS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(ORDER)], dtype=np.uint64)
#: Stands before each text; never scored.
EDGE = "\x01"
BLOCK_CHARS = 1 << 18

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space for what is no letter."""
    if not _letters:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for point in range(0x30000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
        table[1] = 1
        _letters.append(table)
    return _letters[0]


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(points, bounds): the texts' letters with one space for what lies between, each after ORDER - 1 edges.

    bounds[i] is where text i's edges begin; its first scored character is ORDER - 1 further on.
    """
    edges = EDGE * (ORDER - 1)
    raw = [t.replace(EDGE, " ") for t in texts]
    joined = np.frombuffer((edges + edges.join(raw)).encode("utf-32-le", "replace"), dtype=np.uint32)
    points = letters()[joined]
    lengths = np.array([len(t) for t in raw]) + ORDER - 1
    starts = np.concatenate([[0], np.cumsum(lengths)])
    keep = points != 32
    keep[1:] |= (points[:-1] != 32) & (points[:-1] != 1)
    place = np.concatenate([[0], np.cumsum(keep)])
    return points[keep], place[starts]


def grams(points: np.ndarray, back: int = 0) -> list[np.ndarray]:
    """Hashes of the 1-, 2-, ... grams that end ``back`` before each position from ORDER - 1 on."""
    wide, out = points.astype(np.uint64), []
    n = len(points) - ORDER + 1
    for k in range(ORDER - back):
        part = wide[ORDER - 1 - back - k : ORDER - 1 - back - k + n] * WEIGHTS[k]
        out.append(out[-1] + part if out else part)
    return out


def named(strings: list[str]) -> np.ndarray:
    """The hashes, as ``grams`` has them, of strings of one length."""
    if not strings:
        return np.empty(0, np.uint64)
    points = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32).reshape(len(strings), -1)
    return (points[:, ::-1] * WEIGHTS[: points.shape[1]]).sum(axis=1, dtype=np.uint64)


class HashArray:
    """Rows of values by 64-bit key: keys sorted, found from the slot that their leading bits name."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = mixed(keys)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length() + 1))
        heads = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.float64) * 2.0 ** int(self.shift)
        self.slots = np.searchsorted(self.keys.astype(np.float64), heads[:-1]).astype(np.int64)
        self.keys = np.append(self.keys, np.uint64(0xFFFFFFFFFFFFFFFF))
        # Conversion to floats may round a key up into the next slot; one step back is always enough to be below.
        self.slots = np.maximum(self.slots - 1, 0)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, found)."""
        keys = mixed(keys)
        place = self.slots[keys >> self.shift]
        behind = np.flatnonzero(self.keys[place] < keys)
        while len(behind):
            place[behind] += 1
            behind = behind[self.keys[place[behind]] < keys[behind]]
        return place, (self.keys[place] == keys) & (place < len(self.values))


class Model:
    """Kneser-Ney models of several languages over one set of hash arrays.

    ``scores`` has, for each ORDER-gram seen in any language, every language's interpolated log-probability;
    a gram seen in none falls back to the next shorter one plus the weight that its context leaves.
    """

    def __init__(self, counts: pd.DataFrame):
        """counts: lang, gram (ORDER characters), n."""
        self.langs = sorted(counts["lang"].unique())
        by_lang = {lang: part.set_index("gram")["n"] for lang, part in counts.groupby("lang")}
        levels: list[list[pd.Series]] = []
        now = [by_lang[lang] for lang in self.langs]
        for _ in range(ORDER):
            levels.append(now)
            now = [pd.Series(s.index.str[1:]).value_counts() for s in now]
        levels.reverse()
        alphabet = len(set().union(*(s.index for s in levels[0]))) + 1
        self.floor = np.log(np.full(len(self.langs), 1 / alphabet))
        self.scores: list[HashArray] = []
        self.left: list[HashArray] = []
        lower = None
        for k, level in enumerate(levels, 1):
            union = pd.Index(sorted(set().union(*(s.index for s in level))))
            contexts = union.str[:-1]
            heads = pd.Index(sorted(set(contexts)))
            chance = np.empty((len(union), len(self.langs)))
            rest = np.ones((len(heads), len(self.langs)))
            base = np.full((len(union), len(self.langs)), 1 / alphabet) if lower is None else lower.loc[union.str[1:]].values
            at = heads.get_indexer(contexts)
            for i, s in enumerate(level):
                once, twice = int((s == 1).sum()), int((s == 2).sum())
                discount = once / (once + 2 * twice) if once and twice else 0.5
                by_head = s.groupby(s.index.str[:-1]).agg(["sum", "count"]).reindex(heads)
                total = by_head["sum"].to_numpy()
                seen = total > 0
                rest[seen, i] = discount * by_head["count"].to_numpy()[seen] / total[seen]
                own = s.reindex(union).fillna(0).to_numpy()
                kept = np.where(seen[at], np.maximum(own - discount, 0) / np.where(seen, total, 1)[at], 0)
                chance[:, i] = kept + rest[at, i] * base[:, i]
            lower = pd.DataFrame(chance, index=union)
            self.scores.append(HashArray(named(list(union)), np.log(chance)))
            self.left.append(HashArray(named(list(heads)) if k > 1 else np.zeros(1, np.uint64), np.log(rest)))

    def log_probabilities(self, points: np.ndarray) -> np.ndarray:
        """(positions from ORDER - 1 on, languages)."""
        own = grams(points)
        before = [None] + grams(points, back=1)
        place, found = self.scores[-1].find(own[-1])
        out = self.scores[-1].values[np.where(found, place, 0)].astype(np.float64)
        todo = np.flatnonzero(~found)
        out[todo] = 0
        for k in range(ORDER, 0, -1):
            if not len(todo):
                break
            if k > 1:
                at, known = self.left[k - 1].find(before[k - 1][todo])
                out[todo[known]] += self.left[k - 1].values[at[known]]
                at, known = self.scores[k - 2].find(own[k - 2][todo])
                out[todo[known]] += self.scores[k - 2].values[at[known]]
                todo = todo[~known]
            else:
                out[todo] += self.left[0].values[0] + self.floor
        return out


def blocks(texts: list[str]) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, rows, pieces) of about BLOCK_CHARS: several short texts, or a piece of a long one."""
    first, held, size = 0, [], 0
    for row, text in enumerate(texts):
        if held and size + len(text) > BLOCK_CHARS:
            yield first, len(held), held
            first, held, size = row, [], 0
        if len(text) > BLOCK_CHARS:
            for at in range(0, len(text), BLOCK_CHARS):
                yield row, 1, [text[at : at + BLOCK_CHARS]]
            first = row + 1
        else:
            held.append(text)
            size += len(text)
    if held:
        yield first, len(held), held


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(summed negative log-probabilities by text and language, scored characters by text)."""
    loss, size = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts), np.int64)
    for first, rows, pieces in blocks(texts):
        points, bounds = characters(pieces)
        if len(points) < ORDER:
            continue
        scored = model.log_probabilities(points)
        # Position j of scored is point j + ORDER - 1; a text's own are from bounds[i] on, up to the next one's edges.
        starts, ends = bounds[:-1], bounds[1:] - (ORDER - 1)
        full = ends > starts
        sums = np.zeros((rows, len(model.langs)))
        running = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(scored, axis=0)])
        sums[full] = running[ends[full]] - running[starts[full]]
        loss[first : first + rows] -= sums
        size[first : first + rows] += np.maximum(ends - starts, 0)
    return loss, size


class Identifier:
    """A model and, for each language, the cross-entropy beyond which a text is none of them.

    The limit lies halfway between what 99 of 100 calibration texts stay below and what characters drawn at
    random would cost; for a short text it is raised by the spread of a mean over that many characters.
    """

    def __init__(self, model: Model, texts: list[str], langs: list[str]):
        self.model = model
        loss, size = entropies(model, texts)
        rate = loss / np.maximum(size, 1)[:, None]
        self.limit, self.spread = np.full(len(model.langs), np.inf), np.full(len(model.langs), 0.0)
        uniform = -float(model.floor[0])
        known = np.array([model.langs.index(lang) if lang in model.langs else -1 for lang in langs], dtype=int)
        for i in range(len(model.langs)):
            own = rate[(known == i) & (size >= 20), i]
            if len(own) >= 5:
                self.limit[i] = (np.quantile(own, 0.99) + uniform) / 2
                self.spread[i] = uniform

    def __call__(self, texts: list[str | None]) -> pd.DataFrame:
        loss, size = entropies(self.model, [t or "" for t in texts])
        rate = loss / np.maximum(size, 1)[:, None]
        best = rate.argmin(axis=1)
        lowest = rate[np.arange(len(texts)), best]
        # Posterior for equal priors, from at most 50 characters' worth of evidence: neighbours depend on each other.
        sure = 1 / np.exp(-(rate - lowest[:, None]) * np.minimum(size, 50)[:, None]).sum(axis=1)
        with_letters = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
        far = lowest > self.limit[best] + self.spread[best] / np.sqrt(np.maximum(size, 1))
        langs = np.array(self.model.langs, dtype=object)
        return pd.DataFrame(
            {
                "lang_pred": np.where(with_letters, langs[best], UNKNOWN),
                "score": np.where(with_letters, sure, 0.0),
                "cross_entropy": np.where(with_letters & (size > 0), lowest, np.nan),
                "rejected": ~with_letters | far,
            }
        )


def fit(spark: SparkSession, labelled: DataFrame, text: str = "text", lang: str = "lang") -> Identifier | None:
    """Fit on rows with text and language, sampled to about SAMPLE_CHARS a language; None without any.

    The sample takes each document of a language with one chance, that of a hash of its text, so that it
    is the same on every run. Counting is distributed; the driver gets at most the sample's distinct
    ORDER-grams and the calibration texts, which the number of documents doesn't change.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null and length(text) > 0")
    sizes = {r["lang"]: r["size"] for r in rows.groupBy("lang").agg(F.sum(F.length("text")).alias("size")).collect()}
    if not sizes:
        return None
    shares = F.create_map(*(F.lit(x) for name, size in sizes.items() for x in (name, min(1.0, SAMPLE_CHARS / size))))
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = rows.withColumn("chance", chance / F.element_at(shares, F.col("lang"))).where("chance < 1")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for _, _, pieces in blocks([value]):
                    points, _ = characters(pieces)
                    line = "".join(map(chr, points.tolist()))
                    found.update((name, line[i : i + ORDER]) for i in range(len(line) - ORDER + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.string()),
                    pa.array([k[1] for k in found], pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                names=["lang", "gram", "n"],
            )

    fitted = sampled.where(F.col("chance") >= CALIBRATION) if sum(sizes.values()) > SAMPLE_CHARS // 20 else sampled
    counts = fitted.mapInArrow(count, "lang string, gram string, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if not len(counts):
        return None
    held = sampled.where(F.col("chance") < CALIBRATION).select("text", "lang").toPandas()
    return Identifier(Model(counts), held["text"].tolist(), held["lang"].tolist())


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(
    spark: SparkSession, docs: DataFrame, identifier: Identifier | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected for every row of ``docs``.

    The language with the least cross-entropy per character over the whole text wins; ``score`` is its
    posterior. A null text or one without a letter is ``und`` with score 0 and rejected; a text further
    from its language than calibration texts are, allowing for its length, is rejected too, but named.
    Equal cross-entropies go to the first language in order. Without a fitted identifier all are ``und``.
    Rows that repeat are answered alike, columns other than the two named are ignored, and empty input
    gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if identifier is None:
        return rows.select(
            "doc_id",
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"),
            F.lit(True).alias("rejected"),
        )
    # Bounded: SAMPLE_CHARS times the number of languages.
    shared = spark.sparkContext.broadcast(identifier)
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, "
        "cross_entropy double, rejected boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = pa.RecordBatch.from_pandas(shared.value(batch.column(1).to_pylist()), preserve_index=False)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *found.columns], names=["doc_id", *found.schema.names]
                )

    return rows.mapInArrow(run, schema)
