"""Packing of tokenized documents into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import base64
import bisect
import functools
import heapq
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
#: The end of a document, less than a window, is cut into pieces of at most this many tokens.
PIECE = 512
#: Pieces that are dealt over windows together, within one task.
BLOCK = 4096
END = 1


class Encoder:
    """Ids of texts, as bytes of little-endian 32-bit numbers, by a ``tokenizers`` file.

    ``ranks``, the same vocabulary and pattern as ``tiktoken`` ranks, gives the ids of plain texts several
    times faster. Texts that hold the tokenizer's own marks, characters on whose class Unicode tables may
    disagree, or words of 1,000 characters go to the tokenizer itself (tests hold both equal).
    """

    #: What a plain text does not hold: marks, separators, characters outside of long settled ranges, long words.
    ODD = (
        r"<\||[\x1c-\x1f\x{85}\x{a0}]|[^\x{0}-\x{52f}\x{2010}-\x{2027}\x{2030}-\x{203e}\x{20ac}\x{3041}-\x{3096}"
        r"\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]|[^ ]{1000}"
    )

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            ).encode_ordinary

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def batch(self, texts: list[str]) -> list[bytes]:
        if not self.ranked:
            return self.whole(texts)
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), self.ODD).to_pylist()
        slow = iter(self.whole([t for t, o in zip(texts, odd) if o]))
        return [next(slow) if o else array("I", self.ranked(t)).tobytes() for t, o in zip(texts, odd)]


@functools.lru_cache(maxsize=1)
def encoder_of(path: str, ranks: str | None) -> Encoder:
    """One encoder a Python worker, which its tasks share."""
    return Encoder(path, ranks)


def multiway(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item: Karmarkar-Karp largest differencing for ``windows`` sums.

    Every item starts as a partial partition with one filled sum. The two partial partitions with the
    largest spread are merged, the largest sums of one with the smallest of the other, until one is left.
    Only the sums that differ from the smallest are held, so a merge costs what it moves.
    """
    heap: list[tuple[int, int, list[tuple[int, list]]]] = []
    for i, size in enumerate(sizes.tolist()):
        heap.append((-size, i, [(size, [i])]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, first = heapq.heappop(heap)
        _, tie, second = heapq.heappop(heap)
        # Both are in descending order and short of trailing sums, which are 0 above the smallest.
        room = windows - len(first)
        if len(second) <= room:
            merged = first
            for filled in second:
                bisect.insort(merged, filled, key=lambda x: -x[0])
        else:
            left = first + [(0, [])] * room
            right = second + [(0, [])] * (windows - len(second))
            merged = [(a + b, [m, n] if m and n else m or n) for (a, m), (b, n) in zip(left, reversed(right))]
            least = min(s for s, _ in merged)
            merged = sorted(((s - least, m) for s, m in merged), key=lambda x: -x[0])
        heapq.heappush(heap, (-(merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)), tie, merged))
    window = np.zeros(len(sizes), dtype=np.int64)
    for number, (_, members) in enumerate(heap[0][2] if heap else []):
        todo = [members]
        while todo:
            for x in todo.pop():
                if isinstance(x, list):
                    todo.append(x)
                else:
                    window[x] = number
    return window


def dealt(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows for items of at most ``capacity``; their number rises until none is overfull."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = multiway(sizes, windows) if windows < len(sizes) else np.arange(len(sizes))
        if not len(sizes) or np.bincount(window, sizes).max() <= capacity:
            return window
        windows += max(1, windows // 500)


def pieces(length: int) -> list[tuple[int, int]]:
    """(start, length): whole windows, then the rest in equal pieces of at most PIECE."""
    out = [(at, CAPACITY) for at in range(0, length - CAPACITY + 1, CAPACITY)]
    at, rest = len(out) * CAPACITY, length % CAPACITY
    parts = -(-rest // PIECE)
    for k in range(parts):
        stop = length - rest + rest * (k + 1) // parts
        out.append((at, stop - at))
        at = stop
    return out


def pack(
    docs: DataFrame, path: str, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: each document's pieces in windows.

    A document is its text's ids and then END; full windows are cut from its front and the rest into
    pieces of at most PIECE tokens, so that windows can be filled evenly. Each task deals BLOCK pieces
    at a time over as few windows as hold them, by multiway differencing, and nothing is shuffled: a
    window's pieces come from one task and its number names that task's partition. Windows hold at most
    CAPACITY tokens; offsets in a window run from 0 without gaps.

    A null text counts as empty: one piece of one token. Rows that repeat are packed each; a null doc_id is
    carried along. Long texts are tokenized whole and only their ids, not their windows, are held.
    ``path``, and ``ranks`` if given, are tokenizer files that every executor can read (see ``Encoder``). Empty input gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, "
        "doc_tokens long, sequence_id long, offset long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base, used = encoder_of(path, ranks), TaskContext.get().partitionId() << 40, 0
        names, cut, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal used, names, cut, held
            table = np.concatenate(cut)
            lengths = table[:, 1]
            full = lengths == CAPACITY
            window = np.empty(len(table), dtype=np.int64)
            window[full] = np.arange(full.sum())
            if not full.all():
                window[~full] = dealt(lengths[~full], CAPACITY) + full.sum()
            order = np.argsort(window, kind="stable")
            ended = np.cumsum(lengths[order])
            first = np.searchsorted(window[order], window[order])
            offset = np.empty(len(table), dtype=np.int64)
            offset[order] = ended - lengths[order] - (ended - lengths[order])[first]
            columns = [pa.concat_arrays(names), *(pa.array(c) for c in table.T), pa.array(base + used + window)]
            used += int(window.max()) + 1
            names, cut, held = [], [], 0
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = pc.fill_null(batch.column(1), "").to_pylist()
                found, owner = [], []
                for row, ids in enumerate(encoder.batch(texts)):
                    ids += END.to_bytes(4, "little")
                    view, tokens = memoryview(ids), len(ids) // 4
                    for start, length in pieces(tokens):
                        found.append((start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), tokens))
                        owner.append(row)
                names.append(batch.column(0).take(pa.array(owner, pa.int64())))
                cut.append(np.array(found, dtype=np.int64))
                held += len(found)
                if held >= BLOCK:
                    yield flush()
        if held:
            yield flush()

    return rows.mapInArrow(run, schema)
