"""Order-preserving packing by dynamic programming.

Documents are one stream of tokens in input order. A window (a sequence) ends at a document's
or a sentence's end; only a stretch of more than STRETCH tokens without either gets further
cut points. A window costs its padding plus a penalty where it cuts a document. With f the least
cost up to a cut point, f(j) = pen(j) + L - pos(j) + min(f(i) + pos(i)) over the points i within
L tokens, a sliding minimum kept in a monotone queue; windows of a power of two of
tokens, from LEAST_POWER, carry no padding and are looked up directly.

Partitions are packed one by one without a shuffle, in blocks of BLOCK_TOKENS, so memory is bounded
and a lost task is simply run again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .shared import table, tidy

BLOCK_TOKENS, STRETCH, STEP, LEAST_POWER = 1_000_000, 192, 64, 128
SENTENCE_PENALTY, STRETCH_PENALTY, SEQUENCE_COST = 2.0, 24.0, 1.0
PIECES = "row_no long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _jumps(pos: np.ndarray, powers: list[int]) -> dict[int, list[int]]:
    """By index into ``pos``: the indices that lie just one of ``powers`` before it."""
    place = np.full(pos[-1] + 1, -1)
    place[pos] = np.arange(len(pos))
    found: dict[int, list[int]] = {}
    for w in powers:
        later = np.flatnonzero(pos >= w)
        at = place[pos[later] - w]
        for j, k in zip(later[at >= 0].tolist(), at[at >= 0].tolist(), strict=True):
            found.setdefault(j, []).append(k)
    return found


def best_cuts(pos: np.ndarray, penalty: np.ndarray, limit: int) -> list[int]:
    """Indices into ``pos`` of the window ends that cost least. pos[0] is 0, no gap exceeds ``limit``."""
    jumps = _jumps(pos, [1 << k for k in range(limit.bit_length()) if LEAST_POWER <= 1 << k < limit])
    p, pen = pos.tolist(), (penalty + SEQUENCE_COST).tolist()
    cost, back = [0.0] * len(p), [0] * len(p)
    queue: deque = deque([(0.0, 0)])  # (cost + position, index), increasing in both
    for j in range(1, len(p)):
        at = p[j]
        while p[queue[0][1]] < at - limit:
            queue.popleft()
        best, i = queue[0]
        best += limit - at
        if j in jumps:
            for k in jumps[j]:
                if cost[k] < best:
                    best, i = cost[k], k
        best += pen[j]
        cost[j], back[j] = best, i
        value = best + at
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    ends, j = [], len(p) - 1
    while j:
        ends.append(j)
        j = back[j]
    return ends[::-1]


def cut_points(ids: np.ndarray, ends: np.ndarray, closes: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut points of a block with their penalties. ends: where its documents end; closes, opens: by id, whether a sentence may end or begin with it."""
    inner = np.flatnonzero(closes[ids[:-1]] & opens[ids[1:]]) + 1
    penalty = np.full(len(ids) + 1, np.inf)
    penalty[inner] = SENTENCE_PENALTY
    penalty[ends] = 0
    penalty[0] = 0
    pos = np.flatnonzero(np.isfinite(penalty))
    wide = np.flatnonzero(np.diff(pos) > STRETCH)
    if len(wide):
        more = np.concatenate([np.arange(pos[k] + STEP, pos[k + 1], STEP) for k in wide])
        penalty[more] = STRETCH_PENALTY
        pos = np.flatnonzero(np.isfinite(penalty))
    return pos, penalty[pos]


@cache
def sentence_tables(path: str) -> tuple[np.ndarray, np.ndarray]:
    """By id: does the token close a sentence, does it open one (it begins with white space)?"""
    vocabulary = tokens.encoder(path, True).tokenizer.get_vocab()
    closes, opens = np.zeros(max(vocabulary.values()) + 2, bool), np.zeros(max(vocabulary.values()) + 2, bool)
    for token, i in vocabulary.items():
        closes[i] = token.rstrip("\"')]").endswith((".", "!", "?", "Ċ"))
        opens[i] = token.startswith(("Ġ", "Ċ"))
    return closes, opens


def _packer(path: str, limit: int, end_id: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end_bytes = tokens.encoder(path, True), np.array([end_id], "<u4").tobytes()
        closes, opens = sentence_tables(path)
        sequence = TaskContext.get().partitionId() << 36

        def flush(keys: list, parts: list) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            data = b"".join(parts)
            lengths = np.array([len(b) // 4 for b in parts], "i8")
            last = np.cumsum(lengths)
            first = last - lengths
            pos, penalty = cut_points(np.frombuffer(data, "<u4"), last, closes, opens)
            ends = pos[best_cuts(pos, penalty, limit)]
            begins = np.concatenate([[0], ends[:-1]])
            at = np.union1d(first, begins)
            until = np.append(at[1:], last[-1])
            doc, window = np.searchsorted(last, at, "right"), np.searchsorted(ends, at, "right")
            for lo in range(0, len(at), 5000):
                s = slice(lo, lo + 5000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[d] for d in doc[s].tolist()], pa.int64()),
                        pa.array(at[s] - first[doc[s]]),
                        pa.array(until[s] - at[s]),
                        pa.array(lengths[doc[s]]),
                        pa.array(sequence + window[s]),
                        pa.array(at[s] - begins[window[s]]),
                        pa.array([data[4 * a : 4 * b] for a, b in zip(at[s].tolist(), until[s].tolist(), strict=True)], pa.binary()),
                    ],
                    ["row_no", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )
            sequence += len(ends)

        keys, parts, held = [], [], 0
        for key, ids in tokens.encoded(enc, batches):
            parts.append(ids + end_bytes)
            keys.append(key)
            held += len(ids) // 4 + 1
            if held >= BLOCK_TOKENS:
                yield from flush(keys, parts)
                keys, parts, held = [], [], 0
        if parts:
            yield from flush(keys, parts)

    return pack


def pack(docs: DataFrame, limit: int = 1024, path: str | None = None, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece of a document: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ids are little-endian unsigned 32-bit integers; a document's ids are those of its text (null:
    empty) and ``end_id``. Rows keep the order in which the input is read. A document of any length
    is cut into as many pieces as needed; repeated rows are packed each on its own, a null key is
    kept, an empty input gives no row. Other columns are not read.
    """
    src = docs.select(F.col(key).cast("long").alias("row_no"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return src.mapInArrow(tidy(_packer(path or tokens.vocabulary("byte_bpe_50k.json"), limit, end_id)), PIECES).withColumnRenamed("row_no", "doc_id")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    out = pack(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
