"""Token ids as directly addressable codes.

An id is cut into 8-bit chunks, the lowest first. Level 0 holds the lowest chunk of every id,
level k the k-th chunk of the ids that have one. A bitmap at each level marks the codes that
continue, and a rank directory (ones before each block of 512 codes) turns a position at one
level into the position at the next, so any token is read without decoding a block.

A file is a run of self-contained segments and a footer that lists them; a writer keeps one
segment in memory. Files are written under a temporary name and renamed, so a task that is run
again after an executor is lost replaces its own file with equal bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .shared import new_path

MAGIC, BLOCK, SEGMENT_TOKENS = b"LTDAC001", 512, 2_000_000
MANIFEST = "part int, path string, n_docs long, n_tokens long"


def encode_segment(doc_ids: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """Bytes of one segment: documents in order, their token counts, all their ids."""
    out = [struct.pack("<qq", len(doc_ids), len(ids)), doc_ids.astype("<i8").tobytes(), known.astype("u1").tobytes(), counts.astype("<i8").tobytes()]
    levels, rest = [], ids.astype("<u4")
    while True:
        more = rest > 0xFF
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype="i8"))]) if len(more) else np.zeros(1, "i8")
        levels.append(struct.pack("<q", len(rest)) + (rest & 0xFF).astype("u1").tobytes() + np.packbits(more, bitorder="little").tobytes() + ranks.astype("<i8").tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            break
    return b"".join([*out, struct.pack("<q", len(levels)), *levels])


class Segment:
    """Random access to the ids of one encoded segment."""

    def __init__(self, data: bytes):
        self.n_docs, self.n_tokens = struct.unpack_from("<qq", data)
        at = 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, n, at)
            at += got.nbytes
            return got

        self.doc_ids, self.known, self.counts = take("<i8", self.n_docs), take("u1", self.n_docs), take("<i8", self.n_docs)
        self.levels = []
        for _ in range(int(take("<q", 1)[0])):
            n = int(take("<q", 1)[0])
            self.levels.append((take("u1", n), take("u1", -(-n // 8)), take("<i8", -(-n // BLOCK) + 1)))

    def token(self, i: int) -> int:
        """The i-th id, by one code and one rank for each level it has."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for codes, bits, ranks in self.levels:
            value |= int(codes[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            start = i - i % BLOCK
            i = int(ranks[i // BLOCK]) + int(np.unpackbits(bits[start >> 3 : (i >> 3) + 1], bitorder="little")[: i - start].sum())
            shift += 8
        return value

    def ids(self) -> np.ndarray:
        """All ids, in order."""
        out, where = np.zeros(self.n_tokens, "<u4"), np.arange(self.n_tokens)
        for k, (codes, bits, _) in enumerate(self.levels):
            out[where] |= codes.astype("<u4") << np.uint32(8 * k)
            where = where[np.unpackbits(bits, count=len(codes), bitorder="little").astype(bool)]
        return out


def read_segments(uri: str) -> Iterator[Segment]:
    """The segments of a file, one in memory at a time."""
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        size = f.size()
        n, magic = struct.unpack("<q8s", f.read_at(16, size - 16))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        for start, length in struct.iter_unpack("<qq", f.read_at(16 * n, size - 16 - 16 * n)):
            yield Segment(f.read_at(length, start))


def _writer(folder: str, vocabulary: str, spaced: bool, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{base}/ids-{task.partitionId():07d}.dac"
        temporary = f"{name}.{task.taskAttemptId()}.tmp"
        enc, end = tokens.encoder(vocabulary, spaced), struct.pack("<I", end_id)
        places, held, n_held, n_docs, n_tokens = [], [], 0, 0, 0
        with store.open_output_stream(temporary) as f:

            def flush() -> None:
                nonlocal held, n_held
                if held:
                    keys = [k for k, _ in held]
                    data = encode_segment(np.array([k or 0 for k in keys], "i8"), np.array([k is not None for k in keys]), np.array([len(b) // 4 for _, b in held], "i8"), np.frombuffer(b"".join(b for _, b in held), "<u4"))
                    places.append((f.tell(), len(data)))
                    f.write(data)
                held, n_held = [], 0

            for key, ids in tokens.encoded(enc, batches):
                held.append((key, ids + end))
                n_docs, n_tokens, n_held = n_docs + 1, n_tokens + len(ids) // 4 + 1, n_held + len(ids) // 4 + 1
                if n_held >= SEGMENT_TOKENS:
                    flush()
            flush()
            f.write(b"".join(struct.pack("<qq", *p) for p in places) + struct.pack("<q8s", len(places), MAGIC))
        if store.get_file_info(name).type != fs.FileType.NotFound:
            store.delete_file(name)
        store.move(temporary, name)
        uri = f"{folder}/ids-{task.partitionId():07d}.dac"
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([uri]), pa.array([n_docs], pa.int64()), pa.array([n_tokens], pa.int64())], ["part", "path", "n_docs", "n_tokens"])

    return write


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, spaced: bool, end_id: int, key: str = "doc_id", text: str = "text") -> list:
    """Tokenise ``docs`` and write one file for each key range; returns the manifest rows in key order.

    Rows are ordered by ``key`` (null keys first) and, where keys are equal, by the text's hash
    and the text. A null text counts as empty. The manifest has one row for each file, whose
    number follows the shuffle partitions, not the documents.
    """
    src = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tie = F.xxhash64("t")
    placed = src.repartitionByRange("k", tie).sortWithinPartitions("k", tie, "t")
    return sorted(placed.mapInArrow(_writer(folder, vocabulary, spaced, end_id), MANIFEST).collect())


def read_token_files(spark: SparkSession, manifest: list) -> DataFrame:
    """A row for each document in the files: doc_id, start, n_tokens, ids (little-endian unsigned 32 bits)."""
    rows, start = [], 0
    for m in manifest:
        rows.append((m.path, start))
        start += m.n_tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for seg in read_segments(path):
                    data, ends = seg.ids().tobytes(), np.concatenate([[0], np.cumsum(seg.counts)])
                    for lo in range(0, seg.n_docs, 2000):
                        hi = min(lo + 2000, seg.n_docs)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(seg.doc_ids[lo:hi], pa.int64(), mask=seg.known[lo:hi] == 0),
                                pa.array(base + ends[lo:hi], pa.int64()),
                                pa.array(seg.counts[lo:hi], pa.int64()),
                                pa.array([data[4 * ends[i] : 4 * ends[i + 1]] for i in range(lo, hi)], pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )
                    base += seg.n_tokens

    files = spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")




def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, written, and read back from the files."""
    from .shared import table

    folder = new_path(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, tokens.vocabulary("word_bpe_49k.json"), False, 1)
    return read_token_files(spark, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
