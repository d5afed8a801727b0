"""Exact removal of long repeats, by a logarithmic family of sampled suffix arrays.

A full suffix array holds an entry for every byte. Here suffixes are sampled so that no repeat of
LENGTH bytes is lost: of the K-byte strings in each window of LENGTH bytes the one with the least
hash is the window's anchor, so equal windows have equal anchors at equal places. A run of windows
with one anchor is an entry: the suffix that starts at the anchor, and the hash of the run's bytes. A
level is the array of its entries in the order of their suffixes' first eight bytes; those that agree in
them stand by the hash of their first K bytes, and then by that of their run, so whatever shares K bytes
lies together. It is dealt into parts by the hash of the K bytes, each in a file of its own.

What occurs again in one file of texts stays one entry of it, marked as covered, and a level keeps one entry
of each run, so text that a third of all documents share doesn't gather in one part.

A new batch gets such an array, which is merged with those of the levels before it, part by part, and
scanned once: runs with equal bytes are covered whole, those that share K bytes only are compared window
by window. Levels of equal rank merge into one of the next rank in the same scan, so there are at most
log2(batches) + 1, and an entry is written anew as often.

Texts are kept once, in files; what is asked of them and what is covered goes to their files, so texts
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, remove, stash, table, whole_groups

LENGTH, K, SLICE = 200, 64, 250_000
#: Entries of one anchor that are compared in memory; more go by shuffles.
GROUP_ROWS = 50_000
#: Entries of one file that are held at a time to find runs that occur again there.
ENTRIES = 500_000
#: Runs of one anchor that are compared in one task; of more, windows are dealt by their place before the anchor and the bytes that all windows of such places hold.
HOT_RUNS, OFFSETS = 1_000, 20
#: In the place of an entry: the run is covered (it occurs again in its file or has done so before), or that is all there is to tell.
AGAIN, ONLY = 1 << 61, 1 << 62
#: Bytes of text for each part of the levels, bytes in a batch of a text file, and op10's batches.
PART_BYTES, LEAST_PARTS, BLOCK_BYTES, BATCHES = 4 << 20, 64, 4 << 20, 4
_BITS = np.uint64((1 << 21) - 1)
ENTRY = "part long, p long, m long, c long, tid long, place long"
COLUMNS = ["part", "p", "m", "c", "tid", "place"]


class _Hash:
    """Polynomial hashes modulo 2 ** 64 of all windows at once, from running sums."""

    def __init__(self, seed: int, size: int):
        rng = np.random.default_rng(seed)
        self.bytes = rng.integers(0, 1 << 63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.concatenate([[1], np.full(size, base)]).astype("u8"), dtype="u8")
            self.down = np.cumprod(np.concatenate([[1], np.full(size, pow(base, -1, 1 << 64))]).astype("u8"), dtype="u8")

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, "u8")
        with np.errstate(over="ignore"):
            np.cumsum(self.bytes[data] * self.down[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((sums[end] - sums[start]) * self.up[start])


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


_hashes: dict[int, _Hash] = {}


def _hash(seed: int) -> _Hash:
    if seed not in _hashes:
        _hashes[seed] = _Hash(seed, SLICE + SLICE // 4)
    return _hashes[seed]


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    padded = np.full(-(-len(v) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(v)] = v
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, 1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(after[: len(v) - width + 1], before[width - 1 : len(v)])


def runs(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of concatenated texts: each run's anchor hash, hash of its bytes, first window, number of windows and anchor."""
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, "u8"), np.zeros(0, "u8"), np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "i8"))
    h = _hash(1)
    sums = h.sums(data)
    at = np.arange(n - K + 1)
    grams = h.of(sums, at, at + K)
    anchor = (_sliding_least((grams & ~_BITS) | at.astype("u8"), LENGTH - K + 1) & _BITS).astype("i8")
    text = np.repeat(np.arange(len(lengths)), lengths)
    within = text[: n - LENGTH + 1] == text[LENGTH - 1 :]
    key = np.where(within, anchor, -1)
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (text[1 : n - LENGTH + 1] != text[: n - LENGTH])]))
    count = np.diff(np.append(first, n - LENGTH + 1))
    good = key[first] >= 0
    first, count = first[good], count[good]
    return grams[key[first]], h.of(sums, first, first + count + LENGTH - 1), first, count, key[first]


def _slices(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[list, list[bytes]]]:
    """(tid, offset) and bytes of texts, together SLICE bytes or little more; a longer text comes in overlapping parts."""
    keys, parts, size = [], [], 0
    for tid, whole in texts:
        for lo in range(0, max(1, len(whole) - LENGTH + 1), SLICE):
            part = whole[lo : lo + SLICE + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if size and size + len(part) > SLICE:
                yield keys, parts
                keys, parts, size = [], [], 0
            keys.append((tid, lo))
            parts.append(part)
            size += len(part)
    if parts:
        yield keys, parts


class _Output:
    """A file in shared storage, under its name only once it is whole; a task that runs again replaces it with equal bytes."""

    def __init__(self, uri: str, schema: pa.Schema):
        self.store, self.name = fs.FileSystem.from_uri(uri)
        self.store.create_dir(self.name.rpartition("/")[0], recursive=True)
        self.temporary = f"{self.name}.{TaskContext.get().taskAttemptId()}.tmp"
        self.stream = self.store.open_output_stream(self.temporary)
        self.writer = pa.ipc.new_stream(self.stream, schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))

    def close(self) -> None:
        self.writer.close()
        self.stream.close()
        if self.store.get_file_info(self.name).type != fs.FileType.NotFound:
            self.store.delete_file(self.name)
        self.store.move(self.temporary, self.name)


def _blocks(uri: str) -> Iterator[pa.RecordBatch]:
    store, name = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(name) as f, pa.ipc.open_stream(f) as blocks:
        yield from blocks


def _keeper(folder: str, base: int):
    """Writes (doc_id, b) rows to one file for each task; yields its number, rows and bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("b", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, total, out = base + TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            ends = np.cumsum([len(b) for b in batch.column(1).to_pylist()]) if len(batch) else np.zeros(0, "i8")
            cuts = np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                if hi > lo:
                    out = out or _Output(f"{folder}/{number}", schema)
                    out.writer.write_batch(pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)], schema=schema))
            rows, total = rows + len(batch), total + (int(ends[-1]) if len(batch) else 0)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (number, rows, total)], ["file", "rows", "bytes"])

    return write


def _texts(folder: str, number: int) -> Iterator[tuple[int, object, bytes]]:
    """(tid, doc_id, bytes) of a file of texts; a tid is the number of the file and the row's place in it."""
    row = 0
    for block in _blocks(f"{folder}/{number}"):
        for d, b in zip(block.column(0).to_pylist(), block.column(1), strict=True):
            yield (number << 32) + row, d, b.as_py()
            row += 1


def _entries(folder: str, parts: int):
    """The entries of the texts of files; a run that occurs again in its file is one entry, the other places are only covered."""

    def slices(number: int) -> Iterator[list[np.ndarray]]:
        for keys, texts in _slices((tid, b) for tid, _, b in _texts(folder, number)):
            data = np.frombuffer(b"".join(texts), "u1")
            lengths = np.array([len(t) for t in texts], "i8")
            m, c, first, count, anchor = runs(data, lengths)
            ends = np.cumsum(lengths)
            text = np.searchsorted(ends, first, "right")
            own = first - (ends - lengths)[text] + np.array([k[1] for k in keys], "i8")[text]
            tid = np.array([k[0] for k in keys], "i8")[text]
            suffix = np.lib.stride_tricks.sliding_window_view(data, 8)[anchor].copy().view(">u8")[:, 0] ^ np.uint64(1 << 63)
            yield [suffix.astype("u8").view("i8"), m.view("i8"), c.view("i8") ^ count, tid, (own << 20) | ((anchor - first) << 10) | count]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number in (n for batch in batches for n in batch.column(0).to_pylist()):
            held, size = [], 0
            for cols in slices(number):
                held.append(cols)
                size += len(cols[0])
                if size >= ENTRIES:
                    yield from entries(held)
                    held, size = [], 0
            if held:
                yield from entries(held)

    def entries(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        p, m, c, tid, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((c, m))
        same = (m[order][1:] == m[order][:-1]) & (c[order][1:] == c[order][:-1])
        place[order[:-1][same]] |= AGAIN
        place[order[1:][same]] |= AGAIN
        place[order[1:][same]] |= ONLY
        only = (place & ONLY) != 0
        part = m.view("u8") % np.uint64(parts)
        part[only] = tid[only].view("u8") % np.uint64(parts)
        out = pa.RecordBatch.from_arrays([pa.array(x) for x in (part.astype("i8"), p, m, c, tid, place)], COLUMNS)
        for lo in range(0, len(out), 10_000):
            yield out.slice(lo, 10_000)

    return run


def _scan(levels: list[str], merged: list[str], into: str | None):
    """Streams a batch's entries sorted by part, p, m, c; merges each part with those of ``levels`` and scans it.

    Yields entries that are covered (kind 0) and entries to compare (kind 1). The batch and the levels in
    ``merged`` are written as one level, ``into``.
    """
    schema = pa.schema([(c, pa.int64()) for c in COLUMNS[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cols in whole_groups(batches, 1 << 62):
            bounds = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1], [True]]))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield from scan(int(cols[0][lo]), [x[lo:hi][cols[4][lo:hi] >= 0] for x in cols[1:]])

    def scan(part: int, batch: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        told = (batch[4] & ONLY) != 0
        yield from out(0, batch[1][told], batch[2][told], batch[3][told], batch[4][told])
        batch = [x[~told] for x in batch]
        arrays, sources = [batch], [np.full(len(batch[0]), -1)]
        for k, level in enumerate(levels):
            for block in _blocks(f"{level}/{part}"):
                arrays.append([block.column(i).to_numpy() for i in range(5)])
                sources.append(np.full(len(block), k))
        p, m, c, tid, place = (np.concatenate(x) for x in zip(*arrays, strict=True))
        source = np.concatenate(sources)
        if levels:
            order = np.lexsort((c, m, p))
            p, m, c, tid, place, source = (x[order] for x in (p, m, c, tid, place, source))
        new_anchor = np.concatenate([[True], (m[1:] != m[:-1]) | (p[1:] != p[:-1])])[: len(m)]
        new_run = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])[: len(m)]
        run_of, runs_at = np.cumsum(new_run) - 1, np.flatnonzero(new_run)
        size, fresh, known = (np.bincount(run_of, x, len(runs_at)) for x in (None, source < 0, (place & AGAIN) != 0))
        again = (size > 1) | (known > 0)
        if into:
            kept = np.isin(source, [-1, *[k for k, level in enumerate(levels) if level in merged]])
            at = np.flatnonzero(kept)
            at = at[np.unique(run_of[at], return_index=True)[1]]
            held = [p[at], m[at], c[at], tid[at], place[at] | np.where(again[run_of[at]], AGAIN, 0)]
            file = _Output(f"{into}/{part}", schema)
            rows = pa.RecordBatch.from_arrays([pa.array(x) for x in held], schema=schema)
            for lo in range(0, len(rows), 50_000):
                file.writer.write_batch(rows.slice(lo, 50_000))
            file.close()
        if not len(batch[0]):
            return
        # of a run that occurs again, what is new, and what stood alone before
        covered = np.flatnonzero(again[run_of] & ((source < 0) | ((place & AGAIN) == 0)) & (fresh > 0)[run_of])
        anchor_of = (np.cumsum(new_anchor) - 1)[runs_at]  # of each run
        compared = (np.bincount(anchor_of) > 1) & (np.bincount(anchor_of, ~again) > 0) & (np.bincount(anchor_of, fresh == size) > 0)
        asked = runs_at[compared[anchor_of]]
        for kind, at in ((0, covered), (1, asked)):
            yield from out(kind, m[at], c[at], tid[at], place[at])

    def out(kind: int, m: np.ndarray, c: np.ndarray, tid: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = pa.RecordBatch.from_arrays([pa.array(np.full(len(m), kind, "i1")), *[pa.array(x) for x in (m, tid, place & (AGAIN - 1))]], ["kind", "m", "tid", "place"])
        for lo in range(0, len(rows), 10_000):
            yield rows.slice(lo, 10_000)

    return run


def _fetch(folder: str):
    """Streams (file, tid, m, place, hot) sorted by file; yields the runs' bytes.

    Those of a hot anchor come in pieces by the windows' places before it, dealt by the bytes that all windows
    of such places hold; pieces that are equal in one file are covered (without bytes), but for one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cols in whole_groups(batches, 1 << 62):
            bounds = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1], [True]]))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield from pieces(int(cols[0][lo]), *(x[lo:hi] for x in cols[1:]))

    def pieces(number: int, tid: np.ndarray, m: np.ndarray, place: np.ndarray, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
        import xxhash

        order = np.argsort(tid, kind="stable")
        wanted = list(zip(*(x[order].tolist() for x in (tid, m, place, hot)), strict=True))
        i, rows = 0, []
        known: dict[tuple[int, bytes], tuple | None] = {}  # the first of equal pieces, or none once it is told
        for t, _, b in _texts(folder, number):
            while i < len(wanted) and wanted[i][0] == t:
                _, anchor, x, is_hot = wanted[i]
                i += 1
                a, before, n = x >> 20, (x >> 10) & 1023, x & 1023
                if not is_hot:
                    rows.append((anchor, t, a, a + n + LENGTH - 1, b[a : a + n + LENGTH - 1]))
                    continue
                for k in range((before - n + 1) // OFFSETS, before // OFFSETS + 1):
                    first, last = a + max(0, before - (k + 1) * OFFSETS + 1), a + min(n - 1, before - k * OFFSETS)
                    at = a + before - k * OFFSETS
                    key = _dealt(anchor ^ xxhash.xxh64_intdigest(b[at : at - OFFSETS + 1 + LENGTH]), k)
                    piece = b[first : last + LENGTH]
                    row, same = (key, t, first, last + LENGTH), (key, xxhash.xxh3_128_digest(piece))
                    if same not in known:
                        known[same] = row
                        rows.append((*row, piece))
                        continue
                    if known[same]:
                        rows.append((*known[same], None))
                        known[same] = None
                    rows.append((*row, None))
            if len(rows) >= 2_000:
                yield batch_of(rows)
                rows = []
        yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary())], ["m", "tid", "a", "e", "bytes"])

    return run


def _dealt(anchor: int, block: int) -> int:
    """The key of a block of windows of an anchor."""
    key = (anchor * 31 + block * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)
    return key - 2**64 if key >> 63 else key


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (m, tid, a, bytes) sorted by m: stretches that occur twice (kind 0), or all windows of a group too large for memory (kind 1)."""
    held: list[pa.RecordBatch] = []
    size, hot = 0, None

    def windows(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        data = b"".join(rows.column("bytes").to_pylist())
        lengths = np.array([len(b) for b in rows.column("bytes").to_pylist()], "i8")
        count, begin = lengths - LENGTH + 1, np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(lengths)), count)
        offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        at = begin[row] + offset
        z = []
        for seed in (2, 3):
            h = _hash(seed)
            if len(data) + 1 > len(h.up):
                h = _Hash(seed, len(data) + 1)
            z.append(h.of(h.sums(np.frombuffer(data, "u1")), at, at + LENGTH))
        m = rows.column("m").to_numpy().view("u8")[row]
        return z[0] ^ mixed(m), z[1], row, rows.column("a").to_numpy()[row] + offset

    def out(kind: int, rows: pa.RecordBatch, row: np.ndarray, z1, z2, start, end) -> pa.RecordBatch:
        take = pa.array(row)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(row), kind, "i1")), pa.array(z1), pa.array(z2), rows.column("tid").take(take), pa.array(start), pa.array(end)], ["kind", "z1", "z2", "tid", "s", "e"])

    def spread(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(rows), 2_000):
            part = rows.slice(lo, 2_000)
            z1, z2, row, s = windows(part)
            yield out(1, part, row, z1.view("i8"), z2.view("i8"), s, s + LENGTH)

    def resolve(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Whole groups, some 1,000 rows of them at a time."""
        m, lo = rows.column("m").to_numpy(), 0
        for hi in [*(np.flatnonzero(m[1:] != m[:-1]) + 1).tolist(), len(m)]:
            if hi - lo >= 1_000 or hi == len(m):
                yield from groups(rows.slice(lo, hi - lo))
                lo = hi

    def groups(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        z1, z2, row, s = windows(rows)
        order = np.lexsort((z2, z1))
        same = (z1[order][1:] == z1[order][:-1]) & (z2[order][1:] == z2[order][:-1])
        twice = np.zeros(len(row), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.flatnonzero(twice)
        first = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])])) if len(hit) else hit
        last = np.append(first[1:], len(hit)) - 1 if len(hit) else hit
        none = np.zeros(len(first), "i8")
        yield out(0, rows, row[hit[first]], none, none, s[hit[first]], s[hit[last]] + LENGTH)

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        lo = 0
        if hot is not None:
            lo = int(np.searchsorted(batch.column("m").to_numpy() != hot, True))
            yield from spread(batch.slice(0, lo))
            if lo == len(batch):
                continue
            hot = None
        held.append(batch.slice(lo))
        size += len(held[-1])
        if size < 4_000:
            continue
        rows = joined()
        m = rows.column("m").to_numpy()
        cut = int(np.searchsorted(m != m[-1], False)) if m[0] == m[-1] else len(m) - int(np.argmax((m != m[-1])[::-1]))
        if cut:
            yield from resolve(rows.slice(0, cut))
        held, size = [rows.slice(cut)], len(rows) - cut
        if size > GROUP_ROWS:
            hot = int(m[-1])
            yield from spread(held[0])
            held, size = [], 0
    if size:
        yield from resolve(joined())


class Family:
    """The texts taken in, the levels of their entries, and what these show to be covered."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = new_path(spark, "texts")
        self.levels: list[tuple[int, str]] = []
        self.files: DataFrame | None = None
        self.found: DataFrame | None = None
        self.n_files = self.parts = 0

    def store(self, texts: DataFrame) -> DataFrame:
        """Keep texts (doc_id, b); returns their files (file, rows, bytes)."""
        files = stash(texts.mapInArrow(_keeper(self.folder, self.n_files), "file long, rows long, bytes long"), "files")
        last, size = files.agg(F.max("file"), F.sum("bytes")).first()
        self.n_files = self.n_files if last is None else last + 1
        self.files = files if self.files is None else self.files.unionAll(files)
        self.parts = self.parts or max(LEAST_PARTS, -(-(size or 0) // PART_BYTES))
        return files

    def add(self, texts: DataFrame) -> None:
        """Take in a batch (doc_id, b) of any size."""
        self.index(self.store(texts))

    def index(self, files: DataFrame, last: bool = False) -> None:
        """Make the array of a batch of files, and merge and scan it with the levels. After the ``last`` one no level is written."""
        n = files.count()
        if not n:
            return
        entries = files.select("file").repartition(n).mapInArrow(_entries(self.folder, self.parts), ENTRY)
        none = [F.lit(0).cast("long").alias(c) for c in ("p", "m", "c")]
        every = self.spark.range(self.parts).select(F.col("id").alias("part"), *none, F.lit(-1).cast("long").alias("tid"), F.lit(0).cast("long").alias("place"))
        merged, rank = [], 0
        while self.levels and self.levels[-1][0] == rank:
            merged.append(self.levels.pop()[1])
            rank += 1
        into = None if last else new_path(self.spark, "level")
        levels = [level for _, level in self.levels] + merged
        dealt = entries.unionAll(every).repartition("part").sortWithinPartitions("part", "p", "m", "c")
        found = stash(dealt.mapInArrow(_scan(levels, merged, into), "kind byte, m long, tid long, place long"), "found")
        self.found = found if self.found is None else self.found.unionAll(found)
        for level in merged if into else levels:
            remove(self.spark, level)
        self.levels = [*self.levels, (rank, into)] if into else []

    def covered(self) -> DataFrame:
        """tid, s, e of every stretch that occurs elsewhere."""
        n = F.col("place").bitwiseAND(F.lit(1023))
        whole = self.found.filter("kind = 0").select("tid", F.shiftright("place", 20).alias("s"), (F.shiftright("place", 20) + n + LENGTH - 1).alias("e"))
        asked = stash(self.found.filter("kind = 1").select("m", "tid", "place").distinct(), "asked")
        hot = asked.groupBy("m").count().filter(F.col("count") > HOT_RUNS).select("m", F.lit(1).cast("long").alias("hot"))
        marked = asked.join(hot, "m", "left").select(F.shiftright("tid", 32).alias("file"), "tid", "m", "place", F.coalesce("hot", F.lit(0)).cast("long").alias("hot"))
        pieces = marked.repartition("file").sortWithinPartitions("file").mapInArrow(_fetch(self.folder), "m long, tid long, a long, e long, bytes binary")
        pieces = stash(pieces, "pieces")
        equal = pieces.filter("bytes is null").select("tid", F.col("a").alias("s"), "e")
        done = stash(pieces.filter("bytes is not null").select("m", "tid", "a", "bytes").repartition("m").sortWithinPartitions("m").mapInArrow(_compare, "kind byte, z1 long, z2 long, tid long, s long, e long"), "windows")
        large = done.filter("kind = 1")
        twice = large.groupBy("z1", "z2").agg(F.count("*").alias("k")).filter("k > 1").select("z1", "z2")
        return whole.unionAll(equal).unionAll(done.filter("kind = 0").select("tid", "s", "e")).unionAll(large.join(twice, ["z1", "z2"]).select("tid", "s", "e"))


def _strip(folder: str):
    """Streams (file, tid, s, e) sorted by file, one row without a text for each file; yields every text's remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cols in whole_groups(batches, 1 << 62):
            bounds = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1], [True]]))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield from stripped(int(cols[0][lo]), *(x[lo:hi] for x in cols[1:]))

    def stripped(number: int, tid: np.ndarray, s: np.ndarray, e: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((e, s, tid))
        tid, s, e = tid[order], s[order].tolist(), e[order].tolist()
        i = int(np.searchsorted(tid, 0))
        tids, rows, size = tid.tolist(), [], 0
        for t, d, b in _texts(folder, number):
            kept, at, n, gone = [], 0, 0, 0
            while i < len(tids) and tids[i] == t:
                if e[i] > at:
                    if s[i] > at or not n:
                        kept.append(b[at : s[i]])
                        n += 1
                    gone += e[i] - max(s[i], at)
                    at = e[i]
                i += 1
            rows.append((d, len(b), gone, n, b"".join([*kept, b[at:]])))
            size += len(b)
            if size >= BLOCK_BYTES:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("b"))


def without_repeats(docs: DataFrame, batches: list[DataFrame] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of each row.

    A null text counts as empty; a text of fewer than LENGTH bytes has nothing to remove, one of any
    length is taken whole. Repeated rows of LENGTH bytes or more repeat each other and lose every byte.
    Other columns are not read; an empty input gives no row. batches: ``docs`` in parts, to take in one
    after another; by default its files are dealt into BATCHES.
    """
    family = Family(docs.sparkSession)
    if batches:
        for part in batches:
            family.add(keyed(part, key, text))
    else:
        files = family.store(keyed(docs, key, text))
        for k in range(BATCHES):
            family.index(files.filter(F.pmod("file", F.lit(BATCHES)) == k), last=k == BATCHES - 1)
    none = F.lit(0).cast("long")
    every = family.files.select("file", F.lit(-1).cast("long").alias("tid"), none.alias("s"), none.alias("e"))
    if family.found is not None:
        every = every.unionAll(family.covered().select(F.shiftright("tid", 32).alias("file"), "tid", "s", "e"))
    return every.repartition("file").sortWithinPartitions("file").mapInArrow(_strip(family.folder), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats of 200 bytes leave of every document."""
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
