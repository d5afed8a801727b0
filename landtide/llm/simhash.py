r"""Near-duplicates by SimHash, with covering locality-sensitive hashing.

A fingerprint has bit i set if more than half of the XXH64 hashes of a text's word shingles have.
Each bit position is given a nonzero vector of radius + 1 bits; for each nonzero vector x a table's
mask has the positions whose vector has an odd product with x. The vectors of at most ``radius``
positions don't span the space, so some x is orthogonal to all of them: in that table two
fingerprints that differ in just these positions have equal masked bits. Every pair within the
radius so meets in one of 2 ** (radius + 1) - 1 tables, without exception.

Fingerprints are made distinct first, so copies never meet each other. Buckets are streamed in
sorted order; within one, a spanning tree of its links is emitted, not its pairs. A bucket of more
than BUCKET_ROWS is dealt out again by radius + 1 blocks of bits, one of which any pair within the
radius shares, and goes to another round; each round's blocks are others, so buckets shrink until
they fit.

near_copies() finds texts alike in SIMILARITY of their five-word shingles or more. Near copies keep most
of their words, while an edit changes five shingles, so it takes SEEDS fingerprints of the set of words:
two texts whose fingerprints lie within the radius for any seed meet in a table, and what has met is
compared exactly, in whole shingle sets: first with a head of each bucket, and what that leaves apart
inside the buckets, where the sets go, so a family of varied copies is never spelled out in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components
from .shared import stash, table, tidy, whole_groups

BUCKET_ROWS, DIRECT_ROWS, ROUNDS = 200_000, 2_000, 12
BITS = 64
#: Of near_copies(): words of a shingle, similarity, fingerprints of a text and what one of them may differ by
#: at most in a candidate pair.
SHINGLE, SIMILARITY, SEEDS, FARTHEST = 5, (4, 5), 3, 14
#: Bounds of memory: known words, rows of a broadcast key table.
MEMO_WORDS, BROADCAST_ROWS = 100_000, 1_000_000


def masks(radius: int) -> list[int]:
    """The tables' bit masks, as unsigned integers."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(BITS)]
    return [sum(1 << i for i, y in enumerate(vectors) if (x & y).bit_count() & 1) for x in range(1, 1 << (radius + 1))]


def fingerprint(text: bytes, shingle: int) -> int:
    """Of a text as UTF-8: signed; 0 if it has no word."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(x, 42) for x in map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))]
    h, ones = np.array(hashes, "<u8"), np.zeros(BITS, "i8")
    for lo in range(0, len(h), 50_000):
        part = h[lo : lo + 50_000]
        ones += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (a signed long) of each row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t, shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()], pa.int64())], ["doc_id", "fp"])

    src = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return src.mapInArrow(run, "doc_id long, fp long")


def spanning(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (fingerprint, other) that connect just what links within ``radius`` connect among distinct ``fps``."""
    if len(fps) > DIRECT_ROWS:
        varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
        free = [i for i in range(BITS) if varying >> i & 1]
        if len(free) > 2 * radius:
            out = []
            for k in range(radius + 1):
                block = np.uint64(sum(1 << i for i in free[k :: radius + 1]))
                part = fps & block
                order = np.argsort(part, kind="stable")
                for group in np.split(fps[order], np.flatnonzero(np.diff(part[order])) + 1):
                    if len(group) > 1:
                        out += spanning(group, radius)
            return out
    out, left = [], fps
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                out += [(int(y), int(x)) for y in found]
                todo += list(found)
                left = left[~near]
    return out


def dealt(radius: int, depth: int) -> list[int]:
    """Masks of radius + 1 disjoint blocks of all bits, others at each depth: an odd stride meets every bit once."""
    stride = depth * 6 + 1
    out = [sum(1 << (i * stride) % BITS for i in range(k, BITS, radius + 1)) for k in range(radius + 1)]
    assert sum(out) == (1 << BITS) - 1 and sum(m.bit_count() for m in out) == BITS
    return out


def _linker(radius: int, last: bool, depth: int):
    """Streams (bucket, fp) rows sorted by bucket; yields links (kind 0) and rows for another round (kind 1)."""
    blocks = dealt(radius, depth)

    def batch_of(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, "i1")), pa.array(a.astype("u8").view("i8")), pa.array(b.astype("u8").view("i8"))], ["kind", "a", "b"])

    def again(bucket: int, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k, block in enumerate(blocks):
            with np.errstate(over="ignore"):
                key = (np.uint64(bucket) * np.uint64(31) + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15) ^ (fps & np.uint64(block)) * np.uint64(0xC2B2AE3D27D4EB4F)
            yield batch_of(1, key, fps)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_f, hot = np.zeros(0, "u8"), np.zeros(0, "u8"), None

        def ready(b: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, int)
            sizes = np.diff(np.append(starts, len(b)))
            two = starts[sizes == 2]
            x, y = f[two], f[two + 1]
            near = (np.bitwise_count(x ^ y) <= radius) & (x != y)
            links = [(x[near], y[near])]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                found = spanning(np.unique(f[s : s + n]), radius)
                if found:
                    got = np.array(found, "u8")
                    links.append((got[:, 0], got[:, 1]))
            yield batch_of(0, np.concatenate([p for p, _ in links]), np.concatenate([q for _, q in links]))

        for batch in batches:
            b = np.concatenate([held_b, batch.column(0).to_numpy().view("u8")])
            f = np.concatenate([held_f, batch.column(1).to_numpy().view("u8")])
            if hot is not None:
                n = int(np.searchsorted(b != np.uint64(hot), True))
                yield from again(hot, f[:n])
                b, f = b[n:], f[n:]
                hot = hot if not len(b) else None
            if not len(b):
                held_b, held_f = b, f
                continue
            cut = len(b) - int(np.argmax((b != b[-1])[::-1])) if b[0] != b[-1] else 0
            if cut:
                yield from ready(b[:cut], f[:cut])
            held_b, held_f = b[cut:], f[cut:]
            if len(held_b) > BUCKET_ROWS and not last:
                hot = int(held_b[0])
                yield from again(hot, held_f)
                held_b, held_f = held_b[:0], held_f[:0]
        if len(held_b):
            yield from ready(held_b, held_f)

    return link


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links a, b that connect just what pairs of the distinct fingerprints ``fp`` within ``radius`` connect."""
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks(radius)]
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)])
    rows = nodes.select(F.explode(keys).alias("bucket"), "fp")
    out = None
    for depth in range(ROUNDS):
        last = depth == ROUNDS - 1
        found = stash(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_linker(radius, last, depth), "kind byte, a long, b long"), "buckets")
        these = found.filter("kind = 0").select("a", "b")
        out = these if out is None else out.unionAll(these)
        rows = found.filter("kind = 1").select(F.col("a").alias("bucket"), F.col("b").alias("fp"))
        if last or rows.isEmpty():
            return out
    return out


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the smallest key reachable) of each row.

    Rows without words have fingerprint 0 and are linked like any other. Null keys never name a
    component unless it has no other key. Repeated rows each give a row. An empty input gives none.
    """
    made = stash(fingerprints(docs, shingle, key, text), "fingerprints")
    nodes = stash(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, nodes["fp"] == roots["u"], "left").select("fp", "least", F.coalesce("v", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return made.join(rooted.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _hashes(text: bytes, memo: dict[bytes, int]) -> np.ndarray:
    """The hash of each word, A-Z in lower case."""
    import xxhash

    words = text.lower().split()
    if len(memo) > MEMO_WORDS:
        memo.clear()
    for w in words:
        if w not in memo:
            memo[w] = xxhash.xxh64_intdigest(w, 42)
    return np.fromiter(map(memo.__getitem__, words), "u8", len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of word hashes; fewer words are one shingle, none have none."""
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1 if size else 0, "u8")
    with np.errstate(over="ignore"):
        for k in range(size):
            out = _mixed(out + np.uint64(size)) + words[k : len(words) - size + k + 1]
    return np.unique(_mixed(out))


def word_prints(words: np.ndarray) -> list[int]:
    """SEEDS fingerprints of the set of words, signed."""
    own, out = np.unique(words), []
    for k in range(SEEDS):
        ones = np.zeros(BITS, "i8")
        for lo in range(0, len(own), 50_000):
            h = _mixed(own[lo : lo + 50_000] + np.uint64(k))
            ones += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
        out.append(int(np.packbits(2 * ones > len(own), bitorder="little").view("<i8")[0]))
    return out


def _texts(batch: pa.RecordBatch, i: int) -> Iterator[bytes]:
    return (x.as_py() for x in batch.column(i).cast(pa.binary()))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, th, text): doc_id, th, sid (hash of the shingle set), n (its size) and the fingerprints."""
    import xxhash

    memo: dict[bytes, int] = {}
    for batch in batches:
        rows = []
        for t in _texts(batch, 2):
            words = _hashes(t, memo)
            held = shingles(words)
            rows.append((xxhash.xxh64_intdigest(held.tobytes(), 7), len(held), *word_prints(words)))
        cols = list(zip(*rows, strict=True)) if rows else [()] * (2 + SEEDS)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(cols[0], "u8").view("i8")), *[pa.array(c, pa.int64()) for c in cols[1:]]], ["doc_id", "th", "sid", "n", *[f"f{k}" for k in range(SEEDS)]])


def _alike(shared, n, m):
    """Do sets of n and m elements with so many shared ones reach SIMILARITY? In whole numbers."""
    num, den = SIMILARITY
    return shared * (num + den) >= num * (n + m)


MET = "kind byte, bucket long, a long, b long, fp long, n long"


def _meet(radius: int, depth: int):
    """Streams (bucket, sid, fp, nt) sorted by bucket; nt is the size of the set and the number of the table.

    Yields pairs with a head of their bucket that may be alike (kind 0), the rows of buckets that hold more
    pairs (kind 1), and rows of buckets that are dealt out again (kind 2).
    """
    blocks = dealt(radius, depth)

    def out(kind: int, bucket, a, b, fp, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, "i1")), *[pa.array(x.view("i8")) for x in (bucket, a, b, fp, n)]], ["kind", "bucket", "a", "b", "fp", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for is_hot, (bucket, sid, fp, n) in whole_groups(batches, BUCKET_ROWS if depth < ROUNDS - 1 else 1 << 62):
            if is_hot:
                for k, block in enumerate(blocks):
                    with np.errstate(over="ignore"):
                        key = _mixed((bucket.view("u8") * np.uint64(31) + np.uint64(k + 1)) ^ _mixed(fp.view("u8") & np.uint64(block)))
                    yield out(2, key, sid, sid, fp, n)
                continue
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            sizes = np.diff(np.append(starts, len(bucket)))
            i = starts[sizes == 2]
            j = i + 1
            fits = _possible(fp, n >> 6, i, j)
            a, b = [sid[i[fits]]], [sid[j[fits]]]
            for s, m in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                left = np.arange(s, s + m)
                while len(left) > 1:
                    head, left = left[0], left[1:]
                    near = _possible(fp, n >> 6, head, left)
                    a.append(np.full(int(near.sum()), sid[head]))
                    b.append(sid[left[near]])
                    left = left[~near]
            a, b = np.concatenate(a), np.concatenate(b)
            none = np.zeros(len(a), "i8")
            yield out(0, none, a, b, none, none)
            more = np.repeat(sizes > 2, sizes)
            yield out(1, bucket[more], sid[more], sid[more], fp[more], n[more])

    return run


def _possible(fp: np.ndarray, n: np.ndarray, i, j) -> np.ndarray:
    num, den = SIMILARITY
    return (np.bitwise_count(fp[i].view("u8") ^ fp[j].view("u8")) <= FARTHEST) & (np.minimum(n[i], n[j]) * den >= np.maximum(n[i], n[j]) * num)


def _rest(radius: int):
    """Of the rows (bucket, sid, fp, nt, root, ...) of one bucket: (i, partners of other roots that may be alike, nearest first), for rows outside the commonest root.

    A pair that meets in several tables of a fingerprint is left to the first of them.
    """
    tables = [np.uint64(m) for m in masks(radius)]

    def partners(fp: np.ndarray, nt: np.ndarray, root: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        values, counts = np.unique(root, return_counts=True)
        if len(values) < 2:
            return
        main, n = values[counts.argmax()], nt >> 6
        earlier = tables[: int(nt[0]) & 63]
        for i in np.flatnonzero(root != main).tolist():
            j = np.flatnonzero((root != root[i]) & ((root == main) | (np.arange(len(root)) > i)))
            j = j[_possible(fp, n, i, j)]
            apart = fp[j].view("u8") ^ fp[i : i + 1].view("u8")
            first = np.ones(len(j), bool)
            for m in earlier:
                first &= (apart & m) != 0
            if first.any():
                yield i, j[first][np.argsort(np.bitwise_count(apart[first]), kind="stable")]

    return partners


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for _, cols in whole_groups(batches, 1 << 62):
        starts = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1]])).tolist()
        for s, e in zip(starts, [*starts[1:], len(cols[0])], strict=True):
            yield [c[s:e] for c in cols]


def _open(radius: int):
    """Streams (bucket, sid, fp, nt, root) sorted by bucket; yields the rows that may be alike to one of another root."""
    partners = _rest(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _buckets(batches):
            used = np.zeros(len(cols[0]), bool)
            for i, j in partners(*cols[2:]):
                used[i] = used[j] = True
            if used.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[used]) for c in cols], ["bucket", "sid", "fp", "n", "root"])

    return run


def _join(radius: int):
    """Streams (bucket, sid, fp, nt, root, x) sorted by bucket, x being whole sets; yields links that connect what is alike across roots."""
    partners = _rest(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sid, fp, nt, root, x in _buckets(batches):
            parent, held, links = {r: r for r in root.tolist()}, {}, []

            def find(r: int, parent: dict = parent) -> int:
                while parent[r] != r:
                    parent[r] = r = parent[parent[r]]
                return r

            def of(i: int, held: dict = held, x: np.ndarray = x) -> np.ndarray:
                if i not in held:
                    held[i] = np.frombuffer(x[i], "u8")
                return held[i]

            for i, near in partners(fp, nt, root):
                for j in near.tolist():
                    r, q = find(int(root[i])), find(int(root[j]))
                    if r != q and _same(of(i), of(j)):
                        links.append((int(sid[i]), int(sid[j])))
                        parent[r] = q
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], ["a", "b"])

    return run


def _same(x: np.ndarray, y: np.ndarray) -> bool:
    """Are two sets alike?"""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return bool(_alike(int((both[1:] == both[:-1]).sum()), len(x), len(y)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: dict[bytes, int] = {}
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(_hashes(t, memo)).tobytes() for t in _texts(batch, 1)], pa.binary())], ["sid", "x"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, x, y), x and y being whole sets: those that are alike."""
    for batch in batches:
        keep = []
        for i in range(len(batch)):
            x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), "u8") for k in (2, 3))
            keep.append(_same(x, y))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.coalesce(F.col(text), F.lit("")).alias("t"))


def near_copies(docs: DataFrame, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """sid, doc_id, th, n_rows and root of each distinct shingle set: its smallest key, that row's text hash, its rows, and one root for what pairs of SIMILARITY connect.

    Any two texts alike that lie within ``radius`` for one of the fingerprints are linked; farther ones
    mostly are, and no pair below the similarity is. A null text counts as empty; all rows without words
    are one set. A text of any length is taken whole. An empty input gives none.
    """
    made = _hashed(docs, key, text).mapInArrow(tidy(_sketched), "doc_id long, th long, sid long, n long, " + ", ".join(f"f{k} long" for k in range(SEEDS)))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th")))
    nodes = made.groupBy("sid").agg(first.alias("one"), F.min("th").alias("any"), F.count("*").alias("n_rows"), F.first("n").alias("n"), *[F.first(f"f{k}").alias(f"f{k}") for k in range(SEEDS)])
    nodes = stash(nodes, "nodes")
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks(radius)]
    keys = F.array(*[F.struct(F.xxhash64(F.lit(k), F.lit(i), F.col(f"f{k}").bitwiseAND(F.lit(m).cast("long"))).alias("bucket"), F.col(f"f{k}").alias("fp"), (F.col("n") * 64 + i).alias("n")) for k in range(SEEDS) for i, m in enumerate(signed)])
    rows = nodes.select(F.explode(keys).alias("k"), "sid").select("k.bucket", "sid", "k.fp", "k.n")
    pairs = members = None
    for depth in range(ROUNDS):
        met = stash(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_meet(radius, depth)), MET), "met")
        these, those = met.filter("kind = 0").select("a", "b"), met.filter("kind = 1").select("bucket", F.col("a").alias("sid"), "fp", "n")
        pairs, members = (these, those) if pairs is None else (pairs.unionAll(these), members.unionAll(those))
        rows = met.filter("kind = 2").select("bucket", F.col("a").alias("sid"), "fp", "n")
        if rows.isEmpty():
            break
    heads = stash(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    whole = _whole(docs, nodes, heads.select(F.col("a").alias("sid")).union(heads.select("b")), key, text)
    both = heads.join(whole.select(F.col("sid").alias("a"), "x"), "a").join(whole.select(F.col("sid").alias("b"), F.col("x").alias("y")), "b").select("a", "b", "x", "y")
    links = stash(both.mapInArrow(tidy(_verify), "a long, b long"), "alike")
    roots = components(links)
    known = members.join(roots, F.col("sid") == F.col("u"), "left").select("bucket", "sid", "fp", "n", F.coalesce("v", "sid").alias("root"))
    apart = stash(known.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_open(radius)), "bucket long, sid long, fp long, n long, root long"), "apart")
    if not apart.isEmpty():
        whole = _whole(docs, nodes, apart.select("sid"), key, text)
        rest = apart.join(whole, "sid").select("bucket", "sid", "fp", "n", "root", "x").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_join(radius)), "a long, b long")
        roots = components(links.unionAll(rest))
    return nodes.join(roots, F.col("sid") == F.col("u"), "left").select("sid", "one.doc_id", "one.th", "n_rows", F.coalesce("v", "sid").alias("root"))


def _whole(docs: DataFrame, nodes: DataFrame, sids: DataFrame, key: str, text: str) -> DataFrame:
    """sid and x, the whole shingle set, of ``sids``. Sets are made again, from one text of each."""
    involved = stash(sids.distinct().join(nodes.select("sid", F.col("any").alias("th")), "sid"), "involved")
    texts = _hashed(docs, key, text).select("th", "t")
    if involved.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(involved.select("th")), "th", "left_semi")
    once = texts.groupBy("th").agg(F.first("t").alias("t")).join(involved, "th").select("sid", "t")
    return stash(once.mapInArrow(tidy(_sets), "sid long, x binary"), "whole-sets")


def keep_one(docs: DataFrame, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: that of its smallest key (of equal keys, of the least text hash).

    Rows with a null key can't be told apart and all stay. Columns, whatever their names, are as given.
    """
    names = docs.columns
    found = near_copies(docs, radius, key, text).filter("doc_id is not null")
    best = found.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("s")).select("s.doc_id", "s.th").distinct()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"))
    once = Window.partitionBy("doc_id", "th").orderBy(F.lit(1))
    kept = own.join(best, ["doc_id", "th"], "left_semi").withColumn("nth", F.row_number().over(once)).filter("nth = 1")
    return kept.unionByName(own.filter("doc_id is null").withColumn("nth", F.lit(1))).select("row.*")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and component, at 4-word shingles and radius 4."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
