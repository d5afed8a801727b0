"""Approximate nearest neighbours by inner product, with balanced posting lists.

Vectors are lifted by one coordinate, so that the largest inner product is the least distance. A
bounded sample is split in halves by size again and again; the means of the parts are the centroids,
and a graph over them, in each worker's memory, is searched by a beam. Every distinct vector goes
into the list of its nearest centroid, and a boundary vector also into those of others hardly
farther. A query reads the lists whose centroid is at most 1 + SEARCH_RATIO times as far as the
nearest one, LEAST_LISTS at least and no more than the beam of the search holds. Lists lie in files by group of centroids, in blocks; found candidates are scored again
in double precision on the original vectors.

Equal vectors are one entry with its TOP + 1 smallest ids: since ties go to the smaller id, no other
copy can be in a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import new_path, stash, table

#: The centroids are fitted on about SAMPLE vectors at most, chosen by hash; every vector is indexed.
SAMPLE, LIST_ROWS, GROUP_LISTS = 40_000, 128, 128
REPLICAS, REPLICA_RATIO, SEARCH_RATIO = 3, 0.05, 0.15
DEGREE, POST_BEAM, ASK_BEAM, LEAST_LISTS, BLOCK_ROWS, QUERIES = 16, 16, 160, 64, 4096, 256


class Centroids:
    """Balanced centroids and the graph over them."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 0):
        self.rng, self.points = np.random.default_rng(seed), sample
        self.c = np.array([sample[part].mean(0) for part in self._split(np.arange(len(sample)), lists)], "f4")
        self.points = None
        n = len(self.c)
        self.norms = (self.c * self.c).sum(1)
        near = np.argsort(self.norms[None] - 2 * self.c @ self.c.T + self.norms[:, None], 1)[:, 1 : DEGREE + 1]
        links: list[set] = [set(row) for row in near.tolist()]
        for i, row in enumerate(near.tolist()):
            for j in row:
                links[j].add(i)
        far = self.rng.integers(0, n, (n, 4))
        width = max((len(s) for s in links), default=0) + 4
        self.graph = np.array([[*sorted(s), *far[i].tolist(), *[i] * width][:width] for i, s in enumerate(links)])

    def _split(self, part: np.ndarray, lists: int) -> list[np.ndarray]:
        if lists <= 1 or len(part) < 2:
            return [part]
        p = self.points[part]
        a = p[self.rng.integers(len(p))]
        a = p[((p - a) ** 2).sum(1).argmax()]
        b = p[((p - a) ** 2).sum(1).argmax()]
        for _ in range(4):
            first = ((p - a) ** 2).sum(1) < ((p - b) ** 2).sum(1)
            if first.all() or not first.any():
                break
            a, b = p[first].mean(0), p[~first].mean(0)
        order = np.argsort(p @ (b - a), kind="stable")
        cut = max(1, len(part) * (lists // 2) // lists)
        return self._split(part[order[:cut]], lists // 2) + self._split(part[order[cut:]], lists - lists // 2)

    def search(self, q: np.ndarray, ratio: float, least: int, beam: int) -> list[np.ndarray]:
        """For each row of ``q`` the centroids found within 1 + ``ratio`` times the distance of its nearest, at least ``least``, nearest first.

        A beam search over the graph: each hop expands the nearest centroid of the beam that hasn't been, and
        costs the same whatever the number of centroids. It ends when what is left lies out of the ratio
        and ``least`` centroids are known to be nearer, or the whole beam has been expanded.
        """
        m, n = len(q), len(self.c)
        beam = min(beam, n)
        q2, out = (q * q).sum(1), []
        start = np.unique(np.linspace(0, n - 1, beam).astype(int))
        ids = np.broadcast_to(start, (m, len(start))).copy()
        dist = q2[:, None] + self.norms[start] - 2 * q @ self.c[start].T
        done = np.zeros(ids.shape, bool)
        live = np.arange(m)
        while len(live):
            d, i = dist[live], ids[live]
            open_ = np.where(done[live], np.inf, d)
            best = open_.argmin(1)
            rows = np.arange(len(live))
            score = open_[rows, best]
            wanted = np.partition(d, least - 1, 1)[:, least - 1] if least < d.shape[1] else d.max(1)
            goes = np.isfinite(score) & ((score <= np.maximum(d.min(1), 0) * (1 + ratio) ** 2) | (score <= wanted))
            live, best, i, d = live[goes], best[goes], i[goes], d[goes]
            if not len(live):
                break
            done[live, best] = True
            near = np.sort(self.graph[i[np.arange(len(live)), best]], 1)
            new = self.norms[near] + q2[live, None] - 2 * np.einsum("ij,ikj->ik", q[live], self.c[near])
            new[:, 1:][near[:, 1:] == near[:, :-1]] = np.inf
            new[(near[:, :, None] == i[:, None, :]).any(2)] = np.inf
            every, of, seen = np.concatenate([d, new], 1), np.concatenate([i, near], 1), np.concatenate([done[live], ~np.isfinite(new)], 1)
            keep = np.argpartition(every, beam - 1, 1)[:, :beam]
            dist[live], ids[live], done[live] = (np.take_along_axis(x, keep, 1) for x in (every, of, seen))
        root = np.sqrt(np.maximum(dist, 0))
        for k in range(m):
            order = np.argsort(root[k], kind="stable")
            n_near = int((root[k] <= (1 + ratio) * root[k][order[0]] + 1e-6).sum())
            out.append(ids[k][order[: max(n_near, least)]])
        return out


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, top - (x * x).sum(1)))[:, None]], 1).astype("f4")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def valid(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v of the rows that take part: no null key, no null, non-finite or all-zero vector."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.filter(F.col(key).isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)).select(F.col(key).cast("long").alias("id"), v.cast("array<float>").alias("v"))


FOUND = "query_id long, rank int, vec_id long, score double"


def nearest(rows: DataFrame, is_query, top: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``top`` nearest found for each query, the query's own id left out.

    is_query: a condition on the column id. Rows that can't take part (see valid) neither ask nor
    answer; vectors of different lengths have no product, so each length has an index of its own.
    Equal rows count once. With fewer candidates all of them are returned; an empty input gives no row.
    Other columns are not read.
    """
    spark = rows.sparkSession
    good = stash(valid(rows, key, vector), "vectors")
    sizes = sorted(r[0] for r in good.select(F.size("v")).distinct().collect())
    found = [_nearest(good.filter(F.size("v") == n), is_query, top) for n in sizes]
    if not found:
        return spark.createDataFrame([], FOUND)
    for more in found[1:]:
        found[0] = found[0].unionAll(more)
    return found[0]


def _nearest(good: DataFrame, is_query, top: int) -> DataFrame:
    """nearest() of valid vectors of one length."""
    spark = good.sparkSession
    copies = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    distinct = stash(good.distinct().withColumn("n", F.row_number().over(copies)).filter(F.col("n") <= top + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct-vectors")
    n = distinct.count()
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    scale = distinct.agg(F.max(norm)).first()[0]
    part = distinct if n <= SAMPLE else distinct.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int((1 << 30) * SAMPLE / n))
    sample = np.array([r[0] for r in part.select("v").toLocalIterator()], "f4")
    sample = sample[np.lexsort(sample.T[::-1])] if len(sample) else np.array([distinct.first()["v"]], "f4")
    lists = max(1, min(-(-n // LIST_ROWS), len(sample) // 8))
    shared = spark.sparkContext.broadcast((Centroids(_lift(sample, scale), lists), scale))
    folder = new_path(spark, "posting-lists")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, scale = shared.value
        for batch in batches:
            for lo in range(0, len(batch), QUERIES):
                b = batch.slice(lo, QUERIES)
                found = [f[:REPLICAS] for f in centroids.search(_lift(_matrix(b.column(0)), scale), REPLICA_RATIO, 1, POST_BEAM)]
                take = pa.array(np.repeat(np.arange(len(b)), [len(f) for f in found]))
                place = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array((place // GROUP_LISTS).astype("i4")), pa.array(place.astype("i4")), b.column(0).take(take), b.column(1).take(take)], ["g", "list", "v", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out = None
        for batch in batches:
            g = batch.column(0).to_numpy()
            for lo, hi in zip(np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])).tolist(), [*(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)], strict=True):
                if out is None or out[0] != g[lo]:
                    if out is not None:
                        yield from close(store, *out)
                    name = f"{base}/{int(g[lo])}-{task.partitionId()}"
                    stream = store.open_output_stream(f"{name}.{task.taskAttemptId()}.tmp")
                    out = (int(g[lo]), name, f"{name}.{task.taskAttemptId()}.tmp", stream, pa.ipc.new_stream(stream, batch.schema))
                for at in range(lo, hi, BLOCK_ROWS):
                    out[4].write_batch(batch.slice(at, min(hi, at + BLOCK_ROWS) - at))
        if out is not None:
            yield from close(store, *out)

    def close(store, g: int, name: str, temporary: str, stream, writer) -> Iterator[pa.RecordBatch]:
        writer.close()
        stream.close()
        if store.get_file_info(name).type != fs.FileType.NotFound:
            store.delete_file(name)
        store.move(temporary, name)
        yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([f"{folder}/{name.rpartition('/')[2]}"])], ["g", "path"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, scale = shared.value
        for batch in batches:
            for lo in range(0, len(batch), QUERIES):
                b = batch.slice(lo, QUERIES)
                q = _matrix(b.column(1))
                lifted = np.concatenate([q * np.float32(math.sqrt(scale)) / np.maximum(np.sqrt((q * q).sum(1))[:, None], 1e-30), np.zeros((len(q), 1), "f4")], 1)
                rows_ = [(i, g, f[f // GROUP_LISTS == g]) for i, f in enumerate(centroids.search(lifted.astype("f4"), SEARCH_RATIO, LEAST_LISTS, ASK_BEAM)) for g in np.unique(f // GROUP_LISTS)]
                take = pa.array([i for i, _, _ in rows_], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([g for _, g, _ in rows_], pa.int32()), b.column(0).take(take), b.column(1).take(take), pa.array([f.tolist() for _, _, f in rows_], pa.list_(pa.int32()))], ["g", "query_id", "q", "lists"])

    order = F.xxhash64("v")
    posted = stash(distinct.mapInArrow(post, "g int, list int, v array<float>, ids array<long>"), "posted")
    placed = posted.repartitionByRange("g", "list", order).sortWithinPartitions("g", "list", order)
    paths: dict[int, list[str]] = {}
    for r in sorted(placed.mapInArrow(write, "g int, path string").collect()):
        paths.setdefault(r["g"], []).append(r["path"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = batch.column(0).to_numpy()
            for part in np.split(np.arange(len(g)), np.flatnonzero(g[1:] != g[:-1]) + 1):
                for lo in range(0, len(part), 4 * QUERIES):
                    some = batch.slice(int(part[lo]), min(4 * QUERIES, len(part) - lo))
                    yield from _best(some, paths.get(int(g[part[0]]), []), top)

    asking = good.filter(is_query).distinct().mapInArrow(ask, "g int, query_id long, q array<float>, lists array<int>")
    dealt = asking.repartition("g", F.pmod(F.xxhash64("query_id"), F.lit(8))).sortWithinPartitions("g", "query_id")
    found = dealt.mapInArrow(search, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _best(queries: pa.RecordBatch, paths: list[str], top: int) -> Iterator[pa.RecordBatch]:
    """The best of the entries in a group's files for each query, over the lists that it selected: a list is scored for the queries that want it only."""
    q, names = _matrix(queries.column(2)).astype("f8"), queries.column(1).to_numpy()
    keep = REPLICAS * (top + 1)  # an entry may lie in so many lists
    chosen = np.zeros((len(q), GROUP_LISTS), bool)
    lists = queries.column(3)
    chosen[np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy() % GROUP_LISTS] = True
    best = np.full((len(q), keep), -np.inf)
    where = np.zeros((len(q), keep), "i8")
    vectors, ids, held = [], [], 0
    for path in paths:
        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_stream(name) as f, pa.ipc.open_stream(f) as blocks:
            for block in blocks:
                x, which = _matrix(block.column(2)), block.column(1).to_numpy() % GROUP_LISTS
                edges = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1], [True]]))
                used = np.zeros(len(x), bool)
                for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    asking = np.flatnonzero(chosen[:, which[lo]])
                    if not len(asking):
                        continue
                    scores = np.concatenate([best[asking], q[asking] @ x[lo:hi].T.astype("f8")], 1)
                    places = np.concatenate([where[asking], np.broadcast_to(np.arange(held + lo, held + hi), (len(asking), hi - lo))], 1)
                    cut = np.argpartition(-scores, keep - 1, 1)[:, :keep]
                    best[asking], where[asking] = np.take_along_axis(scores, cut, 1), np.take_along_axis(places, cut, 1)
                # only the entries that some query keeps stay in memory
                mine = where[np.isfinite(best)]
                used[mine[mine >= held] - held] = True
                place = np.cumsum(used) - 1 + held
                late = where >= held
                where[late] = place[where[late] - held]
                vectors.append(x[used])
                ids.append(block.column(3).filter(pa.array(used)))
                held += int(used.sum())
    out_q, out_v, out_s = [], [], []
    if held:
        x, known = np.concatenate(vectors), [i for part in ids for i in part.to_pylist()]
        for i in range(len(q)):
            mine = where[i][np.isfinite(best[i])]
            exact = np.einsum("ij,j->i", x[mine].astype("f8"), q[i])
            rows = {(v, s) for j, s in zip(mine.tolist(), exact.tolist(), strict=True) for v in known[j] if v != names[i]}
            for v, s in sorted(rows, key=lambda r: (-r[1], r[0]))[:top]:
                out_q.append(int(names[i]))
                out_v.append(v)
                out_s.append(s)
    yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())], ["query_id", "vec_id", "score"])


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
