"""Storage that the driver and every executor can reach, and a few helpers for it."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, as a URI.

    Only in local mode, where that setting is absent, does this make a temporary folder; on a cluster
    the executors could not reach one.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and every executor share")
    if not found:
        found = getattr(spark, "_landtide_shared", None)
        if not found:
            found = "file://" + tempfile.mkdtemp(prefix="landtide-")
            spark._landtide_shared = found
    return found.rstrip("/") if "://" in found or found.startswith("file:") else "file://" + found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh location below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there.

    A lost executor costs only the tasks it ran, because the files are on shared storage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._landtide_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared one; the caller no longer reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Remove what stash() wrote for ``df``; the caller no longer reads it."""
    path = getattr(df, "_landtide_path", None)
    if path:
        remove(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, made by a one-row generator.

    Unlike a projection, the optimizer doesn't fold a generator's expressions into later filters
    or lambda functions, where they would be evaluated again for each use or each element.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def whole_groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[bool, list[np.ndarray]]]:
    """Columns of rows sorted by the first: (False, some whole groups of equal first values), or (True, a part of a group of more than ``most`` rows)."""
    waiting: list[list[np.ndarray]] = []
    held, hot = 0, None
    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
        if hot is not None and len(batch):
            n = int(np.searchsorted(cols[0] != hot, True))
            if n:
                yield True, [c[:n] for c in cols]
            cols = [c[n:] for c in cols]
            hot = None if len(cols[0]) else hot
        if not len(cols[0]):
            continue
        if not (waiting and waiting[0][0][0] == cols[0][-1]):
            cols = [np.concatenate(x) for x in zip(*waiting, cols, strict=True)] if waiting else cols
            cut = len(cols[0]) - int(np.argmax((cols[0] != cols[0][-1])[::-1])) if cols[0][0] != cols[0][-1] else 0
            if cut:
                yield False, [c[:cut] for c in cols]
            waiting, held = [], 0
            cols = [c[cut:] for c in cols]
        waiting.append(cols)  # a group over several batches is put together once
        held += len(cols[0])
        if held > most:
            hot = waiting[0][0][0]
            yield from ((True, part) for part in waiting)
            waiting, held = [], 0
    if waiting:
        yield False, [np.concatenate(x) for x in zip(*waiting, strict=True)]


def tidy(run: Callable) -> Callable:
    """``run`` for mapInArrow. When a task ends its worker gives memory back: it stays alive beside the stages that follow."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped
