"""Sharding by minimax contiguous partition.

Equal values of the group column are one group, and a group is never cut. Groups stand in hash
order and are gathered into at most ATOMS atoms (ranges of that order), whose byte sizes are all
the driver sees. The smallest feasible capacity is found by binary search, each candidate being
checked greedily over prefix sums, and the cuts are made there. An atom larger than an even
share takes a shard alone and the rest is solved again with the shards that remain, so one hot
group does not make the others uneven.

Slots come from per-atom row counts. An atom with many rows is dealt into cells by the hash of
the key, and rows are numbered within a cell; the driver's table of cells has at most 2 * ATOMS rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stash, table

ATOMS, CELL_ROWS = 65_536, 1_000


def greedy_cuts(prefix: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Ends of the shards when each takes all that fits in ``capacity``; None if ``shards`` don't suffice."""
    ends, at, n = [], 0, len(prefix) - 1
    while at < n:
        end = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        if end == at or len(ends) == shards:
            return None
        ends.append(end)
        at = end
    return ends


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[list[int], int]:
    """Ends of at most ``shards`` contiguous ranges of ``sizes`` with the smallest largest sum, and that sum."""
    sizes = np.asarray(sizes, "i8")
    if not len(sizes):
        return [], 0
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    low, high = max(int(sizes.max()), -(-int(prefix[-1]) // shards)), int(prefix[-1])
    while low < high:
        mid = (low + high) // 2
        if greedy_cuts(prefix, mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return even_cuts(prefix, low, shards), low


def even_cuts(prefix: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Cuts within ``capacity`` that lie as near to even shares of what is left as it allows.

    Filling each shard to the capacity would leave the last one short.
    """
    n = len(prefix) - 1
    reach = (np.searchsorted(prefix, prefix[:-1] + capacity, "right") - 1).tolist()
    need = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        need[i] = 1 + need[reach[i]]
    ends, at = [], 0
    for left in range(min(shards, n), 0, -1):
        if at == n:
            break
        target = prefix[at] + (prefix[-1] - prefix[at]) / left
        end = int(np.searchsorted(prefix, target))
        if end - 1 > at and target - prefix[end - 1] < prefix[end] - target:
            end -= 1
        end = max(at + 1, min(end, reach[at], n))
        while need[end] > left - 1:
            end += 1
        ends.append(end)
        at = end
    return ends


def assign(sizes: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each atom: atoms above an even share first, one shard each, then minimax over the others."""
    sizes = np.asarray(sizes, "i8")
    out, rest, left = np.zeros(len(sizes), "i8"), np.arange(len(sizes)), shards
    while left > 1 and len(rest) > 1:
        k = int(sizes[rest].argmax())
        if sizes[rest[k]] * left <= sizes[rest].sum():
            break
        out[rest[k]] = shards - left
        rest, left = np.delete(rest, k), left - 1
    ends, _ = minimax_cuts(sizes[rest], left)
    out[rest] = shards - left + np.searchsorted(np.array(ends, "i8"), np.arange(len(rest)), "right")
    return out


def shard(rows: DataFrame, shards: int, group, size, key: str = "doc_id") -> DataFrame:
    """``rows`` with shard (0 to shards-1) and slot (gapless from 0 in each shard).

    group: a column; rows with equal values stay together, nulls being one group. size: a long
    column of bytes. ``key`` orders the slots of a cell. Any other columns are kept; __atom and
    __bytes must not be among them, and columns
    named shard or slot are replaced. An empty input gives an empty result; repeated rows each
    take a slot of their own.
    """
    spark = rows.sparkSession
    keyed = stash(rows.drop("shard", "slot").withColumn("__atom", F.pmod(F.xxhash64(group), F.lit(ATOMS)).cast("int")).withColumn("__bytes", size), "sharding")
    atoms = keyed.groupBy("__atom").agg(F.sum("__bytes").alias("b"), F.count("*").alias("n")).toPandas().sort_values("__atom")
    atom, counts = atoms["__atom"].to_numpy("i8"), atoms["n"].to_numpy("i8")
    shard_of = assign(atoms["b"].to_numpy("i8"), shards)
    cells = -(-counts // max(CELL_ROWS, -(-int(counts.sum()) // ATOMS)))
    plan = _table(spark, {"__atom": atom, "__cells": cells})
    salt = F.pmod(F.xxhash64(F.col(key)), F.col("__cells")).cast("int")
    celled = keyed.join(F.broadcast(plan), "__atom").withColumn("__cell", F.when(F.col("__cells") > 1, salt).otherwise(0)).drop("__cells")
    place = {(int(a), 0): int(n) for a, n, c in zip(atom, counts, cells, strict=True) if c == 1}
    if (cells > 1).any():
        hot = celled.join(F.broadcast(plan.filter("__cells > 1").select("__atom")), "__atom", "left_semi")
        place |= {(r[0], r[1]): r[2] for r in hot.groupBy("__atom", "__cell").count().collect()}
    order = sorted(place)
    in_shard = dict(zip(atom.tolist(), shard_of.tolist(), strict=True))
    seen, base = [0] * shards, []
    for a, c in order:
        base.append(seen[in_shard[a]])
        seen[in_shard[a]] += place[a, c]
    where = _table(spark, {"__atom": [a for a, _ in order], "__cell": [c for _, c in order], "shard": [in_shard[a] for a, _ in order], "__base": base})
    within = Window.partitionBy("__atom", "__cell").orderBy(F.col(key).asc_nulls_first(), "__bytes")
    placed = celled.join(F.broadcast(where), ["__atom", "__cell"]).withColumn("slot", F.col("__base") + F.row_number().over(within) - 1)
    return placed.withColumn("shard", F.col("shard").cast("int")).drop("__atom", "__cell", "__base", "__bytes")


def _table(spark: SparkSession, columns: dict) -> DataFrame:
    """A small table, at most 2 * ATOMS rows."""
    import pandas as pd

    kinds = {"__atom": "int", "__cells": "long", "__cell": "int", "shard": "int", "__base": "long"}
    return spark.createDataFrame(pd.DataFrame(columns), ", ".join(f"{c} {kinds[c]}" for c in columns))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes; equal texts (null as empty) share a shard.

    Only the key, the size and two hashes of a text leave the scan.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))
    out = shard(docs, 40, F.col("h"), F.col("size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
