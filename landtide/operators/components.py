"""Connected components of cells.

Cells are labelled inside square tiles by vectorised label propagation; only labels that touch
across a tile border go into a distributed closure, large-star and small-star, whose rounds are
checkpointed. What is shuffled after the tiles is the border, not the area.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

TILE = 1024
#: Half of the eight neighbours; the others are the same pairs seen from the other cell. Fixed values.
FORWARD = ((0, 1), (1, -1), (1, 0), (1, 1))


def closure(edges: DataFrame) -> DataFrame:
    """(u, v): v the least node of u's component, for every u that isn't it. edges: a, b, longs."""
    checkpointed(edges.sparkSession)
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    seen = None
    while True:
        mark = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or not mark[0]:
            return pairs
        seen = mark
        both = pairs.select("u", F.col("v").alias("w")).unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("w")))
        least = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("w > u").join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()


def _label(pdf: pd.DataFrame) -> pd.DataFrame:
    cy, cx, ids = pdf["cy"].to_numpy(), pdf["cx"].to_numpy(), pdf["id"].to_numpy()
    y0, x0 = cy.min() - 1, cx.min() - 1
    none = np.iinfo("i8").max
    grid = np.full((cy.max() - y0 + 2, cx.max() - x0 + 2), none)
    at = (cy - y0, cx - x0)
    order = np.argsort(ids, kind="stable")
    grid[at[0][order], at[1][order]] = np.arange(len(ids))
    parent = np.arange(len(ids))
    near = [grid[at[0] + dy, at[1] + dx][order] for dy, dx in FORWARD]
    links = np.concatenate([np.column_stack([np.flatnonzero(n != none), n[n != none]]) for n in near])
    while True:
        low = np.minimum(parent[links[:, 0]], parent[links[:, 1]])
        new = parent.copy()
        for k in (0, 1):
            np.minimum.at(new, parent[links[:, k]], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == parent).all():
            break
        parent = new
    return pd.DataFrame({"cy": cy[order], "cx": cx[order], "id": ids[order], "label": ids[order][parent]})


def components(cells: DataFrame, width: int, tile: int = TILE) -> DataFrame:
    """cy, cx and comp: the least cy * width + cx of each cell's 8-connected component. cells: distinct cy, cx."""
    keyed = cells.select("cy", "cx", (F.col("cy") * width + F.col("cx")).alias("id"))
    tiled = keyed.withColumn("ty", F.floor(F.col("cy") / tile)).withColumn("tx", F.floor(F.col("cx") / tile))
    checkpointed(cells.sparkSession)
    labelled = tiled.groupBy("ty", "tx").applyInPandas(_label, "cy long, cx long, id long, label long").checkpoint()
    edge = labelled.filter((F.col("cy") % tile).isin(0, tile - 1) | (F.col("cx") % tile).isin(0, tile - 1))
    steps = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y, x in FORWARD])
    ahead = edge.select("label", F.explode(steps).alias("d"), "cy", "cx").select(F.col("label").alias("a"), (F.col("cy") + F.col("d.y")).alias("cy"), (F.col("cx") + F.col("d.x")).alias("cx"))
    across = ahead.join(edge.select("cy", "cx", F.col("label").alias("b")), ["cy", "cx"]).filter("a <> b").select("a", "b").distinct()
    roots = closure(across)
    return labelled.join(roots, labelled["label"] == roots["u"], "left").select("cy", "cx", F.coalesce("v", "label").alias("comp"))


def neighbours(cells: DataFrame, reach: int) -> DataFrame:
    """Each row of ``cells`` once for every cell within ``reach`` steps, as ny and nx."""
    d = F.sequence(F.lit(-reach), F.lit(reach))
    return cells.withColumn("dy", F.explode(d)).withColumn("dx", F.explode(d)).withColumn("ny", F.col("cy") + F.col("dy")).withColumn("nx", F.col("cx") + F.col("dx")).drop("dy", "dx")


def near_pairs(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    """Distinct (a, b) of ids whose cells come within ``reach`` steps. left: a, cy, cx; right: b, cy, cx.

    An equi-join on cells; reach 1 is touching, reach 2 is within 15 m of 10 m cells.
    """
    spread = neighbours(left, reach).select("a", F.col("ny").alias("cy"), F.col("nx").alias("cx")).distinct()
    return spread.join(right, ["cy", "cx"]).select("a", "b").distinct()


def contour(cells: DataFrame) -> DataFrame:
    """Cells that lack one of their four neighbours."""
    steps = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y, x in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    shown = cells.select(F.explode(steps).alias("d"), "cy", "cx").select((F.col("cy") + F.col("d.y")).alias("cy"), (F.col("cx") + F.col("d.x")).alias("cx"))
    counts = shown.groupBy("cy", "cx").agg(F.count("*").alias("k")).filter("k = 4")
    return cells.join(counts, ["cy", "cx"], "left_anti")


def boundary_edges(cells: DataFrame, by: str) -> DataFrame:
    """Unit edges that one cell only of a component has: component, orientation, y, x."""
    sides = F.array(
        F.struct(F.lit("h").alias("o"), F.col("cy").alias("y"), F.col("cx").alias("x")),
        F.struct(F.lit("h").alias("o"), (F.col("cy") + 1).alias("y"), F.col("cx").alias("x")),
        F.struct(F.lit("v").alias("o"), F.col("cy").alias("y"), F.col("cx").alias("x")),
        F.struct(F.lit("v").alias("o"), F.col("cy").alias("y"), (F.col("cx") + 1).alias("x")),
    )
    return cells.select(by, F.inline(sides)).groupBy(by, "o", "y", "x").agg(F.count("*").alias("k")).filter("k = 1").drop("k")
