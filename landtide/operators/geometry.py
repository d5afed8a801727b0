"""Geometry without a library: grids, tiles, rings from edges, simplification, points in polygons."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grid_bounds(points: DataFrame, step: float = 10.0) -> DataFrame:
    """points: x, y. Corners of the grid that holds them, on multiples of ``step``, and its size in cells."""
    low, high = (lambda c: F.floor(F.min(c) / step) * step), (lambda c: F.ceil(F.max(c) / step) * step)
    out = points.agg(low("x").alias("x0"), low("y").alias("y0"), high("x").alias("x1"), high("y").alias("y1"))
    return out.withColumn("width", ((F.col("x1") - F.col("x0")) / step).cast("long")).withColumn("height", ((F.col("y1") - F.col("y0")) / step).cast("long"))


def tiles(cells: DataFrame, size: int = 1024) -> DataFrame:
    """The tiles that a set of cells touches; only these are read."""
    return cells.select(F.floor(F.col("cy") / size).alias("ty"), F.floor(F.col("cx") / size).alias("tx")).distinct()


def representative(cells: DataFrame, by: str) -> DataFrame:
    """Centroid of each set of cells, and the cell nearest to it (then the first), which always lies inside."""
    w = Window.partitionBy(by)
    mid = cells.withColumn("my", F.avg("cy").over(w)).withColumn("mx", F.avg("cx").over(w))
    far = (F.col("cy") - F.col("my")) ** 2 + (F.col("cx") - F.col("mx")) ** 2
    return mid.groupBy(by).agg(F.round(F.first("my"), 5).alias("my"), F.round(F.first("mx"), 5).alias("mx"), F.min(F.struct(F.round(far, 6).alias("d"), "cy", "cx")).alias("r")).select(by, "my", "mx", F.col("r.cy").alias("cy"), F.col("r.cx").alias("cx"))


def inside(points: DataFrame, rings: DataFrame, block: float) -> DataFrame:
    """points: id, y, x; rings: zone, points. (id, zone) of points inside, by the even-odd rule over all of a zone's rings.

    Points meet only the edges that cross their row of blocks.
    """
    edges = rings.select("zone", "points", F.posexplode("points").alias("i", "a")).select("zone", F.col("a.y").alias("ya"), F.col("a.x").alias("xa"), F.coalesce(F.get("points", F.col("i") + 1), F.get("points", F.lit(0))).alias("b"))
    edges = edges.select("zone", "ya", "xa", F.col("b.y").alias("yb"), F.col("b.x").alias("xb")).filter("ya <> yb")
    low, high = F.floor(F.least("ya", "yb") / block), F.floor(F.greatest("ya", "yb") / block)
    spread = edges.withColumn("row", F.explode(F.sequence(low, high)))
    near = points.withColumn("row", F.floor(F.col("y") / block)).join(spread, "row")
    crosses = ((F.col("ya") > F.col("y")) != (F.col("yb") > F.col("y"))) & (F.col("x") < F.col("xa") + (F.col("y") - F.col("ya")) * (F.col("xb") - F.col("xa")) / (F.col("yb") - F.col("ya")))
    return near.groupBy("id", "zone").agg(F.count(F.when(crosses, 1)).alias("k")).filter("k % 2 = 1").select("id", "zone")


def land_cover(points: DataFrame, rings: DataFrame, covers: DataFrame, names: DataFrame, block: float) -> DataFrame:
    """The cover code and name at each point; null outside, the code where it has no name. covers: zone, code; names: code, name."""
    found = inside(points, rings, block).join(covers, "zone").groupBy("id").agg(F.min("code").alias("code"))
    return points.select("id").join(found, "id", "left").join(names, "code", "left").select("id", "code", F.coalesce("name", "code").alias("name"))


def _walk(edges: pd.DataFrame) -> list[list[tuple[int, int]]]:
    """Closed rings from unit edges, each walked with the inside on its left; at a crossing the walk turns left."""
    ahead: dict[tuple, list] = {}
    for a, b in zip(zip(edges["ya"], edges["xa"], strict=True), zip(edges["yb"], edges["xb"], strict=True), strict=True):
        ahead.setdefault(a, []).append(b)
    rings = []
    while ahead:
        start = min(ahead)
        ring, here, way = [start], start, (0, 1)
        while True:
            ends = ahead[here]
            turn = lambda b, here=here, way=way: -((b[0] - here[0]) * way[1] - (b[1] - here[1]) * way[0])
            nxt = min(ends, key=turn)
            ends.remove(nxt)
            if not ends:
                del ahead[here]
            new = (nxt[0] - here[0], nxt[1] - here[1])
            if new == way and len(ring) > 1:
                ring[-1] = nxt
            else:
                ring.append(nxt)
            here, way = nxt, new
            if here == start:
                break
        rings.append(ring)
    return rings


def outlines(cells: DataFrame, by: str) -> DataFrame:
    """Rings of each set of cells: by, ring, points (y, x). Only edges that one cell has are shipped to the walk."""
    y, x = F.col("cy"), F.col("cx")
    side = lambda ya, xa, yb, xb: F.struct(ya.alias("ya"), xa.alias("xa"), yb.alias("yb"), xb.alias("xb"))
    sides = F.array(side(y, x, y, x + 1), side(y, x + 1, y + 1, x + 1), side(y + 1, x + 1, y + 1, x), side(y + 1, x, y, x))
    all_ = cells.select(by, F.inline(sides))
    key = [F.least("ya", "yb"), F.greatest("ya", "yb"), F.least("xa", "xb"), F.greatest("xa", "xb")]
    named = all_.withColumns({f"k{i}": c for i, c in enumerate(key)})
    single = named.groupBy(by, "k0", "k1", "k2", "k3").agg(F.count("*").alias("n"), F.first(F.struct("ya", "xa", "yb", "xb")).alias("e")).filter("n = 1").select(by, "e.*")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = _walk(pdf)
        return pd.DataFrame({by: [pdf[by].iloc[0]] * len(rings), "ring": range(len(rings)), "points": [[{"y": float(a), "x": float(b)} for a, b in r[:-1]] for r in rings]})

    return single.groupBy(by).applyInPandas(run, f"{by} long, ring int, points array<struct<y: double, x: double>>")


def stitch(lines: DataFrame, by: str) -> DataFrame:
    """lines: by, points. Closed rings made by joining lines end to end; what doesn't close is left out."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = [[(p["y"], p["x"]) for p in points] for points in pdf["points"] if len(points) > 1]
        rings = []
        while left:
            ring = left.pop(0)
            while ring[0] != ring[-1]:
                k = next((i for i, s in enumerate(left) if ring[-1] in (s[0], s[-1])), None)
                if k is None:
                    break
                s = left.pop(k)
                ring += (s if s[0] == ring[-1] else s[::-1])[1:]
            if ring[0] == ring[-1] and len(ring) >= 4:
                rings.append(ring[:-1])
        return pd.DataFrame({by: [pdf[by].iloc[0]] * len(rings), "ring": range(len(rings)), "points": pd.Series([[{"y": a, "x": b} for a, b in r] for r in rings], dtype=object)}) if rings else pdf.head(0).assign(ring=0)[[by, "ring", "points"]]

    return lines.groupBy(by).applyInPandas(run, f"{by} long, ring int, points array<struct<y: double, x: double>>")


def simplify(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """A line without the points that lie within ``tolerance`` of what is left (Douglas and Peucker 1973); the ends stay."""
    keep, todo = {0, len(points) - 1}, [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        (ya, xa), (yb, xb) = points[a], points[b]
        size = math.hypot(yb - ya, xb - xa)
        worst, where = tolerance, None
        for i in range(a + 1, b):
            y, x = points[i]
            d = abs((yb - ya) * (xa - x) - (ya - y) * (xb - xa)) / size if size else math.hypot(y - ya, x - xa)
            if d > worst:
                worst, where = d, i
        if where is not None:
            keep.add(where)
            todo += [(a, where), (where, b)]
    return [points[i] for i in sorted(keep)]


def simplified(rings: DataFrame, tolerance: float) -> DataFrame:
    """rings: id, points. Rings in fewer points; one that would vanish stays as it is."""

    def run(batches):
        for pdf in batches:
            out = []
            for points in pdf["points"]:
                ring = [(p["y"], p["x"]) for p in points]
                less = simplify([*ring, ring[0]], tolerance)[:-1] if ring else ring
                out.append([{"y": y, "x": x} for y, x in (less if len(less) >= 3 else ring)])
            yield pd.DataFrame({"id": pdf["id"], "points": out})

    return rings.select("id", "points").mapInPandas(run, "id long, points array<struct<y: double, x: double>>")


def sites(layers: list[DataFrame]) -> DataFrame:
    """One row for each site code of several layers: its name, kind, rings of all layers and hectares."""
    every = layers[0]
    for other in layers[1:]:
        every = every.unionByName(other)
    return every.groupBy("code").agg(F.min("name").alias("name"), F.min("kind").alias("kind"), F.flatten(F.collect_list("rings")).alias("rings"), F.sum("ha").alias("ha"))


def without_slivers(rows: DataFrame, least: float = 1.0) -> DataFrame:
    return rows.filter(F.col("ha") >= least)


def rounded(points: Column, digits: int = 6) -> Column:
    return F.transform(points, lambda p: F.struct(F.round(p["y"], digits).alias("y"), F.round(p["x"], digits).alias("x")))
