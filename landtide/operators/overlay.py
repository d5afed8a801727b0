"""Overlay of cell sets with vector layers.

A cell is a square; the share of a ring in a cell is found by clipping, and for rectangles in closed
form. Candidates come from an equi-join on blocks of cells, never from all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import PARAMS, Params

BLOCK = 16
#: Sizes of grid cells for the nearest zone, the largest four times the layer's extent.
LEVELS = 16


def blocks(low: Column, high: Column, size: int = BLOCK) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def rectangle_overlap(cells: DataFrame, parcels: DataFrame, block: int = BLOCK) -> DataFrame:
    """cells: alert, cy, cx (unit squares); parcels: parcel, y0, x0, y1, x1. Area of each alert in each parcel, in cells."""
    left = cells.withColumn("by", F.floor(F.col("cy") / block)).withColumn("bx", F.floor(F.col("cx") / block))
    right = parcels.withColumn("by", F.explode(blocks(F.col("y0"), F.col("y1"), block))).withColumn("bx", F.explode(blocks(F.col("x0"), F.col("x1"), block)))
    h = F.least(F.col("cy") + 1.0, F.col("y1")) - F.greatest(F.col("cy").cast("double"), F.col("y0"))
    w = F.least(F.col("cx") + 1.0, F.col("x1")) - F.greatest(F.col("cx").cast("double"), F.col("x0"))
    hits = left.join(right, ["by", "bx"]).withColumn("h", h).withColumn("w", w).filter("h > 0 and w > 0")
    return hits.select("alert", "parcel", "cy", "cx", (F.col("h") * F.col("w")).alias("area"))


def kept_overlaps(parts: DataFrame, parcels: DataFrame, cell_m2: float = 100.0, p: Params = PARAMS) -> DataFrame:
    """Area of each alert and parcel, in m2, without slivers: under 200 m2 and under half of the parcel."""
    area = parts.groupBy("alert", "parcel").agg((F.sum("area") * cell_m2).alias("m2"))
    sized = area.join(parcels.select("parcel", ((F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0")) * cell_m2).alias("parcel_m2")), "parcel")
    return sized.filter(~((F.col("m2") < p.sliver_m2) & (F.col("m2") < p.sliver_share * F.col("parcel_m2"))))


def top_parcels(kept: DataFrame, p: Params = PARAMS) -> DataFrame:
    """The 40 parcels of each alert with most of it, by rounded hectares, and how many there are."""
    order = Window.partitionBy("alert").orderBy(F.desc("ha"), "parcel")
    rows = kept.withColumn("ha", F.round(F.col("m2") / 10_000 + 1e-9, 4))
    counted = rows.withColumn("k", F.row_number().over(order)).withColumn("n_parcels", F.count("*").over(Window.partitionBy("alert")))
    return counted.filter(F.col("k") <= p.top_parcels).select("alert", "parcel", "ha", "k", "n_parcels")


def covered_fraction(parts: DataFrame, kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """Share of an alert that kept parcels cover: the parts of a cell add up to one cell at most. 0 without parcels."""
    per_cell = parts.join(kept.select("alert", "parcel"), ["alert", "parcel"], "left_semi").groupBy("alert", "cy", "cx").agg(F.least(F.sum("area"), F.lit(1.0)).alias("area"))
    covered = per_cell.groupBy("alert").agg(F.sum("area").alias("area"))
    return sizes.join(covered, "alert", "left").select("alert", F.round(F.least(F.coalesce(F.col("area") / F.col("size"), F.lit(0.0)), F.lit(1.0)), 3).alias("fraction"))


def ranked_zones(parts: DataFrame) -> DataFrame:
    """Zones of each alert by shared area, names descending on ties; zones that only touch it count with none. parts: alert, zone, area."""
    area = parts.groupBy("alert", "zone").agg(F.round(F.sum("area"), 6).alias("area"))
    order = Window.partitionBy("alert").orderBy(F.desc("area"), F.desc("zone"))
    return area.withColumn("k", F.row_number().over(order))


def nearest(points: DataFrame, zones: DataFrame) -> DataFrame:
    """The zone nearest to each point, least name on ties. points: id, y, x; zones: zone, y0, x0, y1, x1.

    Square grids of LEVELS sizes, each twice the one before. A zone is entered at each size that is not
    under its own, in four cells at most. The first size at which a zone is in one of the nine cells around
    a point bounds the nearest distance by 2.83 sides, so the nine cells of four times that size hold the
    nearest zone, unless it is larger; such zones are found at their own size. Points that meet no zone at
    any size lie far outside of the layer and are compared with all of it.
    """
    c = F.col
    span = zones.agg(F.min("y0"), F.min("x0"), F.max("y1"), F.max("x1"), F.max(F.greatest(c("y1") - c("y0"), c("x1") - c("x0")))).first()
    ya, xa, yb, xb, largest = (v if v is not None else 0.0 for v in span)
    base = (max(yb - ya, xb - xa, largest) or 1.0) / (1 << (LEVELS - 3))
    side = lambda level: F.lit(base) * F.pow(F.lit(2.0), level)
    cell = lambda v, low, level: F.floor((v - low) / side(level))
    level = c("level")

    size = F.greatest(c("y1") - c("y0"), c("x1") - c("x0"))
    own = F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), F.lit(LEVELS - 1), lambda a, k: F.when(side(k) >= size, F.least(a, k)).otherwise(a))
    entered = zones.withColumn("own", own).withColumn("level", F.explode(F.sequence(c("own"), F.lit(LEVELS - 1))))
    entered = entered.withColumn("by", F.explode(F.sequence(cell(c("y0"), ya, level), cell(c("y1"), ya, level)))).withColumn("bx", F.explode(F.sequence(cell(c("x0"), xa, level), cell(c("x1"), xa, level))))

    def around(p: DataFrame) -> DataFrame:
        three = lambda v, low: F.explode(F.sequence(cell(v, low, level) - 1, cell(v, low, level) + 1))
        return p.withColumn("by", three(c("y"), ya)).withColumn("bx", three(c("x"), xa))

    all_points = points.select("id", "y", "x").distinct()
    inside = all_points.filter((F.abs(c("y")) < 1e300) & (F.abs(c("x")) < 1e300) & (F.abs(c("y") - ya) < base * 2.0**40) & (F.abs(c("x") - xa) < base * 2.0**40))
    tried = around(inside.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1)))))
    first = tried.join(entered.select("level", "by", "bx").distinct(), ["level", "by", "bx"], "left_semi").groupBy("id", "y", "x").agg(F.min("level").alias("first"))
    goal = first.withColumn("goal", F.least(c("first") + 2, F.lit(LEVELS - 1)))
    looked = around(goal.withColumn("level", F.explode(F.sequence(c("goal"), F.lit(LEVELS - 1)))))
    near = looked.join(entered, ["level", "by", "bx"]).filter((level == c("goal")) | (c("own") == level))
    same = [all_points[k].eqNullSafe(first[k]) for k in ("id", "y", "x")]
    rest = all_points.join(first, same[0] & same[1] & same[2], "left_anti").crossJoin(zones)
    pairs = near.select("id", "y", "x", "zone", "y0", "x0", "y1", "x1").unionByName(rest.select("id", "y", "x", "zone", "y0", "x0", "y1", "x1"))
    dy = F.greatest(c("y0") - c("y"), F.lit(0.0), c("y") - c("y1"))
    dx = F.greatest(c("x0") - c("x"), F.lit(0.0), c("x") - c("x1"))
    return pairs.withColumn("d2", dy * dy + dx * dx).groupBy("id").agg(F.min_by("zone", F.struct("d2", "zone")).alias("zone"), F.round(F.min("d2"), 6).alias("d2"))


def clip_area(ring: list[tuple[float, float]], y0: float, x0: float, y1: float, x1: float) -> float:
    """Signed area of a ring inside a rectangle; holes, being clockwise, are negative."""
    points = list(ring)
    for axis, bound, keep in ((0, y0, 1), (0, y1, -1), (1, x0, 1), (1, x1, -1)):
        out = []
        for i, b in enumerate(points):
            a = points[i - 1]
            in_a, in_b = keep * (a[axis] - bound) >= 0, keep * (b[axis] - bound) >= 0
            if in_a != in_b:
                t = (bound - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
            if in_b:
                out.append(b)
        points = out
    return sum(points[i - 1][1] * b[0] - b[1] * points[i - 1][0] for i, b in enumerate(points)) / 2


def ring_overlap(cells: DataFrame, rings: DataFrame, block: int = BLOCK) -> DataFrame:
    """cells: alert, cy, cx; rings: parcel, points (array of y, x structs), one row for each ring. Area of each cell in each ring, by clipping in Arrow batches."""
    box = rings.select("parcel", "points", F.array_min(F.col("points.y")).alias("y0"), F.array_max(F.col("points.y")).alias("y1"), F.array_min(F.col("points.x")).alias("x0"), F.array_max(F.col("points.x")).alias("x1"))
    left = cells.withColumn("by", F.floor(F.col("cy") / block)).withColumn("bx", F.floor(F.col("cx") / block))
    right = box.withColumn("by", F.explode(blocks(F.col("y0"), F.col("y1"), block))).withColumn("bx", F.explode(blocks(F.col("x0"), F.col("x1"), block)))
    hits = left.join(right, ["by", "bx"]).filter("cy + 1 > y0 and cy < y1 and cx + 1 > x0 and cx < x1").select("alert", "parcel", "cy", "cx", "points")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            area = [clip_area([(p["y"], p["x"]) for p in points], y, x, y + 1, x + 1) for points, y, x in zip(pdf["points"], pdf["cy"], pdf["cx"], strict=True)]
            yield pd.DataFrame({"alert": pdf["alert"], "parcel": pdf["parcel"], "cy": pdf["cy"], "cx": pdf["cx"], "area": area})

    return hits.mapInPandas(run, "alert long, parcel long, cy long, cx long, area double").groupBy("alert", "parcel", "cy", "cx").agg(F.sum("area").alias("area"))


def rasterise(rings: DataFrame) -> DataFrame:
    """Cells whose centre is inside: each row of centres crosses the edges, and every second gap is inside. rings: id, points."""
    edges = rings.select("id", "points", F.posexplode("points").alias("i", "a")).select("id", "a", F.coalesce(F.get("points", F.col("i") + 1), F.get("points", F.lit(0))).alias("b"))
    low, high = F.least("a.y", "b.y"), F.greatest("a.y", "b.y")
    first, last = F.ceil(low - 0.5), F.ceil(high - 0.5) - 1
    rows = edges.filter(first <= last).withColumn("cy", F.explode(F.sequence(first, last)))
    x = F.col("a.x") + (F.col("cy") + 0.5 - F.col("a.y")) * (F.col("b.x") - F.col("a.x")) / (F.col("b.y") - F.col("a.y"))
    spans = rows.select("id", "cy", x.alias("x")).groupBy("id", "cy").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size("xs"), 1) - 1), lambda k: F.struct(F.ceil(F.get("xs", 2 * k) - 0.5).alias("lo"), (F.ceil(F.get("xs", 2 * k + 1) - 0.5) - 1).alias("hi")))
    runs = spans.select("id", "cy", F.explode(pairs).alias("r")).filter("r.lo <= r.hi")
    return runs.select("id", F.col("cy").cast("long").alias("cy"), F.explode(F.sequence("r.lo", "r.hi")).alias("cx"))
