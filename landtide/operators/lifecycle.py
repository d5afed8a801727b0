"""The life cycle of alerts, and the merging of fragments.

Within a window alerts don't depend on each other, so each alert's windows are one sorted array and
its states a fold over it, inside one expression; alerts are spread by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import PARAMS, Params
from .components import closure, near_pairs

#: The states, active ones first.
STATES = ("provisional", "confirmada", "descartada", "revertida", "fusionada")
ACTIVE = STATES[:2]


def step(state: Column, w: Column, expiry: int) -> Column:
    """The state after a window (t, seen, back, level). A state is (state, first, last, n_seen, changes).

    n_seen counts different windows. What is the level of a water body is seen, but not confirmed.
    """
    seen, t = w["seen"], w["t"]
    active = state["state"].isin(*ACTIVE)
    n = state["n_seen"] + F.when(seen & ~t.eqNullSafe(state["last"]), 1).otherwise(0)
    last = F.when(seen, t).otherwise(state["last"])
    first = F.when(state["first"].isNull() & seen, t).otherwise(state["first"])
    name = (
        F.when(seen & state["state"].isNull(), "provisional")
        .when(seen & (n >= 2) & (last > first) & ~w["level"], "confirmada")
        .when(seen, state["state"])
        .when(t <= state["last"], state["state"])
        .when(active & w["back"] & (state["state"] == "provisional"), "descartada")
        .when(active & w["back"], "revertida")
        .when((state["state"] == "provisional") & (t - state["last"] >= expiry), "descartada")
        .otherwise(state["state"])
    )
    changed = F.when(~name.eqNullSafe(state["state"]), 1).otherwise(0)
    return F.struct(name.alias("state"), first.alias("first"), last.alias("last"), n.alias("n_seen"), (state["changes"] + changed).alias("changes"))


def fold(windows: DataFrame, key: str, expiry: int) -> DataFrame:
    """windows: key, t (int), seen, back (booleans) and, where known, level. Final state of each alert, or none if it was never seen."""
    level = F.coalesce("level", F.lit(False)) if "level" in windows.columns else F.lit(False)
    start = F.struct(F.lit(None).cast("string").alias("state"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), F.lit(0).alias("n_seen"), F.lit(0).alias("changes"))
    ordered = windows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("t").cast("int").alias("t"), (~F.col("seen")).alias("unseen"), "seen", "back", level.alias("level")))).alias("ws"))
    return ordered.select(key, F.aggregate("ws", start, lambda s, w: step(s, w, expiry)).alias("s")).select(key, "s.*").filter(F.col("state").isNotNull())


def merge_groups(alerts: DataFrame, cells: DataFrame, p: Params = PARAMS) -> DataFrame:
    """alerts: id, first (ym) and, where known, state, of which active ones only take part; cells: id, cy, cx. (id, grp): fragments within merge_cells of each other whose first months lie close, closed over chains."""
    alerts = alerts.filter(F.col("state").isin(*ACTIVE)) if "state" in alerts.columns else alerts
    pairs = near_pairs(cells.withColumnRenamed("id", "a"), cells.withColumnRenamed("id", "b"), p.merge_cells).filter("a < b")
    firsts = alerts.select("id", "first")
    known = pairs.join(firsts.toDF("a", "fa"), "a").join(firsts.toDF("b", "fb"), "b").filter(F.abs(F.col("fa") - F.col("fb")) < p.merge_months)
    roots = closure(known.select("a", "b"))
    return alerts.select("id").join(roots, F.col("id") == F.col("u"), "left").select("id", F.coalesce("v", "id").alias("grp"))


def merge(alerts: DataFrame, groups: DataFrame) -> DataFrame:
    """alerts: id, first, detected, pixels, ndvi, state. A row for each group: its survivor, total pixels, weighted index, state and the ids merged into it."""
    rows = alerts.join(groups, "id")
    order = Window.partitionBy("grp").orderBy("first", "detected", F.desc("pixels"), "id")
    ranked = rows.withColumn("k", F.row_number().over(order))
    lead = F.max(F.when(F.col("k") == 1, F.col("id")))
    own = F.max(F.when(F.col("k") == 1, F.col("state")))
    state = F.when((own == "provisional") & F.bool_or(F.col("state") == "confirmada"), "confirmada").otherwise(own)
    return ranked.groupBy("grp").agg(
        lead.alias("survivor"), F.count("*").alias("members"), F.sum("pixels").alias("pixels"), F.round(F.sum(F.col("ndvi") * F.col("pixels")) / F.sum("pixels"), 3).alias("ndvi"), state.alias("state"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("k") > 1, F.col("id")))), ",").alias("merged"),
    )


def merge_registry(alerts: DataFrame, groups: DataFrame, cells: DataFrame) -> DataFrame:
    """The survivor of each group of two or more, as the registry keeps it.

    alerts: id, first, detected, pixels, ndvi_ref, ndvi, state, months (array), merged (array of ids); cells: id,
    cy, cx. Its pixels and hectares are those of the union of the cells, both indices are weighted by
    the members' cells, months and ids absorbed by any member are carried over, and last is the latest month.
    """
    members = groups.join(groups.groupBy("grp").agg(F.count("*").alias("members")).filter("members > 1"), "grp")
    union = cells.join(members.select("id", "grp"), "id").groupBy("grp", "cy", "cx").agg(F.lit(1).alias("one")).groupBy("grp").agg(F.count("*").alias("union_cells"))
    sizes = cells.groupBy("id").agg(F.count("*").alias("weight"))
    order = Window.partitionBy("grp").orderBy("first", "detected", F.desc("pixels"), "id")
    ranked = alerts.join(members, "id").join(sizes, "id").withColumn("k", F.row_number().over(order))
    lead = lambda c: F.max(F.when(F.col("k") == 1, F.col(c)))
    mean = lambda c: F.round(F.sum(F.col(c) * F.col("weight")) / F.sum("weight"), 3)
    state = F.when((lead("state") == "provisional") & F.bool_or((F.col("k") > 1) & (F.col("state") == "confirmada")), "confirmada").otherwise(lead("state"))
    months = F.array_sort(F.array_distinct(F.flatten(F.collect_list("months"))))
    ids = F.array_sort(F.array_union(F.collect_set(F.when(F.col("k") > 1, F.col("id"))), F.array_distinct(F.flatten(F.collect_list("merged")))))
    out = ranked.groupBy("grp").agg(lead("id").alias("survivor"), F.first("members").alias("members"), state.alias("state"), months.alias("months"), F.array_max(months).alias("last"), mean("ndvi_ref").alias("ndvi_ref"), mean("ndvi").alias("ndvi"), ids.alias("merged"))
    return out.join(union, "grp").select("grp", "survivor", "members", "state", "months", "last", "ndvi_ref", "ndvi", "merged", F.col("union_cells").alias("pixels"), F.round(F.col("union_cells") / 100, 2).alias("ha"))


def grow(pairs: DataFrame, changes: DataFrame, alerts: DataFrame, change_cells: DataFrame, alert_cells: DataFrame) -> DataFrame:
    """Alerts that grow: the first alert a change touches takes in its shape if the change is larger than the alert.

    pairs: change, alert (see touches()); changes: change, pixels; alerts: alert, pixels; cells with cy, cx. Changes of one
    window don't touch each other, so of an alert's changes the largest decides. Returns alert, change, its
    pixels, and the cells and hectares of the union.
    """
    sized = first_touched(pairs).select("change", "alert").join(changes.select("change", F.col("pixels").alias("grown")), "change").join(alerts.select("alert", "pixels"), "alert").filter("grown > pixels")
    best = sized.groupBy("alert").agg(F.max_by(F.struct("change", "grown"), F.struct("grown", -F.col("change"))).alias("b")).select("alert", "b.change", F.col("b.grown").alias("pixels"))
    new = best.join(change_cells.select("change", "cy", "cx"), "change").select("alert", "cy", "cx")
    own = alert_cells.join(best.select("alert"), "alert", "left_semi").select("alert", "cy", "cx")
    union = new.union(own).distinct().groupBy("alert").agg(F.count("*").alias("cells"))
    return best.join(union, "alert").select("alert", "change", "pixels", "cells", F.round(F.col("cells") / 100, 2).alias("ha"))


def touches(changes: DataFrame, alerts: DataFrame) -> DataFrame:
    """Pairs of changes and alerts whose cells touch, corners included. changes: change, cy, cx, pixels; alerts: alert, cy, cx, rank."""
    pairs = near_pairs(changes.select(F.col("change").alias("a"), "cy", "cx"), alerts.select(F.col("alert").alias("b"), "cy", "cx"), 1)
    return pairs.select(F.col("a").alias("change"), F.col("b").alias("alert"))


def first_touched(pairs: DataFrame) -> DataFrame:
    """The alert of least id that a change touches: the only one that it may let grow."""
    return pairs.groupBy("change").agg(F.min("alert").alias("alert"), F.count("*").alias("n_touched"))


def new_ids(changes: DataFrame, existing: DataFrame, prefix: str) -> DataFrame:
    """changes: month (text), pixels, key; existing: id. Ids prefix-YYYYMM-NNN, numbered on from those of the month, larger changes first."""
    taken = existing.select(F.substring("id", len(prefix) + 2, 6).alias("m")).groupBy("m").agg(F.count("*").alias("taken"))
    month = F.replace(F.col("month"), F.lit("-"), F.lit(""))
    order = Window.partitionBy("m").orderBy(F.desc("pixels"), "key")
    rows = changes.withColumn("m", month).join(taken, "m", "left").withColumn("k", F.row_number().over(order) + F.coalesce("taken", F.lit(0)))
    return rows.select("key", "month", F.format_string(f"{prefix}-%s-%03d", "m", F.col("k").cast("int")).alias("id"))


def pending_analysis(alerts: DataFrame, version: int) -> DataFrame:
    """alerts: id, state, version, photo, photo_window, last, pixels. Active alerts that an older version analysed, or without a photo of their last window; the order of work."""
    stale = ~F.col("version").eqNullSafe(F.lit(version))
    no_photo = F.col("photo").isNull() & ~F.col("photo_window").eqNullSafe(F.col("last"))
    return alerts.filter(F.col("state").isin(*ACTIVE) & (stale | no_photo)).orderBy(F.col("class").isNotNull(), F.desc("pixels"), "id")


def pending_parcels(alerts: DataFrame) -> DataFrame:
    """alerts: id, state, parcel_pixels, pixels. Those whose parcels were read for another size, larger first."""
    return alerts.filter(~F.col("state").isin("descartada", "fusionada") & ~F.col("parcel_pixels").eqNullSafe(F.col("pixels"))).orderBy(F.desc("pixels"), "id")


def last_index(pairs: DataFrame, changes: DataFrame) -> DataFrame:
    """The index that each touched alert ends with: that of its smallest change, the last to be written. changes: change, pixels, ndvi."""
    return pairs.join(changes, "change").groupBy("alert").agg(F.min_by("ndvi", F.struct("pixels", F.col("change"))).alias("ndvi"))


def water_discards(alerts: DataFrame) -> DataFrame:
    """Active alerts with a class that are the level of a water body. alerts: id, state, clc, class."""
    from ..functions.spectral import water_level

    return alerts.filter(F.col("state").isin(*ACTIVE) & F.col("class").isNotNull() & water_level(F.col("clc"), F.col("class")))


def photo_windows(alerts: DataFrame, version: int) -> DataFrame:
    """alerts: id, first, last (ym), version. Windows to look for photos in, in order: the first where the version is stale, then the last if it lies within a year."""
    stale = ~F.col("version").eqNullSafe(F.lit(version))
    wanted = F.array_distinct(F.filter(F.array(F.when(stale, F.col("first")), F.when(F.col("last") - F.col("first") < 12, F.col("last"))), lambda w: w.isNotNull()))
    return alerts.select("id", F.posexplode(wanted).alias("k", "window"))
