"""Permits and notices beside parcels.

The conditions under which a parcel and a notice agree are three equalities of which one must hold;
each is an equi-join, and their union is made distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.months import permit_lower_bound
from ..params import PARAMS, Params

#: Outcomes of a notice that allow the work, and the state of an annulled permit.
FAVOURABLE = ("favorable", "condicionada", "parcial", "sin_eia")
ANNULLED = "4"


def notice_hits(parcels: DataFrame, notices: DataFrame) -> DataFrame:
    """parcels: alert, parcel, ref, mun, muni_name, pol, par; notices: notice, refs, rustic (mun, pol, par), polpar (pol, par), munis. Distinct (alert, notice).

    The three ways to agree are one key each, tagged by its kind, so notices are read once and joined once.
    """
    key = lambda kind, *parts: F.concat_ws("|", F.lit(kind), *[p.cast("string") for p in parts])
    whole = lambda kind, *parts: F.when(F.least(*[p.isNotNull() for p in parts], F.lit(True)), key(kind, *parts))
    c = F.col
    own = F.array(whole("ref", c("ref")), whole("rustic", c("mun"), c("pol"), c("par")), whole("polpar", c("pol"), c("par"), c("muni_name")))
    cited = F.concat(
        F.coalesce(F.transform("refs", lambda r: key("ref", r)), F.array()), F.coalesce(F.transform("rustic", lambda r: key("rustic", r["mun"], r["pol"], r["par"])), F.array()),
        F.coalesce(F.flatten(F.transform("polpar", lambda q: F.transform("munis", lambda m: key("polpar", q["pol"], q["par"], m)))), F.array()),
    )
    asked = parcels.select("alert", F.explode(F.array_compact(own)).alias("key")).distinct()
    return asked.join(notices.select("notice", F.explode(F.array_distinct(cited)).alias("key")), "key").select("alert", "notice").distinct()


def notice_status(alerts: DataFrame, hits: DataFrame, notices: DataFrame) -> DataFrame:
    """alerts: alert, has_parcels; notices: notice, outcome, kind. pendiente, resolucion, tramitacion or sin_expediente."""
    known = hits.join(notices.select("notice", "outcome", "kind"), "notice")
    granted = (F.col("kind") == "resolucion") & F.col("outcome").isin(*FAVOURABLE)
    found = known.groupBy("alert").agg(F.bool_or(F.coalesce(granted, F.lit(False))).alias("granted"), F.count("*").alias("n_hits"))
    return _status(alerts, found, F.when(F.col("granted"), "resolucion").when(F.col("n_hits") > 0, "tramitacion"))


def _status(alerts: DataFrame, found: DataFrame, known: Column) -> DataFrame:
    rows = alerts.join(found, "alert", "left")
    status = F.when(~F.col("has_parcels"), "pendiente").otherwise(F.coalesce(known, F.lit("sin_expediente")))
    return rows.select("alert", status.alias("status"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"))


def context_counts(alerts: DataFrame, notices: DataFrame) -> DataFrame:
    """Notices of an alert's municipality that name no parcel at all. alerts: alert, muni; notices: notice, munis, n_parcels."""
    bare = notices.filter(F.col("n_parcels") == 0).select("notice", F.explode("munis").alias("muni"))
    found = alerts.join(bare, "muni").groupBy("alert").agg(F.countDistinct("notice").alias("n_context"))
    return alerts.select("alert").distinct().join(found, "alert", "left").select("alert", F.coalesce("n_context", F.lit(0)).alias("n_context"))


def first_hits(hits: DataFrame, notices: DataFrame, p: Params = PARAMS) -> DataFrame:
    """The first notices of each alert, newest first, undated last."""
    order = Window.partitionBy("alert").orderBy(F.col("date").desc_nulls_last(), "notice")
    return hits.join(notices.select("notice", "date"), "notice").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= p.first_hits).select("alert", "notice", "k")


def permits(raw: DataFrame, watched: DataFrame, p: Params = PARAMS) -> DataFrame:
    """raw: commune, number, kind, date, state, dest, parcels (array of keys). Permits of watched communes, dated since the first day kept, with a parcel. Applicants are never read."""
    dated = raw.filter(F.col("date").isNotNull() & (F.col("date") >= F.lit(p.permit_since).cast("date")))
    listed = dated.withColumn("parcels", F.array_distinct(F.array_compact("parcels"))).filter(F.size("parcels") > 0)
    return listed.join(watched.select("commune").distinct(), "commune", "left_semi")


def inverted(kept: DataFrame) -> DataFrame:
    """(commune, parcel) to its permits, oldest first."""
    rows = kept.select("commune", F.explode("parcels").alias("parcel"), "date", "number")
    return rows.groupBy("commune", "parcel").agg(F.transform(F.array_sort(F.collect_list(F.struct("date", "number"))), lambda x: x["number"]).alias("numbers"))


def permit_hits(parcels: DataFrame, kept: DataFrame, p: Params = PARAMS) -> DataFrame:
    """parcels: alert, commune, parcel, first (ym). Distinct permits on an alert's parcels from so many months before it."""
    rows = kept.select("commune", F.explode("parcels").alias("parcel"), "date", "number", "state")
    hits = parcels.join(rows, ["commune", "parcel"]).filter(F.col("date") >= permit_lower_bound(F.col("first"), p.permit_months))
    return hits.select("alert", "number", "date", "state").distinct()


def permit_status(alerts: DataFrame, hits: DataFrame) -> DataFrame:
    """resolucion if a permit isn't annulled, else sin_expediente; pendiente without parcels."""
    found = hits.groupBy("alert").agg(F.bool_or(F.col("state") != ANNULLED).alias("live"), F.count("*").alias("n_hits"))
    return _status(alerts, found, F.when(F.col("live"), "resolucion"))


def first_permits(hits: DataFrame, p: Params = PARAMS) -> DataFrame:
    """The first permits of each alert: annulled ones last, then the oldest."""
    order = Window.partitionBy("alert").orderBy(F.when(F.col("state") == ANNULLED, 1).otherwise(0), "date", "number")
    return hits.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= p.first_hits).select("alert", "number", "k")


def permit_context(alerts: DataFrame, kept: DataFrame, p: Params = PARAMS) -> DataFrame:
    """alerts: alert, commune, first. How many permits the alert's communes have from the lower bound on."""
    rows = alerts.join(kept.select("commune", "date", "number"), "commune").filter(F.col("date") >= permit_lower_bound(F.col("first"), p.permit_months))
    found = rows.groupBy("alert").agg(F.countDistinct("number").alias("n_context"))
    return alerts.select("alert").distinct().join(found, "alert", "left").select("alert", F.coalesce("n_context", F.lit(0)).alias("n_context"))


def coverage_since(rows: DataFrame, date: str = "date") -> DataFrame:
    return rows.agg(F.min(date).alias("since"))


def watched_communes(communes: DataFrame, zone: DataFrame, metres: float = 1000.0, cell: float = 1000.0) -> DataFrame:
    """communes: commune, y, x; zone: y, x (metres). Communes within a distance of the zone, by cells of that size."""
    key = lambda c: F.floor(F.col(c) / cell)
    d = F.sequence(F.lit(-1), F.lit(1))
    near = communes.withColumn("dy", F.explode(d)).withColumn("dx", F.explode(d)).withColumn("by", key("y") + F.col("dy")).withColumn("bx", key("x") + F.col("dx"))
    places = zone.select(F.col("y").alias("zy"), F.col("x").alias("zx"), F.floor(F.col("y") / cell).alias("by"), F.floor(F.col("x") / cell).alias("bx"))
    close = (F.col("y") - F.col("zy")) ** 2 + (F.col("x") - F.col("zx")) ** 2 <= metres * metres
    return near.join(places, ["by", "bx"]).filter(close).select("commune").distinct()


def stale_footprints(notices: DataFrame, known: DataFrame, version: int) -> DataFrame:
    """Notices without a footprint of this version."""
    return notices.join(known.filter(F.col("v") == version).select("notice"), "notice", "left_anti")


def declared_use(parts: DataFrame, sizes: DataFrame, p: Params = PARAMS) -> DataFrame:
    """parts: alert, code, grp, area; sizes: alert, size. The declared crop with most area and the verdict."""
    by_code = parts.groupBy("alert", "code", "grp").agg(F.sum("area").alias("area"))
    best = by_code.groupBy("alert").agg(F.max_by(F.struct("code", "grp"), F.struct(F.col("area"), -F.col("grp"), F.col("code"))).alias("best"), F.sum("area").alias("total"))
    rows = sizes.join(best, "alert", "left").withColumn("fraction", F.round(F.least(F.coalesce(F.col("total") / F.col("size"), F.lit(0.0)), F.lit(1.0)), 3))
    use = F.when(F.col("best").isNull() | (F.col("fraction") < p.least_declared), "sin_declarar").when(F.col("best.grp").isin(*p.permanent_groups), "pradera_permanente").otherwise("rotacion")
    return rows.select("alert", "fraction", use.alias("use"), F.col("best.code").alias("code"), F.col("best.grp").alias("grp"))


def names_to_codes(alerts: DataFrame, table: DataFrame) -> DataFrame:
    """alerts: alert, names (array); table: name, insee, ine. The codes of names, in order; unknown names are left out, of equal names the last wins."""
    codes = table.groupBy("name").agg(F.max_by(F.coalesce("insee", "ine"), "n").alias("code"))
    rows = alerts.select("alert", F.posexplode("names").alias("k", "name")).join(codes, "name").filter(F.col("code").isNotNull())
    return rows.groupBy("alert").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "code"))), lambda x: x["code"]).alias("codes"))


def full_text(notices: DataFrame, dumps: DataFrame, markup: DataFrame) -> DataFrame:
    """The text of each notice: that of its day's dump, else its markup without tags, else null (asked for again later)."""
    from ..functions.text import without_markup

    rows = notices.join(dumps.select("day", "notice", F.col("text").alias("dump")), ["day", "notice"], "left").join(markup.select("notice", "xml"), "notice", "left")
    return rows.select("notice", F.coalesce("dump", without_markup(F.col("xml"))).alias("text"))


def with_crops(used: DataFrame, crops: DataFrame) -> DataFrame:
    """Names of declared crops; an unknown code is its own name. crops: code, label."""
    return used.join(crops, "code", "left").withColumn("label", F.coalesce("label", "code"))


def layer_of(year: Column, latest: Column) -> Column:
    """Name of the declaration layer of a year: LATEST for the latest and beyond."""
    return F.when(year >= latest, "LATEST").otherwise(year.cast("string"))
