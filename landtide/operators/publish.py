"""What is published: signals, the feed, key figures and facets."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.locale import escaped
from ..params import PARAMS, Params
from .lifecycle import ACTIVE

#: Names of permit states by language, and the order of states and permit states in lists.
STATUS_NAMES = {
    "es": {"resolucion": "Resolución favorable en la parcela", "tramitacion": "Expediente en tramitación en la parcela", "sin_expediente": "Sin expediente conocido", "pendiente": "Parcelas por consultar"},
    "fr": {"resolucion": "Autorisation d’urbanisme connue", "sin_expediente": "Sans autorisation connue", "pendiente": "Parcelles à consulter"},
}
STATE_RANK = {"confirmada": 0, "provisional": 1, "descartada": 2, "revertida": 3}
STATUS_RANK = {"sin_expediente": 0, "tramitacion": 1, "resolucion": 2, "pendiente": 3}


def names(code: Column, table: dict[str, str]) -> Column:
    """The name of a code; an unknown code is its own name."""
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.element_at(known, code), code)


def rank(code: Column, table: dict[str, int]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), code), F.lit(len(table)))


def link(path: Column, base: str) -> Column:
    """An absolute address, or null for none."""
    return F.when(path.rlike("^https?://"), path).when(path != "", F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(path, "^/+", "")))


def current(alerts: DataFrame, base: str, language: str) -> DataFrame:
    """alerts: id, state, detected, ha, lat, lon, class, status, photo, sites (array of codes). Active alerts as signals, in no order; parcels never appear."""
    return alerts.filter(F.col("state").isin(*ACTIVE)).select(
        "id", F.col("detected").cast("string").alias("detected"), F.round("ha", 2).alias("ha"), F.array("lon", "lat").alias("point"), F.col("class").alias("title"),
        names(F.col("status"), STATUS_NAMES[language]).alias("permit"), link(F.col("photo"), base).alias("image"), F.transform(F.array_sort(F.array_distinct("sites")), lambda s: F.struct(s.alias("code"))).alias("sites"),
    )


def signals(alerts: DataFrame, base: str, language: str) -> DataFrame:
    """Active alerts as signals in (detected, id) order."""
    return current(alerts, base, language).orderBy("detected", "id")


def document(found: DataFrame, country: str, generated: Column) -> DataFrame:
    """The country's document as rows, so that none holds all its signals: a head (n signals, codes of its sites), then a row for each signal as found; all say when it was made (to the minute, UTC)."""
    made = [F.lit(country).alias("country"), F.date_format(generated, "yyyy-MM-dd'T'HH:mm'Z'").alias("generated")]
    by_code = found.select(F.posexplode_outer("sites").alias("at", "site")).groupBy("site").agg(F.count("at").alias("uses"), F.count_if(F.coalesce("at", F.lit(0)) == 0).alias("firsts"))
    codes = F.array_sort(F.collect_list(F.when(F.col("uses") > 0, F.col("site"))))["code"]
    head = by_code.agg(F.coalesce(F.sum("firsts"), F.lit(0)).alias("n"), codes.alias("codes")).select(F.lit(True).alias("head"), *made, "n", "codes")
    return head.unionByName(found.select(F.lit(False).alias("head"), *made, *found.columns), allowMissingColumns=True)


def combine(documents: DataFrame) -> DataFrame:
    """Documents of countries in one, as rows in order: a head (version, coverage, n), then the signals by country, detected and id. ES alone stays version 1; else version 2 with a coverage map and ES first."""
    order = F.when(F.col("country") == "ES", 0).otherwise(1)
    out = documents.filter("head").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "country", "generated"))).alias("d"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    head = out.select(
        F.lit(True).alias("head"), F.when((F.size("d") == 1) & (F.get("d", F.lit(0))["country"] == "ES"), 1).otherwise(2).alias("version"), F.map_from_entries(F.transform("d", lambda x: F.struct(x["country"], x["generated"]))).alias("coverage"), "n"
    )
    rows = documents.filter("not head").orderBy(order, "country", "detected", "id").drop("generated", "n", "codes")
    return head.unionByName(rows, allowMissingColumns=True)


#: Values in a piece of a text that is digested: short enough that a batch of pieces is small.
PIECE = 256


def digest(rows: DataFrame, value: str, name: str) -> DataFrame:
    """One row: the MD5 of the values, joined by commas in the order of the rows; null for none. Values are joined to pieces where they lie, and the pieces go through one task in turn, so the whole text is nowhere held."""

    def pieces(batches):
        at, k = TaskContext.get().partitionId(), 0
        for b in batches:
            found = b.column(0).drop_null()
            starts = range(0, len(found), PIECE)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([*starts, len(found)], pa.int32()), found), ",")
            yield pa.RecordBatch.from_arrays([pa.array([at] * len(starts), pa.int32()), pa.array(range(k, k + len(starts)), pa.int64()), texts], ["at", "k", "piece"])
            k += len(starts)

    def folded(batches):
        made, comma = hashlib.md5(usedforsecurity=False), b""
        for b in batches:
            for piece in b.column(2):
                made.update(comma + piece.as_py().encode())
                comma = b","
        if comma:
            yield pa.RecordBatch.from_arrays([pa.array([made.hexdigest()])], [name])

    ordered = rows.select(value).mapInArrow(pieces, "at int, k long, piece string").repartition(1).sortWithinPartitions("at", "k")
    return ordered.mapInArrow(folded, f"{name} string").agg(F.max(name).alias(name))


def feed(alerts: DataFrame, p: Params = PARAMS) -> DataFrame:
    """Entries of the feed: the newest active alerts, as XML."""
    newest = alerts.filter(F.col("state").isin(*ACTIVE)).orderBy(F.desc("detected"), "id").limit(p.feed_entries)
    return newest.select("id", F.format_string("<entry><id>%s</id><title>%s</title><updated>%sT00:00:00Z</updated></entry>", "id", escaped(F.col("class")), F.col("detected").cast("string")).alias("entry"))


def figures(alerts: DataFrame) -> DataFrame:
    active = F.col("state").isin(*ACTIVE)
    return alerts.agg(
        F.count(F.when(active, 1)).alias("active"), F.count(F.when(F.col("state") == "confirmada", 1)).alias("confirmed"), F.count(F.when(active & (F.col("status") == "resolucion"), 1)).alias("with_permit"),
        F.round(F.sum(F.when(active, F.col("ha"))), 1).alias("ha"), F.count(F.when(F.col("state") != "fusionada", 1)).alias("visible"),
    )


def facets(alerts: DataFrame, fields: list[str]) -> DataFrame:
    """Counts of active alerts by each value of each field, in one pass; fields without a value are left out."""
    pairs = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value")) for f in fields])
    rows = alerts.filter(F.col("state").isin(*ACTIVE)).select(F.inline(pairs))
    return rows.filter("value is not null and value <> ''").groupBy("facet", "value").agg(F.count("*").alias("n"))


def listed(alerts: DataFrame, state: str = "activas", status: str | None = None, klass: str | None = None) -> DataFrame:
    """The list as shown: filtered, by state, permit state and size; pos counts from 1."""
    wanted = {"activas": F.col("state").isin(*ACTIVE), "cerradas": ~F.col("state").isin(*ACTIVE) & (F.col("state") != "fusionada")}.get(state, F.col("state") == state)
    rows = alerts.filter(wanted)
    if status:
        rows = rows.filter(F.col("status") == status)
    if klass:
        rows = rows.filter(F.col("class") == klass)
    return rows.orderBy(rank(F.col("state"), STATE_RANK), rank(F.col("status"), STATUS_RANK), F.desc("ha"), "id")


def redirects(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("state") == "fusionada").select("id", "merged_into")


def features(alerts: DataFrame, properties: list[str], geometry: str) -> DataFrame:
    """Each alert, merged ones too, as a GeoJSON feature of the download; properties as they are, but for the geometry. geometry: a column of GeoJSON text."""
    body = F.to_json(F.struct(*properties))
    text = F.concat(F.lit('{"type":"Feature","properties":'), body, F.lit(',"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit("}"))
    return alerts.select("id", text.alias("feature"))


def photo_value(reflectance: Column) -> Column:
    """The brightness 0..255 of a photo's pixel, by a gamma curve. Fixed values."""
    return F.floor(F.pow(F.least(F.greatest(reflectance / 0.22, F.lit(0.0)), F.lit(1.0)), F.lit(1 / 1.6)) * 255).cast("int")
