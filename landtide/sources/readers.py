"""Readers of the engine's source formats, each a plan over files with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the permit files that are read. Those that tell the applicant are never among them.
PERMIT_COLUMNS = ("COMM", "DATE_REELLE_AUTORISATION", "NUM_DAU", "ETAT_DAU", "TYPE_DAU", "DESTINATION_PRINCIPALE", "SEC_CADASTRE1", "NUM_CADASTRE1", "SEC_CADASTRE2", "NUM_CADASTRE2", "SEC_CADASTRE3", "NUM_CADASTRE3")


def permit_csv(spark: SparkSession, path: str) -> DataFrame:
    """Permit files (semicolons, a header, UTF-8 with or without a mark) in the form that permits() takes."""
    from ..functions.text import parcel_key, permit_number

    raw = spark.read.csv(path, sep=";", header=True, encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns]).select(*PERMIT_COLUMNS)
    keys = F.array(*[parcel_key(F.col(f"SEC_CADASTRE{k}"), F.col(f"NUM_CADASTRE{k}")) for k in (1, 2, 3)])
    return raw.select(
        F.col("COMM").alias("commune"), permit_number(F.col("TYPE_DAU"), F.col("NUM_DAU")).alias("number"), F.col("TYPE_DAU").alias("kind"), F.to_date("DATE_REELLE_AUTORISATION").alias("date"),
        F.col("ETAT_DAU").alias("state"), F.col("DESTINATION_PRINCIPALE").alias("dest"), keys.alias("parcels"),
    )


def feature_collection(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row for each feature of GeoJSON files, plain or gzipped: its properties and the rings of its polygons (x, y)."""
    schema = f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    g = F.col("f.geometry")
    nested = F.when(g["type"] == "MultiPolygon", F.from_json(g["coordinates"], "array<array<array<array<double>>>>")).otherwise(F.array(F.from_json(g["coordinates"], "array<array<array<double>>>")))
    rings = F.transform(F.flatten(nested), lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return rows.filter(g.isNotNull()).select("f.properties.*", rings.alias("rings"))


def ring_area(ring):
    """Signed area of a ring of x, y structs."""
    n = F.size(ring)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda a, i: a + F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"]) / 2


def parcels_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Cadastral parcels: id, area (stated, or else that of the rings) and rings."""
    rows = feature_collection(spark, path, "id: string, contenance: double")
    shape = F.aggregate(F.transform("rings", lambda r: F.abs(ring_area(r))), F.lit(0.0), lambda a, x: a + x)
    return rows.select(F.col("id").alias("parcel"), F.coalesce(F.nullif(F.col("contenance"), F.lit(0.0)), shape).alias("area_m2"), "rings")


def atom_index(spark: SparkSession, path: str) -> DataFrame:
    """Entries of an ATOM index with an enclosure: municipality code, name, address and date."""
    entries = spark.read.format("xml").option("rowTag", "entry").schema("title string, updated string, link array<struct<_href: string, _rel: string>>").load(path)
    rows = entries.select(F.substring("updated", 1, 10).alias("updated"), F.explode("link").alias("l")).filter(F.col("l._rel") == "enclosure")
    pattern = r"/39/(\d{5})-([^/]+)/"
    return rows.select(F.regexp_extract("l._href", pattern, 1).alias("code"), F.regexp_extract("l._href", pattern, 2).alias("name"), F.col("l._href").alias("href"), "updated").filter("code <> ''")


def layer_years(capabilities: DataFrame, column: str = "text") -> DataFrame:
    """Years of the declaration layers that a capabilities document lists."""
    found = F.regexp_extract_all(F.col(column), F.lit(r"RPG\.(\d{4}):parcelles_graphiques"), F.lit(1))
    return capabilities.select(F.explode(F.transform(found, lambda y: y.cast("int"))).alias("year")).distinct()


#: The groups of an observatory's file, and the fields that are read of a notice.
GROUPS = ("anuncios", "resoluciones")
NOTICE = "fecha: string, titulo: string, url_html: string, url_xml: string, fuente: string, municipios: array<string>, sentido: string, sentido_etiqueta: string, categoria: string, provincias: array<string>"


def observatory(spark: SparkSession, path: str, region: str) -> DataFrame:
    """Notices of a region from an observatory's JSON files, newest first, undated last; an id that comes again wins by the later file and group.

    A file maps each group to its notices by id; one that isn't JSON has none. Columns: notice, grp, and
    fecha, titulo, url, url_xml, fuente (BOE where missing), municipios, sentido, sentido_etiqueta, categoria.
    """
    schema = "struct<" + ", ".join(f"{g}: map<string, struct<{NOTICE}>>" for g in GROUPS) + ">"
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.from_json("value", schema).alias("d"))
    groups = [files.select("file", F.lit(k).alias("place"), F.lit(g).alias("grp"), F.explode(f"d.{g}").alias("notice", "n")) for k, g in enumerate(GROUPS)]
    rows = groups[0].unionAll(groups[1]).filter(F.array_contains("n.provincias", region))
    last = rows.groupBy("notice").agg(F.max_by(F.struct("grp", "n"), F.struct("file", "place")).alias("x")).select("notice", "x.grp", "x.n")
    given = lambda c: F.coalesce(c, F.lit("")).alias(c.rpartition(".")[2])
    return last.select(
        "notice", "grp", "n.fecha", "n.titulo", F.col("n.url_html").alias("url"), "n.url_xml", F.coalesce(F.nullif(F.col("n.fuente"), F.lit("")), F.lit("BOE")).alias("fuente"), F.coalesce("n.municipios", F.array().cast("array<string>")).alias("municipios"),
        given("n.sentido"), given("n.sentido_etiqueta"), given("n.categoria"),
    ).orderBy(F.col("fecha").desc_nulls_last(), "notice")


def registry(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The alerts of a registry; none where there isn't any."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"alertas array<struct<{schema}>>").json(path, multiLine=True).select(F.inline("alertas"))


def write_months(comp: DataFrame, path: str) -> None:
    """Composites by month; writing a month again replaces that month only."""
    comp.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(path)


def read_months(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Composites of a range of months; other partitions aren't listed."""
    return spark.read.parquet(path).filter(F.col("ym").between(first, last))


def cadastre_zip(spark: SparkSession, path: str) -> DataFrame:
    """Parcels from zipped GML files, one file in a worker's memory at a time, read element by element: parcel, area_m2, rings (x, y).

    An entry without a reference or without a ring of four points is left out; rings of fewer points too.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        import io
        import zipfile
        from xml.etree.ElementTree import iterparse

        import pandas as pd

        tag = lambda e: e.tag.rsplit("}", 1)[-1]
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in [n for n in z.namelist() if n.lower().endswith(".gml")]:
                        rows = []
                        for _, element in iterparse(z.open(name)):
                            if tag(element) != "CadastralParcel":
                                continue
                            ref, stated, rings = None, None, []
                            for e in element.iter():
                                if tag(e) == "nationalCadastralReference":
                                    ref = (e.text or "").strip()
                                elif tag(e) == "areaValue" and e.text:
                                    stated = float(e.text)
                                elif tag(e) == "posList" and e.text:
                                    v = list(map(float, e.text.split()))
                                    if len(v) >= 8:
                                        rings.append([{"x": a, "y": b} for a, b in zip(v[::2], v[1::2], strict=True)])
                            if ref and rings:
                                rows.append((ref, stated, rings))
                            element.clear()
                        yield pd.DataFrame(rows, columns=["parcel", "stated", "rings"])

    rows = files.mapInPandas(run, "parcel string, stated double, rings array<array<struct<x: double, y: double>>>")
    shape = F.aggregate("rings", F.lit(0.0), lambda a, r: a + ring_area(r))
    return rows.select("parcel", F.coalesce(F.nullif(F.col("stated"), F.lit(0.0)), F.abs(shape)).alias("area_m2"), "rings")


def write_snapshot(rows: DataFrame, path: str) -> None:
    """A registry that is replaced as a whole: written beside the old one, then swapped by two renames."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}.new")
    Path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    store = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(Path(path)):
        store.delete(Path(f"{path}.old"), True)
        store.rename(Path(path), Path(f"{path}.old"))
    store.rename(Path(f"{path}.new"), Path(path))


def append_missing(rows: DataFrame, known: DataFrame, keys: list[str], path: str) -> int:
    """Append the rows whose keys aren't known; returns how many."""
    fresh = rows.join(known, keys, "left_anti").persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return n


def within_box(rows: DataFrame, y0: float, x0: float, y1: float, x1: float) -> DataFrame:
    """Rows whose box (y0, x0, y1, x1) meets another; the comparisons reach a Parquet scan."""
    return rows.filter((F.col("y0") <= y1) & (F.col("y1") >= y0) & (F.col("x0") <= x1) & (F.col("x1") >= x0))
