import gzip
import hashlib
import json
import random

import numpy as np
from pyspark.sql import functions as F

from landtide.operators import components, lifecycle, overlay, permits, publish
from landtide.sources import readers
from landtide.streaming import alerts as stream


def bfs(cells):
    left, out = set(cells), {}
    while left:
        start = min(left)
        left.discard(start)
        todo, seen = [start], [start]
        while todo:
            y, x = todo.pop()
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    if (y + dy, x + dx) in left:
                        left.discard((y + dy, x + dx))
                        todo.append((y + dy, x + dx))
                        seen.append((y + dy, x + dx))
        for c in seen:
            out[c] = start
    return out


def test_components_across_tiles_equal_a_search(spark):
    rng = random.Random(3)
    cells = [(y, x) for y in range(40) for x in range(40) if rng.random() < 0.42]
    got = components.components(spark.createDataFrame(cells, "cy long, cx long"), 40, tile=8).collect()
    wanted = bfs(cells)
    assert {(r["cy"], r["cx"]): r["comp"] for r in got} == {c: s[0] * 40 + s[1] for c, s in wanted.items()}


def test_near_pairs_reach(spark):
    at = lambda *p: spark.createDataFrame([(1, 0, 0), *p], "id long, cy long, cx long")
    pairs = lambda f, r: {tuple(x) for x in components.near_pairs(f.withColumnRenamed("id", "a"), f.withColumnRenamed("id", "b"), r).filter("a < b").collect()}
    assert pairs(at((2, 2, 2)), 2) == {(1, 2)} and pairs(at((2, 3, 0)), 2) == set()


def test_clipping_equals_sampling():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(3, 9))
        angle = np.sort(rng.uniform(0, 2 * np.pi, n))
        radius = rng.uniform(1, 4, n)
        ring = [(5 + r * np.sin(a), 5 + r * np.cos(a)) for a, r in zip(angle, radius, strict=True)]
        whole = overlay.clip_area(ring, -100, -100, 100, 100)
        parts = sum(overlay.clip_area(ring, y, x, y + 1, x + 1) for y in range(11) for x in range(11))
        assert abs(whole - parts) < 1e-9


def test_ring_overlap_and_rasterise(spark):
    ring = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]
    rings = spark.createDataFrame([(7, [{"y": y, "x": x} for y, x in ring])], "parcel long, points array<struct<y: double, x: double>>")
    cells = spark.createDataFrame([(1, y, x) for y in range(2, 6) for x in range(2)], "alert long, cy long, cx long")
    got = {(r["cy"], r["cx"]): r["area"] for r in overlay.ring_overlap(cells, rings).collect()}
    assert sum(abs(a) for a in got.values()) == 4
    inside = overlay.rasterise(rings.withColumnRenamed("parcel", "id")).collect()
    assert {(r["cy"], r["cx"]) for r in inside} == {(y, x) for y in range(4) for x in range(4)}


def test_life_cycle(spark):
    def last(*ws):
        rows = [(1, t, s, b) for t, s, b in ws]
        got = lifecycle.fold(spark.createDataFrame(rows, "alert long, t int, seen boolean, back boolean"), "alert", 3).collect()
        return got[0]["state"] if got else None

    assert last((1, True, False)) == "provisional"
    assert last((1, True, False), (2, True, False)) == "confirmada"
    assert last((1, True, False), (2, False, True)) == "descartada"
    assert last((1, True, False), (2, True, False), (3, False, True)) == "revertida"
    assert last((1, True, False), (2, False, False), (4, False, False)) == "descartada"
    assert last((1, True, False), (2, False, True), (5, True, False)) == "confirmada"
    assert last((1, False, True)) is None


def test_stream_equals_batch(spark):
    rng = random.Random(1)
    rows = [(a, t, rng.random() < 0.3, rng.random() < 0.2) for a in range(20) for t in range(12)]
    frame = spark.createDataFrame(rows, "alert long, t int, seen boolean, back boolean")
    batch = {r["alert"]: (r["state"], r["n_seen"]) for r in lifecycle.fold(frame, "alert", 3).collect()}
    assert {r["alert"]: (r["state"], r["n_seen"]) for r in stream.run_to_end(spark, frame, 3).collect()} == batch


def test_permit_files(spark, tmp_path):
    head = "COMM;DATE_REELLE_AUTORISATION;NUM_DAU;ETAT_DAU;TYPE_DAU;DESTINATION_PRINCIPALE;DENOM_DEM;SIREN_DEM;SIRET_DEM;ADR_LOCALITE_TER;SEC_CADASTRE1;NUM_CADASTRE1;SEC_CADASTRE2;NUM_CADASTRE2;SEC_CADASTRE3;NUM_CADASTRE3"
    lines = [head, "64024;2024-05-02;06402424X1001;5;PC;1;SECRET;1;2;X;AB;42;;;;", "64024;2016-05-02;06402416X1001;5;PC;1;SECRET;1;2;X;AB;42;;;;"]
    (tmp_path / "p.csv").write_text("﻿" + "\n".join(lines), encoding="utf-8")
    raw = readers.permit_csv(spark, str(tmp_path / "p.csv"))
    assert not [c for c in raw.columns if "DEM" in c.upper()]
    kept = permits.permits(raw, spark.createDataFrame([("64024",)], "commune string"))
    got = kept.collect()
    assert [(r["commune"], str(r["date"]), r["state"], r["parcels"]) for r in got] == [("64024", "2024-05-02", "5", ["AB0042"])]
    parcel = lambda ym: spark.createDataFrame([("a", "64024", "AB0042", ym)], "alert string, commune string, parcel string, first int")
    state = lambda ym: permits.permit_status(spark.createDataFrame([("a", True)], "alert string, has_parcels boolean"), permits.permit_hits(parcel(ym), kept)).first()["status"]
    assert state(2026 * 12 + 8) == "resolucion" and state(2028 * 12 + 8) == "sin_expediente"


def test_geojson_and_xml(spark, tmp_path):
    square = [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]]
    doc = {"type": "FeatureCollection", "features": [{"properties": {"id": "a", "contenance": 0}, "geometry": {"type": "Polygon", "coordinates": square}}, {"properties": {"id": "b", "contenance": 70}, "geometry": {"type": "MultiPolygon", "coordinates": [square]}}, {"properties": {"id": "c"}, "geometry": None}]}
    with gzip.open(tmp_path / "p.json.gz", "wt") as f:
        json.dump(doc, f)
    got = {r["parcel"]: r["area_m2"] for r in readers.parcels_geojson(spark, str(tmp_path / "p.json.gz")).collect()}
    assert got == {"a": 100.0, "b": 70.0}
    (tmp_path / "i.xml").write_text('<feed><entry><title>x</title><updated>2026-01-02T00:00:00</updated><link rel="enclosure" href="http://h/39/39012-CAMARGO/a.zip"/><link rel="self" href="http://h"/></entry></feed>')
    row = readers.atom_index(spark, str(tmp_path / "i.xml")).first()
    assert (row["code"], row["name"], row["updated"]) == ("39012", "CAMARGO", "2026-01-02")
    years = readers.layer_years(spark.createDataFrame([("<a>RPG.2023:parcelles_graphiques</a> RPG.2024:parcelles_graphiques RPG.2024:x",)], "text string"))
    assert sorted(r["year"] for r in years.collect()) == [2023, 2024]


def test_months_are_replaced_one_by_one(spark, tmp_path):
    p = str(tmp_path / "comp")
    rows = lambda *r: spark.createDataFrame(list(r), "cell long, q int, ym int")
    readers.write_months(rows((1, 5, 10), (1, 6, 11)), p)
    readers.write_months(rows((2, 9, 11)), p)
    assert sorted((r["cell"], r["q"], r["ym"]) for r in readers.read_months(spark, p, 10, 11).collect()) == [(1, 5, 10), (2, 9, 11)]
    assert readers.registry(spark, str(tmp_path / "none.json"), "id string").count() == 0


def test_signals(spark):
    rows = [("b", "provisional"), ("a", "confirmada"), ("c", "fusionada"), ("d", "descartada")]
    frame = spark.createDataFrame(rows, "id string, state string").select("id", "state", F.lit("2026-09-01").alias("detected"), F.lit(1.0).alias("ha"), F.lit(43.0).alias("lat"), F.lit(-3.0).alias("lon"), F.lit("suelo").alias("class"), F.lit("tramitacion").alias("status"), F.lit(None).cast("string").alias("photo"), F.array(F.lit("Z"), F.lit("A"), F.lit("A")).alias("sites"), F.lit("39").alias("refcat"))
    got = publish.signals(frame, "https://x.org/", "fr").collect()
    assert [r["id"] for r in got] == ["a", "b"] and got[0]["point"] == [-3.0, 43.0] and got[0]["image"] is None
    assert [s["code"] for s in got[0]["sites"]] == ["A", "Z"] and got[0]["permit"] == "tramitacion" and "refcat" not in got[0].asDict()
    one = publish.document(publish.signals(frame, "https://x.org/", "es"), "ES", F.lit("2026-10-13 07:02:41").cast("timestamp"))
    assert one.first()["generated"] == "2026-10-13T07:02Z" and publish.combine(one).first()["version"] == 1


def test_signals_of_documents_in_rows(spark):
    n, stamp = 3000, F.lit("2026-10-13 07:02:41").cast("timestamp")
    alerts = spark.range(0, n, 1, 3).select(
        F.format_string("a%04d", "id").alias("id"), F.lit("provisional").alias("state"), F.date_add(F.lit("2026-09-01"), (F.col("id") % 7).cast("int")).alias("detected"), F.lit(1.0).alias("ha"), F.lit(43.0).alias("lat"), F.lit(-3.0).alias("lon"), F.lit("suelo").alias("class"), F.lit("pendiente").alias("status"),
        F.lit("f.jpg").alias("photo"), F.when(F.col("id") % 5 > 1, F.array(F.format_string("S%d", F.col("id") % 5), F.lit("S9"))).when(F.col("id") % 5 == 1, F.array().cast("array<string>")).alias("sites"),
    )
    documents = publish.document(publish.signals(alerts, "https://x.org/", "fr"), "FR", stamp).unionByName(publish.document(publish.current(alerts, "https://x.org/", "es"), "ES", stamp))
    made = publish.combine(documents)
    for frame in documents, made:  # no row grows with the signals
        assert frame.count() in (2 * n + 1, 2 * n + 2) and frame.agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] < 1000
    assert [(r["n"], r["codes"], r["id"]) for r in documents.filter("head").collect()] == [(n, ["S2", "S3", "S4", "S9"], None)] * 2
    head, *rows = made.collect()
    assert (head["version"], head["coverage"], head["n"]) == (2, {"ES": "2026-10-13T07:02Z", "FR": "2026-10-13T07:02Z"}, 2 * n)
    ids = [f"a{i:04d}" for i in sorted(range(n), key=lambda i: (i % 7, i))]
    assert [(r["country"], r["id"]) for r in rows] == [(k, x) for k in ("ES", "FR") for x in ids] and rows[-1]["permit"] == "Parcelles à consulter"
    assert publish.digest(made.filter("not head"), "id", "m").collect() == [(hashlib.md5(",".join(ids + ids).encode()).hexdigest(),)]
    none = publish.document(publish.current(alerts.filter("id is null"), "https://x.org/", "es"), "ES", stamp)
    assert [(r["country"], r["n"], r["codes"]) for r in none.collect()] == [("ES", 0, [])] and publish.digest(none.filter("not head"), "id", "m").collect() == [(None,)]


def test_nearest_of_a_large_layer(spark):
    rng = random.Random(3)
    # a dense town, a sparse country and a few wide zones, over 10,000 in all
    low = [(rng.uniform(0, 5), rng.uniform(0, 5)) for _ in range(9_900)] + [(rng.uniform(0, 1000), rng.uniform(900, 1000)) for _ in range(200)]
    zones = [(f"z{i}", y, x, y + rng.uniform(0, 0.05), x + rng.uniform(0, 0.05)) for i, (y, x) in enumerate(low)] + [("wide", 300.0, 100.0, 700.0, 160.0), ("twin", 300.0, 100.0, 700.0, 160.0)]
    points = [(i, rng.uniform(-100, 1100), rng.uniform(-100, 1100)) for i in range(150)] + [(200 + i, rng.uniform(0, 5), rng.uniform(0, 5)) for i in range(50)] + [(300, 1e7, -1e7), (301, 500.0, 130.0)]
    got = {r["id"]: (r["zone"], r["d2"]) for r in overlay.nearest(spark.createDataFrame(points, "id long, y double, x double"), spark.createDataFrame(zones, "zone string, y0 double, x0 double, y1 double, x1 double")).collect()}
    assert len(got) == len(points) and got[301] == ("twin", 0.0)
    for i, y, x in points:
        d2, name = min((max(y0 - y, 0.0, y - y1) ** 2 + max(x0 - x, 0.0, x - x1) ** 2, z) for z, y0, x0, y1, x1 in zones)
        assert got[i][0] == name and abs(got[i][1] - d2) <= 1e-6 * max(1, d2)
