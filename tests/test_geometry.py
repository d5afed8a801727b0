import random
import zipfile

from pyspark.sql import functions as F

from landtide.operators import geometry, overlay, publish
from landtide.sources import readers


def test_outlines_give_back_the_area_and_the_cells(spark):
    rng = random.Random(2)
    cells = {(k, y, x) for k in range(3) for y in range(9) for x in range(9) if rng.random() < 0.6}
    frame = spark.createDataFrame(sorted(cells), "comp long, cy long, cx long")
    rings = geometry.outlines(frame, "comp").collect()
    for k in range(3):
        own = [[(p["y"], p["x"]) for p in r["points"]] for r in rings if r["comp"] == k]
        assert abs(sum(overlay.clip_area(r, -1, -1, 99, 99) for r in own)) == sum(c[0] == k for c in cells)
    names = geometry.outlines(frame, "comp").withColumn("id", F.col("comp") * 100 + F.col("ring"))
    parity = overlay.rasterise(names).groupBy(F.floor(F.col("id") / 100).alias("k"), "cy", "cx").count().filter("count % 2 = 1").collect()
    assert {(r["k"], r["cy"], r["cx"]) for r in parity} == cells


def test_lines_are_stitched(spark):
    p = lambda *xs: [{"y": float(a), "x": float(b)} for a, b in xs]
    lines = spark.createDataFrame([(1, p((0, 0), (0, 5))), (1, p((5, 5), (0, 5))), (1, p((5, 5), (5, 0), (0, 0))), (2, p((0, 0), (1, 1)))], "muni long, points array<struct<y: double, x: double>>")
    got = geometry.stitch(lines, "muni").collect()
    assert len(got) == 1 and abs(overlay.clip_area([(q["y"], q["x"]) for q in got[0]["points"]], -9, -9, 9, 9)) == 25


def test_simplification(spark):
    line = [(0, 0), (0.01, 1), (0, 2), (3, 3), (0, 4)]
    assert geometry.simplify(line, 0.1) == [(0, 0), (0, 2), (3, 3), (0, 4)] and geometry.simplify(line, 9) == [(0, 0), (0, 4)]
    ring = spark.createDataFrame([(1, [{"y": float(y), "x": float(x)} for y, x in [(0, 0), (0, 1), (0, 2), (2, 2), (2, 0)]])], "id long, points array<struct<y: double, x: double>>")
    assert len(geometry.simplified(ring, 0.1).first()["points"]) == 4


def test_points_in_a_ring_with_a_hole(spark):
    square = lambda a, b: [{"y": float(y), "x": float(x)} for y, x in [(a, a), (a, b), (b, b), (b, a)]]
    rings = spark.createDataFrame([("z", square(0, 10)), ("z", square(4, 6))], "zone string, points array<struct<y: double, x: double>>")
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 5.0), (3, 11.0, 5.0)], "id long, y double, x double")
    assert [r["id"] for r in geometry.inside(points, rings, 3.0).collect()] == [1]


def test_zipped_cadastre_and_snapshots(spark, tmp_path):
    gml = """<r xmlns:c="u"><c:CadastralParcel><c:areaValue>0</c:areaValue><c:nationalCadastralReference>A1</c:nationalCadastralReference><c:posList>0 0 10 0 10 10 0 10 0 0</c:posList></c:CadastralParcel>
    <c:CadastralParcel><c:areaValue>7.5</c:areaValue><c:nationalCadastralReference>A2</c:nationalCadastralReference><c:posList>0 0 1 0 1 1 0 0</c:posList></c:CadastralParcel><c:CadastralParcel><c:posList>0 0 1 0 1 1 0 0</c:posList></c:CadastralParcel></r>"""
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("a.cadastralparcel.gml", gml)
    got = {r["parcel"]: r["area_m2"] for r in readers.cadastre_zip(spark, str(tmp_path / "m.zip")).collect()}
    assert got == {"A1": 100.0, "A2": 7.5}
    path = str(tmp_path / "reg")
    for n in (1, 2):
        readers.write_snapshot(spark.range(n), path)
        assert spark.read.parquet(path).count() == n
    rows = spark.createDataFrame([(1, 3), (2, 3)], "id long, v int")
    assert readers.append_missing(rows, rows.filter("id = 1"), ["id", "v"], str(tmp_path / "fp")) == 1


def test_features_keep_their_properties(spark):
    frame = spark.createDataFrame([("a", "provisional", None), ("b", "fusionada", None)], "id string, state string, g string")
    rows = publish.features(frame, ["id", "state"], "g").collect()
    # the download has merged alerts too
    assert [r["feature"] for r in rows] == [f'{{"type":"Feature","properties":{{"id":"{i}","state":"{s}"}},"geometry":null}}' for i, s in (("a", "provisional"), ("b", "fusionada"))]
