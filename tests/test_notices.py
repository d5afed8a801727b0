"""What notices cite, and where notices come from."""

import json
import re
import unicodedata

from pyspark.sql import functions as F

from landtide.functions import text
from landtide.sources import readers


def cited(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.cited(F.col("t")).alias("c"))
    return [(list(r["c"]["refs"]), [tuple(x) for x in r["c"]["rustic"]], [tuple(x) for x in r["c"]["polpar"]]) for r in sorted(frame.collect())]


def test_capitals_and_full_width_digits(spark):
    plain = "polígono 4, parcelas 18, 19 y 20; parcela 3 del polígono 7"
    wide = plain.translate(str.maketrans("0123456789", "０１２３４５６７８９"))
    got = cited(spark, [plain, plain.upper(), wide, unicodedata.normalize("NFD", plain), None, ""])
    assert all(g[2] == [(4, 18), (4, 19), (4, 20), (7, 3)] for g in got[:4]) and got[4] == got[5] == ([], [], [])


def test_a_list_of_many_parcels(spark):
    n = 60_000
    got = cited(spark, ["polígono 4, parcelas " + ", ".join(str(i % 5000) for i in range(n)), "parcelas " + ", ".join(str(i % 3000) for i in range(n)) + " del polígono 9"])
    assert got[0][2] == [(4, i) for i in range(5000)] and got[1][2] == [(9, i) for i in range(3000)]


def test_tails_are_judged_by_their_place(spark):
    damaged, tail = "39036?008003820000MP", "008003820000MP"
    assert re.fullmatch(r"\d{7}[0-9A-Z]{7}", tail)
    alone, inside, both = cited(spark, [f"finca {tail} sola", f"finca {damaged}", f"finca {damaged} y {tail}"])
    assert alone[0] == [tail] and both[0] == [tail] and inside[0] == [] and inside[1] == both[1] == [("39036", 8, 382)]


def test_names_with_rare_letters(spark):
    names = ["Győr", "Rzeszów-Žižkov", "ﬁnca Ａlta", "El Astillero", "Łódź", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(names)], "i int, t string").select("i", text.place(F.col("t")).alias("p"))
    plain = lambda t: " ".join(re.sub("[^a-z ]", " ", unicodedata.normalize("NFKD", t or "").encode("ascii", "ignore").decode().lower()).split())
    assert [r["p"] for r in sorted(frame.collect())] == [re.sub("^(el|la|los|las) ", "", plain(t)) for t in names]


def test_observatory_reads_both_groups_of_a_region(spark, tmp_path):
    notice = lambda date, *regions, **more: {"fecha": date, "titulo": "t", "provincias": list(regions), **more}
    one = {"anuncios": {"a": notice("2024-01-02", "Cantabria"), "b": notice("2024-03-02", "Burgos")}, "resoluciones": {"c": notice(None, "Cantabria", "Burgos", fuente="BOC", municipios=["X"])}}
    two = {"anuncios": {"a": notice("2024-05-02", "Cantabria", sentido="favorable")}, "resoluciones": None, "otros": {"d": notice("2024-05-02", "Cantabria")}}
    for name, data in (("1.json", json.dumps(one)), ("2.json", json.dumps(two)), ("3.json", "not json")):
        (tmp_path / name).write_text(data)
    rows = readers.observatory(spark, str(tmp_path), "Cantabria").collect()
    assert [(r["notice"], r["grp"], r["fecha"], r["fuente"], r["municipios"], r["sentido"]) for r in rows] == [("a", "anuncios", "2024-05-02", "BOE", [], "favorable"), ("c", "resoluciones", None, "BOC", ["X"], "")]


def test_late_windows_and_water_levels_in_a_stream(spark, tmp_path):
    """Windows that come in a later batch than they belong to give the states of the fold over all of them."""
    from landtide.operators import lifecycle
    from landtide.streaming import alerts

    schema = "alert long, t int, seen boolean, back boolean, level boolean"
    first = [(1, 5, True, False, False), (2, 9, True, False, False), (3, 4, True, False, True), (4, 9, False, True, False)]
    late = [(1, 2, True, False, False), (2, 3, False, True, False), (3, 6, True, False, True), (4, 2, True, False, False), (1, 3, False, False, False)]
    for k, rows in enumerate((first, late)):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        for path in (tmp_path / "in" / str(k)).glob("*.parquet"):
            path.rename(tmp_path / "in" / f"{k}.parquet")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*.parquet")
    alerts._drained(alerts.alert_states(stream, 3), str(tmp_path), "update")
    out = spark.read.parquet(f"{tmp_path}/out").groupBy("alert").agg(F.max_by(F.struct("state", "first", "last", "n_seen"), "batch").alias("s")).select("alert", "s.*").collect()
    whole = lifecycle.fold(spark.createDataFrame(first + late, schema), "alert", 3).drop("changes").collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, whole)) == [(1, "confirmada", 2, 5, 2), (2, "provisional", 9, 9, 1), (3, "provisional", 4, 6, 2), (4, "descartada", 2, 2, 1)]
