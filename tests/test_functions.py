import pytest
from pyspark.sql import functions as F

from landtide.functions import geodesy, locale, months, spectral, text
from landtide.params import country


def one(spark, c, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return frame.select(c.alias("v")).first()["v"]


def test_countries():
    assert (country("FR").data, country("FR").site, country("FR").site_prefix, country("FR").alert_prefix) == ("data/fr", "site/fr", "FR64_", "CF")
    assert (country("ES").data, country("ES").alert_prefix) == ("data", "CN")
    with pytest.raises(ValueError):
        country("PT")


@pytest.mark.parametrize(("ref", "wanted"), [("64024000AB0042", ("000", "AB", 42)), ("640240000A0151", ("000", "A", 151))])
def test_french_reference(spark, ref, wanted):
    assert tuple(one(spark, text.french_reference(F.lit(ref)))) == wanted


def test_spanish_reference(spark):
    assert tuple(one(spark, text.spanish_reference(F.lit("39012A00409123")))) == ("rustica", 4, 9123, True)
    assert tuple(one(spark, text.spanish_reference(F.lit("1234567VP12345")))) == ("urbana", None, None, False)


@pytest.mark.parametrize(("section", "number", "wanted"), [("AB", "42", "AB0042"), ("0A", "151P", "A0151"), ("", "12", None), ("A", "0", None), ("A", "12345", "A12345"), (None, "1", None)])
def test_parcel_key(spark, section, number, wanted):
    assert one(spark, text.parcel_key(F.lit(section).cast("string"), F.lit(number))) == wanted


def test_permit_number(spark):
    assert one(spark, text.permit_number(F.lit("PC"), F.lit("06400524X1001"))) == "PC 064 005 24 X1001"
    assert one(spark, text.permit_number(F.lit("PC"), F.lit("12"))) == "PC 12"


@pytest.mark.parametrize(("month", "year"), [("2026-09", 2026), ("2026-08", 2026), ("2026-07", 2025), ("2026-02", 2025)])
def test_declaration_year_of_a_window_end(spark, month, year):
    # a window is known by its last month; its first one is two months earlier
    assert one(spark, months.declaration_year(months.parse(F.lit(month)) - 2)) == year


def test_numbers(spark):
    assert one(spark, locale.number(F.lit(1234.5), 1, "es")) == "1.234,5"
    assert one(spark, locale.number(F.lit(1234.5), 1, "fr")) == "1\u202f234,5"
    assert one(spark, locale.percent(F.lit(0.854), "es")) == "85 %"
    assert one(spark, locale.percent(F.lit(0.854), "fr")) == "85\u202f%"


def test_months(spark):
    assert one(spark, months.text_of(months.parse(F.lit("1999-12")))) == "1999-12"
    assert one(spark, months.window_of(F.lit(24000), 1)) == [23986, 23987, 23988]
    assert one(spark, months.water_months(F.lit(24000)))[0] == 24000 - 26 and one(spark, months.water_months(F.lit(24000)))[-1] == 24000 - 3
    assert str(one(spark, months.permit_lower_bound(months.parse(F.lit("2026-09")), 36))) == "2023-09-01"


def test_extraction(spark):
    t = F.lit("Ref 39012A00400018 y polígono 4, parcelas 18, 19 y 20; parcela 3 del polígono 7; 39012#00500019")
    assert one(spark, text.references(t)) == ["39012A00400018"]
    assert {tuple(x) for x in one(spark, text.polygon_parcels(t))} == {(4, 18), (4, 19), (4, 20), (7, 3)}
    assert ("39012", 5, 19) in {tuple(x) for x in one(spark, text.rustic(t))}
    assert one(spark, text.place(F.lit("Los Corrales de Buelna"))) == "corrales de buelna"
    assert one(spark, text.context(F.lit("Los  Corrales-Ñ"))) == "los corrales n"


def test_validity_and_quantisation(spark):
    rows = [(4, 0.05, 0.3, 0.1, True), (4, 0.5, 0.3, 0.05, False), (4, 0.05, 0.03, 0.1, False), (6, 0.0, 0.0, 0.0, True), (8, 0.05, 0.3, 0.1, False)]
    frame = spark.createDataFrame(rows, "scl int, green double, nir double, swir double, wanted boolean")
    got = frame.select(F.coalesce(spectral.valid(F.col("scl"), F.col("green"), F.col("nir"), F.col("swir")), F.lit(False)).alias("v"), "wanted").collect()
    assert all(r["v"] == r["wanted"] for r in got)
    assert one(spark, spectral.quantise(F.lit(0.345))) in (134, 135) and one(spark, spectral.quantise(F.lit(None).cast("double"))) is None
    assert one(spark, spectral.boa_shift(F.lit("02.05"), F.lit(False), F.lit(-0.1), F.lit(1e-4))) == 0
    assert one(spark, spectral.boa_shift(F.lit("04.00"), F.lit(None).cast("boolean"), F.lit(-0.1), F.lit(1e-4))) == 1000
    assert one(spark, spectral.water_level(F.lit("512"), F.lit("suelo"))) and not one(spark, spectral.water_level(F.lit(None).cast("string"), F.lit("agua")))


def test_utm(spark):
    x, y = geodesy.to_utm(F.lit(-3.0), F.lit(43.0))
    got = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(got["x"] - 500000) < 1e-3 and abs(got["y"] - 4760814.8) < 1
