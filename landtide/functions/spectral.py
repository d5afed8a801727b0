"""Spectral expressions over reflectance columns; a division by zero gives null, which no rule passes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import PARAMS, Params


def normalised(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


def boa_shift(baseline: Column, applied: Column, offset: Column, scale: Column) -> Column:
    """Digital numbers to subtract: none before baseline 04.00 or where already applied, 1000 if unstated."""
    stated = F.coalesce(F.rint(F.try_divide(-offset, scale)), F.lit(1000.0))
    return F.when((baseline < "04.00") | F.coalesce(applied, F.lit(False)), F.lit(0.0)).otherwise(stated)


def reflectance(dn: Column, shift: Column) -> Column:
    return F.when(dn > shift, (dn - shift) * 1e-4)


def valid(scl: Column, green: Column, nir: Column, swir: Column, p: Params = PARAMS) -> Column:
    """A clear, snowless and not too dark observation, or water."""
    snow = F.coalesce(normalised(green, swir) > p.snow_ndsi, F.lit(False)) & (nir > p.snow_nir) & (green > p.snow_green)
    return (scl.isin(*p.scl_clear) & ~snow & (nir >= p.dark_nir)) | (scl == p.scl_water)


def quantise(v: Column) -> Column:
    """-1..1 to 0..200, ties to even; null stays null."""
    return F.when(v.isNotNull(), F.least(F.greatest(F.rint((v + 1) * 100), F.lit(0.0)), F.lit(200.0))).cast("int")


def dequantise(q: Column) -> Column:
    return q / 100.0 - 1.0


def indices(blue: Column, green: Column, red: Column, nir: Column, swir16: Column, swir22: Column) -> dict[str, Column]:
    return {
        "ndvi": normalised(nir, red),
        "mndwi": normalised(green, swir16),
        "nbr": normalised(nir, swir22),
        "bsi": normalised(swir16 + red, nir + blue),
        "brightness": (blue + green + red) / 3,
    }


def land_class(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """The first rule that holds names the class. Fixed values."""
    any_null = F.lit(False)
    for c in [*before.values(), *after.values()]:
        any_null = any_null | c.isNull()
    return (
        F.when(any_null, "vegetacion")
        .when((after["mndwi"] > 0) & (after["ndvi"] < 0.15), "agua")
        .when((before["nbr"] - after["nbr"] > 0.27) & (after["nir"] < 0.8 * before["nir"]) & (after["brightness"] < 0.10), "quemado")
        .when((after["bsi"] > 0.05) & (after["ndvi"] < 0.25), "suelo")
        .when((after["ndvi"] < 0.2) & (after["brightness"] < 0.08) & (after["nir"] < 0.15), "oscuro")
        .otherwise("vegetacion")
    )


def water_level(clc: Column, name: Column) -> Column:
    """Is the change the level of a water body? Fixed values: reservoirs always, other water for the class of water."""
    wet = clc.isin("411", "421", "423", "511", "512", "521", "522")
    return F.coalesce((clc == "512") | ((name == "agua") & wet), F.lit(False))
