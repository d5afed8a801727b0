"""Text: cadastral references in notices, names of places, permit numbers."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .spans import ends, let

#: The patterns of references. Classes and cases are Unicode's; a possessive list changes no
#: match, but is a loop in the matcher, where a greedy one recurses for every item.
REF = r"(?U)(?<![0-9A-Z])(\d{5}[A-Z]\d{8}|\d{7}[0-9A-Z]{7})(?:\d{4}[A-Z]{2})?(?![0-9A-Z])"
RUSTIC = r"(?U)(?<![0-9A-Z])(39\d{3})[^\s\d]?(\d{3})(\d{5})(?:\d{4}[A-Z]{2})?(?![0-9A-Z])"
_N = r"(?:n\.?\s*[ºo°]\.?\s*)?"
_LIST = r"(\d{1,5}(?:\s*(?:,|y|e)\s*\d{1,5})*+)"
POL_PAR = rf"(?iuU)pol(?:[íi]gono|\.)\s*{_N}(\d{{1,3}})\W{{0,6}}(?:y\s+)?parc(?:elas?|\.)\s*{_N}{_LIST}"
PAR_POL = rf"(?iuU)parc(?:elas?|\.)\s*{_N}{_LIST}\s*,?\s*del?\s+pol(?:[íi]gono|\.)\s*{_N}(\d{{1,3}})"
#: Letters with marks and what they become.
_MARKED, _PLAIN = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ", "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(StringType())
def _nfkd_ascii(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), na_action="ignore")


def compatible(text: Column) -> Column:
    """Normal form KC. Only texts with letters beyond those that it leaves as they are go to Python."""
    return F.coalesce(_nfkc(F.when(text.rlike(f"[^\\x00-\\x7F{_MARKED}¡¿«»–—€]"), text)), text)


def references(text: Column) -> Column:
    """Distinct 14-character references, sorted, without urban-looking tails of a damaged rustic one: those that lie inside it, but begin later."""
    spots = F.struct(_all(text, RUSTIC).alias("rustic"), ends(text, RUSTIC).alias("rustic_ends"), _all(text, REF).alias("whole"), _all(text, REF, 1).alias("refs"), ends(text, REF).alias("ends"))

    def kept(x: Column) -> Column:
        rustic = F.zip_with(x["rustic"], x["rustic_ends"], lambda r, e: F.struct((e - F.length(r)).alias("start"), e.alias("end")))
        found = F.arrays_zip(x["refs"].alias("ref"), x["whole"].alias("whole"), x["ends"].alias("end"))
        start = lambda m: m["end"] - F.length(m["whole"])
        tail = lambda m: ~F.substring(m["ref"], 6, 1).rlike("[A-Z]") & F.exists(rustic, lambda r: (r["start"] < start(m)) & (start(m) + F.length(m["ref"]) <= r["end"]))
        return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda m: ~tail(m)), lambda m: m["ref"])))

    return let(spots, kept)


def rustic(text: Column) -> Column:
    """Distinct (municipality, polygon, parcel) of rustic references, sorted."""
    parts = F.arrays_zip(_all(text, RUSTIC, 1).alias("m"), _all(text, RUSTIC, 2).alias("p"), _all(text, RUSTIC, 3).alias("q"))
    return F.array_sort(F.array_distinct(F.transform(parts, lambda x: F.struct(x["m"].alias("mun"), x["p"].cast("int").alias("pol"), x["q"].cast("int").alias("par")))))


def polygon_parcels(text: Column) -> Column:
    """Distinct (polygon, parcel) named in words, either order, lists expanded, sorted."""

    def pairs(pattern: str, pol: int, par: int) -> Column:
        zipped = F.arrays_zip(_all(text, pattern, pol).alias("a"), _all(text, pattern, par).alias("b"))
        return F.flatten(F.transform(zipped, lambda z: F.transform(_all(z["b"], r"\d+"), lambda n: F.struct(z["a"].cast("int").alias("pol"), n.cast("int").alias("par")))))

    return F.array_sort(F.array_distinct(F.concat(pairs(POL_PAR, 1, 2), pairs(PAR_POL, 2, 1))))


def cited(text: Column) -> Column:
    """What a notice cites: refs, rustic and polpar, all of one text in normal form."""
    return let(compatible(F.coalesce(text, F.lit(""))), lambda t: F.struct(references(t).alias("refs"), rustic(t).alias("rustic"), polygon_parcels(t).alias("polpar")))


def ascii_lower(s: Column) -> Column:
    """Lower case, letters without their marks, the rest of what is not ASCII left out. Texts with other letters than the table's go to Python for normal form KD."""
    own = F.coalesce(s, F.lit(""))
    known = F.regexp_replace(F.translate(own, _MARKED, _PLAIN), r"[^\x00-\x7F]", "")
    return F.lower(F.coalesce(_nfkd_ascii(F.when(own.rlike(f"[^\\x00-\\x7F{_MARKED}]"), own)), known))


def place(s: Column) -> Column:
    """A municipality's name for comparison: plain letters, single blanks, no leading article."""
    return _place(ascii_lower(s))


def plain_place(s: Column) -> Column:
    """place() of a name with no letters beyond the table's; for use inside arrays, where Python can't be called."""
    return _place(F.lower(F.regexp_replace(F.translate(F.coalesce(s, F.lit("")), _MARKED, _PLAIN), r"[^\x00-\x7F]", "")))


def _place(plain: Column) -> Column:
    letters = F.trim(F.regexp_replace(F.regexp_replace(plain, "[^a-z ]", " "), " +", " "))
    return F.trim(F.regexp_replace(letters, "^(el|la|los|las) ", ""))


def context(s: Column) -> Column:
    """A municipality's name for counting context: the article stays."""
    return F.trim(F.regexp_replace(F.replace(ascii_lower(s), F.lit("-"), F.lit(" ")), r"\s+", " "))


def without_markup(s: Column) -> Column:
    return F.regexp_replace(s, "<[^>]+>", " ")


def spanish_reference(ref: Column) -> Column:
    """Kind, polygon, parcel and whether it is a discount parcel, of a 14-character reference."""
    is_rustic = (F.length(ref) == 14) & F.substring(ref, 6, 1).rlike("^[A-Za-z]$") & F.concat(F.substring(ref, 1, 5), F.substring(ref, 7, 8)).rlike("^[0-9]+$")
    parcel = F.when(is_rustic, F.substring(ref, 10, 5).cast("int"))
    return F.struct(
        F.when(is_rustic, "rustica").otherwise("urbana").alias("kind"), F.when(is_rustic, F.substring(ref, 7, 3).cast("int")).alias("polygon"), parcel.alias("parcel"), F.coalesce((parcel >= 9000) & (parcel < 10000), F.lit(False)).alias("discount")
    )


def french_reference(ref: Column) -> Column:
    """Prefix, section and number of a 14-character id."""
    section = F.regexp_replace(F.substring(ref, 9, 2), "^0+", "")
    return F.struct(F.substring(ref, 6, 3).alias("prefix"), F.when(section == "", "0").otherwise(section).alias("section"), F.substring(ref, 11, 4).cast("int").alias("number"))


def parcel_key(section: Column, number: Column) -> Column:
    """Section without leading zeros and the number in four digits or more; null if either is missing."""
    s = F.regexp_replace(F.upper(F.trim(F.coalesce(section, F.lit("")))), "^0+", "")
    n = F.regexp_replace(F.coalesce(number.cast("string"), F.lit("")), "[^0-9]", "")
    value = F.when(n != "", n.cast("long"))
    return F.when((s != "") & (value > 0), F.format_string("%s%04d", s, value))


def permit_number(kind: Column, number: Column) -> Column:
    """The official form: kind, department, commune, year, rest."""
    n = F.trim(number)
    parts = F.concat_ws(" ", kind, F.substring(n, 1, 3), F.substring(n, 4, 3), F.substring(n, 7, 2), F.substr(n, F.lit(9)))
    return F.when(F.length(n) >= 13, parts).otherwise(F.concat_ws(" ", kind, n))
