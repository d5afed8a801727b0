"""Numbers, dates and escapes of the published pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NARROW = "\u202f"
#: Names of months.
MONTHS = {
    "es": ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"],
    "fr": ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"],
}


def number(x: Column, digits: int, lang: str) -> Column:
    """1.234,5 in Spanish; a narrow blank between thousands in French."""
    return F.translate(F.format_number(x, digits), ",.", ".," if lang == "es" else NARROW + ",")


def percent(x: Column, lang: str) -> Column:
    gap = " " if lang == "es" else NARROW
    return F.concat(F.rint(x * 100).cast("int").cast("string"), F.lit(gap + "%"))


def month_name(m: Column, lang: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTHS[lang]]), m.cast("int"))


def window_text(first: Column, last: Column, lang: str) -> Column:
    """Months of a window, the year once if it is the same. first, last: integer months."""
    of = " de " if lang == "es" else " "
    name = lambda ym: month_name(ym % 12 + 1, lang)
    year = lambda ym: ((ym - ym % 12) / 12).cast("int").cast("string")
    same = F.concat(name(first), F.lit("–"), name(last), F.lit(of), year(last))
    return F.when(year(first) == year(last), same).otherwise(F.concat(name(first), F.lit(of), year(first), F.lit("–"), name(last), F.lit(of), year(last)))


def long_date(d: Column, lang: str) -> Column:
    of = " de " if lang == "es" else " "
    return F.concat(F.day(d).cast("string"), F.lit(of), month_name(F.month(d), lang), F.lit(of), F.year(d).cast("string"))


def typographic(s: Column) -> Column:
    return F.translate(s, "~", NARROW)


def escaped(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def in_script(s: Column) -> Column:
    return F.replace(s, F.lit("</"), F.lit("<\\/"))
