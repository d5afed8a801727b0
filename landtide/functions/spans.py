"""Places of matches in a text, by running lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 64


def let(value: Column, *steps) -> Column:
    """``value`` passed through functions of a column, each result computed once."""
    once = lambda step: lambda x: step(x)
    for step in steps:
        value = F.get(F.transform(F.array(value), once(step)), F.lit(0))
    return value


def running(values: Column, combine) -> Column:
    """The sums, or maxima, of the beginnings of an array of integers, in chunks: an aggregate that holds an array would copy it at each step."""
    over = lambda part: F.aggregate(part, F.lit(0), combine)
    chunks = let(values, lambda v: F.struct(v.alias("v"), F.transform(F.sequence(F.lit(0), (F.size(v) / CHUNK).cast("int")), lambda k: over(F.slice(v, k * CHUNK + 1, F.lit(CHUNK)))).alias("whole")))

    def prefix(c: Column) -> Column:
        before = F.transform(c["whole"], lambda _, k: over(F.slice(c["whole"], F.lit(1), k)))
        return let(F.struct(c["v"].alias("v"), before.alias("before")), lambda x: F.transform(x["v"], lambda _, i: combine(F.get(x["before"], (i / CHUNK).cast("int")), over(F.slice(x["v"], (i / CHUNK).cast("int") * CHUNK + 1, i % CHUNK + 1)))))

    return let(chunks, prefix)


def ends(text: Column, pattern: str) -> Column:
    """The end of each match, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def places(found: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
        return F.when(F.size(found) == 0, F.array().cast("array<int>")).otherwise(running(lengths, lambda a, b: a + b))

    return let(found, places)
