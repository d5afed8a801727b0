"""Connected components of links between longs, by alternating large-star and small-star.

Nothing is gathered on the driver but a count and a checksum for each round; links of each round
are written to the shared folder, so the plan doesn't grow and a lost executor costs its tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, stash


def components(links: DataFrame) -> DataFrame:
    """(u, v) for every node u that is not the smallest of its component, v being the smallest.

    links: two long columns, a and b, of any order, repeats allowed. Nodes without links aren't
    returned; links with a null end or equal ends are passed over.
    """
    edges = stash(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or not mark[0]:
            return edges
        seen = mark
        both = edges.select("u", F.col("v").alias("n")).unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("n")))
        least = both.groupBy("u").agg(F.min("n").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("n > u").join(least, "u").select(F.col("n").alias("u"), F.col("m").alias("v")).distinct()
        large = stash(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).distinct()
        after = stash(small, "small-star")
        discard(edges)
        discard(large)
        edges = after
