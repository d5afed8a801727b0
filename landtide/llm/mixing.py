"""Mixing sources to target weights by Poisson replication.

A source s with n_s of N documents and target share w_s has the repetition rate
lambda_s = rate * N * w_s / n_s. Each document draws a uniform number from a hash of the seed and
its key, and its count is the inverse of the Poisson distribution function at that number, so the
draw is the same on every run and every cluster. Documents are exploded by their counts and dealt
out at random by a second hash, sorted within partitions: one shuffle, no key with many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: Up to so many sources the table of rates is broadcast; beyond it is joined by shuffle.
BROADCAST_SOURCES = 10_000


def uniform(seed: str, key: Column) -> Column:
    """A number in (0, 1) from 48 bits of an MD5 of seed and key; a null key counts as empty."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit("")))), 1, 12), 16, 10)
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def distribution(rate: Column) -> Column:
    """Poisson distribution function at 0, 1, ... until it is 1 to double precision; sums run over logarithms of the terms."""
    terms = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int"))
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def step(a: Column, k: Column) -> Column:
        log = a["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = a["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(a["all"], F.array(total)).alias("all"))

    return F.when(rate > 0, F.aggregate(terms, start, step, lambda a: a["all"])).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, weights: dict | None, alpha: float, rate: float, source: str = "source") -> DataFrame:
    """A row for each source: __source, __rate. weights: target share by source, others get none; without it n ** alpha."""
    counts = docs.groupBy(F.col(source).alias("__source")).agg(F.count("*").alias("__n"))
    spark = docs.sparkSession
    found = counts.limit(BROADCAST_SOURCES + 1).collect()
    if len(found) <= BROADCAST_SOURCES:
        counts = spark.createDataFrame(found, counts.schema)
    share = F.pow(F.col("__n").cast("double"), F.lit(alpha))
    if weights is not None:
        given = spark.createDataFrame(list(weights.items()), "__name string, __share double")
        counts = counts.join(F.broadcast(given) if len(weights) <= BROADCAST_SOURCES else given, F.col("__source").eqNullSafe(F.col("__name")), "left")
        share = F.coalesce("__share", F.lit(0.0))
    weighed = counts.withColumn("__w", share)
    total = weighed.agg(F.sum("__w").alias("__all_w"), F.sum("__n").alias("__all_n"))
    out = weighed.crossJoin(total).select("__source", F.coalesce(F.try_divide(F.lit(rate) * F.col("__all_n") * F.col("__w"), F.col("__all_w") * F.col("__n")), F.lit(0.0)).alias("__rate"))
    return F.broadcast(out) if len(found) <= BROADCAST_SOURCES else out


def mix(docs: DataFrame, weights: dict | None = None, alpha: float = 0.5, rate: float = 1.0, seed: str = "mix-1", key: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` replicated to the target weights, with copy_no (from 0), n_copies and mix_key, in random order.

    A null source is a source of its own (of weight 0 where weights are given without it). Rows with
    equal keys draw equal counts. A document whose count is 0 is left out: that is the method. An
    empty input, or one whose weights are all 0, gives no row. Columns named copy_no, n_copies or
    mix_key are replaced.
    """
    base = docs.drop("copy_no", "n_copies", "mix_key")
    table_ = rates(base, weights, alpha, rate, source).select("__source", distribution(F.col("__rate")).alias("__cdf"))
    drawn = base.withColumn("__u", uniform(seed, F.col(key))).join(table_, F.col(source).eqNullSafe(F.col("__source")))
    counted = drawn.withColumn("n_copies", F.size(F.filter("__cdf", lambda c: c < F.col("__u"))).cast("long")).filter("n_copies > 0").drop("__cdf", "__u", "__source")
    copies = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_copies") - 1)))
    keyed = copies.withColumn("mix_key", F.md5(F.concat_ws("|", F.lit(seed + "-order"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("copy_no").cast("string"))))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with sources flattened to the square root of their counts, 1.0 times the size."""
    return mix(table(spark, sf_dir, "documents"))


SQL = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, 1.0::DOUBLE * sum(n) OVER () * sqrt(n::DOUBLE) / (sum(sqrt(n::DOUBLE)) OVER () * n) AS rate FROM n),
terms AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM r, generate_series(0, 200) AS g(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 30)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
u AS (SELECT *, (('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u FROM documents),
drawn AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM u.source AND cdf.c < u.u) AS n_copies FROM u)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy_no, md5('mix-1-order|' || coalesce(doc_id::VARCHAR, '') || '|' || copy_no::VARCHAR) AS mix_key
FROM (SELECT *, unnest(generate_series(0, n_copies - 1)) AS copy_no FROM drawn WHERE n_copies > 0)
"""
