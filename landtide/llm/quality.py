r"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger stores its measurements and one failure
bit for each rule; a policy is a version with a mask of the rules it applies, so verdicts of any
version, and ablations, come from the bits without reading a text again.

Words are ``[^\x20\x09-\x0D]+``. Words in three-word windows that occur more than once are found in
the row: windows are hashed, sorted with their places, and the places of equal neighbours give the
covered words, so no window leaves its row and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import computed_once, table

#: Rules by bit: name, and whether a document fails it, by the measurements.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("shouting", "2 * n_capitals > word_chars"),
    ("exclamations", "10 * n_exclamations > 3 * n_words"),
]
BASE_MASK = 0b0000011
#: The mask of rules by policy version.
POLICIES = {1: BASE_MASK, 2: 0b1111111}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations"]


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more."""

    def places(s: Column) -> Column:
        equal = lambda j, d: F.get(s, j)["h"] == F.get(s, j + d)["h"]
        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: equal(j, -1) | equal(j, 1)), lambda j: F.get(s, j)["i"]))

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(_let(ordered, places), start, lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements (long) and failure_bits (int); bit k is rule k of RULES.

    A null text counts as empty; it has no words and fails few_words. Columns that bear the name of
    a measurement or of failure_bits are replaced; others, ``text`` too, are kept. Repeated rows are
    measured each on its own.
    """
    base = docs.drop(*[c for c in [*MEASURES, "failure_bits"] if c != text])
    t = F.coalesce(F.col(text), F.lit(""))
    read = computed_once(base, __words=F.regexp_extract_all(t, F.lit(r"[^ \t-\r]+"), F.lit(0)), __lines=F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \t-\r]")))
    w = F.col("__words")
    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    counted = computed_once(
        read,
        n_words=F.size(w).cast("long"),
        word_chars=F.length(F.array_join(w, "")).cast("long"),
        n_symbols=F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        n_capitals=F.regexp_count(t, F.lit("[A-Z]")).cast("long"),
        n_exclamations=F.regexp_count(t, F.lit("!")).cast("long"),
        n_lines=F.size("__lines").cast("long"),
        n_dup_lines=(F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        __windows=windows,
    ).drop("__words", "__lines")
    g = F.col("__windows")
    repeats = F.when(g.isNull() | (F.size(F.array_distinct(g)) == F.size(g)), 0).otherwise(_covered(g))
    measured = computed_once(counted, n_repeat_words=repeats.cast("long")).drop("__windows")
    bits = F.lit(0)
    for k, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << k)).otherwise(0))
    return measured.withColumn("failure_bits", bits)


def verdict(version: int) -> Column:
    """Does the policy of this version keep a row of the ledger?"""
    return F.col("failure_bits").bitwiseAND(F.lit(POLICIES[version])) == 0


def ablation(rows: DataFrame, version: int) -> DataFrame:
    """For each rule of a policy: how many rows fail it, fail it alone, and are kept without it.

    The ledger is counted by its bits first, at most 2 ** len(RULES) rows whatever the input.
    """
    counts = rows.groupBy("failure_bits").agg(F.count("*").alias("n"))
    mask, out = POLICIES[version], None
    failed = F.col("failure_bits").bitwiseAND(F.lit(mask))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    aggregated = []
    for k, (name, _) in enumerate(RULES):
        if mask >> k & 1:
            one = F.lit(1 << k)
            aggregated.append(F.struct(F.lit(name).alias("rule"), total(failed.bitwiseAND(one) != 0).alias("n_failed"), total(failed == one).alias("n_failed_alone"), total(failed.bitwiseAND(F.bitwise_not(one)) == 0).alias("n_kept_without")))
    out = counts.agg(F.array(*aggregated).alias("rules"))
    return out.select(F.inline("rules"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents with the base verdict and that of policy 2."""
    rows = ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.col("failure_bits").bitwiseAND(F.lit(BASE_MASK)) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), verdict(2).alias("kept"), "n_lines", "n_capitals", "n_exclamations", "failure_bits")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS g FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w WHERE len(words) >= 3)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
p AS (SELECT r, count(DISTINCT i + o) AS n FROM c, (VALUES (0), (1), (2)) AS o(o) WHERE n >= 2 GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
  length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_exclamations FROM w LEFT JOIN p USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END + CASE WHEN 2 * n_capitals > word_chars THEN 32 ELSE 0 END
  + CASE WHEN 10 * n_exclamations > 3 * n_words THEN 64 ELSE 0 END)::INTEGER AS failure_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, n_lines, n_capitals, n_exclamations, failure_bits FROM b
"""
