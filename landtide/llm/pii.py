r"""Personal data: patterns, and information-theoretic sanitisation of the terms that reveal it.

Base spans are matches of fixed patterns for emails, IP addresses, card and phone numbers. The protected
entities are the values found and those parts of them that recur: an address's domain and the names in
it, an IP's network, a card's issuer, a phone's exchange. A term that occurs in documents with an entity
discloses it by its pointwise mutual information with it, over the corpus: PMI = log(n_te N / (n_t n_e)),
where n_t counts the documents with the term, n_e those with the entity and n_te those with both. A term
is revealing if its PMI is at least THRESHOLD of the entity's own information log(N / n_e), if
n_te * PMI exceeds the log of the number of pairs tested, so that chance alone passes less than one pair,
and if it stands beside the entity in two different texts or more, with different words before it and
different words after it: a word that only copies of one passage share tells the passage, not the entity.
It is then a span of kind "term" at each of its places in the documents that hold the entity. Sanitising
puts a general word in the place of every span.

All of it is DataFrame expressions. Document frequencies are taken over every word of every document
as 64-bit hashes, with partial aggregation; pairs are counted over distinct texts that hold an entity of
more texts than one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.spans import let, running
from .shared import computed_once, stash, table

THRESHOLD = 0.75
#: The base patterns. Possessive repeats and the look-behinds change no match: they keep long runs
#: linear, and a possessive group is a loop in the matcher, where a greedy one recurses for every repeat.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
WORD = r"[^\s\p{Punct}]+"
_SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches as (kind, start, end, value): code points, end exclusive.

    The pieces between matches and the matches themselves give the places by running lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def places(found: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
        one = lambda m, end: F.struct(F.lit(kind).alias("kind"), (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value"))
        return F.when(F.size(found) == 0, F.array().cast(_SPAN)).otherwise(F.zip_with(found, running(lengths, lambda a, b: a + b), one))

    return let(found, places)


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """The valid base matches of a text, by kind as listed and then by start."""
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    valid = {
        "email": lambda v: F.lit(True),
        "ip": lambda v: F.forall(F.split(v, r"\."), lambda x: x.cast("double") <= 255),
        "card": lambda v: F.length(digits(v)).between(13, 19) & luhn(digits(v)),
        "phone": lambda v: F.length(digits(v)).between(9, 15),
    }
    holds = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9][ -]?[0-9]"), "phone": text.rlike(r"\+[0-9]")}
    none = F.array().cast(_SPAN)
    passes = lambda k: lambda s: valid[k](s["value"])
    return F.concat(*[F.when(holds[k], F.filter(matches(text, p, i), passes(k))).otherwise(none) for i, (k, p) in enumerate(PATTERNS.items())])


def rewritten(text: Column, spans: Column, word) -> Column:
    """``text`` with word(span, end of those before it) in the place of ``spans``, which are in order of start and may overlap."""

    def pieces(x: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(x["reach"], i - 1), F.lit(0))
            return F.concat(F.array_join(F.slice(x["chars"], before + 1, F.greatest(s["start"] - before, F.lit(0))), ""), word(s, before))

        tail = F.array_join(F.slice(x["chars"], F.get(x["reach"], F.size(x["reach"]) - 1) + 1, F.size(x["chars"])), "")
        return F.concat(F.array_join(F.transform(x["spans"], piece), ""), tail)

    ends = lambda spans: running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    held = let(spans, lambda spans: F.struct(F.split(text, "").alias("chars"), spans.alias("spans"), ends(spans).alias("reach")), pieces)
    return F.when(F.size(spans) == 0, text).otherwise(held)


def masked(text: Column, spans: Column) -> Column:
    """``text`` with blanks in the place of ``spans``, which are in order of start; all other places stay."""
    return rewritten(text, spans, lambda s, before: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], before), F.lit(0))))


def _tokens(text: Column) -> Column:
    return F.split(F.lower(text), r"[\s\p{Punct}]+")


def words(text: Column) -> Column:
    """Hashes of the distinct words, in lower case."""
    return F.transform(F.array_distinct(_tokens(text)), lambda w: F.xxhash64(w))


def words_between(text: Column) -> Column:
    """(h, before, after) of each distinct word: its hash, and those of its neighbours where it first stands."""

    def placed(held: Column) -> Column:
        return F.transform(held, lambda w, i: F.struct(w.alias("h"), i.alias("i"), F.coalesce(F.get(held, i - 1), F.lit(0)).alias("before"), F.coalesce(F.get(held, i + 1), F.lit(0)).alias("after")))

    def firsts(held: Column) -> Column:
        return F.transform(F.filter(held, lambda x, i: (i == 0) | (F.get(held, i - 1)["h"] != x["h"])), lambda x: F.struct(x["h"], x["before"], x["after"]))

    value = F.transform(F.filter(_tokens(text), lambda w: w != ""), lambda w: F.xxhash64(w))
    return let(value, placed, F.sort_array, firsts)


def parts(span: Column) -> Column:
    """The protected entities of a base span: its value, and the parts of it that other values may share."""
    value = F.lower(span["value"])
    digits = F.regexp_replace(value, "[^0-9]", "")
    names = F.transform(F.filter(F.split(F.substring_index(value, "@", 1), "[._%+-]+"), lambda x: (F.length(x) >= 3) & x.rlike("[a-z]")), lambda x: F.concat(F.lit("name:"), x))
    of = {
        "email": F.concat(F.array(F.concat(F.lit("domain:"), F.substring_index(value, "@", -1))), names),
        "ip": F.array(F.concat(F.lit("network:"), F.substring_index(value, ".", 3))),
        "card": F.array(F.concat(F.lit("issuer:"), F.substring(digits, 1, 6))),
        "phone": F.array(F.concat(F.lit("exchange:"), F.substring(digits, 1, 7))),
    }
    more = F.array().cast("array<string>")
    for i, k in enumerate(PATTERNS):
        more = F.when(span["kind"] == i, of[k]).otherwise(more)
    return F.transform(F.array_distinct(F.concat(F.array(value), more)), lambda x: F.xxhash64(x, span["kind"]))


def _occurrences(texts: DataFrame) -> DataFrame:
    """t, h, start, end of each word of ``texts`` (t, text), by running lengths."""
    parts = F.arrays_zip(F.split("text", WORD, -1).alias("gap"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("word"))
    rows = texts.select("t", F.posexplode(parts).alias("i", "p")).filter(F.col("p.word").isNotNull())
    end = F.sum(F.length("p.gap") + F.length("p.word")).over(Window.partitionBy("t").orderBy("i")).cast("int")
    placed = rows.select("t", F.xxhash64(F.lower("p.word")).alias("h"), end.alias("end"), F.length("p.word").alias("n"))
    return placed.select("t", "h", (F.col("end") - F.col("n")).alias("start"), "end")


def find(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with __base and __spans (all spans: arrays of kind, start, end, value) of each row.

    A null text counts as empty and has no spans. Repeated rows are documents of their own. A text of
    any length is taken whole; the patterns are linear in it. Without rows there are none. Unless
    keep_text, ``text`` is null where a row has no base span. Columns named __rid, __base,
    __spans, __t or __terms are replaced.
    """
    own = docs.drop("__rid", "__base", "__spans", "__t", "__terms")
    t = F.coalesce(F.col(text), F.lit(""))
    found = computed_once(own, __base=base_spans(t)).withColumn("__rid", F.monotonically_increasing_id())
    if not keep_text:
        found = found.withColumn(text, F.when(F.size("__base") > 0, F.col(text)))
    found = stash(found, "pii")
    held = found.filter(F.size("__base") > 0)
    spans = held.select("__rid", F.xxhash64(text).alias("t"), F.explode("__base").alias("s")).withColumn("e", F.explode(parts(F.col("s"))))
    # one row for each entity of each distinct text, with the number of documents of that text
    once = stash(spans.groupBy("t", "e").agg(F.count_distinct("__rid").alias("copies"), F.sort_array(F.collect_set(F.struct("s.start", "s.end"))).alias("own")), "pii-entities")
    entities = once.groupBy("e").agg(F.sum("copies").alias("n_e"), F.count("*").alias("n_texts")).filter("n_texts > 1").drop("n_texts")
    recurring = once.join(entities.select("e"), "e", "left_semi")
    texts = held.select(F.xxhash64(text).alias("t"), F.col(text).alias("text"), "__base").join(recurring.select("t").distinct(), "t", "left_semi")
    texts = stash(texts.groupBy("t").agg(F.min("text").alias("text"), F.min("__base").alias("__base")), "pii-texts")
    beside = recurring.join(texts, "t").select("e", "copies", F.inline(words_between(masked(F.col("text"), F.col("own")))))
    differ = [F.min(c) < F.max(c) for c in ("before", "after")]
    counted = stash(beside.groupBy("e", "h").agg(F.sum("copies").alias("n_te"), F.count("*").alias("n_texts"), (differ[0] & differ[1]).alias("apart")), "pii-pairs")
    pairs = counted.filter("n_texts > 1 and apart").select("e", "h", "n_te")
    documents = docs.select(F.explode(words(t)).alias("h")).groupBy("h").agg(F.count("*").alias("n_t"))
    n, tested = F.log(F.lit(float(max(1, found.count())))), F.log(F.lit(float(max(1, counted.count()))))
    measured = pairs.join(entities, "e").join(documents, "h")
    own_information = n - F.log("n_e")
    disclosed = F.log("n_te") + n - F.log("n_t") - F.log("n_e")
    revealing = measured.filter((own_information > 0) & (disclosed >= THRESHOLD * own_information) & (F.col("n_te") * disclosed > tested)).select("e", "h")
    told = stash(recurring.join(revealing, "e").select("t", "h").distinct(), "pii-terms")
    ordered = F.sort_array(F.transform("__base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    places = _occurrences(texts.join(told.select("t").distinct(), "t", "left_semi").select("t", masked(F.col("text"), ordered).alias("text"))).join(told, ["t", "h"])
    term = F.struct(F.lit(len(PATTERNS)).alias("kind"), F.col("start"), F.col("end"), F.lit(None).cast("string").alias("value"))
    terms = places.groupBy("t").agg(F.sort_array(F.collect_list(term)).alias("__terms")).withColumnRenamed("t", "__t")
    joined = held.withColumn("__t", F.xxhash64(text)).join(terms, "__t", "left").withColumn("__spans", F.when(F.col("__terms").isNull(), F.col("__base")).otherwise(F.concat("__base", "__terms"))).drop("__terms", "__t")
    rest = found.filter(F.size("__base") == 0).withColumn("__spans", F.col("__base"))
    return joined.unionByName(rest).drop("__rid")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, with commas between."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a general word in the place of every span; overlapping spans become one, of the first's kind.

    A null text stays null. Columns, whatever their names, and rows are as given.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    held = docs.select(F.col(f"`{text}`").alias("text"), (F.struct(*rest) if rest else F.lit(0)).alias("row"))
    found = find(held, keep_text=True)
    ordered = F.sort_array(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    general = F.array(*[F.lit(GENERAL[k]) for k in KINDS])
    clean = rewritten(F.col("text"), ordered, lambda s, before: F.when(s["start"] >= before, F.get(general, s["kind"])).otherwise(""))
    return computed_once(found, __clean=clean).select(*[F.col("__clean").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda i: lambda s: s["kind"] == i
    counts = [F.size(F.filter("__base", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(PATTERNS)]
    terms = (F.size("__spans") - F.size("__base")).cast("long").alias("n_term")
    return found.select("doc_id", *counts, F.sha2(joined(F.col("__base")), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"), terms)
