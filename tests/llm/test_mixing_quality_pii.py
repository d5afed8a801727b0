import hashlib
import math
import random
import re

import pytest
from oracle import compare
from pyspark.sql import functions as F

from landtide.llm import mixing, pii, quality, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLES[name], SF)


def poisson_inverse(u, lam):
    k, p, c = 0, math.exp(-lam), math.exp(-lam)
    while c < u:
        k += 1
        p *= lam / k
        c += p
    return k


def test_counts_invert_the_distribution(spark):
    frame = spark.range(400).withColumn("rate", F.col("id") % 20 / 3).withColumn("u", mixing.uniform("t", F.col("id"))).withColumn("cdf", mixing.distribution(F.col("rate")))
    for r in frame.select("rate", "u", F.size(F.filter("cdf", lambda c: c < F.col("u"))).alias("n")).collect():
        assert r["n"] == (poisson_inverse(r["u"], r["rate"]) if r["rate"] else 0)


def test_mixing_reaches_its_weights(documents):
    docs = documents([(i, f"t{i}") for i in range(6000)])
    got = {r["source"]: r["count"] for r in mixing.mix(docs, {"s0": 3.0, "s1": 1.0}).groupBy("source").count().collect()}
    assert set(got) == {"s0", "s1"} and abs(got["s0"] / 4500 - 1) < 0.06 and abs(got["s1"] / 1500 - 1) < 0.1


def test_mixing_odd_rows(odd):
    got = mixing.mix(odd, rate=5.0)
    assert set(odd.columns) <= set(got.columns)
    rows = got.collect()
    assert all(0 <= r["copy_no"] < r["n_copies"] for r in rows) and any(r["source"] is None for r in rows)
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mix(odd, {"none": 1.0}).count() == 0


def measured(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(3)} if len(w) < 3000 else None
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), twice and len(twice) or 0


def test_ledger_measures(odd):
    for r in quality.ledger(odd).collect():
        n, chars, symbols, dup, repeats = measured(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (n, chars, symbols, dup)
        assert n >= 3000 or r["n_repeat_words"] == repeats
        assert bool(r["failure_bits"] & 1) == (n < 50)
    assert quality.ledger(odd.limit(0)).count() == 0


def test_ablation_counts_from_bits(documents):
    rows = quality.ledger(documents(["a b", "w" + " x" * 60, " ".join(f"w{i}" for i in range(60)), "$$ " * 20]))
    bits = [r["failure_bits"] for r in rows.collect()]
    mask = quality.POLICIES[2]
    for r in quality.ablation(rows, 2).collect():
        one = 1 << [n for n, _ in quality.RULES].index(r["rule"])
        assert r["n_failed"] == sum(bool(b & one) for b in bits)
        assert r["n_failed_alone"] == sum((b & mask) == one for b in bits)
        assert r["n_kept_without"] == sum((b & mask & ~one) == 0 for b in bits)


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    out = []
    for kind, p in PATTERNS:
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))) or (kind == "card" and 13 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 9 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    "mail a.b@c.de, x@y.z.w_q@r.s and é@é", "a@b.cd_x@y.org+1 (487) 555-7209 end", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 10.0.0.255", "4111 1111 1111 1111 and 4111-1111-1111-1112 4736962573099581", "+1 (487) 555-7209. +12 3 +123456789012345678",
    "9" * 30_000, "a" * 30_000 + "@x.yz", "", None, "ü +49 (30) 123-4567 4111111111111111 q@w.er é 1.1.1.1",
]


def test_base_spans(documents):
    got = {r["doc_id"]: r["s"] for r in pii.find(documents(TEXTS)).select("doc_id", pii.joined(F.col("__base")).alias("s")).collect()}
    assert got == {i: base(t or "") for i, t in enumerate(TEXTS)}


def test_terms_that_reveal_an_entity_are_found_and_replaced(documents):
    filler = [(100 + i, f"common words here and there number{i} follow the rest of the text") for i in range(300)]
    rows = [(1, "common words here Zorblax zorblax@corp.example and there follow"), (2, "the rest Zorblax zorblax@corp.example of text and there"), (3, "unique Quuxly single@corp.example words and the rest")]
    docs = documents(rows + filler)
    got = {r["doc_id"]: r["s"] for r in pii.find(docs).select("doc_id", pii.joined(F.col("__spans")).alias("s")).collect()}
    at = rows[0][1].index("Zorblax")
    assert f"term:{at}:{at + 7}" in got[1] and "term" in got[2] and "term" not in got[3]
    assert all(not got[i] for i, _ in filler)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "[TERM]" in clean[1] and "Zorblax" not in clean[1] and "[EMAIL]" in clean[1] and clean[100] == filler[0][1]


def test_terms_far_from_their_entity_are_found_everywhere(documents):
    filler = [(100 + i, f"common words here and there number{i} follow the rest of the text") for i in range(300)]
    far = " ".join("common words here and there follow the rest of the text".split() * 8)
    rows = [(1, f"Dear Zorblax, {far} call +1 (487) 555-7209. éZ ZORBLAX"), (2, f"+1 (487) 555-7209 {far} of zorblax"), (3, f"+1 (487) 555-7209 {far} of zorblax"), (4, "Zorblax alone")]
    got = {r["doc_id"]: r["s"].split(",") for r in pii.find(documents(rows + filler)).select("doc_id", pii.joined(F.col("__spans")).alias("s")).collect()}
    assert got[4] == [""] and len(got) == 304
    for i, t in rows[:3]:
        assert [x for x in got[i] if x.startswith("term")] == [f"term:{m.start()}:{m.end()}" for m in re.finditer("zorblax", t.lower())]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(documents(rows + filler)).collect()}
    assert all("zorblax" not in clean[i].lower() and "[PHONE]" in clean[i] for i in (1, 2, 3)) and clean[1].startswith("Dear [TERM], common")


def test_long_runs_of_every_pattern(documents):
    texts = ["a@b" + ".c" * 300_000, "1." * 40_000, "7 " * 200_000, "+1" * 100_000, "+1((((((" * 30_000 + "x", "a@b.c " * 10_000, "9" * 1_000_000]
    got = {r["doc_id"]: r["s"] for r in pii.find(documents(texts)).select("doc_id", pii.joined(F.col("__base")).alias("s")).collect()}
    wanted = {0: "email:0:600003", 1: ",".join(f"ip:{8 * i}:{8 * i + 7}" for i in range(10_000)), 5: ",".join(f"email:{6 * i}:{6 * i + 5}" for i in range(10_000))}
    assert got == {i: wanted.get(i, "") for i in range(len(texts))}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(documents(texts)).collect()}
    assert clean[0] == "[EMAIL]" and clean[5] == "[EMAIL] " * 10_000 and clean[1].count("[IP]") == 10_000


def test_terms_by_brute_force(documents):
    rng = random.Random(3)
    common = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(common) for _ in range(30)) for _ in range(400)]
    for k in range(6):  # a firm's name beside its own domain, in texts that have nothing else in common
        at = rng.randint(2, 20)
        words = texts[k].split()
        texts[k] = " ".join([*words[:at], "Zorblax", *words[at:], f"u{k}.x@firm.example"])
    copy = " ".join(f"rare{i}" for i in range(30)) + " a.b@copied.example"
    texts += [copy + " one", copy + " two"]  # words of one passage only tell the passage
    got = {r["doc_id"]: r["s"] for r in pii.find(documents(texts)).select("doc_id", pii.joined(F.col("__spans")).alias("s")).collect()}
    found = {i: [t for t in s.split(",") if t.startswith("term")] for i, s in got.items()}
    assert {i for i, t in found.items() if t} == set(range(6))
    assert all([texts[i][int(t.split(":")[1]) : int(t.split(":")[2])] for t in found[i]] == ["Zorblax"] for i in range(6))


def test_columns_with_the_names_in_use_come_back(documents):
    docs = documents(["mail a@b.cd now", None])
    for name in ("__rid", "__base", "__spans", "__t", "__terms", "__clean", "row"):
        docs = docs.withColumn(name, F.lit(name))
    got = pii.sanitise(docs)
    assert got.columns == docs.columns and {r["text"] for r in got.collect()} == {"mail [EMAIL] now", None}
    assert all(r["__rid"] == "__rid" and r["row"] == "row" for r in got.collect())


def test_odd_rows_are_sanitised(odd):
    got = pii.sanitise(odd)
    assert got.columns == odd.columns and sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert pii.sanitise(odd.limit(0)).count() == 0


def test_op9_digest(spark):
    for r in queries.QUERIES["op9_information_pii"](spark, SF).collect():
        kept = ",".join(s for s in r["spans"].split(",") if not s.startswith("term"))
        assert r["base_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
