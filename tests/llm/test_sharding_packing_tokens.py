import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landtide.llm import dac, packing, queries, sharding, tokens
from landtide.llm.shared import new_path

SF = "/root/testdata/sf0.001"
FRESH: dict = {}


def brute(sizes, shards):
    best = None
    for cuts in itertools.combinations(range(1, len(sizes)), min(shards, len(sizes)) - 1):
        edges = [0, *cuts, len(sizes)]
        worst = max(sum(sizes[a:b]) for a, b in itertools.pairwise(edges))
        best = worst if best is None else min(best, worst)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=9), st.integers(1, 5))
def test_minimax_is_the_least_possible(sizes, shards):
    ends, capacity = sharding.minimax_cuts(np.array(sizes), shards)
    assert capacity == brute(sizes, shards) and ends[-1] == len(sizes) and len(ends) <= shards
    edges = [0, *ends]
    assert max(sum(sizes[a:b]) for a, b in itertools.pairwise(edges)) <= capacity


def test_shards(documents):
    rows = [(i, f"text {i % 150} " + "x" * (i * 37 % 90)) for i in range(600)] + [(1000 + i, "hot " * 200) for i in range(100)]
    src = documents(rows).select("doc_id", F.octet_length("text").cast("long").alias("size"), F.xxhash64("text").alias("h"), "text")
    got = sharding.shard(src, 8, F.col("h"), F.col("size")).collect()
    assert len(got) == 700 and len({(r["doc_id"]) for r in got}) == 700
    by, texts = defaultdict(list), defaultdict(set)
    for r in got:
        by[r["shard"]].append(r)
        texts[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for s in texts.values())
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    loads = sorted(sum(r["size"] for r in v) for v in by.values())
    assert len(by) == 8 and loads[-2] < 1.3 * loads[0]


def test_odd_rows_are_sharded(odd):
    got = sharding.shard(odd, 3, F.coalesce("text", F.lit("")), F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 16)
    assert got.count() == 10
    assert sharding.shard(odd.limit(0), 3, F.col("text"), F.lit(1).cast("long")).count() == 0


ENDED = {"byte_bpe_50k.json": [31373, 220, 50256, 995], "word_bpe_49k.json": [3306, 49407, 1002]}
WEIRD = ["a<|endoftext|>b", "<|ENDOFTEXT|> and <|startoftext|>\n<|endoftext|>.", "<|startoftext|> <|STARTOFTEXT|>", "<|endoftext|", "", " ", "  ", "a  b", "a   b", " a", "a ", "\n\na \n b\n", "x\ty  z", "don't can't'll 's", "É é İSTANBUL ΣΑΣ", "<|endoftext|> x", "foo.\nBar baz.\n\nQux", "a b   c", "\x1c\x1d a\x1fb", "123 4.5e6 a1b2 \U0001f600", "\r\n x\r\ny", "日本語 テキスト。", "!!!\nabc", "abc\n", "a\n\t\tb", "a \nb c", "x" * 5000]


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_memoised_ids_are_those_of_the_library(name, spaced):
    e = tokens.Encoder(tokens.vocabulary(name), spaced)
    fresh = Tokenizer.from_file(tokens.vocabulary(name))
    wanted = [np.array(x.ids, "<u4").tobytes() for x in fresh.encode_batch(WEIRD * 2, add_special_tokens=False)]
    assert e.encode_many(WEIRD * 2) == wanted
    assert e.encode_many(["hello <|endoftext|> world"]) == [np.array(ENDED[name], "<u4").tobytes()]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB é.,'\n\t  1!x", max_size=30))
def test_memoised_ids_of_any_text(text):
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        fresh = FRESH.setdefault(name, Tokenizer.from_file(tokens.vocabulary(name)))
        assert tokens.encoder(tokens.vocabulary(name), spaced).encode_many([text]) == [np.array(fresh.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "\n", "a", "B.", "'s"]), max_size=12))
def test_added_tokens_anywhere(parts):
    test_memoised_ids_of_any_text.hypothesis.inner_test("".join(parts))


def by_library(name, text):
    return np.array(FRESH.setdefault(name, Tokenizer.from_file(tokens.vocabulary(name))).encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_memo_that_starts_anew(name, spaced, monkeypatch):
    """Slices with and without added tokens, in any case, while the memo is emptied again and again."""
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 20)
    path, rng = tokens.vocabulary(name), np.random.default_rng(5)
    library, e = Tokenizer.from_file(path), tokens.Encoder(path, spaced)
    bits = ["<|endoftext|>", "<|EndOfText|>", "<|", "Hello", " ", " ", "\n", "world.", "İstanbul", "a,b", "!!!", "12", "naïve"]
    for turn in range(60):
        texts = ["".join(rng.choice(bits[3 * (turn % 2) :], 8)) for _ in range(10)]
        assert e.encode_many(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_op8_of_every_document(spark):
    """The registered query, against a fresh tokenizer on whole texts."""
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_addressable_codes"](spark, SF).collect()}
    at = 0
    for d, t in rows:
        ids = np.append(by_library("word_bpe_49k.json", t), np.uint32(1)).astype("<u4")
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(rows)


def test_op2_of_every_document(spark):
    """The registered query: pieces are the documents' ids by a fresh tokenizer, sequences have no gaps and little padding."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op2_dp_packing"](spark, SF).collect():
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(docs) == set(texts)
    for d, rows in docs.items():
        ids, at = np.append(by_library("byte_bpe_50k.json", texts[d]), np.uint32(0)).astype("<u4"), 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padded = used = 0
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
        used, padded = used + at, padded + (0 if at & (at - 1) == 0 else 1024 - at)
    assert padded < 0.05 * used


def test_op1_of_every_document(spark):
    """The registered query: sizes, checksums, whole groups, gapless slots and shards of near equal bytes."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows, home, slots, sizes = queries.QUERIES["op1_minimax_sharding"](spark, SF).collect(), {}, defaultdict(list), Counter()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        assert home.setdefault(raw, r["shard"]) == r["shard"] and 0 <= r["shard"] < 40
        slots[r["shard"]].append(r["slot"])
        sizes[raw] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    loads = Counter()
    for raw, n in sizes.items():
        loads[home[raw]] += n
    assert max(loads.values()) <= max(max(sizes.values()), 1.35 * sum(sizes.values()) / 40)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1200))
def test_codes_give_back_every_token(ids):
    seg = dac.Segment(dac.encode_segment(np.array([1]), np.array([True]), np.array([len(ids)]), np.array(ids, "<u4")))
    assert seg.ids().tolist() == ids
    assert [seg.token(i) for i in range(0, len(ids), 7)] == ids[::7]


def test_token_files(spark, odd):
    folder = new_path(spark, "t")
    manifest = dac.write_token_files(odd, folder, tokens.vocabulary("word_bpe_49k.json"), False, 1)
    got = dac.read_token_files(spark, manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda k: (k is not None, k or 0)) and len(got) == 10
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"] and r["ids"][-4:] == b"\x01\0\0\0"
        at += r["n_tokens"]
    assert dac.read_token_files(spark, dac.write_token_files(odd.limit(0), new_path(spark, "t"), tokens.vocabulary("word_bpe_49k.json"), False, 1)).count() == 0


def cost(pos, pen, ends, limit):
    total, at = 0.0, 0
    for j in ends:
        n = pos[j] - pos[at]
        assert 0 < n <= limit
        total += (0 if n & (n - 1) == 0 and n >= packing.LEAST_POWER else limit - n) + pen[j] + packing.SEQUENCE_COST
        at = j
    return total


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 400), st.sampled_from([0.0, 2.0, 24.0])), min_size=1, max_size=10))
def test_cuts_cost_least(steps):
    limit = 1024
    pos = np.cumsum([0, *[s for s, _ in steps]])
    pen = np.array([0.0, *[p for _, p in steps]])
    got = cost(pos.tolist(), pen.tolist(), packing.best_cuts(pos, pen, limit), limit)
    best = np.inf
    inner = range(1, len(pos) - 1)
    for k in range(len(inner) + 1):
        for cuts in itertools.combinations(inner, k):
            ends = [*cuts, len(pos) - 1]
            if all(pos[b] - pos[a] <= limit for a, b in itertools.pairwise([0, *ends])):
                best = min(best, cost(pos.tolist(), pen.tolist(), ends, limit))
    assert abs(got - best) < 1e-9


def test_packing_places_every_token_once(odd):
    got = packing.pack(odd).collect()
    e = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"), True)
    wanted = Counter((r["doc_id"], zlib.crc32(e.encode_many([r["text"] or ""])[0] + b"\0\0\0\0")) for r in odd.collect())
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and r["start"] + r["length"] <= r["doc_tokens"]
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    for key, rows in docs.items():
        whole = sum(r["length"] for r in rows)
        assert whole == sum(rows[0]["doc_tokens"] * n for (k, _), n in wanted.items() if k == key)
    one = sorted(docs[7], key=lambda r: r["start"])
    assert (7, zlib.crc32(b"".join(r["ids"] for r in one))) in wanted
    assert packing.pack(odd.limit(0)).count() == 0
