"""Toxicity by maximum-scoring segments.

Words and word beginnings get log-odds between toxic and other labelled documents, with Dirichlet
priors whose mass follows their frequency in the whole corpus; a feature counts by the lower bound
of its log-odds, and a word by its best feature. All other words score -DRIFT. A linear scan finds
all maximal-scoring segments of a text (Ruzzo and Tompa 1999); a segment's score is turned into an
expected number of chance segments E = K n exp(-lambda S) (Karlin and Altschul 1990), those with
E < 1 add -ln E, and a logistic curve over that sum, fitted on labelled rows that the log-odds did
not see, gives the score.

Labels are a sample of at most about TRAIN_ROWS rows chosen by hash, and of their features at most the
MOST_FEATURES of highest log-odds between the labels are kept; counts over the corpus and scores cover
every document and every word. So what the driver holds and broadcasts doesn't grow with the input.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stash, table

TRAIN_ROWS, MOST_FEATURES = 200_000, 50_000
DRIFT, PRIOR, LEAST_DOCUMENTS, PREFIXES, K = 0.05, 0.5, 2, (4, 5, 6, 7), 0.1
_FLUSH, _MEMO = 300_000, 400_000
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„…¿¡"


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def features(chunk: str) -> list[str]:
    """Of a lower-case chunk: its word, and the word's beginnings that are shorter."""
    word = chunk.strip(_MARKS)
    return [f"{word}$", *(word[:n] for n in PREFIXES if len(word) > n)] if word else []


def _counts(pick):
    """Counts, over (key, text) rows, in how many texts each distinct word of a feature occurs.

    pick: (key, feature) to the numbers of the columns that the row's counts go to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of, wanted, width = pick()
        chunks: list[Counter] = [Counter() for _ in range(width)]
        totals: list[Counter] = [Counter() for _ in range(width)]

        def flush() -> None:
            for own, total in zip(chunks, totals, strict=True):
                for chunk, n in own.items():
                    for f in features(chunk):
                        if wanted is None or f in wanted:
                            total[f] += n
                own.clear()

        for batch in batches:
            for where, text in zip(rows_of(batch.column(0)), batch.column(1), strict=True):
                if where:
                    own = text.as_py().lower().split()
                    distinct = set(own)
                    for k in where:
                        chunks[k].update(distinct)
                        totals[k][""] += len(own)
            if sum(map(len, chunks)) > _FLUSH:
                flush()
        flush()
        names = list(set().union(*totals))
        for lo in range(0, len(names), 50_000):
            part = names[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *[pa.array([t.get(f, 0) for f in part], pa.int64()) for t in totals]], ["feature", *[f"c{k}" for k in range(width)]])

    return run


def _sample(labels: DataFrame, key: str, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, labels and folds of the rows to learn from. Labels or keys that are null are passed over; a key with several labels is toxic if one of them is."""
    rows = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(F.col(key)) != 0)).groupBy(F.col(key).cast("long").alias("k")).agg(F.max(F.col(label).cast("int")).alias("y"))
    n = rows.count()
    if n > TRAIN_ROWS:
        rows = rows.filter(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < F.lit(int((1 << 30) * TRAIN_ROWS / n)))
    got = rows.select("k", "y", fold(F.col("k")).cast("int").alias("f")).toPandas().sort_values("k")
    return got["k"].to_numpy("i8"), got["y"].to_numpy("i1"), got["f"].to_numpy("i1")


def weights(toxic: np.ndarray, clean: np.ndarray, corpus: np.ndarray, sums: tuple[int, int, int]) -> np.ndarray:
    """Lower bounds of the log-odds of features, from counts and the total counts of the three collections.

    A collection's prior mass is PRIOR times its own size, spread by the corpus, so a feature that
    neither collection has is neutral.
    """
    n_toxic, n_clean, n_all = (max(1, s) for s in sums)
    share = (corpus + 0.5) / (n_all + 1)
    a, b = toxic + PRIOR * n_toxic * share, clean + PRIOR * n_clean * share
    odds = np.log(a / np.maximum((1 + PRIOR) * n_toxic - a, 0.5)) - np.log(b / np.maximum((1 + PRIOR) * n_clean - b, 0.5))
    return odds - 1.64 * np.sqrt(1 / a + 1 / b)


def _odds(n_toxic: int, n_clean: int) -> Column:
    """The same lower bound over rows of toxic and clean counts, the prior being spread by both together."""
    share = (F.col("toxic") + F.col("clean") + 0.5) / (n_toxic + n_clean + 1)
    a, b = F.col("toxic") + PRIOR * n_toxic * share, F.col("clean") + PRIOR * n_clean * share
    odds = F.log(a / F.greatest((1 + PRIOR) * n_toxic - a, F.lit(0.5))) - F.log(b / F.greatest((1 + PRIOR) * n_clean - b, F.lit(0.5)))
    return odds - 1.64 * F.sqrt(1 / a + 1 / b)


def decay(rates: np.ndarray, scores: np.ndarray) -> float:
    """lambda > 0 with sum(rate * exp(lambda * score)) = 1 when all other words score -DRIFT."""
    if not len(scores):
        return 1.0
    rest = max(1e-9, 1 - rates.sum())
    total = lambda x: float((rates * np.exp(np.minimum(x * scores, 600))).sum() + rest * math.exp(-x * DRIFT)) - 1
    low, high = 0.0, 1.0
    while total(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 0 else (low, mid)
    return max(high, 0.05)


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments, (score, first, end), by one scan."""
    hits = np.flatnonzero(scores > 0)
    if not len(hits):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []  # [sum before, sum after, first, end]
    for i in hits.tolist():
        new = [float(sums[i]), float(sums[i + 1]), i, i + 1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= new[0]:
                j -= 1
            if j < 0 or stack[j][1] >= new[1]:
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
    return [(r - left, a, b) for left, r, a, b in stack]


class _Scores(dict):
    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, chunk: str) -> float:
        score = max((self.known.get(f, -DRIFT) for f in features(chunk)), default=-DRIFT)
        if len(self) > _MEMO:
            self.clear()
        self[chunk] = score
        return score


def evidence(docs: DataFrame, known: dict[str, float], lam: float, key: str, text: str) -> DataFrame:
    """doc_id, evidence (the sum of -ln E), n_segments that are significant, and those as (first word, end word, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Scores(known)
        for batch in batches:
            sums, found = [], []
            for t in batch.column(1):
                words = t.as_py().lower().split()
                scores = np.fromiter(map(memo.__getitem__, words), "f8", len(words))
                kept = [(s, a, b, lam * s - math.log(K * len(words))) for s, a, b in maximal_segments(scores)]
                kept = [x for x in kept if x[3] > 0]
                sums.append(sum(x[3] for x in kept))
                found.append([{"first": a, "end": b, "score": s} for s, a, b, _ in kept])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.float64()), pa.array(found, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))], ["doc_id", "evidence", "segments"])

    src = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return src.mapInArrow(run, "doc_id long, evidence double, segments array<struct<first:int,end:int,score:double>>")


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, by Newton steps with a weak prior."""
    a, b = 0.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(y - p).sum() - 0.1 * a, ((y - p) * x).sum() - 0.1 * (b - 1)])
        w = p * (1 - p)
        h = np.array([[w.sum() + 0.1, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.1]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), max(0.05, float(b))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted, evidence and segments of each row of ``docs``.

    A null text counts as empty: it has no evidence and the score of a text without any. A text of any
    length is read whole. Repeated rows each give a row. Without labels the curve stays at its default. Only ``key`` and ``text``
    are read of ``docs``; no input of a score but the text.
    """
    spark = docs.sparkSession
    keys, toxic, folds = _sample(labels, key, label)
    fit = folds != 4 if toxic[folds == 4].sum() >= 20 else np.ones(len(keys), bool)
    src = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    known: dict[str, float] = {}
    lam = 1.0
    if (toxic[fit] == 1).any():
        ids = spark.createDataFrame([(int(k), int(y)) for k, y in zip(keys[fit], toxic[fit], strict=True)], "k long, y int")
        by_label = lambda: (lambda c: [(y,) for y in c.to_pylist()], None, 2)
        first = src.join(F.broadcast(ids), "k").select("y", "t").mapInArrow(_counts(by_label), "feature string, c0 long, c1 long")
        labelled = stash(first.groupBy("feature").agg(F.sum("c0").alias("clean"), F.sum("c1").alias("toxic")), "features")
        sums = labelled.filter("feature = ''").select("toxic", "clean").first() or (0, 0)
        chosen = labelled.filter((F.col("feature") != "") & (F.col("toxic") >= LEAST_DOCUMENTS)).withColumn("w", _odds(max(1, sums[0]), max(1, sums[1])))
        best = chosen.orderBy(F.desc("w"), "feature").limit(MOST_FEATURES).select("feature", "toxic", "clean").toPandas().sort_values("feature")
        shared = spark.sparkContext.broadcast(frozenset(best["feature"]))
        whole = lambda: (lambda c: [(0,)] * len(c), shared.value, 1)
        counted = src.mapInArrow(_counts(whole), "feature string, c0 long").groupBy("feature").agg(F.sum("c0").alias("n")).toPandas()
        shared.unpersist()
        corpus = dict(zip(counted["feature"], counted["n"].tolist(), strict=True))
        order = best["feature"].tolist()
        t, c, n = best["toxic"].to_numpy("f8"), best["clean"].to_numpy("f8"), np.array([corpus.get(f, 0) for f in order], "f8")
        w = weights(t, c, n, (sums[0], sums[1], corpus.get("", 0)))
        good = w > 0.5
        known = {f: float(x) for f, x, ok in zip(order, w, good, strict=True) if ok}
        lam = decay((c[good] + 0.5) / max(1, sums[1]), w[good])
    out = stash(evidence(docs, known, lam, key, text), "toxicity")
    used = ~fit if (~fit).any() else fit
    a, b = -3.0, 1.0
    if used.any() and len(set(toxic[used].tolist())) == 2:
        rows = spark.createDataFrame([(int(k), int(y)) for k, y in zip(keys[used], toxic[used], strict=True)], "doc_id long, y int")
        got = out.select("doc_id", "evidence").join(F.broadcast(rows), "doc_id").select("evidence", "y").toPandas()
        if len(got):
            a, b = logistic(np.minimum(got["evidence"].to_numpy("f8"), 50), got["y"].to_numpy("f8"))
    value = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.least(F.col("evidence"), F.lit(50.0)))))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), value.alias("score"), (value >= 0.5).cast("int").alias("predicted"), "evidence", "segments")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    out = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "evidence", F.size("segments").alias("n_segments"))
