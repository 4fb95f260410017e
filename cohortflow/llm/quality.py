"""Quality classifier: Naive Bayes support vectors.

Indicators of n-grams are scaled by their log-count ratio between the classes, then a linear
hinge-loss model is fitted to them by dual coordinate descent. The log-count ratios come from
all labelled rows; the descent runs on a sample of at most ``FIT_ROWS`` of them in one task.

The n-grams are of two kinds: words in lower case (n = 1), and word shapes (n = 1 to 3) that
keep the letter case, the signs around a word and whether it repeats the word before. A shape
that makes up a 2^-k share of a text is an indicator of its own for k = 0 to 4. All of them
are hashed into 2^17 buckets, so every table of the model has a fixed size.

Defined cases: a null or empty text has no n-grams and gets the score of the bias alone;
without labels of both classes every text scores the share of good labels (0.5 without any);
repeated rows score alike; an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import land, python_tasks
from cohortflow.llm.labels import bounded_sample, fold, logistic, training_rows

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
#: Labelled rows in the descent at most (about; drawn by hash), its passes, cost and mixing share.
FIT_ROWS, EPOCHS, COST, BETA = 6000, 30, 1.0, 0.25
SMOOTHING = 2.0
#: Words a worker remembers before it starts anew.
MEMO = 1 << 20


def _shape(word: str) -> str:
    """Case class of the letters with the signs before and after, runs of a sign cut to three."""
    core = word.strip("".join({c for c in word if not c.isalnum()}))
    at = word.find(core) if core else len(word)
    signs = (word[:at], word[at + len(core):])
    before, after = ("".join(c for i, c in enumerate(s[:8]) if s[max(0, i - 3):i] != c * 3) for s in signs)
    if not core:
        kind = ""
    elif core.isdigit():
        kind = "9"
    elif core.isupper():
        kind = "X" if len(core) > 1 else "T"
    elif core.islower():
        kind = "x"
    elif core.istitle():
        kind = "T"
    else:
        kind = "m"
    return f"{before}\x01{kind}\x01{after}"


class _Memo(dict):
    """word -> (hash of its lower case) << 32 | hash of its shape."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        lower = zlib.crc32(word.lower().encode("utf-8", "replace"))
        shape = zlib.crc32(_shape(word).encode("utf-8", "replace"))
        self[word] = out = lower << 32 | shape
        return out


_memo = _Memo()
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_TOP = np.uint64(64 - BUCKET_BITS)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x ^ np.uint64(kind)) * _M[0]
    x ^= x >> np.uint64(29)
    return ((x * _M[1]) >> _TOP).astype(np.int32)


def indicators(text: str) -> np.ndarray:
    """Distinct buckets of a text's n-grams."""
    packed = np.array([_memo[w] for w in text.split()], np.uint64)
    if not len(packed):
        return np.zeros(0, np.int32)
    words, shapes = packed >> np.uint64(32), packed & np.uint64(0xFFFFFFFF)
    same = np.zeros(len(words), np.uint64)
    same[1:] = words[1:] == words[:-1]
    shapes = shapes * np.uint64(2) + same
    found = [_bucket(np.unique(words), 1)]
    kinds, counts = np.unique(shapes, return_counts=True)
    found.append(_bucket(kinds, 2))
    for k in range(5):
        found.append(_bucket(kinds[counts * (1 << k) * 1.5 >= len(words)], 10 + k))
    two = shapes[:-1] * _M[2] + shapes[1:]
    if len(two):
        found.append(_bucket(np.unique(two), 3))
        three = two[:-1] * _M[3] + shapes[2:]
        found.append(_bucket(np.unique(three), 4))
    return np.unique(np.concatenate(found))


def class_counts(rows: DataFrame) -> DataFrame:
    """(bucket, bad, good): documents of each class that have the n-gram; bucket -1 counts documents.

    A task adds up its documents in two arrays of fixed size before anything is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((2, BUCKETS), np.int64), [0, 0]
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[y][indicators(text.as_py())] += 1
                n[y] += 1
        some = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1).astype(np.int64)), pa.array(np.append(counts[0][some], n[0])),
                                          pa.array(np.append(counts[1][some], n[1]))], ["bucket", "bad", "good"])

    return (rows.select("_text", "_y").mapInArrow(run, "bucket long, bad long, good long")
            .groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Hinge loss with an L2 norm by dual coordinate descent; the last weight is the bias.

    Rows are log-count ratios at their buckets scaled to length 1. One dual variable is solved at a
    time, in a seeded order, until no projected gradient is over 0.01.
    """
    w = np.zeros(BUCKETS + 1)
    alpha = np.zeros(len(rows))
    scaled = [unit(r, ratio) for r in rows]
    order, draw = np.arange(len(rows)), np.random.default_rng(42)
    for _ in range(epochs):
        worst = 0.0
        draw.shuffle(order)
        for i in order:
            r, x = rows[i], scaled[i]
            gradient = y[i] * (w[r] @ x + w[-1]) - 1.0
            if (alpha[i] <= 0 and gradient >= 0) or (alpha[i] >= cost and gradient <= 0):
                continue
            worst = max(worst, abs(gradient))
            new = min(cost, max(0.0, alpha[i] - gradient / (x @ x + 1.0)))
            step, alpha[i] = (new - alpha[i]) * y[i], new
            w[r] += step * x
            w[-1] += step
        if worst < 0.01:
            break
    return w


def unit(r: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    x = ratio[r]
    return x / max(1e-9, math.sqrt(x @ x))


class Model:
    """Log-count ratios and weights by bucket (the bias last) and the logistic curve."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, curve: tuple[float, float], prior: float = 0.5):
        self.ratio, self.weights, self.curve, self.prior = ratio, weights, curve, prior

    def margin(self, r: np.ndarray) -> float:
        return float(self.weights[r] @ unit(r, self.ratio)) + float(self.weights[-1])

    def score(self, text: str) -> float:
        if self.ratio is None:
            return self.prior
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * self.margin(indicators(text)) + b))))


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit to (_id, _text, _y) rows. The driver sees tables of 2^17 rows at most, never texts."""
    python_tasks(rows.sparkSession)
    counts = land(class_counts(rows), "quality_counts")
    table = counts.toPandas()
    table["bucket"] = table["bucket"].astype(int)
    known = table[table.bucket == -1]
    bad, good = (int(known[c].sum()) for c in ("bad", "good"))
    if not bad or not good:
        return Model(None, None, None, good / (good + bad) if good + bad else 0.5)
    table = table[table.bucket >= 0]
    # smoothed in proportion to the classes, so that an n-gram of neither class has ratio 0
    p, q = np.full(BUCKETS, SMOOTHING * good / (good + bad)), np.full(BUCKETS, SMOOTHING * bad / (good + bad))
    p[table.bucket] += table.good
    q[table.bucket] += table.bad
    ratio = np.log(p / good) - np.log(q / bad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        y: list[int] = []
        ids: list = []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            held += [np.frombuffer(f, np.int32) for f in batch.column(1).to_pylist()]
            y += batch.column(2).to_pylist()
        if not held:
            return
        order = sorted(range(len(held)), key=lambda i: (ids[i], y[i], len(held[i])))
        held, signs = [held[i] for i in order], np.array([y[i] for i in order]) * 2 - 1
        w = descend(held, signs, ratio)
        # between the plain Naive Bayes direction and the support vectors'
        w[:-1] = BETA * w[:-1] + (1 - BETA) * np.abs(w[:-1]).mean()
        model = Model(ratio, w, (1.0, 0.0))
        a, b = logistic(np.array([[model.margin(r)] for r in held]), signs > 0)
        some = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([some, [-1, -2]]).astype(np.int64)),
                                          pa.array(np.concatenate([w[some], [a, b]]))], ["bucket", "weight"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [indicators(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)], ["_id", "f", "_y"])

    drawn = bounded_sample(rows, good + bad, fit_rows, "quality")
    kind = drawn.schema["_id"].dataType.simpleString()
    drawn = drawn.select("_id", "_text", "_y").mapInArrow(features, f"_id {kind}, f binary, _y int")
    weights = land(drawn.repartition(1).mapInArrow(run, "bucket long, weight double"), "quality_weights").toPandas()
    w = np.zeros(BUCKETS + 1)
    plain = weights[weights.bucket >= 0]
    w[plain.bucket] = plain.weight
    curve = tuple(float(weights[weights.bucket == k].weight.sum()) for k in (-1, -2))
    return Model(ratio, w, curve if curve[0] > 0 else (2.0, 0.0))


def scorer(docs: DataFrame, model: Model):
    """A column function text -> score."""
    python_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of fixed size

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t or "") for t in text], dtype="float64")

    return lambda text: score(F.coalesce(text, F.lit("")))


HELD_OUT = (3, 1)


def _model(docs: DataFrame, labels: DataFrame) -> Model:
    folds, held = HELD_OUT
    return fit(training_rows(docs, labels, "quality", fold(F.col("doc_id"), folds) != held))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op2 over all documents."""
    score = scorer(docs, _model(docs, labels))
    held_out: Column = fold(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]
    return (docs.select("doc_id", held_out.alias("held_out"), score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, their columns unchanged."""
    score = scorer(docs, _model(docs, labels))
    return docs.where(score(F.col("text")) >= 0.5)
