"""Toxicity after noisy-channel restoration.

1. A character 4-gram model is counted over the words of all documents.
2. Disguised words and spans (imitated letters, letters set apart, repeats) are restored by
   Viterbi search over their lattices; see ``deobfuscate``. Every text is restored once: its
   distinct restored words are landed, and counts, cover and scores read those.
3. The restored words and their prefixes of 4 to 7 letters are counted by label over all
   labelled training documents. All that are toxic almost surely are kept, in a table; over a
   bounded sample, a greedy cover adds likely ones that explain toxic documents not explained yet.
4. A text's evidence is the log-odds of the kept words it contains, the surest one apart; a
   logistic curve over the sample turns it into a score. Texts give the words that pass a filter
   of fixed size; a join with the table finds the kept ones.

Defined cases: a null or empty text has no words and scores the curve without evidence; without
toxic labels every text scores the smoothed rate of toxic ones; repeated rows score alike; words of any length are read whole; an empty table gives an empty result; extra columns
are never read.
"""

from __future__ import annotations

import gc
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import FILTER_BITS, bit_filter, land, python_tasks
from cohortflow.llm.deobfuscate import ORDER, SIZE, Numbers, Restorer, count_grams, language_model, pairs
from cohortflow.llm.labels import bounded_sample, fold, logistic, training_rows

#: Prefix lengths that stand for a word family.
PREFIXES = (4, 5, 6, 7)
#: Bound of the fit: sampled documents of the cover (about, each label).
COVER_ROWS = 20_000
#: A candidate occurs in this many toxic documents; widths of the rate's lower bound for words
#: kept at once and for words of the cover.
MIN_TOXIC, Z_SURE, Z_COVER = 2, 3.0, 1.64
#: Toxic documents that a clean one outweighs in the cover.
CLEAN = 4
#: Features a worker holds before it passes their counts on, and words it remembers.
FLUSH, MEMO = 400_000, 1 << 18


def features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of restored texts, and for each the place of its text."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    words = lists.flatten()
    some = np.asarray(pc.binary_length(words)) > 0
    return np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))[some], words.filter(pa.array(some))


#: What a byte changes in a CRC; strings of more bytes are left to zlib.
_CRC = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)
_CRC_BYTES = 64


def crc32(strings: pa.Array, end: bytes = b"", stops: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """The CRC of each string's bytes and those of ``end``; into ``stops`` those of its first so many bytes, if it is longer, and "*"."""
    strings = strings.cast(pa.large_string())
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
    sizes, stops = np.diff(bounds), stops or {}
    out = np.full(len(strings), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = bounds[:-1][order], sizes[order]
    crc = out[order]
    for k in range(min(_CRC_BYTES, int(sizes.max(initial=0)))):
        n = np.searchsorted(-sizes, -k)  # those that are longer
        if k in stops:
            stops[k][order[:n]] = ~_crc_on(crc[:n], ord("*"))
        crc[:n] = _crc_on(crc[:n], data[begin[:n] + k])
    for i in range(np.searchsorted(-sizes, -_CRC_BYTES)):
        crc[i] = zlib.crc32(data[begin[i]:begin[i] + sizes[i]].tobytes()) ^ 0xFFFFFFFF
    out[order] = crc
    for b in end:
        out = _crc_on(out, b)
    return ~out


def _crc_on(crc: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _CRC[(crc & np.uint32(0xFF)).astype(np.uint8) ^ np.uint8(byte)] ^ (crc >> np.uint32(8))


class Sieve:
    """Lets every feature of a table pass, and others as often as their bits are taken."""

    def __init__(self, table: DataFrame):
        hashed = table.select(F.shiftleft(F.crc32(F.col("feature").cast("binary")), 32).alias("_h"))
        self.bits = bit_filter(hashed, "_h")

    def passes(self, words: pa.Array) -> np.ndarray:
        """Of each word, whether the word passes, and whether each of its prefixes does."""
        out = np.zeros((len(words), 1 + len(PREFIXES)), bool)
        sizes = np.asarray(pc.utf8_length(words))
        ascii_ = sizes == np.asarray(pc.binary_length(words))
        ends = {k: np.zeros(len(words), np.uint32) for k in PREFIXES}
        out[:, 0] = self._of(crc32(words, stops=ends))
        for i, k in enumerate(PREFIXES, 1):
            out[:, i] = self._of(ends[k]) & ascii_ & (sizes > k)
            long = np.flatnonzero(~ascii_ & (sizes > k))
            out[long, i] = self._of(crc32(pc.utf8_slice_codeunits(words.take(pa.array(long)), 0, k), b"*"))
        return out

    def _of(self, crc: np.ndarray) -> np.ndarray:
        at = crc >> np.uint32(32 - FILTER_BITS)
        return (self.bits[at >> np.uint32(3)] >> (np.uint8(7) - (at & np.uint32(7)).astype(np.uint8)) & 1).astype(bool)


@contextmanager
def uncollected() -> Iterator[None]:
    """Without the search for cycles, of which there are none, among the many remembered words."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def restored(texts: DataFrame, text_col: str, prices: np.ndarray) -> DataFrame:
    """The texts replaced by their distinct restored words, parted by spaces."""
    python_tasks(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(prices)  # 27^4 numbers
    others = [c for c in texts.columns if c != text_col]
    kinds = "".join(f"`{c}` {texts.schema[c].dataType.simpleString()}, " for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value, MEMO)
        for batch in batches:
            with uncollected():
                out = restorer.restored(batch.column(len(others)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], [*others, text_col])

    return texts.select(*others, text_col).mapInArrow(run, f"{kinds}`{text_col}` string")


def gram_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """Character 4-grams of all documents, summed in tasks, then by gram: 27^4 numbers at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE ** ORDER, np.int64)
        for batch in batches:
            count_grams(" ".join(batch.column(0).to_pylist()), counts)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["gram", "n"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    table = (texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))).toPandas()
    out = np.zeros(SIZE ** ORDER, np.int64)
    out[table.gram.astype(int)] = table.n
    return out


def document_counts(rows: DataFrame, sieve: Sieve | None = None) -> DataFrame:
    """(feature, n): restored texts of ``rows`` that contain the feature, of those that pass the sieve."""
    shared = rows.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = Numbers(), np.zeros(0, np.int64)
        for batch in batches:
            owner, read = split_words(batch.column(0))
            read = read.dictionary_encode()
            passes = np.ones((len(read.dictionary), 1 + len(PREFIXES)), bool)
            if shared.value is not None:
                passes = shared.value.passes(read.dictionary)
            held = []
            for i, k in enumerate((None, *PREFIXES)):  # the words that have such a feature, and the features' numbers
                some, found = read.dictionary, np.flatnonzero(passes[:, i])
                if k:
                    found = found[np.asarray(pc.utf8_length(some))[found] > k]
                some = some.take(pa.array(found))
                if k:
                    some = pc.binary_join_element_wise(pc.utf8_slice_codeunits(some, 0, k), "*", "")
                some = some.dictionary_encode()
                number = np.full(len(read.dictionary), -1, np.int64)
                number[found] = names.of(some.dictionary.to_pylist())[0][np.asarray(some.indices)]
                number = number[np.asarray(read.indices)]
                held.append((owner[number >= 0], number[number >= 0]))
            _, found = pairs(*map(np.concatenate, zip(*held)), len(names.names))  # each feature once a text
            counts = np.pad(counts, (0, len(names.names) - len(counts))) + np.bincount(found, minlength=len(names.names))
            if len(counts) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(names.names), pa.array(counts)], ["feature", "n"])
                names, counts = Numbers(), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names.names, pa.string()), pa.array(counts)], ["feature", "n"])

    return rows.select("_text").mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def label_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): restored training documents of each label, for features of ``MIN_TOXIC`` toxic ones and more.

    Others are no candidates however many clean documents hold them, so of clean documents only
    what passes the sieve of these is counted.
    """
    toxic = land(document_counts(rows.where("_y = 1")).where(F.col("n") >= MIN_TOXIC).withColumnRenamed("n", "toxic"), "toxic_features")
    clean = document_counts(rows.where("_y = 0"), Sieve(toxic)).withColumnRenamed("n", "clean")
    return toxic.join(clean, "feature", "left").na.fill(0, ["clean"])


def lower_rate(toxic: float, n: float, z: float) -> float:
    """Wilson's lower bound of a rate."""
    if not n:
        return 0.0
    p = toxic / n
    return max(0.0, (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n))


def gain(toxic: float, n: float, z: float) -> float:
    return toxic - CLEAN * (n - toxic) if lower_rate(toxic, n, z) > 0.5 else 0.0


def cover(docs: list[tuple[int, list[str]]], weight: tuple[float, float]) -> dict[str, float]:
    """Greedy cover: again and again the feature that explains most toxic documents not explained yet.

    A feature counts by what it adds: its rate is that of toxic documents among those that hold it
    and no feature kept before (``weight`` undoes the sampling of clean and toxic ones), and its
    lower bound must pass one half. A clean document weighs ``CLEAN`` toxic ones, so that a precise
    word goes before a family that also has innocent members. Rates only fall as documents are
    explained, so a feature that fails is done with.
    """
    holds: tuple[dict[str, set[int]], dict[str, set[int]]] = ({}, {})
    for i, (y, found) in enumerate(docs):
        for f in found:
            holds[y].setdefault(f, set()).add(i)
    clean, toxic = holds
    kept: dict[str, float] = {}

    def counts(f: str) -> tuple[float, float]:
        t = len(toxic[f]) * weight[1]
        return t, t + len(clean.get(f, ())) * weight[0]

    while True:
        toxic = {f: held for f, held in toxic.items() if len(held) >= MIN_TOXIC and gain(*counts(f), Z_COVER) > 0}
        if not toxic:
            return kept
        best = max(toxic, key=lambda f: (gain(*counts(f), Z_COVER), -len(f), f))  # of equals the wider, then by name
        t, n = counts(best)
        kept[best] = (t + 0.1) / (n + 1)
        for side in (toxic, clean):
            done = set(side.get(best, ()))
            for i in done:
                for f in docs[i][1]:
                    if f in side:
                        side[f].discard(i)


def evidence(groups: set[str], kept: dict[str, float]) -> tuple[float, float]:
    """The largest log-odds among a text's words, and the logarithm of one plus the others' sum.

    A word counts with the surest of its kept features. The largest stands apart, so that one sure
    word is enough and many doubtful ones in a long text are not.
    """
    odds = []
    for group in {" ".join(f for f in g.split(" ") if f in kept) for g in groups} - {""}:
        rate = max(kept[f] for f in group.split(" "))
        odds.append(max(0.0, math.log(rate / (1 - rate))))
    top = max(odds, default=0.0)
    return top, math.log1p(sum(odds) - top)


class Model(NamedTuple):
    """Prices of the restoration, the landed table (feature, rate) of kept ones, and the curve over
    the evidence (a coefficient each, the offset last)."""

    prices: np.ndarray
    kept: DataFrame | None
    curve: tuple[float, float, float]


def wilson(z: float) -> Column:
    """Whether the full counts pass ``gain`` at a width ``z``."""
    t, n = F.col("toxic").cast("double"), F.col("n").cast("double")
    p = t / n
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return (low > 0.5) & (t - CLEAN * (n - t) > 0)


def hits(texts: DataFrame, text_col: str, table: DataFrame) -> DataFrame:
    """The other columns and ``found`` of restored texts: for each word its features that pass the table's filter, in one string."""
    shared = texts.sparkSession.sparkContext.broadcast(Sieve(table))  # 2 MB of bits
    others = [c for c in texts.columns if c != text_col]
    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, words = split_words(batch.column(len(others)))
            passes = shared.value.passes(words)
            some = np.flatnonzero(passes.any(axis=1))
            found: list = [set() for _ in range(batch.num_rows)]
            for text, word, pass_ in zip(owner[some].tolist(), words.take(pa.array(some)).to_pylist(), passes[some].tolist()):
                found[text].add(" ".join(compress(features(word), pass_)))
            found = list(map(sorted, found))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.string()))], [*others, "found"])

    return texts.select(*others, text_col).mapInArrow(run, f"{kinds}, found array<string>")


def character_prices(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Prices of the character model of all texts."""
    python_tasks(docs.sparkSession)
    return language_model(gram_counts(docs, text_col))


def fit(docs: DataFrame, rows: DataFrame, text_col: str = "text") -> Model:
    """Fit to all texts of ``docs`` (characters) and the labelled (_id, _text, _y) ``rows``."""
    prices = character_prices(docs, text_col)
    return fit_restored(land(restored(rows.select("_id", "_y", "_text"), "_text", prices), "toxic_rows"), prices)


def fit_restored(rows: DataFrame, prices: np.ndarray) -> Model:
    """Fit to labelled rows whose ``_text`` is restored."""
    spark = rows.sparkSession
    counts = land(label_counts(rows), "toxic_counts")
    totals = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    known = toxic + clean
    base = (toxic + 0.5) / (known + 10)
    candidates = land(counts.withColumn("n", F.col("toxic") + F.col("clean"))
                      .where(F.col("toxic") > 0.5 * F.col("n"))
                      .select("feature", ((F.col("toxic") + 0.1) / (F.col("n") + 1)).alias("rate"), wilson(Z_SURE).alias("sure")),
                      "toxic_candidates")
    if candidates.isEmpty():
        return Model(prices, None, (1.0, 0.0, min(-0.1, math.log(base / (1 - base)))))
    drawn = bounded_sample(rows.where("_y = 1"), toxic, COVER_ROWS, "cover").union(
        bounded_sample(rows.where("_y = 0"), clean, COVER_ROWS, "cover"))
    sample = land(hits(drawn.select("_id", "_y", "_text"), "_text", candidates), "toxic_cover")
    # the candidates that the sampled documents hold; what only passed the filter goes
    held = (sample.select(F.explode("found").alias("g")).distinct().select(F.explode(F.split("g", " ")).alias("feature")).distinct()
            .join(candidates, "feature").collect())
    rate, sure = {r["feature"]: r["rate"] for r in held}, {r["feature"] for r in held if r["sure"]}
    some = [(r["_y"], sorted({" ".join(f for f in g.split(" ") if f in rate) for g in r["found"]} - {""}))
            for r in sample.where(F.size("found") > 0).orderBy("_id", "found").collect()]
    some = [x for x in some if x[1]]
    share = [max(1.0, known_y / COVER_ROWS) for known_y in (clean, toxic)]
    unread = [(y, [f for g in found for f in g.split(" ")]) for y, found in some]
    added = cover([x for x in unread if sure.isdisjoint(x[1])], (share[0], share[1]))  # none of them is sure
    rates = {f: rate[f] for f in sure} | added
    # the curve: documents with evidence one by one, those without as two weights
    seen = np.array([evidence(set(found), rates) for _, found in some] + [(0.0, 0.0)] * 2)
    is_toxic = np.array([y == 1 for y, _ in some] + [False, True])
    n_all = {r["_y"]: r["count"] for r in sample.groupBy("_y").count().collect()}
    n_some = Counter(y for y, _ in some)
    weight = np.array([share[y] for y, _ in some] + [(n_all.get(y, 0) - n_some[y]) * share[y] + 1e-6 for y in (0, 1)])
    cover_rows = spark.createDataFrame([*added.items()], "feature string, rate double")  # bounded by the sample
    kept = land(candidates.where("sure").select("feature", "rate").union(cover_rows), "toxic_kept")
    return Model(prices, kept, tuple(logistic(seen, is_toxic, weight).tolist()))


def scored(texts: DataFrame, model: Model, text_col: str) -> DataFrame:
    """The other columns and ``score``."""
    return scored_restored(restored(texts, text_col, model.prices), model, text_col)


def scored_restored(texts: DataFrame, model: Model, text_col: str) -> DataFrame:
    """``scored`` for restored texts; ``evidence`` by a join of the words with the kept table, of any size."""
    a, b, c = model.curve
    if model.kept is None:
        return texts.drop(text_col).withColumn("score", F.lit(1 / (1 + math.exp(-c))))
    read = land(hits(texts, text_col, model.kept).withColumn("_at", F.monotonically_increasing_id()), "toxic_hits")
    words = read.select("_at", F.explode("found").alias("_word"))
    odds = (words.select("_at", "_word", F.explode(F.split("_word", " ")).alias("feature")).join(model.kept, "feature")
            .groupBy("_at", "_word").agg(F.array_sort(F.collect_set("feature")).alias("_group"), F.max("rate").alias("rate"))
            .groupBy("_at", "_group").agg(F.max("rate").alias("rate"))
            .select("_at", F.greatest(F.lit(0.0), F.log(F.col("rate") / (1 - F.col("rate")))).alias("_odds"))
            .groupBy("_at").agg(F.max("_odds").alias("_top"), F.array_sort(F.collect_list("_odds")).alias("_all")))
    rest = F.aggregate("_all", F.lit(0.0), lambda x, y: x + y) - F.col("_top")  # in order, so that equal texts score alike
    top, others = F.coalesce("_top", F.lit(0.0)), F.coalesce(F.log1p(F.greatest(rest, F.lit(0.0))), F.lit(0.0))
    at = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * top + b * others + c))
    return read.join(odds, "_at", "left").withColumn("score", 1 / (1 + F.exp(-at))).drop("_at", "found", "_top", "_all")


HELD_OUT = (5, 0)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op1 over all documents."""
    held_out = fold(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]
    prices = character_prices(docs)
    texts = docs.select("doc_id", held_out.alias("held_out"), F.col("text").alias("_text"))
    texts = land(restored(texts, "_text", prices), "toxic_restored", compression="zstd")
    rows = land(training_rows(texts, labels, "toxic", fold(F.col("doc_id"), HELD_OUT[0]) != HELD_OUT[1], text_col="_text"),
                "toxic_training", compression="zstd")
    return scored_restored(texts, fit_restored(rows, prices), "_text").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
