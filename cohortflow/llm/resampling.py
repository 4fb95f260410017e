"""Importance resampling toward a target distribution, by hashed n-gram features.

An untrained ``tokenizers`` pre-tokenizer (a Regex Split) cuts the ASCII-lowered text into words with
offsets. Windows over neighbouring offset pairs are the features: one word, or several joined by one
space. A feature's CRC-32 picks its bucket; it is computed from the words' CRCs and the lengths between
their offsets, so no feature is put together as a string.
Histograms of all documents and of all target texts give each bucket a gain, the log ratio of their
smoothed frequencies; a document's weight is the mean gain of its features. A Gumbel number from the
document's id makes the highest scores a weighted draw without replacement.

All documents and all target texts are counted whole. Buckets (a parameter, 10,000 here) bound the
histograms; what reaches the driver is one row a bucket and one a range partition. The draw ranks thin
rows in a range-partitioned sort, never in one task.

Defined cases: a null or wordless text has no features and weight 0; a null id hashes as the empty
string and sorts last; rows equal in score and id are drawn one by one in the order of a row number;
repeated rows count each; with an empty target all gains come from the smoothing; an empty table gives
an empty result; extra columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import land, python_tasks

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, LONGEST_RUN, SEED = 10_000, 2, 7
MIN_WORDS, DRAW_PERCENT = 20, 25
#: A long text is split in pieces of about this many characters, between two words.
PIECE = 1 << 16
#: Words whose CRC a task keeps; when full it starts anew.
MEMO = 1 << 18
_BORDER = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")  # in a text not yet lowered
_INDEX_BITS = 33  # of monotonically_increasing_id: the row inside its partition


def splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(WORD), "removed", invert=True)


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that end outside words."""
    at = 0
    while len(text) - at > PIECE:
        border = _BORDER.search(text, at + PIECE)
        end = border.start() if border else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class _WordCrc(dict):
    """CRC-32 of words, each computed when first met; starts anew when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        crc = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return crc


class _Append:
    """CRC-32 of joined strings from the CRCs of their parts.

    Appending n bytes maps the CRC so far by a linear map, whatever the bytes, and adds their own CRC.
    The maps are tables of four bytes' images: one for each n below 64, then one for each power of two.
    """

    small = 64

    def __init__(self) -> None:
        zero = zlib.crc32(b"\0")
        one = np.array([[zlib.crc32(b"\0", b << 8 * j) ^ zero for b in range(256)] for j in range(4)], np.uint32)
        self.by_length = np.empty((self.small, 4, 256), np.uint32)
        self.by_length[0] = [[b << 8 * j for b in range(256)] for j in range(4)]
        for n in range(1, self.small):
            self.by_length[n] = self._map(one, self.by_length[n - 1])
        power = self._map(one, self.by_length[self.small - 1])
        self.powers = [power]
        for _ in range(25):  # words of up to 2 GB
            power = self._map(power, power)
            self.powers.append(power)

    @staticmethod
    def _map(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0, crc & 255] ^ table[1, crc >> 8 & 255] ^ table[2, crc >> 16 & 255] ^ table[3, crc >> 24]

    def __call__(self, left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRCs of left + right, where right has ``length`` bytes."""
        low, t = length % self.small, self.by_length
        out = t[low, 0, left & 255] ^ t[low, 1, left >> 8 & 255] ^ t[low, 2, left >> 16 & 255] ^ t[low, 3, left >> 24]
        for i in np.flatnonzero(length >= self.small).tolist():
            one = out[i:i + 1]
            for k, power in enumerate(self.powers):
                if int(length[i]) // self.small >> k & 1:
                    one = self._map(power, one)
            out[i] = one[0]
        return out ^ right


def word_offsets(split, text: str) -> Iterator[tuple[str, tuple[int, int], None]]:
    """(word, byte offsets in its piece, no tokens) of the ASCII-lowered text, in order."""
    from tokenizers import PreTokenizedString

    for piece in pieces(text):
        lowered = PreTokenizedString(piece.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))  # bytes: A-Z only
        split.pre_tokenize(lowered)
        yield from lowered.get_splits(offset_referential="original", offset_type="byte")


def feature_hashes(split, text: str, longest: int, memo: _WordCrc, append: _Append) -> tuple[int, np.ndarray]:
    """Number of words, and the CRC-32 of every run of 1 to ``longest`` words."""
    found = list(word_offsets(split, text))
    n = len(found)
    own = np.fromiter(map(memo.__getitem__, (w for w, _, _ in found)), np.uint32, n)
    length = np.fromiter((span[1] - span[0] for _, span, _ in found), np.int64, n)
    runs, out = own, [own]
    space, one = np.uint32(zlib.crc32(b" ")), np.ones(n, np.int64)
    for k in range(1, min(longest, n)):  # runs of k + 1 words from those of k that end a word earlier
        runs = append(append(runs[:-1], space, one[:len(runs) - 1]), own[k:], length[k:])
        out.append(runs)
    return n, np.concatenate(out)


def _bucket_type(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def features(docs: DataFrame, text_col: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN,
             columns: Sequence[str] | None = None) -> DataFrame:
    """(_row, n_words, n_features, _buckets): the bucket of every feature, packed; ``_row`` holds ``columns``."""
    python_tasks(docs.sparkSession)
    names = docs.columns if columns is None else list(columns)
    row = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(1).alias("_"))
    thin = docs.select(row.alias("_row"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, memo, append, kind = splitter(), _WordCrc(), _Append(), _bucket_type(buckets)
        for batch in batches:
            n_words, n_features, packed = [], [], []
            for text in batch.column(1):
                n, hashes = feature_hashes(split, text.as_py() or "", longest, memo, append)
                n_words.append(n)
                n_features.append(len(hashes))
                packed.append((hashes % np.uint32(buckets)).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(packed, pa.binary())],
                ["_row", "n_words", "n_features", "_buckets"])

    return thin.mapInArrow(run, f"_row {thin.schema['_row'].dataType.simpleString()}, n_words long, n_features long, _buckets binary")


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket; every task sums its own rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros(buckets, np.int64), _bucket_type(buckets)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = found.select("_buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target and source frequency by bucket, rounded down."""
    k = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def _weight(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with ``weight`` in the place of its buckets."""
    kind, dtype = found.schema["_row"].dataType.simpleString(), _bucket_type(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = []
            for packed in batch.column(3):
                own = np.frombuffer(packed.as_py(), dtype)
                weight.append(int(gain[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], ["_row", "n_words", "n_features", "weight"])

    return found.select("_row", "n_words", "n_features", "_buckets").mapInArrow(
        run, f"_row {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number, rounded down, from the hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
          buckets: int = BUCKETS, longest: int = LONGEST_RUN, seed: int = SEED, columns: Sequence[str] | None = None) -> DataFrame:
    """(_row, _key, _id, n_words, n_features, weight, score) of every document, written.

    ``_row`` holds ``columns`` of the document (all by default; the id alone keeps what is written
    thin), ``_key`` numbers the rows. Every text is read by the pre-tokenizer once.
    """
    names = list(dict.fromkeys([*(docs.columns if columns is None else columns), id_col]))
    found = land(features(docs, text_col, buckets, longest, names), "dsir_features")
    gain = gains(histogram(found, buckets), histogram(features(target, target_col, buckets, longest, []), buckets))
    weighed = _weight(found, gain).withColumn("_id", F.col(f"_row.`{id_col}`"))
    return land(weighed.withColumn("score", F.col("weight") + gumbel(F.col("_id"), seed))
                .withColumn("_key", F.monotonically_increasing_id()), "dsir_weights")


def rank(weighed: DataFrame, min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT) -> DataFrame:
    """``weighed`` with ``rank``: 1, 2, ... for the drawn documents, null for the others.

    Rows are range-partitioned by (fit to be drawn, score, id, row number) and sorted inside their
    partition; the row number keeps even equal keys apart, so no range outgrows a task. A row's place
    is its index inside its partition plus the rows of the partitions before (one row a partition).
    """
    fit = F.col("n_words") >= min_words
    quota = weighed.where(fit).count() * percent // 100
    order = [F.col("_unfit"), F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_key")]
    placed = (weighed.withColumn("_unfit", ~fit).repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    placed = land(placed, "dsir_order")
    part, inside = F.shiftright("_place", _INDEX_BITS), F.col("_place").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0
    for p, n in counts:
        before.append((p, total))
        total += n
    starts = placed.sparkSession.createDataFrame(before, "_part long, _before long")
    place = F.col("_before") + inside + 1
    return (placed.withColumn("_part", part).join(starts, "_part", "left")
            .withColumn("rank", F.when(~F.col("_unfit") & (place <= quota), place))
            .drop("_part", "_before", "_place", "_unfit"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents with all their columns, ``dsir_weight``, ``dsir_score`` and ``dsir_rank``.

    Only thin rows are sorted; the drawn ones meet their documents by row number.
    """
    weighed = weigh(docs, target, id_col, text_col, target_col, seed=seed)
    added = {"dsir_weight": "weight", "dsir_score": "score", "dsir_rank": "rank"}
    drawn = (rank(weighed.select("_key", "_id", "n_words", "weight", "score"), min_words, percent).where("rank IS NOT NULL")
             .select(F.col("_key").alias("_drawn"), *[F.col(c).alias(a) for a, c in added.items()]))
    back = [F.col(f"_row.`{c}`") for c in docs.columns if c not in added]
    return weighed.select("_row", "_key").join(drawn, F.col("_key") == F.col("_drawn")).select(*back, *added)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract of op13: every document with its weight, score and, if drawn, its rank."""
    weighed = weigh(docs, benchmark, columns=["doc_id"])
    return rank(weighed).select(F.col("_row.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")
