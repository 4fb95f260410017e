"""Benchmark decontamination: containment search with size-partitioned MinHash sketches.

A document contains an item if at least ``threshold`` of the item's distinct word shingles occur
in it. Items are partitioned by their number of shingles into powers of two. Each partition has
a sketch size: its items are represented by that many of their smallest shingle hashes, enough
that a document with the wanted containment must hold some of them - at most ``q - ceil(t q)`` of
an item's ``q`` shingles may be missing, so a sketch of more hashes than that cannot be missed.
A document, however long, is not sketched: its shingles are looked up, so a short item stands out
in a long text where the Jaccard similarity of the two would be next to nothing.

1. Items give their shingles (a table) and a bit filter of fixed size.
2. Documents are read once; only shingles that pass the filter leave the task, as strings.
3. Hits meet the sketches by hash; pairs with too few sketch hits for the item's partition, or
   documents too short for it, are no candidates.
4. Candidates are verified by counting the item's shingles among the document's hits, as strings.

Words are ``\\w+`` of the lower-case text. Defined cases: a null or empty document contains
nothing; an item without words is contained nowhere; an item of fewer words than a shingle is one
shingle of all its words; repeated documents or items give their pair once; null ids pair like
others; an empty table gives no pairs; extra columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import bit_filter, land, packed, passes, python_tasks, unpacked

SHINGLE, THRESHOLD = 5, 0.8

_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def hashes(words: list[str], size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words."""
    digest = xxhash.xxh64_intdigest
    w = np.fromiter((digest(x) for x in words), np.uint64, len(words))
    n = len(w) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = (h ^ w[i:i + n]) * _MIX
        h ^= h >> np.uint64(32)
    return h


def shingles(text: str, size: int = SHINGLE) -> dict[str, int]:
    """Distinct shingles of an item with their hashes; a short item is a single one."""
    words = _words(text)
    size = min(size, len(words))
    if not size:
        return {}
    return {" ".join(words[i:i + size]): int(h) for i, h in enumerate(hashes(words, size).tolist())}


def needed(q: int, threshold: float) -> int:
    """Shingles of ``q`` that a containing document must hold."""
    return max(1, math.ceil(threshold * q - 1e-9))


def sketch_size(q: int, threshold: float) -> int:
    """Hashes that represent any item of the size partition of ``q``."""
    top = (1 << q.bit_length()) - 1  # largest number of shingles in the partition
    return top - needed(top, threshold) + 1


def item_shingles(items: DataFrame, id_col: str, text_col: str, size: int, threshold: float) -> DataFrame:
    """A row a shingle: item, text hash, its number of shingles, words a shingle, whether it is in the sketch,
    and how many sketch hits a containing document must have."""
    python_tasks(items.sparkSession)
    thin = items.select(F.col(id_col).alias("item"), F.xxhash64(F.col(text_col)).alias("item_th"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).dropDuplicates(["item", "item_th"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, th, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingles(text, size)
                q = len(found)
                if not q:
                    continue
                ranked = sorted(found.items(), key=lambda x: x[1])
                k = min(q, sketch_size(q, threshold))
                must = k - (q - needed(q, threshold))
                rows += [(item, th, q, s.count(" ") + 1, i < k, must, h - (1 << 64) if h >> 63 else h, s)
                         for i, (s, h) in enumerate(ranked)]
            cols = list(zip(*rows)) or [()] * 8
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["item", "item_th", "q", "words", "sketched", "must", "h", "shingle"])

    kind = thin.schema["item"].dataType.simpleString()
    return thin.mapInArrow(run, f"item {kind}, item_th long, q long, words int, sketched boolean, must long, h long, shingle string")


def hits(docs: DataFrame, id_col: str, text_col: str, bits: np.ndarray, sizes: list[int], size: int) -> DataFrame:
    """(doc, th, n, h, shingle): a document's distinct shingles that pass the filter."""
    python_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    thin = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("th"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n, found, text_of = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                words = _words(text.as_py())
                long = max(1, len(words) - size + 1)
                seen = set()
                for k in sizes:
                    h = hashes(words, k)
                    for i in np.flatnonzero(passes(shared.value, h)).tolist():
                        s = " ".join(words[i:i + k])
                        if s not in seen:
                            seen.add(s)
                            at.append(row)
                            n.append(long)
                            found.append(int(h[i]) - (1 << 64) if int(h[i]) >> 63 else int(h[i]))
                            text_of.append(s)
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(n, pa.int64()), pa.array(found, pa.int64()),
                 pa.array(text_of, pa.string())], ["doc", "th", "n", "h", "shingle"])

    kind = thin.schema["doc"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc {kind}, th long, n long, h long, shingle string")


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc, th, item, n_shared, n_item, containment) of every pair at or over the threshold.

    ``th`` is the hash of the document's text, which tells rows of one id apart. Only hits are
    shuffled; the number of item sizes below a shingle (four at most) reaches the driver.
    """
    table = land(item_shingles(items, item_col, item_text_col, size, threshold), "decon_items")
    sizes = sorted(r["words"] for r in table.select("words").distinct().collect())
    found = land(hits(docs, id_col, text_col, bit_filter(table, "h"), sizes, size).distinct(), "decon_hits")
    doc, item = ["doc", "th"], ["item", "item_th"]
    sketched = table.where("sketched").select(*item, "q", "words", "must", F.col("h").alias("_h"))
    # documents too short for the item's partition hold too few shingles, whichever they are
    fits = (F.col("n") >= F.ceil(F.lit(threshold) * F.col("q") - F.lit(1e-9))) | (F.col("words") < size)
    pairs = (found.join(sketched, (F.col("h") == F.col("_h")) & fits)
             .groupBy(*doc, *item, "q").agg(F.count(F.lit(1)).alias("_hits"), F.max("must").alias("_must"))
             .where("_hits >= _must").drop("_hits", "_must"))
    pairs = land(pairs, "decon_candidates")
    null_safe = lambda left, right, cols: [left[c].eqNullSafe(right[c]) for c in cols]
    have = pairs.join(found.select(*[F.col(c).alias(f"_{c}") for c in (*doc, "shingle")]),
                      F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th"))).drop("_doc", "_th")
    own = table.select(*[F.col(c).alias(f"_{c}") for c in (*item, "shingle")]).withColumnRenamed("_shingle", "_own")
    shared = (have.join(own, F.col("item").eqNullSafe(F.col("_item")) & (F.col("item_th") == F.col("_item_th"))
                        & (F.col("_shingle") == F.col("_own")))
              .groupBy(*doc, *item, "q").agg(F.count(F.lit(1)).alias("n_shared")))
    return (shared.where(F.col("n_shared") >= F.ceil(F.lit(threshold) * F.col("q") - F.lit(1e-9)))
            .select(*doc, *item, "n_shared", F.col("q").alias("n_item"), (F.col("n_shared") / F.col("q")).alias("containment")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that contain no item; what is dropped is a thin written table."""
    bad = land(contained(docs, items, id_col, text_col).select(F.col("doc").alias("_doc"), F.col("th").alias("_th")).distinct(),
               "decon_dropped")
    rows = packed(docs, _id=F.col(id_col), _text_hash=F.xxhash64(F.col(text_col)))
    return unpacked(rows.join(bad, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_th")), "left_anti"))


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of op4: document, item, shared and item shingles, containment."""
    return contained(docs, benchmark).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_shared", "n_item",
                                             "containment")


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM dw, (SELECT DISTINCT least(5, len(w)) AS k FROM bw WHERE len(w) > 0))),
q AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
p AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared::BIGINT AS n_shared, n::BIGINT AS n_item, n_shared / n AS containment
FROM p JOIN q USING (item_id) WHERE n_shared >= 0.8 * n - 1e-9
"""
