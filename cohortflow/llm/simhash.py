"""SimHash near-duplicates: word shingles, 64-bit fingerprints, bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits are linked and links are followed to
connected components. Equal fingerprints collapse first. Two fingerprints within 3 bits agree
on at least two of five bit blocks, so ten keys (pairs of blocks) bring every linked pair
together; a task packs whole buckets into blocks and compares them by bit planes. A bucket of
more than ``TILE`` fingerprints is cut into tiles that meet pair by pair, so no bucket is ever
one task's. A block gives only the links that hold its groups together, never all pairs.

Defined cases: a null, empty or blank text has fingerprint zero, which is linked like any
other; fewer words than a shingle make one shingle of the whole; repeated rows are copies of
each other; a null ``doc_id`` takes part but never names a component unless no other id can;
an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.bitslice import groups
from cohortflow.llm.common import land, packed, python_tasks, unpacked
from cohortflow.llm.components import components

SEED = 42
#: Five blocks of the 64 bits (low, width); two of them are equal within 3 differing bits.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
RADIUS = 3
#: Largest bucket compared whole, and the fingerprints packed into one comparison.
TILE, PACK = 4096, 1024
#: Shingles hashed at once within a text.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of UTF-8 bytes: bytes.lower and bytes.split know only ASCII, as defined."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        joined: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    digest, ones, left = xxhash.xxh64_intdigest, np.zeros(64, np.int64), n
    while left:
        take = min(left, CHUNK)
        h = np.fromiter((digest(next(joined), SEED) for _ in range(take)), np.uint64, take)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(take, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        left -= take
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(_id, _th, fp): fp is the fingerprint as a signed long, _th a hash of the whole text."""
    python_tasks(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             ["_id", "_th", "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return thin.mapInArrow(run, f"_id {id_type}, _th long, fp long")


def _keys(fp: Column) -> Column:
    """The ten (table, bits of two blocks) of a fingerprint."""
    masks = [sum(((1 << w) - 1) << low for low, w in pair) for pair in combinations(BLOCKS, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(m).cast("long")).alias("k"))
                     for i, m in enumerate(signed)])


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by bucket; whole buckets are packed until a comparison is full."""
    def links(prints: list[np.ndarray]) -> pa.RecordBatch:
        block = np.unique(np.concatenate(prints))
        pairs = groups(block, radius)
        u = block[[a for a, _ in pairs]].view(np.int64) if pairs else np.zeros(0, np.int64)
        v = block[[b for _, b in pairs]].view(np.int64) if pairs else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    held: list[np.ndarray] = []   # whole buckets
    n, part, last = 0, [], None   # the bucket that may go on in the next batch
    for batch in batches:
        key = np.stack([np.asarray(batch.column(i)) for i in range(4)], axis=1)
        fps = np.asarray(batch.column(4)).view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(fps)]):
            name = tuple(key[a].tolist())
            if name != last:
                if part:
                    held += part
                    n += sum(map(len, part))
                if n >= PACK:
                    yield links(held)
                    held, n = [], 0
                part, last = [], name
            part.append(fps[a:b])
    held += part
    if held:
        yield links(held)


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect every group of distinct fingerprints ``fp`` within ``radius`` bits."""
    keyed = distinct.select("fp", F.explode(_keys(F.col("fp"))).alias("_e")).select(
        "fp", F.col("_e.t").alias("t"), F.col("_e.k").alias("k"))
    shared = land(keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash_buckets")
    tiles = F.ceil(F.col("n") / F.lit(TILE)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit("tile")), F.col("tiles").cast("long")).cast("int")
    rows = keyed.join(shared, ["t", "k"]).withColumn("tiles", tiles).withColumn("own", own)
    # a tile meets every other one; a bucket of one tile meets itself
    rows = rows.withColumn("other", F.explode(F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda x: x != F.col("own")))))
    rows = rows.select("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    return (rows.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
            .mapInArrow(lambda it: _compare(it, radius), "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = RADIUS) -> DataFrame:
    """A row a document: (_id, _th, fp, component_id, root). ``root`` names the component by a fingerprint."""
    if radius > len(BLOCKS) - 2:
        raise ValueError("the block pairs guarantee links up to 3 bits")
    prints = land(fingerprints(docs, id_col, text_col, shingle), "simhash_prints")
    distinct = land(prints.groupBy("fp").agg(F.min("_id").alias("first")), "simhash_distinct")
    linked = land(components(near_links(distinct, radius), "simhash_links").withColumnRenamed("node", "fp"), "simhash_roots")
    least = (linked.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("_least")))
    named = linked.join(least, "root").select("fp", "root", "_least")
    classes = distinct.join(named, "fp", "left").select(
        "fp", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("_least")).alias("component_id"),
        F.coalesce("root", "fp").alias("root"))
    return prints.join(land(classes, "simhash_classes"), "fp")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                radius: int = RADIUS) -> DataFrame:
    """One document of each component: the smallest id (a null id only where there is no other).

    The choice is made on thin rows; the texts move once, in the join back. Rows that repeat the
    chosen id and text are one document.
    """
    marked = near_duplicates(docs, id_col, text_col, shingle, radius)
    chosen = marked.groupBy("root", "_id", "_th").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(
        F.min(F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("_th").alias("th"),
                       F.col("n").alias("n"))).alias("c")).select(
        F.col("c.id").alias("_chosen"), F.col("c.th").alias("_chosen_th"), F.col("c.n").alias("_copies"))
    chosen = land(chosen, "simhash_chosen")
    rows = packed(docs, _id=F.col(id_col), _th=F.xxhash64(F.col(text_col)))
    kept = rows.join(chosen, F.col("_id").eqNullSafe(F.col("_chosen")) & (F.col("_th") == F.col("_chosen_th")))
    copies = kept.where("_copies > 1").dropDuplicates(["_chosen", "_chosen_th"])
    return unpacked(kept.where("_copies = 1").union(copies))


def query(docs: DataFrame) -> DataFrame:
    """Contract of op6: fingerprint in hex and the component's smallest id."""
    out = near_duplicates(docs)
    return out.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
