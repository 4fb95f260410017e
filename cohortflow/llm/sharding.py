"""K-d tree partitioning of documents into shards of near equal bytes (native).

The metadata dimensions are the language, the source and the length. Each value falls into
one of 4,096 bins (names by hash, lengths by logarithm). A document's coordinate in a
dimension is its place in the running byte sum over that dimension's bins, spread inside the
bin by a hash of its id and text, so even one value that holds a third of all bytes can be cut.
A node that must hold k shards is cut in its widest dimension (the spread of its bins against
the whole table's) at the weighted median, or at the k/2 : k share where k is odd, until every
leaf has the target bytes. Each level is two aggregates over a thin written table; the driver
sees one row a node.

Defined cases: a null text has 0 bytes and still its overhead; null metadata is a value of its
own; documents that share an id, or have none, are told apart by their texts, rows equal in both
lie together and keep their own slots; an empty table gives an empty
result; extra columns are kept and never read (``shard`` and
``slot`` are replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import gapless, land, packed, unpacked, unsigned_hash

BIN_BITS = 12
BINS = 1 << BIN_BITS
#: Cells of the byte range in which a cut is searched.
CELLS = 1 << 16
DIMS = ("lang", "source", "length")


@dataclass(frozen=True)
class Node:
    """A box in byte coordinates that holds ``shards`` shards from ``first`` on."""
    first: int
    shards: int
    low: tuple[int, ...]
    high: tuple[int, ...]

    def holds(self) -> Column:
        """Every bound as a condition on the coordinates, bounds of the whole range left out."""
        out = F.lit(True)
        for i, (a, b) in enumerate(zip(self.low, self.high)):
            if a > 0:
                out = out & (F.col(f"_u{i}") >= F.lit(a))
            if b < (1 << 62):
                out = out & (F.col(f"_u{i}") < F.lit(b))
        return out


def byte_size(text: Column, overhead: int) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead).cast("long")


def _bins(lang: str, source: str, size: Column) -> list[Column]:
    """Bin of each dimension: 4,096 at most, whatever the values."""
    return [unsigned_hash(F.coalesce(F.col(lang), F.lit("\x00null")), bits=BIN_BITS),
            unsigned_hash(F.coalesce(F.col(source), F.lit("\x00null")), bits=BIN_BITS),
            F.least(F.lit(BINS - 1), F.floor(F.log2(size + 1) * 96)).cast("long")]


def _spread(dim: int) -> Column:
    """Where in its bin a document lies: 24 hash bits as a share of 1."""
    return unsigned_hash(F.col("_id"), F.col("_text_hash"), F.lit(f"dim{dim}"), bits=24) / F.lit(float(1 << 24))


def _when(nodes: list[Node], value) -> Column:
    out = None
    for n in nodes:
        cond = n.holds()
        out = F.when(cond, F.lit(value(n))) if out is None else out.when(cond, F.lit(value(n)))
    return out


@dataclass
class Tree:
    leaves: list[Node]
    places: list[DataFrame]  # by dimension: bin -> running bytes before it, its bytes
    rows: int


def _coordinates(df: DataFrame, places: list[DataFrame]) -> DataFrame:
    """Byte coordinates; each joined table has 4,096 rows at most, hence the broadcasts."""
    for i, p in enumerate(places):
        df = (df.join(F.broadcast(p), f"_b{i}", "left")
              .withColumn(f"_u{i}", (F.col("_before") + F.floor(F.col("_bytes") * F.col(f"_t{i}"))).cast("long"))
              .drop("_before", "_bytes"))
    return df


def keyed(docs: DataFrame, size: Column, text_hash: Column, id_col: str, lang_col: str, source_col: str) -> DataFrame:
    df = packed(docs, _id=F.col(id_col), _text_hash=text_hash, _lang=F.col(lang_col), _source=F.col(source_col), _size=size)
    for i, b in enumerate(_bins("_lang", "_source", F.col("_size"))):
        df = df.withColumn(f"_b{i}", b).withColumn(f"_t{i}", _spread(i))
    return df


def fit(thin: DataFrame, shards: int) -> Tree:
    """Grow the tree over a written thin table (``_size``, ``_b*``, ``_t*``)."""
    dims = range(len(DIMS))
    places, spans = [], []
    for i in dims:
        w = Window.orderBy(f"_b{i}").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows at most
        sums = thin.groupBy(f"_b{i}").agg(F.sum("_size").alias("_bytes"))
        places.append(land(sums.withColumn("_before", F.coalesce(F.sum("_bytes").over(w), F.lit(0))), f"kd_place{i}"))
    total, rows, *ends = thin.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count(F.lit(1)),
                                  *[f(f"_b{i}") for i in dims for f in (F.min, F.max)]).first()
    root = Node(0, shards, (0,) * len(DIMS), (1 << 62,) * len(DIMS))
    if not rows or total <= 0:
        return Tree([root], places, rows)
    spans = [max(1, ends[2 * i + 1] - ends[2 * i]) for i in dims]
    points = land(_coordinates(thin, places).select("_size", *[f"_{k}{i}" for i in dims for k in "bu"]), "kd_points")
    cell = -(-total // CELLS)
    nodes, leaves = [root], []
    while nodes:
        leaves += [n for n in nodes if n.shards == 1]
        nodes = [n for n in nodes if n.shards > 1]
        if not nodes:
            break
        here = points.withColumn("_node", _when(nodes, lambda n: n.first)).where(F.col("_node").isNotNull())
        widths = {r["_node"]: r for r in here.groupBy("_node").agg(
            F.sum("_size").alias("bytes"),
            *[(F.max(f"_b{i}") - F.min(f"_b{i}")).alias(f"w{i}") for i in dims]).collect()}
        widest = {n.first: max(dims, key=lambda i: ((widths[n.first][f"w{i}"] if n.first in widths else 0) / spans[i], i))
                  for n in nodes}
        along = None  # the coordinate in the node's widest dimension
        for n in nodes:
            c, u = F.col("_node") == F.lit(n.first), F.col(f"_u{widest[n.first]}")
            along = F.when(c, u) if along is None else along.when(c, u)
        wanted = None  # bytes left of the cut
        for n in nodes:
            left = (widths[n.first]["bytes"] if n.first in widths else 0) * (n.shards // 2) / n.shards
            c = F.col("_node") == F.lit(n.first)
            wanted = F.when(c, F.lit(float(left))) if wanted is None else wanted.when(c, F.lit(float(left)))
        cells = here.groupBy("_node", F.floor(along / F.lit(cell)).alias("_cell")).agg(F.sum("_size").alias("_bytes"))
        upto = Window.partitionBy("_node").orderBy("_cell")  # CELLS rows at most
        run = cells.withColumn("_to", F.sum("_bytes").over(upto)).withColumn("_wanted", wanted)
        # the cut is the end of the cell whose running sum is nearest to the wanted bytes
        best = run.groupBy("_node").agg(F.min_by("_cell", F.struct(F.abs(F.col("_to") - F.col("_wanted")), "_cell")).alias("c"))
        cuts = {r["_node"]: (int(r["c"]) + 1) * cell for r in best.collect()}
        grown = []
        for n in nodes:
            d, at, k = widest[n.first], cuts.get(n.first, 0), n.shards // 2
            high, low = list(n.high), list(n.low)
            high[d], low[d] = at, at
            grown += [Node(n.first, k, n.low, tuple(high)), Node(n.first + k, n.shards - k, tuple(low), n.high)]
        nodes = grown
    return Tree(leaves, places, rows)


def shard(docs: DataFrame, size: Column, shards: int = 40, id_col: str = "doc_id",
          lang_col: str = "lang", source_col: str = "source", text_hash: Column | None = None) -> DataFrame:
    """Every row of ``docs`` with its ``shard`` and its gapless ``slot`` in the shard.

    ``size`` is the weight to balance; ``text_hash`` (of column ``text``, if not given) tells documents of
    one id apart. The rows move once, into blocks of their shards.
    """
    dims = range(len(DIMS))
    df = keyed(docs, size, F.xxhash64("text") if text_hash is None else text_hash, id_col, lang_col, source_col)
    thin = land(df.select("_size", *[f"_{k}{i}" for i in dims for k in "bt"]), "kd_thin")
    tree = fit(thin, shards)
    placed = _coordinates(df, tree.places).withColumn("shard", _when(tree.leaves, lambda n: n.first).cast("int"))
    placed = placed.select("_row", "_id", "_text_hash", "_size", "shard")
    order = [F.col("_id").asc_nulls_last(), F.col("_size"), F.col("_text_hash")]
    block = F.xxhash64("_id", "_text_hash")
    return unpacked(gapless(placed, "shard", order, block, tree.rows // shards, "slot"), "shard", "slot")


def query(docs: DataFrame) -> DataFrame:
    """Shard, slot and size of each document under the law of equal bytes (contract of op5)."""
    slim = land(docs.select("doc_id", "lang", "source", byte_size(F.col("text"), 16).alias("size"),
                            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")), "kd_documents")
    return shard(slim, F.col("size"), text_hash=F.col("text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
