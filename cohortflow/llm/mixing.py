"""Mixing sources to target weights by capped water-filling (native).

Every source gets a target share of the requested words. A target that exceeds
``max_epochs`` times its source's size is clamped there; what is left over goes to the
other sources in proportion to their weights, until no target is above its cap. A source
then gives ``epochs = target / size`` repetitions: the whole part to each document, the
fraction to the documents that come first in a seeded hash order.

Defined cases: a null or blank text has size 0 and is taken 0 words; a null source is a
source of its own, ordered last; a null ``doc_id`` hashes as the empty string, and documents
that share an id have positions by their texts; rows equal in both are taken alike; an empty table gives an empty result;
extra columns are kept and never read (``mix`` replaces those
named like the ones it adds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import land, packed, unpacked, word_count

#: Hash bins of a source: the fraction's cut is found in the sums of these bins first.
BIN_BITS = 12
HASH_HEX = 12  # 48 bits
#: Columns that ``mix`` adds.
MIX = ("mix_size", "mix_source_size", "mix_target", "mix_reps")


def _position(id_col: Column, text: Column, seed: int) -> Column:
    """Seeded position of a document, 48 bits (md5, so that SQL can repeat it); of one id, each text has its own."""
    text_hash = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), text_hash)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_HEX), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights: tuple[float, ...], total_share: float, max_epochs: float) -> DataFrame:
    """Targets of sources: (_source, source_size) -> plus target.

    With sources ordered by cap / weight the clamped ones are a prefix, and the final level
    ``(total - caps clamped) / (weights left)`` is the largest one met on the way. That is the
    fixed point of clamping and resharing again and again. There is one row a source here.
    """
    by_name = Window.orderBy(F.col("_source").isNull(), F.col("_source"))
    everything = Window.partitionBy()
    ranked = (sizes.withColumn("_rank", F.row_number().over(by_name))
              .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                             F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int") + 1))
              .withColumn("_cap", F.lit(float(max_epochs)) * F.col("source_size"))
              .withColumn("_total", F.lit(float(total_share)) * F.sum("source_size").over(everything)))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (ranked
            .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                        / F.sum("_w").over(onward))
            .withColumn("target", F.least(F.col("_cap"), F.max("_level").over(everything) * F.col("_w")))
            .select("_source", "source_size", "target"))


def plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5,
         max_epochs: float = 2.0, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
         text_col: str = "text") -> DataFrame:
    """One row a source: size, target, whole repetitions and the hash cut of the fraction."""
    thin = land(docs.select(F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"),
                            _position(F.col(id_col), F.col(text_col), seed).alias("_u")), "mix_positions")
    bin_of = F.shiftright(F.col("_u"), 4 * HASH_HEX - BIN_BITS)
    bins = land(thin.groupBy("_source", bin_of.alias("_bin")).agg(F.sum("_size").alias("_words")), "mix_bins")
    sizes = bins.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    targets = (water_fill(sizes, weights, total_share, max_epochs)
               .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(F.lit(0)).cast("long"))
               .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    targets = land(targets, "mix_targets")
    same = lambda a, b: a["_source"].eqNullSafe(b["_source"])
    # the bin in which the running sum passes the budget, by source (at most 2^BIN_BITS rows each)
    upto = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    running = bins.withColumn("_before", F.coalesce(F.sum("_words").over(upto), F.lit(0)))
    cut = (running.join(targets, same(running, targets)).drop(targets["_source"])
           .where((F.col("_before") < F.col("budget")) & (F.col("_before") + F.col("_words") >= F.col("budget")))
           .select("_source", F.col("_bin").alias("_cut_bin"), "_before", "budget"))
    cut = land(cut, "mix_cut_bins")
    # only the rows of that bin are ordered; a row is in if most of it fits the budget
    inside = thin.join(cut, same(thin, cut) & (bin_of == F.col("_cut_bin"))).drop(cut["_source"])
    in_bin = Window.partitionBy("_source").orderBy("_u", "_size").rowsBetween(Window.unboundedPreceding, -1)
    fits = F.col("_before") + F.coalesce(F.sum("_size").over(in_bin), F.lit(0)) + F.col("_size") / 2 < F.col("budget")
    last = (inside.withColumn("_fits", fits).groupBy("_source")
            .agg(F.max(F.when(F.col("_fits"), F.col("_u"))).alias("_last"),
                 F.max("_cut_bin").alias("_cut_bin")))
    start = F.shiftleft(F.col("_cut_bin"), 4 * HASH_HEX - BIN_BITS)
    last = last.select(F.col("_source").alias("_s"), F.coalesce("_last", start - 1).alias("cut"))
    return land(targets.join(last, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s", "budget")
                .withColumn("cut", F.coalesce("cut", F.lit(-1))), "mix_plan")


def _mixed(docs: DataFrame, weights: tuple[float, ...], total_share: float, max_epochs: float, seed: int, id_col: str,
           source_col: str, text_col: str) -> DataFrame:
    """Packed rows with the ``MIX`` columns.

    The plan has one row a source and is read from a written table, so the join is broadcast
    only when that table's size allows it; otherwise it is a sort-merge join whose hot source
    the adaptive skew join splits.
    """
    sources = plan(docs, weights, total_share, max_epochs, seed, id_col, source_col, text_col)
    sources = sources.select("_source", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
                             "whole", "cut")
    rows = packed(docs, _of=F.col(source_col), mix_size=word_count(F.col(text_col)), _u=_position(F.col(id_col), F.col(text_col), seed))
    taken = F.col("whole") + (F.col("_u") <= F.col("cut")).cast("long")
    return rows.join(sources, F.col("_of").eqNullSafe(F.col("_source")), "left").withColumn(
        "mix_reps", F.when(F.col("mix_size") > 0, taken).otherwise(F.lit(0)).cast("long"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5,
        max_epochs: float = 2.0, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_reps``."""
    return unpacked(_mixed(docs, weights, total_share, max_epochs, seed, id_col, source_col, text_col), *MIX)


def mixture(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5,
            max_epochs: float = 2.0, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
            text_col: str = "text") -> DataFrame:
    """The mixture itself: each row, its columns unchanged, as often as the mix takes it."""
    taken = _mixed(docs, weights, total_share, max_epochs, seed, id_col, source_col, text_col).where("mix_reps > 0")
    return unpacked(taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_reps")))))


def query(docs: DataFrame) -> DataFrame:
    """The digest of a mix: words taken of each document (contract of op8)."""
    return mix(docs.select("doc_id", "source", "text")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_reps") * F.col("mix_size")).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS k FROM s),
w AS (SELECT *, CASE (k - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM r),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * w) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             e.target - e.whole * e.source_size AS budget
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN before + size / 2.0::DOUBLE < budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
