"""Exact interpolated percentiles without a single-task value buffer.

``percentile`` keeps every distinct value of the group in one aggregation
buffer. Here the work is split instead:

1. histogram by value (distributed ``groupBy``, map-side combined);
2. order-preserving bins from approximate quantile boundaries of the
   distinct values (a bounded sketch), so each bin holds about 1/bins of them;
3. per-bin row offsets from a window over at most ``bins`` rows, and ranks
   inside each bin from a window partitioned by bin;
4. the two order statistics around ``(N - 1) * p`` are picked by rank and
   interpolated exactly like Spark's ``percentile``:
   ``(hi - pos) * x_lo + (pos - lo) * x_hi``.

The bins only shape the work; any boundaries give the same exact answer.
The result is one row with one column per requested percentile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BINS = 256


def exact_percentiles(values: DataFrame, col: str, ps: Sequence[float], names: Sequence[str] | None = None,
                      freq: str | None = None, bins: int = DEFAULT_BINS) -> DataFrame:
    names = list(names or [f"p{i}" for i in range(len(ps))])
    v = values.select(F.col(col).cast("double").alias("_v"),
                      (F.col(freq) if freq else F.lit(1)).cast("bigint").alias("_w")).where(F.col("_v").isNotNull())
    hist = v.groupBy("_v").agg(F.sum("_w").alias("_n"))
    # boundaries over the *distinct* values: each bin gets about the same number
    # of histogram rows, which is the work per bin (and ``values`` is read once)
    bounds = hist.agg(F.percentile_approx("_v", [i / bins for i in range(1, bins)], 10000).alias("_b"))
    # boundaries and per-bin totals are scalar arrays of at most ``bins``
    # entries; no join is needed to attach them
    binned = hist.withColumn("_b", bounds.select("_b").scalar()).select(
        "_v", "_n", F.size(F.filter(F.col("_b"), lambda b: b < F.col("_v"))).alias("_bin"))
    totals = binned.groupBy("_bin").agg(F.sum("_n").alias("_bn")).agg(
        F.collect_list(F.struct("_bin", "_bn")).alias("_t"))
    with_t = binned.withColumn("_t", totals.select("_t").scalar())
    start = F.aggregate(F.filter(F.col("_t"), lambda x: x["_bin"] < F.col("_bin")), F.lit(0).cast("bigint"),
                        lambda acc, x: acc + x["_bn"])
    total = F.aggregate(F.col("_t"), F.lit(0).cast("bigint"), lambda acc, x: acc + x["_bn"])
    ranked = with_t.select("_v", "_n", "_bin", start.alias("_start"), total.alias("_total")).withColumn(
        "_end", F.col("_start") + F.sum("_n").over(
            Window.partitionBy("_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    # rows cover ranks [_end - _n, _end)
    aggs, outs = [], []
    for i, p in enumerate(ps):
        pos = (F.col("_total") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        at = lambda r: (F.col("_end") - F.col("_n") <= r) & (r < F.col("_end"))
        aggs += [F.max(F.when(at(lo), F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(at(hi), F.col("_v"))).alias(f"_hi{i}"),
                 F.max(pos).alias(f"_pos{i}")]
        x_lo, x_hi, ps_ = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_pos{i}")
        l_, h_ = F.floor(ps_), F.ceil(ps_)
        outs.append(F.when((h_ == l_) | (x_lo == x_hi), x_lo)
                    .otherwise((h_ - ps_) * x_lo + (ps_ - l_) * x_hi).alias(names[i]))
    return ranked.agg(*aggs).select(*outs)
