"""Labelled rows for training: folds by crc32 of the id, and bounded samples of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import bit_filter, land, passes


def fold(id_col: Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, in_training: Column, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(_id, _text, _y) of the labelled rows in the training folds; null labels are no labels.

    Repeated label rows of an id are averaged and rounded (a tie counts as 1), so that the join
    does not multiply texts. Labels have no size bound, so texts and labels are shuffled alike at
    any size; a filter of fixed size over the labelled ids keeps other texts out of the shuffle.
    """
    spark = docs.sparkSession
    known = land(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & in_training)
                 .groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_y")), "labels_known")
    bits = spark.sparkContext.broadcast(bit_filter(known.select(F.xxhash64("_id").alias("_h")), "_h"))

    @F.pandas_udf("boolean")
    def labelled(h: pd.Series) -> pd.Series:
        return pd.Series(passes(bits.value, h.to_numpy().view(np.uint64)))

    texts = docs.where(in_training).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.where(labelled(F.xxhash64("_id"))).join(known.hint("merge"), "_id")


def bounded_sample(rows: DataFrame, known: int, bound: int, salt: str) -> DataFrame:
    """About ``bound`` of ``known`` rows, by a hash threshold on the id; all of them if they are fewer."""
    share = 1 << 30 if known <= bound else max(1, (bound << 30) // known)
    return rows.where(F.pmod(F.xxhash64("_id", F.lit(salt)), F.lit(1 << 30)) < share)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Coefficients of P(y | x) by Newton steps, the offset last; ``x`` is (rows, features).

    Targets keep off 0 and 1, so that the fit exists for separable rows. No feature may count
    against the label: one whose coefficient is negative is left out and the rest fitted anew.
    """
    weight = np.ones(len(x)) if weight is None else weight
    good, bad = weight[y].sum(), weight[~y].sum()
    goal = np.where(y, (good + 1) / (good + 2), 1 / (bad + 2))
    used = list(range(x.shape[1]))
    while True:
        z = np.column_stack([x[:, used], np.ones(len(x))])
        ridge = 1e-3

        def loss(b: np.ndarray) -> float:
            m = z @ b
            return float(weight @ (np.logaddexp(0, m) - goal * m) + ridge / 2 * b @ b)

        b = np.zeros(z.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            q = np.maximum(weight * p * (1 - p), 1e-9)
            step = np.linalg.solve((z.T * q) @ z + ridge * np.eye(len(b)), z.T @ (weight * (p - goal)) + ridge * b)
            size, here = 1.0, loss(b)
            while size > 1e-6 and loss(b - size * step) > here:
                size /= 2
            b = b - size * step
            if abs(size * step).max() < 1e-6:
                break
        worst = int(np.argmin(b[:-1])) if used else 0
        if not used or b[worst] >= 0:
            out = np.zeros(x.shape[1] + 1)
            out[used], out[-1] = b[:-1], b[-1]
            return out
        used.pop(worst)
