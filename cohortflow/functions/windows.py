"""Window-column builders: running sums, trailing baselines, revenue metrics.

Each returns a ``Column`` so callers compose them in one ``select``; Catalyst
merges expressions sharing a window spec into a single Window operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.functions.numeric import DEC4, avg_dec4, avg_double_dec4, ratio, to_dec4


def _cols(partition_by: Sequence[str] | str) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def cum_window(partition_by: Sequence[str] | str, order_by: str = "day_number"):
    return (Window.partitionBy(*_cols(partition_by)).orderBy(F.col(order_by).asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def trailing_window(partition_by: Sequence[str] | str, rows: int = C.TRAILING_COHORTS,
                    order_by: str = "cohort_date"):
    """``rows`` preceding .. 1 preceding cohort rows (current row excluded)."""
    return (Window.partitionBy(*_cols(partition_by)).orderBy(F.col(order_by).asc())
            .rowsBetween(-rows, -1))


def cum_sum(col: str | Column, partition_by: Sequence[str] | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).over(cum_window(partition_by))


def trailing_avg(col: str, partition_by: Sequence[str] | str, rows: int = C.TRAILING_COHORTS,
                 decimal_input: bool = False) -> Column:
    """Trailing average rounded to decimal(18,4); NULL for the first cohort."""
    w = trailing_window(partition_by, rows)
    return avg_dec4(F.col(col), w) if decimal_input else avg_double_dec4(F.col(col), w)


def revenue_metrics_columns(partition_by: Sequence[str] | str) -> list[Column]:
    """cum_revenue, cum_paying_users, cum_arpu, cum_arppu, paying_share.

    Expects ``gross_revenue`` (decimal(18,4)), ``paying_users`` (bigint) and
    ``cohort_size`` in the input. ``cum_paying_users`` sums paying user-days,
    so ``paying_share`` may exceed 1 by design.
    """
    cum_rev = cum_sum("gross_revenue", partition_by).cast(DEC4)
    cum_pay = cum_sum("paying_users", partition_by)
    size = F.col("cohort_size")
    return [
        cum_rev.alias("cum_revenue"),
        cum_pay.alias("cum_paying_users"),
        to_dec4(ratio(cum_rev, size)).alias("cum_arpu"),
        F.when(cum_pay != 0, to_dec4(ratio(cum_rev, cum_pay))).alias("cum_arppu"),
        to_dec4(ratio(cum_pay, size)).alias("paying_share"),
    ]
