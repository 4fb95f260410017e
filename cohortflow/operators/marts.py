"""Dense cohort marts: retention and monetization, overall or by any slice.

One builder per metric family; ``slice_cols`` selects the grain (``[]`` =
overall, ``["install_platform"]`` = by platform, country, medium, ...).
Inputs are the user dimension and the enriched sparse fact. The fact is
unique per (user, activity_date) and day_number is a function of
activity_date per user, so per (cohort, slice, day) ``count(*)`` equals
``count(distinct user)`` — which lets Spark pre-aggregate map-side instead of
shuffling every fact row for a distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.functions.numeric import DEC4, ratio, to_dec4
from cohortflow.functions.windows import revenue_metrics_columns, trailing_avg
from cohortflow.operators.spine import day_number_array

RETENTION_TAIL = ("cohort_size", "retained_users", "retention_pct", "retention_pct_trailing_4w_avg")
REVENUE_TAIL = ("cohort_size", "gross_revenue", "paying_users", "cum_revenue", "cum_paying_users",
                "cum_arpu", "cum_arppu", "paying_share", "cum_arpu_trailing_4w_avg",
                "paying_share_trailing_4w_avg")


def _normalize_slices(df: DataFrame, slice_cols: Sequence[str], null_label: str | None) -> DataFrame:
    if not null_label or not slice_cols:
        return df
    return df.select(*[F.coalesce(F.col(c), F.lit(null_label)).alias(c) if c in slice_cols else F.col(c)
                       for c in df.columns])


def cohort_grid(dim: DataFrame, slice_cols: Sequence[str] = (), max_day: int = C.MAX_DAY_NUMBER,
                null_label: str | None = None) -> DataFrame:
    """(cohort_date, *slices, day_number, cohort_size) for every day 0..max_day."""
    return _dense(cohort_sizes(dim, slice_cols, null_label), slice_cols, max_day)


def _dense(sizes: DataFrame, slice_cols: Sequence[str], max_day: int) -> DataFrame:
    return sizes.select("cohort_date", *slice_cols, F.explode(day_number_array(max_day)).alias("day_number"), "cohort_size")


def _in_window(fact: DataFrame, max_day: int) -> DataFrame:
    return fact.where(F.col("day_number").between(0, max_day))


def cohort_sizes(dim: DataFrame, slice_cols: Sequence[str] = (), null_label: str | None = None) -> DataFrame:
    users = _normalize_slices(dim.select("cohort_date", *slice_cols), slice_cols, null_label)
    return users.groupBy("cohort_date", *slice_cols).agg(F.count(F.lit(1)).alias("cohort_size"))


def retention_mart(dim: DataFrame, fact: DataFrame, slice_cols: Sequence[str] = (),
                   max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS, null_label: str | None = None) -> DataFrame:
    keys = ["cohort_date", *slice_cols, "day_number"]
    f = _normalize_slices(_in_window(fact, max_day).select(*keys), slice_cols, null_label)
    retained = f.groupBy(*keys).agg(F.count(F.lit(1)).alias("retained_users"))
    return retention_metrics(cohort_sizes(dim, slice_cols, null_label), retained, slice_cols, max_day, trailing)


def retention_metrics(sizes: DataFrame, cells: DataFrame, slice_cols: Sequence[str] = (),
                      max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS) -> DataFrame:
    """The mart from cohort sizes and the non-empty (cohort, slice, day) cells' ``retained_users``."""
    slice_cols = list(slice_cols)
    keys = ["cohort_date", *slice_cols, "day_number"]
    joined = _dense(sizes, slice_cols, max_day).join(cells, keys, "left").select(
        *keys, "cohort_size",
        F.coalesce(F.col("retained_users"), F.lit(0)).alias("retained_users"),
    ).withColumn("retention_pct", ratio(F.col("retained_users"), F.col("cohort_size")))
    return joined.select(
        *keys, "cohort_size", "retained_users", "retention_pct",
        trailing_avg("retention_pct", ["day_number", *slice_cols], trailing).alias("retention_pct_trailing_4w_avg"),
    )


def revenue_mart(dim: DataFrame, fact: DataFrame, slice_cols: Sequence[str] = (),
                 max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS, null_label: str | None = None) -> DataFrame:
    keys = ["cohort_date", *slice_cols, "day_number"]
    f = _normalize_slices(_in_window(fact, max_day).select(*keys, "gross_revenue", "paying_flag"),
                          slice_cols, null_label)
    daily = f.groupBy(*keys).agg(
        F.sum("gross_revenue").cast(DEC4).alias("gross_revenue"),
        F.count_if(F.col("paying_flag")).alias("paying_users"),
    )
    return revenue_metrics(cohort_sizes(dim, slice_cols, null_label), daily, slice_cols, max_day, trailing)


def revenue_metrics(sizes: DataFrame, cells: DataFrame, slice_cols: Sequence[str] = (),
                    max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS) -> DataFrame:
    """The mart from cohort sizes and the cells' ``gross_revenue`` and ``paying_users``."""
    slice_cols = list(slice_cols)
    keys = ["cohort_date", *slice_cols, "day_number"]
    joined = _dense(sizes, slice_cols, max_day).join(cells, keys, "left").select(
        *keys, "cohort_size",
        F.coalesce(F.col("gross_revenue"), F.lit(0)).cast(DEC4).alias("gross_revenue"),
        F.coalesce(F.col("paying_users"), F.lit(0)).alias("paying_users"),
    )
    metrics = joined.select(*keys, "cohort_size", "gross_revenue", "paying_users",
                            *revenue_metrics_columns(["cohort_date", *slice_cols]))
    part = ["day_number", *slice_cols]
    return metrics.select(
        *metrics.columns,
        trailing_avg("cum_arpu", part, trailing, decimal_input=True).alias("cum_arpu_trailing_4w_avg"),
        trailing_avg("paying_share", part, trailing, decimal_input=True).alias("paying_share_trailing_4w_avg"),
    )


def engagement_mart(dim: DataFrame, fact: DataFrame, slice_cols: Sequence[str] = (),
                    max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS) -> DataFrame:
    """Documented extension: engagement seconds per cohort user by day number."""
    slice_cols = list(slice_cols)
    keys = ["cohort_date", *slice_cols, "day_number"]
    grid = cohort_grid(dim, slice_cols, max_day)
    daily = _in_window(fact, max_day).groupBy(*keys).agg(
        F.sum("engagement_sec").cast(DEC4).alias("engagement_sec"),
        F.sum("n_sessions_proxy").alias("sessions"),
    )
    joined = grid.join(daily, keys, "left").select(
        *keys, "cohort_size",
        F.coalesce(F.col("engagement_sec"), F.lit(0)).cast(DEC4).alias("engagement_sec"),
        F.coalesce(F.col("sessions"), F.lit(0)).alias("sessions"),
    ).withColumn("engagement_sec_per_user", to_dec4(ratio(F.col("engagement_sec"), F.col("cohort_size"))))
    return joined.select(
        *joined.columns,
        trailing_avg("engagement_sec_per_user", ["day_number", *slice_cols], trailing,
                     decimal_input=True).alias("engagement_sec_per_user_trailing_4w_avg"),
    )


def weekly_triangle(dim: DataFrame, fact: DataFrame, weeks: int = 5) -> DataFrame:
    """Documented extension: weekly-grain triangle — cohort week x week number
    (users active at least once in that week since install / cohort-week size)."""
    wk = F.date_trunc("week", F.col("cohort_date")).cast("date")
    sizes = dim.groupBy(wk.alias("cohort_week")).agg(F.count(F.lit(1)).alias("cohort_size"))
    active = (fact.where(F.col("day_number").between(0, 7 * weeks - 1))
                  .select(wk.alias("cohort_week"), F.floor(F.col("day_number") / 7).cast("int").alias("week_number"),
                          "user_pseudo_id")
                  .groupBy("cohort_week", "week_number").agg(F.count_distinct("user_pseudo_id").alias("retained")))
    piv = active.groupBy("cohort_week").pivot("week_number", list(range(weeks))).agg(F.first("retained"))
    out = sizes.join(piv, "cohort_week", "left")
    return out.select("cohort_week", "cohort_size",
                      *[(F.col(str(w)).cast("double") / F.col("cohort_size")).alias(f"w{w}") for w in range(weeks)])


def with_user_slice(dim: DataFrame, fact: DataFrame, slice_df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Attach a user-grain slice column (e.g. an experiment arm) to both the
    dimension and the fact, for any builder above."""
    s = slice_df.select("user_pseudo_id", col)
    return dim.join(s, "user_pseudo_id", "left"), fact.join(s, "user_pseudo_id", "left")


def with_observed(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Optional right-censoring flag: a cell is observed when its calendar day
    (cohort_date + day_number) is not after the last activity date in the
    data. Censored cells keep their 0 values (and still feed the trailing
    baselines, as in the reference); the flag lets readers mask them."""
    last = fact.agg(F.max("activity_date")).scalar()
    return mart.withColumn("is_observed", F.date_add(F.col("cohort_date"), F.col("day_number")) <= last)
