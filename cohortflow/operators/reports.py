"""Report (dashboard) queries over the marts.

Dashboards only ``SELECT … WHERE`` on marts; these functions are those
selects. The default cohort is the latest one whose whole D0..Dmax window lies
in the data (``cohort_date <= max(activity_date) - max_day``); it is published
as a one-row table beside the marts (``Pipeline.report_dates``) and read as a
scalar subquery, never collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.functions.numeric import agg_avg_exact, avg_dec4, safe_ratio

DAY_AXIS = C.DAY_AXIS
HEADER_RETENTION_DAYS = C.HEADER_RETENTION_DAYS
HEADLINE_DAY = C.HEADLINE_DAY
BASELINE_DAYS = C.BASELINE_CALENDAR_DAYS
NOISE_THRESHOLDS = C.NOISE_THRESHOLDS
COMPARISON_WEEKS = C.COMPARISON_WEEKS


def max_full_cohort(report_dates: DataFrame) -> Column:
    """Scalar: the default report cohort."""
    return report_dates.select("selected_cohort").scalar()


def rpt_header_retention(ret: DataFrame, cohort: Column) -> DataFrame:
    return ret.where((F.col("cohort_date") == cohort) & F.col("day_number").isin(*HEADER_RETENTION_DAYS)).select(
        "day_number", "retention_pct",
        F.col("retention_pct_trailing_4w_avg").cast("double").alias("baseline"))


def rpt_header_revenue(rev: DataFrame, cohort: Column) -> DataFrame:
    return rev.where((F.col("cohort_date") == cohort) & (F.col("day_number") == HEADLINE_DAY)).select(
        F.col("cum_arpu").cast("double").alias("cum_arpu"),
        F.col("cum_arpu_trailing_4w_avg").cast("double").alias("cum_arpu_baseline"),
        F.col("paying_share").cast("double").alias("paying_share"))


def calendar_baseline(rev: DataFrame, cohort: Column, col: str = "paying_share",
                      day: int = HEADLINE_DAY, days: int = BASELINE_DAYS) -> Column:
    """Average of ``col`` over cohorts in the ``days`` calendar days before
    ``cohort`` (a calendar window, unlike the 28-row trailing column), unrounded."""
    return rev.where((F.col("day_number") == day) & (F.col("cohort_date") < cohort)
                     & (F.col("cohort_date") >= F.date_sub(cohort, days))).agg(
        agg_avg_exact(F.col(col))).scalar()


def rpt_header_pay_baseline(rev: DataFrame, cohort: Column) -> DataFrame:
    return rev.sparkSession.range(1).select(calendar_baseline(rev, cohort).alias("paying_share_baseline"))


def _status(delta: Column, threshold: Column) -> Column:
    return (F.when(delta.isNull(), F.lit("no baseline"))
             .when(F.abs(delta) < threshold, F.lit("neutral"))
             .when(delta > 0, F.lit("up")).otherwise(F.lit("down")))


def rpt_kpi_deltas(ret: DataFrame, rev: DataFrame, cohort: Column) -> DataFrame:
    """Header tiles: value, baseline, delta and up/down/neutral status."""
    r = ret.where((F.col("cohort_date") == cohort) & F.col("day_number").isin(*HEADER_RETENTION_DAYS)).select(
        F.concat(F.lit("D"), F.col("day_number").cast("string"), F.lit(" retention")).alias("kpi"),
        F.col("retention_pct").alias("value"),
        F.col("retention_pct_trailing_4w_avg").cast("double").alias("baseline"),
        F.lit(NOISE_THRESHOLDS["retention"]).alias("threshold"))
    d7 = rev.where((F.col("cohort_date") == cohort) & (F.col("day_number") == HEADLINE_DAY))
    arpu = d7.select(F.lit(f"ARPU @ D{HEADLINE_DAY}").alias("kpi"), F.col("cum_arpu").cast("double").alias("value"),
                     F.col("cum_arpu_trailing_4w_avg").cast("double").alias("baseline"),
                     F.lit(NOISE_THRESHOLDS["arpu"]).alias("threshold"))
    share = d7.select(F.lit(f"Pay share @ D{HEADLINE_DAY}").alias("kpi"),
                      F.col("paying_share").cast("double").alias("value"),
                      calendar_baseline(rev, cohort).cast("double").alias("baseline"),
                      F.lit(NOISE_THRESHOLDS["paying_share"]).alias("threshold"))
    tiles = arpu.unionByName(share).unionByName(r)
    delta = F.col("value") - F.col("baseline")
    return tiles.select("kpi", "value", "baseline", delta.alias("delta"), "threshold").select(
        "kpi", "value", "baseline", "delta", _status(F.col("delta"), F.col("threshold")).alias("status"))


def rpt_cohort_triangle(ret: DataFrame, days: Sequence[int] = DAY_AXIS) -> DataFrame:
    """Cohort x {D0, D1, D3, D7, D14, D30} retention matrix with sizes (pivot
    with explicit values: no extra job to discover the pivot columns)."""
    src = ret.where(F.col("day_number").isin(*days))
    out = src.groupBy("cohort_date", "cohort_size").pivot("day_number", list(days)).agg(F.first("retention_pct"))
    return out.select("cohort_date", "cohort_size", *[F.col(str(d)).alias(f"d{d}") for d in days])


def rpt_current_vs_baseline(mart: DataFrame, cohort: Column, value: str, baseline: str,
                            days: Sequence[int] = DAY_AXIS) -> DataFrame:
    return mart.where((F.col("cohort_date") == cohort) & F.col("day_number").isin(*days)).select(
        "day_number", F.col(value).cast("double").alias("selected"),
        F.col(baseline).cast("double").alias("baseline"))


def is_comparison_cohort(cohort: Column, weeks: int = COMPARISON_WEEKS) -> Column:
    """Default pick: the selected cohort and the same weekday 1..weeks-1 weeks back."""
    return F.datediff(cohort, F.col("cohort_date")).isin(*[7 * k for k in range(weeks)])


def rpt_cohort_series_weekly(ret: DataFrame, cohort: Column, weeks: int = COMPARISON_WEEKS) -> DataFrame:
    return ret.where((F.col("day_number") == 0) & is_comparison_cohort(cohort, weeks)).select("cohort_date", "cohort_size")


def rpt_cohort_curves(rev: DataFrame, cohort: Column, days: Sequence[int] = DAY_AXIS,
                      weeks: int = COMPARISON_WEEKS) -> DataFrame:
    return rev.where(is_comparison_cohort(cohort, weeks) & F.col("day_number").isin(*days)).select(
        "cohort_date", "day_number", F.col("cum_arpu").cast("double").alias("cum_arpu"),
        F.col("paying_share").cast("double").alias("paying_share"))


def week_start(c: Column) -> Column:
    """Monday of the week, as a DATE."""
    return F.date_trunc("week", c).cast("date")


def without_first_cohort(mart: DataFrame) -> DataFrame:
    """Left out of averages over a period: the first cohort, whose users are all "new" by construction."""
    return mart.where(F.col("cohort_date") > mart.agg(F.min("cohort_date")).scalar())


def rpt_d7_weekly(ret: DataFrame, slice_cols: Sequence[str] = (), day: int = HEADLINE_DAY,
                  left_censored: bool = True) -> DataFrame:
    """Cohort-size-weighted D7 retention per cohort week (ratio of sums)."""
    ret = ret if left_censored else without_first_cohort(ret)
    return ret.where(F.col("day_number") == day).groupBy(
        week_start(F.col("cohort_date")).alias("week"), *slice_cols).agg(
        safe_ratio(F.sum("retained_users"), F.sum("cohort_size")).alias("ret"))


def rpt_platform_revenue_weighted(rev_by_platform: DataFrame, days: Sequence[int] = DAY_AXIS) -> DataFrame:
    return rev_by_platform.where(F.col("day_number").isin(*days)).groupBy("install_platform", "day_number").agg(
        safe_ratio(F.sum("cum_revenue"), F.sum("cohort_size")).alias("cum_arpu_w"),
        safe_ratio(F.sum("cum_paying_users"), F.sum("cohort_size")).alias("paying_share_w"))


def rpt_period_retention(ret: DataFrame, days: Sequence[int] = DAY_AXIS, left_censored: bool = False) -> DataFrame:
    """Cohort-size-weighted retention of the whole period by day number, without the first cohort."""
    ret = ret if left_censored else without_first_cohort(ret)
    return ret.where(F.col("day_number").isin(*days)).groupBy("day_number").agg(
        safe_ratio(F.sum("retained_users"), F.sum("cohort_size")).alias("ret"))


def latest_n_cohorts(ret: DataFrame, report_dates: DataFrame, n: int = 5, window: int = HEADLINE_DAY) -> DataFrame:
    """Top-k report: the n latest cohorts with full ``window``-day follow-up."""
    last_activity = report_dates.select("max_activity_date").scalar()
    cohorts = ret.where("day_number = 0").select("cohort_date", "cohort_size")
    return (cohorts.where(F.col("cohort_date") <= F.date_sub(last_activity, window))
                   .orderBy(F.col("cohort_date").desc()).limit(n))


def top_n_plus_other(dim: DataFrame, col: str = "install_country", n: int = C.TOP_N_COUNTRIES,
                     other: str = C.OTHER_LABEL, out_col: str | None = None) -> DataFrame:
    """Replace ``col`` by itself for its n most common values, else ``other``.

    The ranking runs over the per-value counts (one row per distinct value);
    the n winners are joined back by value. NULL joins as ``other``.
    """
    out_col = out_col or f"{col}_top{n}"
    counts = dim.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where(F.col(col).isNotNull())
    # distributed top-k (per-partition top n, then a merge of n rows each)
    top = counts.orderBy(F.col("_n").desc(), F.col(col).asc()).limit(n).select(F.col(col).alias("_top_value"))
    joined = dim.join(top, dim[col] == top["_top_value"], "left")
    return joined.select(*dim.columns, F.coalesce(F.col("_top_value"), F.lit(other)).alias(out_col))


def baseline_calendar_28d(rev: DataFrame, col: str = "paying_share", days: int = BASELINE_DAYS,
                          slice_cols: Sequence[str] = ()) -> DataFrame:
    """For every cohort row: average of ``col`` over cohorts in the ``days``
    calendar days before it, same day number (RANGE frame on the day index)."""
    w = (Window.partitionBy("day_number", *slice_cols).orderBy(F.unix_date(F.col("cohort_date")))
         .rangeBetween(-days, -1))
    return rev.select("cohort_date", *slice_cols, "day_number", col,
                      avg_dec4(F.col(col), w).alias(f"{col}_calendar_{days}d"))
