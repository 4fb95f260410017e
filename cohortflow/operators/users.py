"""User-grain operators: install attributes and the user dimension.

All user-level facts come from the user-day rollup (``daily.user_day_rollup``)
rather than from the event stream: that rollup is already pre-aggregated
map-side, so a user holding a third of all events costs one row per day here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.operators.quantiles import exact_percentiles

INSTALL_COLUMNS = ("user_pseudo_id", "cohort_date", "install_platform", "install_country",
                   "install_traffic_medium", "install_app_id", "first_event_name",
                   "is_reinstall", "events_total")

DIM_COLUMNS = INSTALL_COLUMNS[:-1] + ("is_outlier_events",)


def int_user_install(rollup: DataFrame) -> DataFrame:
    """(user, day) rollup -> one row per user.

    cohort_date = first UTC activity date; attributes from the first event
    ordered by (ts, event_name, bundle NULLS LAST, offset NULLS LAST) — the
    per-day ``first_event`` struct carries exactly that order, so a ``min``
    over days is the global first event.
    """
    first = F.min("first_event")
    return rollup.groupBy("user_pseudo_id").agg(
        F.min("activity_date").alias("cohort_date"),
        first.alias("_first"),
        F.coalesce(F.bool_or("reinstall_seen"), F.lit(False)).alias("is_reinstall"),
        F.sum("events").alias("events_total"),
    ).select(
        "user_pseudo_id", "cohort_date",
        F.col("_first.platform").alias("install_platform"),
        F.col("_first.country").alias("install_country"),
        F.col("_first.traffic_medium").alias("install_traffic_medium"),
        F.col("_first.app_id").alias("install_app_id"),
        F.col("_first.event_name").alias("first_event_name"),
        "is_reinstall", "events_total",
    )


def events_p99(install: DataFrame, p: float = C.OUTLIER_PERCENTILE) -> DataFrame:
    """Exact interpolated percentile of events_total, as a one-row frame.

    Distributed (``quantiles.exact_percentiles``): histogram by value, then
    order-preserving bins, so no task buffers all distinct values.
    """
    return exact_percentiles(install, "events_total", [p], ["events_p99"])


def dim_users(install: DataFrame, p: float = C.OUTLIER_PERCENTILE) -> DataFrame:
    """User dimension with the strict ``events_total > p99`` outlier flag.

    The p99 is a scalar subquery (evaluated once, inlined as a value), not a
    cross join.
    """
    p99 = events_p99(install, p).scalar()
    return install.select(
        *INSTALL_COLUMNS[:-1],
        (F.col("events_total") > p99).alias("is_outlier_events"),
    )


def with_left_censored(dim: DataFrame, first_data_date) -> DataFrame:
    """Documented extension: flag users whose cohort is the first data day
    (their true install may precede the window)."""
    return dim.withColumn("is_left_censored", F.col("cohort_date") == first_data_date)


def install_user_property(raw: DataFrame, key: str, out_col: str) -> DataFrame:
    """Per user: the value of user property ``key`` on the earliest event that
    carries it (A/B arm, tier …). Pre-aggregated map-side per user."""
    from cohortflow.functions.params import user_property
    v = user_property("user_properties", key)
    first = raw.where(v.isNotNull()).groupBy("user_pseudo_id").agg(
        F.min(F.struct(F.col("event_timestamp"), v.alias("v"))).alias("_f"))
    return first.select("user_pseudo_id", F.col("_f.v").alias(out_col))
