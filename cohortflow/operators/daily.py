"""User-day operators: the one pass over staging, activity, revenue, the fact.

``user_day_rollup`` is the only aggregation that reads events. It folds every
per-user-day measure *and* the day's first-event struct into one aggregate, so
Spark pre-aggregates map-side and shuffles user-day rows, never events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.functions.numeric import DEC4, to_dec4

PURCHASE_EVENT = C.PURCHASE_EVENT
SESSION_EVENT = C.SESSION_EVENT
MAX_LONG = 9223372036854775807

FACT_COLUMNS = ("user_pseudo_id", "cohort_date", "activity_date", "day_number", "events",
                "engagement_sec", "n_sessions_proxy", "gross_revenue", "n_purchases", "paying_flag")


def first_event_struct():
    """Ordering of the install event: ts, name, bundle / offset NULLS LAST, then
    the attributes themselves as a final deterministic tie-break."""
    return F.struct(
        F.col("event_timestamp").alias("ts"),
        F.col("event_name").alias("event_name"),
        F.coalesce(F.col("event_bundle_sequence_id"), F.lit(MAX_LONG)).alias("bundle"),
        F.coalesce(F.col("event_server_timestamp_offset"), F.lit(MAX_LONG)).alias("offset"),
        F.col("platform").alias("platform"),
        F.col("country").alias("country"),
        F.col("traffic_medium").alias("traffic_medium"),
        F.col("app_id").alias("app_id"),
    )


def user_day_rollup(stg: DataFrame) -> DataFrame:
    is_purchase = F.col("event_name") == F.lit(PURCHASE_EVENT)
    return stg.groupBy("user_pseudo_id", F.col("event_date_utc").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.coalesce(F.col("engagement_time_msec"), F.lit(0))).alias("engagement_msec"),
        F.count_if(F.col("event_name") == F.lit(SESSION_EVENT)).alias("n_sessions_proxy"),
        F.sum(F.when(is_purchase, F.col("event_value_in_usd"))).alias("gross_revenue_raw"),
        F.count_if(is_purchase).alias("n_purchases"),
        F.min(first_event_struct()).alias("first_event"),
        F.bool_or(F.col("previous_first_open_count") > 0).alias("reinstall_seen"),
    )


def int_user_daily_activity(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        "user_pseudo_id", "activity_date", "events",
        to_dec4(F.col("engagement_msec").cast("double") / F.lit(1000.0)).alias("engagement_sec"),
        "n_sessions_proxy",
    )


def int_user_daily_revenue(rollup: DataFrame) -> DataFrame:
    """Purchase days only; gross_revenue stays NULL when every value was NULL."""
    return rollup.where(F.col("n_purchases") > 0).select(
        "user_pseudo_id", "activity_date",
        F.col("gross_revenue_raw").cast(DEC4).alias("gross_revenue"),
        "n_purchases",
    )


def fact_enriched(rollup: DataFrame, install: DataFrame) -> DataFrame:
    """Sparse fact (row presence = active) plus the user's install attributes
    (slice columns for the marts, so they never re-join the dimension).

    Both inputs are keyed by user; the rollup is co-partitioned by user once,
    and the install aggregate and the join reuse that partitioning.
    """
    gross = F.coalesce(F.col("gross_revenue_raw"), F.lit(0)).cast(DEC4)
    return rollup.join(install, "user_pseudo_id", "inner").select(
        "user_pseudo_id", "cohort_date", "activity_date",
        F.datediff("activity_date", "cohort_date").alias("day_number"),
        "events",
        to_dec4(F.col("engagement_msec").cast("double") / F.lit(1000.0)).alias("engagement_sec"),
        "n_sessions_proxy",
        gross.alias("gross_revenue"),
        "n_purchases",
        (gross > 0).alias("paying_flag"),
        "install_platform", "install_country", "install_traffic_medium", "install_app_id",
        "first_event_name", "is_reinstall",
    )


def fct_user_daily(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)
