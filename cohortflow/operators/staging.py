"""stg_events: deduplicate, type and flatten the raw event stream.

Dedup keeps one row per (user_pseudo_id, event_timestamp, event_name): the
lowest bundle sequence id, then the lowest server offset, NULLs last, then the
smallest of the remaining columns in turn, so that copies which differ anywhere
give one answer in any order. ``row_number() == 1`` plans as a
WindowGroupLimit with a *partial* limit before the shuffle, so even a group
holding a large share of the rows is cut to one row per map task before it
moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.functions.numeric import to_dec4
from cohortflow.functions.params import param_int, param_string
from cohortflow.sources.schema import EVENT_KEY, STAGING_COLUMN_NAMES

#: Which copy of an event stays: the two sequence numbers, then every other staging column, so that the
#: answer depends on the copies alone and never on the order they arrive in.
_FIRST = ("event_bundle_sequence_id", "event_server_timestamp_offset", "event_value_in_usd", "event_date")
DEDUP_ORDER = (*_FIRST, *(c for c in STAGING_COLUMN_NAMES if c not in (*_FIRST, *EVENT_KEY, "event_ts_utc", "event_date_utc")))

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ts_from_micros(col: str = "event_timestamp"):
    """BIGINT micros since epoch -> naive UTC timestamp (session-TZ independent)."""
    return F.expr(f"timestampadd(MICROSECOND, {col}, {EPOCH_NTZ})")


def utc_date(ts_ntz):
    return ts_ntz.cast("date")


def typed_projection(deduped: DataFrame) -> DataFrame:
    """Deduplicated raw events -> the 21 staging columns, in contract order."""
    ts = ts_from_micros("event_timestamp")
    bag = F.col("event_params")
    return deduped.select(
        F.col("event_date"),
        F.col("event_timestamp"),
        ts.alias("event_ts_utc"),
        utc_date(ts).alias("event_date_utc"),
        F.col("event_name"),
        F.col("user_pseudo_id"),
        F.col("platform"),
        to_dec4(F.col("event_value_in_usd")).alias("event_value_in_usd"),
        F.col("event_previous_timestamp"),
        F.col("event_bundle_sequence_id"),
        F.col("event_server_timestamp_offset"),
        param_int(bag, C.ENGAGEMENT_KEY).alias("engagement_time_msec"),
        param_string(bag, C.SCREEN_CLASS_KEY).alias("screen_class"),
        param_int(bag, C.PREVIOUS_FIRST_OPEN_KEY).alias("previous_first_open_count"),
        param_int(bag, C.SESSION_ID_KEY).alias("ga_session_id"),
        F.col("device.category").alias("device_category"),
        F.nullif(F.col("device.operating_system"), F.lit(C.NAN_LITERAL)).alias("device_os"),
        F.col("geo.country").alias("country"),
        F.col("app_info.id").alias("app_id"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("traffic_source_name"),
    )


def stg_events(raw: DataFrame) -> DataFrame:
    """Typed projection first (row-local), then the dedup window.

    Projecting before the exchange means the dedup shuffle carries the 21 flat
    staging columns instead of the raw nested bags (``event_params``,
    ``user_properties``, the struct columns). All dedup keys and tie-breaks
    are staging columns, and rounding the value to (18,4) is monotonic, so the
    surviving row is the same.
    """
    out = dedup_staged(typed_projection(raw))
    assert tuple(out.columns) == STAGING_COLUMN_NAMES
    return out


def dedup_staged(stg: DataFrame) -> DataFrame:
    """Re-apply the staging dedup to already typed rows (incremental merges)."""
    w = Window.partitionBy(*EVENT_KEY).orderBy(*[F.col(c).asc_nulls_last() for c in DEDUP_ORDER])
    return stg.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def duplicate_keys(raw: DataFrame) -> DataFrame:
    """Event keys present more than once (``group by … having count(*) > 1``)."""
    return (raw.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("copies"))
               .where(F.col("copies") > 1))
