"""Declared schemas: raw event contract and the fixed staging projection."""

from __future__ import annotations

from pyspark.sql import types as T

from cohortflow.constants import PLATFORMS

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("float_value", T.DoubleType()),
    T.StructField("double_value", T.DoubleType()),
])

USER_PROPERTY_VALUE = T.StructType(PARAM_VALUE.fields + [
    T.StructField("set_timestamp_micros", T.LongType()),
])

PARAM_BAG = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
]))

USER_PROPERTY_BAG = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", USER_PROPERTY_VALUE),
]))

RAW_EVENTS = T.StructType([
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.LongType(), False),
    T.StructField("event_name", T.StringType(), False),
    T.StructField("event_params", PARAM_BAG),
    T.StructField("event_previous_timestamp", T.LongType()),
    T.StructField("event_value_in_usd", T.DoubleType()),
    T.StructField("event_bundle_sequence_id", T.LongType()),
    T.StructField("event_server_timestamp_offset", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType(), False),
    T.StructField("user_properties", USER_PROPERTY_BAG),
    T.StructField("user_first_touch_timestamp", T.LongType()),
    T.StructField("user_ltv", T.StructType([
        T.StructField("revenue", T.DoubleType()),
        T.StructField("currency", T.StringType()),
    ])),
    T.StructField("device", T.StructType([
        T.StructField("category", T.StringType()),
        T.StructField("operating_system", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("mobile_brand_name", T.StringType()),
    ])),
    T.StructField("geo", T.StructType([
        T.StructField("country", T.StringType()),
        T.StructField("continent", T.StringType()),
        T.StructField("city", T.StringType()),
    ])),
    T.StructField("app_info", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("version", T.StringType()),
    ])),
    T.StructField("traffic_source", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("medium", T.StringType()),
        T.StructField("source", T.StringType()),
    ])),
    T.StructField("stream_id", T.StringType()),
    T.StructField("platform", T.StringType()),
])

# Grain of the raw stream and of staging.
EVENT_KEY = ("user_pseudo_id", "event_timestamp", "event_name")

# Staging output, in order (the tuple the loaders pin and check for drift).
STAGING_COLUMNS = (
    ("event_date", "string"),
    ("event_timestamp", "bigint"),
    ("event_ts_utc", "timestamp_ntz"),
    ("event_date_utc", "date"),
    ("event_name", "string"),
    ("user_pseudo_id", "string"),
    ("platform", "string"),
    ("event_value_in_usd", "decimal(18,4)"),
    ("event_previous_timestamp", "bigint"),
    ("event_bundle_sequence_id", "bigint"),
    ("event_server_timestamp_offset", "bigint"),
    ("engagement_time_msec", "bigint"),
    ("screen_class", "string"),
    ("previous_first_open_count", "bigint"),
    ("ga_session_id", "bigint"),
    ("device_category", "string"),
    ("device_os", "string"),
    ("country", "string"),
    ("app_id", "string"),
    ("traffic_medium", "string"),
    ("traffic_source_name", "string"),
)

STAGING_COLUMN_NAMES = tuple(n for n, _ in STAGING_COLUMNS)

ACCEPTED_PLATFORMS = PLATFORMS
