"""Adapter: driver tables -> raw event stream shaped like the source contract.

The driver's ``events`` table has flat, duplicate-free rows whose users almost
all start on the same day, which is useless for cohorts. The adapter keeps
every row and stays deterministic: it staggers installs by shifting each
user's timeline by ``user_id % STAGGER_DAYS`` days, and it injects duplicates
(some with a NULL bundle id so NULLS LAST matters), NULL-valued purchases,
parameter bags (with empty bags), platforms, countries, traffic media and
literal 'NaN' OS values.

The rules live here once, as constants; ``adapt_events`` renders them as a
Spark plan and ``adapter_sql`` as DuckDB SQL for the oracle.

A second source maps ``orders`` x ``customer`` onto the same contract
(user = customer, one purchase event per order, platform = market segment),
which gives ~7 years of cohorts so the 28-cohort trailing windows fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.session import path_bytes
from cohortflow.sources.schema import PARAM_BAG, RAW_EVENTS, USER_PROPERTY_BAG

# ---- fixed values of the mapping -------------------------------------------
START_DATE = "2024-01-01"
STAGGER_DAYS = 20            # each user's timeline is shifted by user_id % STAGGER_DAYS days
LOCAL_TZ_OFFSET_HOURS = 7    # event_date is the local date at UTC-7
EVENT_NAME_MAP = {           # driver event_type -> source event_name
    "purchase": "in_app_purchase",
    "signup": "first_open",
    "click": "session_start",
    "view": "screen_view",
    "error": "user_engagement",
}
NULL_VALUE_EVERY = 11        # purchases with event_id % 11 = 0 carry no value
NULL_BUNDLE_EVERY = 97       # bundle id NULL when event_id % 97 = 0
DUPLICATE_EVERY = 50         # a second copy of rows with event_id % 50 = 0
DUPLICATE_BUNDLE_OFFSET = 1000000
NATION_COUNT = 25            # country = nation name of user_id % 25
NAN_OS_EVERY = 7             # device OS is the string 'NaN' when user_id % 7 = 0
PLATFORM_APP = {"ANDROID": "com.cohortflow.game", "IOS": "com.cohortflow.game.ios"}
PLATFORM_STREAM = {"ANDROID": "1001", "IOS": "2002"}
ORDERS_SOURCE_PLATFORM = "WEB"


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def _param(key: str, string_value=None, int_value=None, double_value=None) -> Column:
    return F.struct(
        F.lit(key).alias("key"),
        F.struct(
            (string_value if string_value is not None else F.lit(None)).cast("string").alias("string_value"),
            (int_value if int_value is not None else F.lit(None)).cast("bigint").alias("int_value"),
            F.lit(None).cast("double").alias("float_value"),
            (double_value if double_value is not None else F.lit(None)).cast("double").alias("double_value"),
        ).alias("value"),
    )


def _uprop(key: str, ts: Column, string_value=None, int_value=None) -> Column:
    return F.struct(
        F.lit(key).alias("key"),
        F.struct(
            (string_value if string_value is not None else F.lit(None)).cast("string").alias("string_value"),
            (int_value if int_value is not None else F.lit(None)).cast("bigint").alias("int_value"),
            F.lit(None).cast("double").alias("float_value"),
            F.lit(None).cast("double").alias("double_value"),
            ts.alias("set_timestamp_micros"),
        ).alias("value"),
    )


#: File bytes of an input table that one task maps.
TASK_BYTES = 4 << 20


def _spread(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, its rows dealt out evenly before the row-wise mapping.

    A row group is read by one task, however many splits its file has, so the number of splits
    says nothing about how the rows lie. The flat rows are cheap to shuffle; a hash of all
    columns needs no sort and has no hot key."""
    df = spark.read.parquet(path)
    tasks = max(spark.sparkContext.defaultParallelism, -(-path_bytes(spark, path) // TASK_BYTES))
    return df.repartition(tasks, *df.columns)


def adapt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver ``events`` (+ ``nation``/``region``) -> raw events (RAW_EVENTS)."""
    ev = _spread(spark, f"{sf_dir}/events.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    # 25 nations x 5 regions: a fixed-size dimension, left to the planner's
    # size check (autoBroadcastJoinThreshold) rather than a forced broadcast.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("_country"),
        F.col("r_name").alias("_continent"))

    uid = F.col("user_id")
    eid = F.col("event_id")
    shifted = ev.withColumn("ts", F.expr(f"timestampadd(DAY, CAST(user_id % {STAGGER_DAYS} AS INT), ts)"))

    # duplicates injected by a generator, not a second scan + union
    copies = F.when(eid % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    base = shifted.select("*", F.explode(copies).alias("_copy"), _k(F.col("props")).alias("_k"))
    base = base.join(geo, (uid % NATION_COUNT).cast("int") == F.col("_nk"), "left")

    mapped = F.lit(None).cast("string")
    for src, dst in EVENT_NAME_MAP.items():
        mapped = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(mapped)
    ts_us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    k = F.col("_k")
    platform = F.when(uid % 2 == 0, F.lit("ANDROID")).otherwise(F.lit("IOS"))
    medium = (F.when(uid % 10 == 0, F.lit(None).cast("string"))
              .when((uid % 10).isin(1, 2), F.lit("organic")).otherwise(F.lit("(none)")))
    first_touch = (F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                          f"timestampadd(DAY, CAST(user_id % {STAGGER_DAYS} AS INT), TIMESTAMP_NTZ'{START_DATE} 00:00:00'))")
                   - (uid % 3) * F.lit(86_400_000_000))
    empty_bag = F.array().cast(PARAM_BAG)
    name = F.col("event_name")
    params = (
        F.when(name == "user_engagement", F.array(_param("engagement_time_msec", int_value=k * 1000)))
        .when(name == "first_open", F.array(_param("previous_first_open_count",
                                                   int_value=F.when(k < 3, k).otherwise(F.lit(0)))))
        .when(name == "screen_view", F.array(_param("firebase_screen_class",
                                                    string_value=F.concat(F.lit("screen_"), (k % 5).cast("string")))))
        .when(name == "session_start", F.array(
            _param("ga_session_id", int_value=eid),
            F.when(eid % 2 == 0, _param("level", int_value=k % 10))
             .otherwise(_param("level", double_value=(k % 10) + F.lit(0.5)))))
        .otherwise(empty_bag)
    )
    bundle = F.when(eid % NULL_BUNDLE_EVERY == 0, F.lit(None).cast("bigint")).otherwise(eid)
    bundle = F.when(F.col("_copy") == 1, eid + DUPLICATE_BUNDLE_OFFSET).otherwise(bundle)
    value = F.when((F.col("event_type") == "purchase") & (eid % NULL_VALUE_EVERY != 0),
                   F.nullif(F.round(F.col("value"), 2), F.lit(0.0)))

    out = base.select(
        F.date_format(F.col("ts") - F.expr(f"INTERVAL {LOCAL_TZ_OFFSET_HOURS} HOURS"), "yyyyMMdd").alias("event_date"),
        ts_us.alias("event_timestamp"),
        mapped.alias("event_name"),
        "*",
    ).select(
        "event_date", "event_timestamp", "event_name",
        params.alias("event_params"),
        F.when(eid % 33 == 0, F.lit(None).cast("bigint"))
         .when(eid % 101 == 0, F.col("event_timestamp") + 1000)
         .otherwise(F.col("event_timestamp") - (k + 1).cast("bigint") * 1_000_000).alias("event_previous_timestamp"),
        value.alias("event_value_in_usd"),
        bundle.alias("event_bundle_sequence_id"),
        ((eid % 13) * 1000).alias("event_server_timestamp_offset"),
        F.lit(None).cast("string").alias("user_id"),
        uid.cast("string").alias("user_pseudo_id"),
        F.array(
            _uprop("first_open_time", F.col("event_timestamp"), int_value=first_touch),
            _uprop("player_tier", F.col("event_timestamp"),
                   string_value=F.concat(F.lit("tier_"), (uid % 3).cast("string"))),
        ).cast(USER_PROPERTY_BAG).alias("user_properties"),
        first_touch.alias("user_first_touch_timestamp"),
        F.struct((uid % 5).cast("double").alias("revenue"), F.lit("USD").alias("currency")).alias("user_ltv"),
        F.struct(
            F.when(uid % 3 == 0, F.lit("tablet")).otherwise(F.lit("mobile")).alias("category"),
            F.when(uid % NAN_OS_EVERY == 0, F.lit("NaN")).otherwise(platform).alias("operating_system"),
            F.lit("en-us").alias("language"),
            F.lit(None).cast("string").alias("mobile_brand_name"),
        ).alias("device"),
        F.struct(F.col("_country").alias("country"), F.col("_continent").alias("continent"),
                 F.lit(None).cast("string").alias("city")).alias("geo"),
        F.struct(
            F.when(uid % 2 == 0, F.lit(PLATFORM_APP["ANDROID"])).otherwise(F.lit(PLATFORM_APP["IOS"])).alias("id"),
            F.concat(F.lit("1.0."), (k % 3).cast("string")).alias("version"),
        ).alias("app_info"),
        F.struct(
            F.when(medium.isNull(), F.lit(None).cast("string"))
             .when(medium == "organic", F.lit("store")).otherwise(F.lit("(direct)")).alias("name"),
            medium.alias("medium"),
            F.when(medium.isNull(), F.lit(None).cast("string"))
             .when(medium == "organic", F.when(uid % 2 == 0, F.lit("google-play")).otherwise(F.lit("app-store")))
             .otherwise(F.lit("(direct)")).alias("source"),
        ).alias("traffic_source"),
        F.when(uid % 2 == 0, F.lit(PLATFORM_STREAM["ANDROID"])).otherwise(F.lit(PLATFORM_STREAM["IOS"])).alias("stream_id"),
        platform.alias("platform"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in RAW_EVENTS.fields])


def adapt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: every order is one ``in_app_purchase`` event of its
    customer; platform = market segment. Long span -> full trailing windows."""
    orders = _spread(spark, f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment", "c_nationkey")
    o = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    ts_us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)")
    null = F.lit(None)
    out = o.select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("event_date"),
        ts_us.alias("event_timestamp"),
        F.lit("in_app_purchase").alias("event_name"),
        F.array().cast(PARAM_BAG).alias("event_params"),
        null.alias("event_previous_timestamp"),
        F.col("o_totalprice").alias("event_value_in_usd"),
        F.col("o_orderkey").alias("event_bundle_sequence_id"),
        null.alias("event_server_timestamp_offset"),
        null.alias("user_id"),
        F.col("o_custkey").cast("string").alias("user_pseudo_id"),
        F.array().cast(USER_PROPERTY_BAG).alias("user_properties"),
        null.alias("user_first_touch_timestamp"),
        null.alias("user_ltv"),
        F.struct(null.cast("string").alias("category"), null.cast("string").alias("operating_system"),
                 null.cast("string").alias("language"), null.cast("string").alias("mobile_brand_name")).alias("device"),
        F.struct(F.col("c_nationkey").cast("string").alias("country"), null.cast("string").alias("continent"),
                 null.cast("string").alias("city")).alias("geo"),
        F.struct(F.lit(ORDERS_SOURCE_PLATFORM).alias("id"), null.cast("string").alias("version")).alias("app_info"),
        F.struct(null.cast("string").alias("name"), F.col("o_orderpriority").alias("medium"),
                 null.cast("string").alias("source")).alias("traffic_source"),
        null.alias("stream_id"),
        F.col("c_mktsegment").alias("platform"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in RAW_EVENTS.fields])


# ---- DuckDB rendering of the same rules (oracle side) ------------------------

def _sql_case_map(col: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{s}' THEN '{d}'" for s, d in mapping.items())
    return f"CASE {col} {arms} END"


_SQL_VALUE = ("{'string_value': %s::VARCHAR, 'int_value': %s::BIGINT, "
              "'float_value': NULL::DOUBLE, 'double_value': %s::DOUBLE}")
_SQL_BAG_TYPE = ("STRUCT(key VARCHAR, value STRUCT(string_value VARCHAR, int_value BIGINT, "
                 "float_value DOUBLE, double_value DOUBLE))[]")


def _sql_param(key: str, s="NULL", i="NULL", d="NULL") -> str:
    return "{'key': '%s', 'value': %s}" % (key, _SQL_VALUE % (s, i, d))


def adapter_sql() -> str:
    """CTEs ``raw_events`` (flat struct fields) for DuckDB over driver views."""
    name_case = _sql_case_map("e.event_type", EVENT_NAME_MAP)
    bag = (
        "CASE "
        f"WHEN n.event_name = 'user_engagement' THEN [{_sql_param('engagement_time_msec', i='n.k * 1000')}] "
        f"WHEN n.event_name = 'first_open' THEN [{_sql_param('previous_first_open_count', i='CASE WHEN n.k < 3 THEN n.k ELSE 0 END')}] "
        f"WHEN n.event_name = 'screen_view' THEN [{_sql_param('firebase_screen_class', s=chr(39) + 'screen_' + chr(39) + ' || (n.k % 5)')}] "
        f"WHEN n.event_name = 'session_start' THEN [{_sql_param('ga_session_id', i='n.event_id')}, "
        f"CASE WHEN n.event_id % 2 = 0 THEN {_sql_param('level', i='n.k % 10')} "
        f"ELSE {_sql_param('level', d='(n.k % 10) + 0.5')} END] "
        f"ELSE []::{_SQL_BAG_TYPE} END"
    )
    return f"""
shifted_events AS (
    SELECT * REPLACE (ts + to_days(CAST(user_id % {STAGGER_DAYS} AS INTEGER)) AS ts) FROM events
),
adapter_src AS (
    SELECT e.*, c.copy_no, json_extract_string(e.props, '$.k')::INTEGER AS k,
           {name_case} AS event_name,
           epoch_us(CAST(DATE '{START_DATE}' + CAST(e.user_id % {STAGGER_DAYS} AS INTEGER) AS TIMESTAMP))
               - (e.user_id % 3) * 86400000000 AS first_touch
    FROM shifted_events e
    CROSS JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1) c
    WHERE c.copy_no = 0 OR e.event_id % {DUPLICATE_EVERY} = 0
),
raw_events AS (
    SELECT
        strftime(n.ts - INTERVAL {LOCAL_TZ_OFFSET_HOURS} HOUR, '%Y%m%d') AS event_date,
        epoch_us(n.ts) AS event_timestamp,
        n.event_name,
        {bag} AS event_params,
        CASE WHEN n.event_id % 33 = 0 THEN NULL
             WHEN n.event_id % 101 = 0 THEN epoch_us(n.ts) + 1000
             ELSE epoch_us(n.ts) - CAST(n.k + 1 AS BIGINT) * 1000000 END AS event_previous_timestamp,
        CASE WHEN n.event_type = 'purchase' AND n.event_id % {NULL_VALUE_EVERY} <> 0
             THEN nullif(round(n.value, 2), 0) END AS event_value_in_usd,
        CASE WHEN n.copy_no = 1 THEN n.event_id + {DUPLICATE_BUNDLE_OFFSET}
             WHEN n.event_id % {NULL_BUNDLE_EVERY} = 0 THEN NULL
             ELSE n.event_id END AS event_bundle_sequence_id,
        (n.event_id % 13) * 1000 AS event_server_timestamp_offset,
        CAST(n.user_id AS VARCHAR) AS user_pseudo_id,
        CASE WHEN n.user_id % 2 = 0 THEN 'ANDROID' ELSE 'IOS' END AS platform,
        CASE WHEN n.user_id % 3 = 0 THEN 'tablet' ELSE 'mobile' END AS device_category,
        CASE WHEN n.user_id % {NAN_OS_EVERY} = 0 THEN 'NaN'
             WHEN n.user_id % 2 = 0 THEN 'ANDROID' ELSE 'IOS' END AS device_operating_system,
        'en-us' AS device_language,
        CAST(NULL AS VARCHAR) AS device_mobile_brand_name,
        na.n_name AS geo_country,
        rg.r_name AS geo_continent,
        CAST(NULL AS VARCHAR) AS geo_city,
        '1.0.' || (n.k % 3) AS app_info_version,
        CASE WHEN n.user_id % 2 = 0 THEN '{PLATFORM_APP["ANDROID"]}' ELSE '{PLATFORM_APP["IOS"]}' END AS app_info_id,
        CASE WHEN n.user_id % 10 = 0 THEN NULL WHEN n.user_id % 10 IN (1, 2) THEN 'organic'
             ELSE '(none)' END AS traffic_source_medium,
        CASE WHEN n.user_id % 10 = 0 THEN NULL WHEN n.user_id % 10 IN (1, 2) THEN 'store'
             ELSE '(direct)' END AS traffic_source_name,
        CASE WHEN n.user_id % 10 = 0 THEN NULL
             WHEN n.user_id % 10 IN (1, 2) THEN (CASE WHEN n.user_id % 2 = 0 THEN 'google-play' ELSE 'app-store' END)
             ELSE '(direct)' END AS traffic_source_source,
        CAST(NULL AS VARCHAR) AS user_id,
        n.first_touch AS user_first_touch_timestamp,
        [{{'key': 'first_open_time', 'value': {{'string_value': NULL::VARCHAR, 'int_value': n.first_touch::BIGINT,
           'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE, 'set_timestamp_micros': epoch_us(n.ts)}}}},
         {{'key': 'player_tier', 'value': {{'string_value': 'tier_' || (n.user_id % 3), 'int_value': NULL::BIGINT,
           'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE, 'set_timestamp_micros': epoch_us(n.ts)}}}}]
            AS user_properties,
        CAST(n.user_id % 5 AS DOUBLE) AS user_ltv_revenue,
        'USD' AS user_ltv_currency,
        CASE WHEN n.user_id % 2 = 0 THEN '{PLATFORM_STREAM["ANDROID"]}' ELSE '{PLATFORM_STREAM["IOS"]}' END AS stream_id
    FROM adapter_src n
    LEFT JOIN nation na ON na.n_nationkey = CAST(n.user_id % {NATION_COUNT} AS INTEGER)
    LEFT JOIN region rg ON rg.r_regionkey = na.n_regionkey
)"""


def orders_adapter_sql() -> str:
    """DuckDB rendering of ``adapt_orders`` (flat struct fields)."""
    return f"""
raw_events AS (
    SELECT
        strftime(o.o_orderdate, '%Y%m%d') AS event_date,
        epoch_us(o.o_orderdate) AS event_timestamp,
        'in_app_purchase' AS event_name,
        []::{_SQL_BAG_TYPE} AS event_params,
        CAST(NULL AS BIGINT) AS event_previous_timestamp,
        o.o_totalprice AS event_value_in_usd,
        o.o_orderkey AS event_bundle_sequence_id,
        CAST(NULL AS BIGINT) AS event_server_timestamp_offset,
        CAST(o.o_custkey AS VARCHAR) AS user_pseudo_id,
        c.c_mktsegment AS platform,
        CAST(NULL AS VARCHAR) AS device_category,
        CAST(NULL AS VARCHAR) AS device_operating_system,
        CAST(c.c_nationkey AS VARCHAR) AS geo_country,
        '{ORDERS_SOURCE_PLATFORM}' AS app_info_id,
        o.o_orderpriority AS traffic_source_medium,
        CAST(NULL AS VARCHAR) AS traffic_source_name
    FROM orders o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""
