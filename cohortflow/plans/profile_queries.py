"""Registered source-profiling queries (§2.13) over the adapted raw stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.operators import profile as P
from cohortflow.operators import staging
from cohortflow.operators.distinct import DistinctUsers
from cohortflow.plans import oracle
from cohortflow.plans.registry import MAX_DAY, pipeline, register
from cohortflow.session import shared_scratch_path
from cohortflow.sources.snapshots import SnapshotStore

UTC_DAY = "CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)"


def _sql(body: str) -> str:
    return oracle.model_ctes(MAX_DAY) + ",\n" + """raw_utc AS (
    SELECT *, CAST(make_timestamp(event_timestamp) AS DATE) AS utc_date FROM raw_events
)
""" + body


def _raw(fn):
    return lambda spark, d: fn(pipeline(spark, d).raw)


_DISTINCT: dict[tuple[str, str], DistinctUsers] = {}


def distinct_users(spark, d) -> DistinctUsers:
    """Bitmaps of the raw events: the older days first, then the newer ones and one day again. Once a session and folder."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"))
    if key not in _DISTINCT:
        raw, day = pipeline(spark, d).raw, F.expr(UTC_DAY)
        found = DistinctUsers(SnapshotStore(spark, shared_scratch_path(spark, "distinct_users")), day)
        cut = F.date_sub(raw.agg(F.max(day)).scalar(), 7)
        found.update(raw.where(day < cut))
        found.update(raw.where(day >= F.date_sub(cut, 1)))
        _DISTINCT[key] = found
    return _DISTINCT[key]


def _by_bitmaps(fn, question: str):
    return lambda spark, d: fn(pipeline(spark, d).raw, distinct_users(spark, d).counts(question))


register("prof_volume", _sql("""SELECT count(*) AS n_rows, count(DISTINCT user_pseudo_id) AS n_users,
       count(DISTINCT user_id) AS n_user_ids, min(event_date) AS min_event_date, max(event_date) AS max_event_date,
       min(event_timestamp) AS min_event_timestamp, max(event_timestamp) AS max_event_timestamp
FROM raw_events"""))(_by_bitmaps(P.prof_volume, "all"))

register("prof_daily_cap", _sql("""SELECT event_date, n_rows,
       (SELECT min(n_rows) = max(n_rows) FROM (SELECT count(*) AS n_rows FROM raw_events GROUP BY event_date)) AS is_constant
FROM (SELECT event_date, count(*) AS n_rows FROM raw_events GROUP BY event_date)"""))(_raw(P.prof_daily_cap))

register("prof_platform_split", _sql("""SELECT platform, count(*) AS n_rows, count(DISTINCT user_pseudo_id) AS n_users
FROM raw_events GROUP BY platform"""))(_by_bitmaps(P.prof_platform_split, "platform"))

register("prof_events_per_user", _sql("""SELECT quantile_cont(n_events, 0.5) AS p50, quantile_cont(n_events, 0.9) AS p90,
       quantile_cont(n_events, 0.99) AS p99, max(n_events) AS max_events
FROM (SELECT user_pseudo_id, count(*) AS n_events FROM raw_events GROUP BY 1)"""))(_raw(P.prof_events_per_user))

register("prof_active_days", _sql("""SELECT active_days, count(*) AS n_users,
       CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT user_pseudo_id) FROM raw_events) AS share_users
FROM (SELECT user_pseudo_id, count(DISTINCT utc_date) AS active_days FROM raw_utc GROUP BY 1) GROUP BY 1"""))(
    _raw(P.prof_active_days))

_NULL_COLS = ("event_date event_timestamp event_name event_params event_previous_timestamp event_value_in_usd "
              "event_bundle_sequence_id event_server_timestamp_offset user_id user_pseudo_id user_properties "
              "user_first_touch_timestamp user_ltv_revenue user_ltv_currency device_category device_operating_system "
              "device_language device_mobile_brand_name geo_country geo_continent geo_city app_info_id app_info_version "
              "traffic_source_name traffic_source_medium traffic_source_source stream_id platform").split()
register("prof_null_coverage", _sql("\nUNION ALL\n".join(
    f"SELECT '{col}' AS column_name, CAST(count({col}) AS DOUBLE) / count(*) AS non_null_share FROM raw_events"
    for col in _NULL_COLS)))(_raw(P.prof_null_coverage))

register("prof_tz_skew", _sql("""SELECT count(*) AS n_rows, count(*) FILTER (WHERE event_date <> strftime(utc_date, '%Y%m%d')) AS n_skewed,
       avg(CAST(event_date <> strftime(utc_date, '%Y%m%d') AS DOUBLE)) AS share_skewed
FROM raw_utc"""))(_raw(P.prof_tz_skew))

register("prof_prev_ts_anomaly", _sql("""SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE event_previous_timestamp IS NULL) AS n_prev_null,
       count(*) FILTER (WHERE event_previous_timestamp >= event_timestamp) AS n_prev_ge_current
FROM raw_events"""))(_raw(P.prof_prev_ts_anomaly))

register("prof_event_vocabulary", _sql("""SELECT event_name, count(*) AS n_events, count(DISTINCT user_pseudo_id) AS n_users,
       CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM raw_events) AS share_events
FROM raw_events GROUP BY event_name ORDER BY n_events DESC, event_name"""))(_by_bitmaps(P.prof_event_vocabulary, "event"))

register("prof_param_keys", _sql("""SELECT key, count(*) AS n, count(v.string_value) AS n_string, count(v.int_value) AS n_int,
       count(v.float_value) AS n_float, count(v.double_value) AS n_double,
       (CAST(count(v.string_value) > 0 AS INTEGER) + CAST(count(v.int_value) > 0 AS INTEGER)
        + CAST(count(v.float_value) > 0 AS INTEGER) + CAST(count(v.double_value) > 0 AS INTEGER)) > 1 AS is_mixed,
       1.0::DOUBLE - greatest(count(v.string_value), count(v.int_value), count(v.float_value), count(v.double_value))::DOUBLE
         / nullif(count(v.string_value) + count(v.int_value) + count(v.float_value) + count(v.double_value), 0) AS share_mixed
FROM (SELECT p.key AS key, p.value AS v FROM (SELECT unnest(event_params) AS p FROM raw_events))
GROUP BY key"""))(_raw(P.prof_param_keys))

register("prof_user_property_keys", _sql("""SELECT key, count(*) AS n, count(v.string_value) AS n_string,
       count(v.int_value) AS n_int, count(v.float_value) AS n_float, count(v.double_value) AS n_double,
       count(v.set_timestamp_micros) AS n_set_timestamp,
       (CAST(count(v.string_value) > 0 AS INTEGER) + CAST(count(v.int_value) > 0 AS INTEGER)
        + CAST(count(v.float_value) > 0 AS INTEGER) + CAST(count(v.double_value) > 0 AS INTEGER)) > 1 AS is_mixed,
       1.0::DOUBLE - greatest(count(v.string_value), count(v.int_value), count(v.float_value), count(v.double_value))::DOUBLE
         / nullif(count(v.string_value) + count(v.int_value) + count(v.float_value) + count(v.double_value), 0) AS share_mixed,
       count(DISTINCT coalesce(v.string_value, CAST(v.int_value AS VARCHAR))) AS n_distinct_values,
       count(DISTINCT user_pseudo_id) AS n_users
FROM (SELECT user_pseudo_id, p.key AS key, p.value AS v
      FROM (SELECT user_pseudo_id, unnest(user_properties) AS p FROM raw_events))
GROUP BY key"""))(_raw(P.prof_user_property_keys))

register("prof_engagement_dist", _sql("""SELECT count(*) AS n, count(*) FILTER (WHERE ms < 0) AS n_negative,
       quantile_cont(ms, 0.5) AS p50, quantile_cont(ms, 0.99) AS p99, max(ms) AS max_ms
FROM (SELECT struct_extract(struct_extract(list_filter(event_params, lambda x: x.key = 'engagement_time_msec')[1],
                            'value'), 'int_value') AS ms FROM raw_events)
WHERE ms IS NOT NULL"""))(_raw(P.prof_engagement_dist))

register("prof_duplicates", _sql("""SELECT count(*) AS n_duplicate_keys, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_extra_rows
FROM (SELECT count(*) AS c FROM raw_events GROUP BY user_pseudo_id, event_timestamp, event_name) WHERE c > 1"""))(
    _raw(P.prof_duplicates))

register("prof_identity_exclusivity", _sql("""SELECT
    (SELECT count(*) FILTER (WHERE k > 1) FROM (SELECT count(DISTINCT platform) AS k FROM raw_events GROUP BY user_pseudo_id)) AS users_on_many_platforms,
    (SELECT max(k) FROM (SELECT count(DISTINCT platform) AS k FROM raw_events GROUP BY stream_id)) AS max_platforms_per_stream,
    (SELECT max(k) FROM (SELECT count(DISTINCT stream_id) AS k FROM raw_events GROUP BY platform)) AS max_streams_per_platform,
    (SELECT max(k) FROM (SELECT count(DISTINCT platform) AS k FROM raw_events GROUP BY app_info_id)) AS max_platforms_per_app,
    (SELECT max(k) FROM (SELECT count(DISTINCT app_info_id) AS k FROM raw_events GROUP BY platform)) AS max_apps_per_platform"""))(
    _raw(P.prof_identity_exclusivity))

register("prof_first_touch_mismatch", _sql("""SELECT CASE WHEN ft IS NULL THEN 'no_first_touch'
            WHEN ft < (SELECT min(event_timestamp) FROM raw_events) THEN 'before_window'
            WHEN ft > fe THEN 'after_first_event' ELSE 'consistent' END AS category,
       count(*) AS n_users
FROM (SELECT user_pseudo_id, min(user_first_touch_timestamp) AS ft, min(event_timestamp) AS fe
      FROM raw_events GROUP BY 1) GROUP BY 1"""))(_raw(P.prof_first_touch_mismatch))

register("prof_first_open_coverage", _sql("""SELECT count(*) AS n_users, count(*) FILTER (WHERE fo > 0) AS users_with_first_open,
       count(*) FILTER (WHERE re) AS users_reinstalled
FROM (SELECT user_pseudo_id, count(*) FILTER (WHERE event_name = 'first_open') AS fo,
             coalesce(bool_or(previous_first_open_count > 0), false) AS re
      FROM stg GROUP BY 1)"""))(lambda spark, d: P.prof_first_open_coverage(pipeline(spark, d).stg_events))

register("prof_literal_nan", _sql("""SELECT count(*) FILTER (WHERE device_operating_system = 'NaN') AS n_nan_rows,
       count(DISTINCT CASE WHEN device_operating_system = 'NaN' THEN user_pseudo_id END) AS n_nan_users,
       count(*) AS n_rows
FROM raw_events"""))(_raw(P.prof_literal_nan))

register("prof_traffic_mix", _sql("""SELECT traffic_source_source AS source, traffic_source_medium AS medium, count(*) AS n_rows,
       count(DISTINCT user_pseudo_id) AS n_users,
       CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM raw_events) AS share_rows
FROM raw_events GROUP BY 1, 2"""))(_by_bitmaps(P.prof_traffic_mix, "traffic"))

register("prof_revenue_signals", _sql("""SELECT
    (SELECT count(DISTINCT user_pseudo_id) FROM raw_events
      WHERE event_name = 'in_app_purchase' AND event_value_in_usd > 0) AS n_event_payers,
    (SELECT count(DISTINCT user_pseudo_id) FROM raw_events WHERE user_ltv_revenue > 0) AS n_ltv_payers,
    (SELECT count(DISTINCT user_pseudo_id) FROM raw_events r WHERE user_ltv_revenue > 0
       AND NOT EXISTS (SELECT 1 FROM raw_events p WHERE p.user_pseudo_id = r.user_pseudo_id
                         AND p.event_name = 'in_app_purchase' AND p.event_value_in_usd > 0)) AS n_ltv_without_purchase,
    (SELECT count(DISTINCT user_ltv_currency) FROM raw_events) AS n_ltv_currencies"""))(_raw(P.prof_revenue_signals))

register("prof_ltv_by_currency", _sql("""SELECT user_ltv_currency AS currency, count(*) AS n_rows,
       count(DISTINCT user_pseudo_id) AS n_users,
       count(DISTINCT CASE WHEN user_ltv_revenue > 0 THEN user_pseudo_id END) AS n_payers, max(user_ltv_revenue) AS max_revenue
FROM raw_events WHERE user_ltv_currency IS NOT NULL GROUP BY 1"""))(_raw(P.prof_ltv_by_currency))

# agg_having: the duplicated event keys themselves (group by ... having count(*) > 1)
register("duplicate_keys", _sql("""SELECT user_pseudo_id, event_timestamp, event_name, count(*) AS copies
FROM raw_events GROUP BY user_pseudo_id, event_timestamp, event_name HAVING count(*) > 1"""))(
    lambda spark, d: staging.duplicate_keys(pipeline(spark, d).raw))
