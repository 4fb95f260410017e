"""Scalar-function surface (§2.3) and documented extensions (§2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.functions.numeric import safe_ratio, within_tolerance
from cohortflow.functions.params import param_number, user_property
from cohortflow.operators import marts as M
from cohortflow.operators import reports as R
from cohortflow.operators import users as U
from cohortflow.operators.staging import ts_from_micros
from cohortflow.plans import oracle
from cohortflow.plans.quality_queries import sql_prefix
from cohortflow.plans.registry import MAX_DAY, TRAILING, pipeline, register


def _scalar_functions(spark, d):
    raw = pipeline(spark, d).raw
    ts = ts_from_micros("event_timestamp")
    local = F.to_date(F.col("event_date"), "yyyyMMdd")
    return raw.select(
        "user_pseudo_id", "event_timestamp", "event_name",
        ts.alias("event_ts_utc"),
        ts.cast("date").alias("event_date_utc"),
        local.alias("local_date"),
        F.date_sub(local, 28).alias("local_date_minus_28"),
        R.week_start(ts.cast("date")).alias("utc_week_start"),
        param_number("event_params", "level").alias("level"),
        user_property("user_properties", "player_tier").alias("player_tier"),
        user_property("user_properties", "first_open_time", "int_value").alias("first_open_time"),
        safe_ratio(F.col("event_value_in_usd"), F.col("user_ltv.revenue")).alias("value_to_ltv"),
        within_tolerance(F.col("event_value_in_usd"), F.round("event_value_in_usd", 1), 0.05).alias("near_tenth"),
    )


def _p(key, slot):
    return (f"struct_extract(struct_extract(list_filter({{bag}}, lambda x: x.key = '{key}')[1], 'value'), '{slot}')")


register("scalar_functions", oracle.model_ctes(MAX_DAY) + f"""
SELECT user_pseudo_id, event_timestamp, event_name,
       make_timestamp(event_timestamp) AS event_ts_utc,
       CAST(make_timestamp(event_timestamp) AS DATE) AS event_date_utc,
       CAST(strptime(event_date, '%Y%m%d') AS DATE) AS local_date,
       CAST(strptime(event_date, '%Y%m%d') AS DATE) - 28 AS local_date_minus_28,
       CAST(date_trunc('week', CAST(make_timestamp(event_timestamp) AS DATE)) AS DATE) AS utc_week_start,
       coalesce(CAST({_p('level', 'int_value').format(bag='event_params')} AS DOUBLE),
                {_p('level', 'double_value').format(bag='event_params')},
                {_p('level', 'float_value').format(bag='event_params')}) AS level,
       {_p('player_tier', 'string_value').format(bag='user_properties')} AS player_tier,
       {_p('first_open_time', 'int_value').format(bag='user_properties')} AS first_open_time,
       CAST(event_value_in_usd AS DOUBLE) / nullif(CAST(user_ltv_revenue AS DOUBLE), 0) AS value_to_ltv,
       abs(CAST(event_value_in_usd AS DOUBLE) - CAST(round(event_value_in_usd, 1) AS DOUBLE)) < 0.05 AS near_tenth
FROM raw_events""")(_scalar_functions)

# ---- §2.14 extensions: more slices through the same builders --------------------
_UNKNOWN = "(unknown)"
for _name, _slice in (("country", "install_country"), ("traffic", "install_traffic_medium")):
    register(f"mart_retention_by_{_name}",
             oracle.retention_sql((_slice,), MAX_DAY, TRAILING, null_label=_UNKNOWN))(
        (lambda s: lambda spark, d: pipeline(spark, d).retention([s], null_label=_UNKNOWN))(_slice))
    register(f"mart_revenue_by_{_name}",
             oracle.revenue_sql((_slice,), MAX_DAY, TRAILING, null_label=_UNKNOWN))(
        (lambda s: lambda spark, d: pipeline(spark, d).revenue([s], null_label=_UNKNOWN))(_slice))

# D60 window by parameter, on the long-span source
register("mart_retention_orders_d60", oracle.retention_sql((), 60, TRAILING, source="orders"))(
    lambda spark, d: M.retention_mart(pipeline(spark, d, "orders").dim_users,
                                      pipeline(spark, d, "orders").fact_enriched, (), 60, TRAILING))

register("dim_users_left_censored", sql_prefix() + """SELECT *, cohort_date = (SELECT min(event_date_utc) FROM stg)
    AS is_left_censored FROM dim""")(
    lambda spark, d: (lambda p: U.with_left_censored(
        p.dim_users, p.stg_events.agg(F.min("event_date_utc")).scalar()))(pipeline(spark, d)))

register("engagement_mart", sql_prefix() + f""",
eg_cohorts AS (SELECT cohort_date, count(*) AS cohort_size FROM dim GROUP BY 1),
eg_grid AS (SELECT c.*, s.day_number FROM eg_cohorts c CROSS JOIN spine s),
eg_daily AS (SELECT cohort_date, day_number, CAST(sum(engagement_sec) AS DECIMAL(18, 4)) AS engagement_sec,
                    sum(n_sessions_proxy) AS sessions
             FROM fct WHERE day_number BETWEEN 0 AND {MAX_DAY} GROUP BY 1, 2),
eg AS (SELECT g.cohort_date, g.day_number, g.cohort_size,
              CAST(coalesce(d.engagement_sec, 0) AS DECIMAL(18, 4)) AS engagement_sec,
              CAST(coalesce(d.sessions, 0) AS BIGINT) AS sessions,
              CAST(coalesce(d.engagement_sec, 0) / g.cohort_size AS DECIMAL(18, 4)) AS engagement_sec_per_user
       FROM eg_grid g LEFT JOIN eg_daily d ON d.cohort_date = g.cohort_date AND d.day_number = g.day_number)
SELECT *, CAST(avg(engagement_sec_per_user) OVER (PARTITION BY day_number ORDER BY cohort_date
            ROWS BETWEEN {TRAILING} PRECEDING AND 1 PRECEDING) AS DECIMAL(18, 4)) AS engagement_sec_per_user_trailing_4w_avg
FROM eg""")(
    lambda spark, d: (lambda p: M.engagement_mart(p.dim_users, p.fact_enriched, (), MAX_DAY, TRAILING))(
        pipeline(spark, d)))

_TRI_W = ", ".join(f"max(CASE WHEN week_number = {w} THEN retention_pct END) AS w{w}" for w in range(5))
register("rpt_cohort_triangle_weekly", sql_prefix() + f""",
wk AS (
    SELECT CAST(date_trunc('week', d.cohort_date) AS DATE) AS cohort_week, f.day_number // 7 AS week_number,
           f.user_pseudo_id
    FROM fct f JOIN dim d ON d.user_pseudo_id = f.user_pseudo_id
    WHERE f.day_number BETWEEN 0 AND 34
),
sizes AS (SELECT CAST(date_trunc('week', cohort_date) AS DATE) AS cohort_week, count(*) AS cohort_size FROM dim GROUP BY 1),
ret AS (SELECT cohort_week, week_number, count(DISTINCT user_pseudo_id) AS retained FROM wk GROUP BY 1, 2)
SELECT s.cohort_week, s.cohort_size, {_TRI_W.replace('retention_pct', 'CAST(r.retained AS DOUBLE) / s.cohort_size')}
FROM sizes s LEFT JOIN ret r ON r.cohort_week = s.cohort_week
GROUP BY s.cohort_week, s.cohort_size""")(
    lambda spark, d: M.weekly_triangle(pipeline(spark, d).dim_users, pipeline(spark, d).fact_enriched, 5))


# A/B-style slice from a user property at install (here: the player tier)
_AB_KEY, _AB_COL = "player_tier", "install_player_tier"


def _ab_mart(spark, d, kind):
    p = pipeline(spark, d)
    arms = U.install_user_property(p.raw, _AB_KEY, _AB_COL)
    dim, fact = M.with_user_slice(p.dim_users, p.fact_enriched, arms, _AB_COL)
    build = M.retention_mart if kind == "retention" else M.revenue_mart
    return build(dim, fact, [_AB_COL], MAX_DAY, TRAILING, null_label=_UNKNOWN)


_AB_CTE = f""",
ab_arm AS (
    SELECT user_pseudo_id,
           first(struct_extract(struct_extract(list_filter(user_properties, lambda x: x.key = '{_AB_KEY}')[1],
                 'value'), 'string_value') ORDER BY event_timestamp,
                 struct_extract(struct_extract(list_filter(user_properties, lambda x: x.key = '{_AB_KEY}')[1],
                 'value'), 'string_value')) AS {_AB_COL}
    FROM raw_events
    WHERE struct_extract(struct_extract(list_filter(user_properties, lambda x: x.key = '{_AB_KEY}')[1],
          'value'), 'string_value') IS NOT NULL
    GROUP BY user_pseudo_id
),
dim_ab AS (SELECT d.*, a.{_AB_COL} FROM dim d LEFT JOIN ab_arm a ON a.user_pseudo_id = d.user_pseudo_id)"""

for _kind, _parts in (("retention", oracle.retention_parts), ("revenue", oracle.revenue_parts)):
    _body, _final = _parts((_AB_COL,), MAX_DAY, TRAILING, null_label=_UNKNOWN, dim="dim_ab")
    register(f"mart_{_kind}_by_user_property", oracle.model_ctes(MAX_DAY) + _AB_CTE + _body + "\n" + _final)(
        (lambda k: lambda spark, d: _ab_mart(spark, d, k))(_kind))


_RET_BODY, _RET = oracle.retention_parts((), MAX_DAY, TRAILING)
register("mart_retention_observed", oracle.model_ctes(MAX_DAY) + _RET_BODY + f""",
ret AS ({_RET})
SELECT *, cohort_date + day_number <= (SELECT max(activity_date) FROM fct) AS is_observed FROM ret""")(
    lambda spark, d: (lambda p: M.with_observed(p.mart_retention_overall, p.fct_user_daily))(pipeline(spark, d)))
