"""The declared checks as SQL, written out one by one from the models' documentation.

Nothing here is rendered from the Spark checks, so a wrong expression on one side shows.
"""

from __future__ import annotations

from collections.abc import Callable

#: Check id (a trailing "warn" is its severity) and its violating rows.
VIOLATIONS = r"""
not_null__source_events__user_pseudo_id: source_events WHERE user_pseudo_id IS NULL
not_null__source_events__event_timestamp: source_events WHERE event_timestamp IS NULL
not_null__source_events__event_name: source_events WHERE event_name IS NULL
not_null__source_events__platform: source_events WHERE platform IS NULL
accepted_values__source_events__platform: source_events WHERE platform NOT IN ('ANDROID', 'IOS')
not_null__stg_events__user_pseudo_id: stg_events WHERE user_pseudo_id IS NULL
not_null__stg_events__event_timestamp: stg_events WHERE event_timestamp IS NULL
not_null__stg_events__event_ts_utc: stg_events WHERE event_ts_utc IS NULL
not_null__stg_events__event_date_utc: stg_events WHERE event_date_utc IS NULL
not_null__stg_events__event_name: stg_events WHERE event_name IS NULL
not_null__stg_events__platform: stg_events WHERE platform IS NULL
not_null__stg_events__device_category: stg_events WHERE device_category IS NULL
unique_combination__stg_events__user_pseudo_id__event_timestamp__event_name: (FROM stg_events SELECT count(*) AS n GROUP BY user_pseudo_id, event_timestamp, event_name) WHERE n > 1
expression_is_true__stg_events__value_only_on_purchases: stg_events WHERE event_value_in_usd <= 0 OR (event_value_in_usd IS NOT NULL AND event_name <> 'in_app_purchase')
not_null__day_numbers__day_number: day_numbers WHERE day_number IS NULL
unique__day_numbers__day_number: (FROM day_numbers SELECT day_number, count(*) AS n GROUP BY day_number) WHERE n > 1 AND day_number IS NOT NULL
accepted_range__day_numbers__day_number: day_numbers WHERE day_number < 0 OR day_number > 30
not_null__int_user_install__user_pseudo_id: int_user_install WHERE user_pseudo_id IS NULL
not_null__int_user_install__cohort_date: int_user_install WHERE cohort_date IS NULL
unique__int_user_install__user_pseudo_id: (FROM int_user_install SELECT user_pseudo_id AS u, count(*) AS n GROUP BY u) WHERE n > 1 AND u IS NOT NULL
not_null__int_user_daily_activity__user_pseudo_id: int_user_daily_activity WHERE user_pseudo_id IS NULL
not_null__int_user_daily_activity__activity_date: int_user_daily_activity WHERE activity_date IS NULL
relationships__int_user_daily_activity__user_pseudo_id warn: int_user_daily_activity a WHERE a.user_pseudo_id IS NOT NULL AND NOT EXISTS (FROM dim_users d WHERE d.user_pseudo_id = a.user_pseudo_id)
not_null__int_user_daily_revenue__user_pseudo_id: int_user_daily_revenue WHERE user_pseudo_id IS NULL
not_null__int_user_daily_revenue__activity_date: int_user_daily_revenue WHERE activity_date IS NULL
relationships__int_user_daily_revenue__user_pseudo_id warn: int_user_daily_revenue a WHERE a.user_pseudo_id IS NOT NULL AND NOT EXISTS (FROM dim_users d WHERE d.user_pseudo_id = a.user_pseudo_id)
not_null__dim_users__user_pseudo_id: dim_users WHERE user_pseudo_id IS NULL
not_null__dim_users__cohort_date: dim_users WHERE cohort_date IS NULL
not_null__dim_users__install_platform: dim_users WHERE install_platform IS NULL
unique__dim_users__user_pseudo_id: (FROM dim_users SELECT user_pseudo_id AS u, count(*) AS n GROUP BY u) WHERE n > 1 AND u IS NOT NULL
not_null__fct_user_daily__user_pseudo_id: fct_user_daily WHERE user_pseudo_id IS NULL
not_null__fct_user_daily__cohort_date: fct_user_daily WHERE cohort_date IS NULL
not_null__fct_user_daily__activity_date: fct_user_daily WHERE activity_date IS NULL
not_null__fct_user_daily__day_number: fct_user_daily WHERE day_number IS NULL
relationships__fct_user_daily__user_pseudo_id: fct_user_daily a WHERE a.user_pseudo_id IS NOT NULL AND NOT EXISTS (FROM dim_users d WHERE d.user_pseudo_id = a.user_pseudo_id)
expression_is_true__fct_user_daily__day_number__ge_0: fct_user_daily WHERE day_number < 0
expression_is_true__fct_user_daily__events__ge_1: fct_user_daily WHERE events < 1
expression_is_true__fct_user_daily__engagement_sec__ge_0: fct_user_daily WHERE engagement_sec < 0
expression_is_true__fct_user_daily__gross_revenue__ge_0: fct_user_daily WHERE gross_revenue < 0
expression_is_true__fct_user_daily__n_purchases__ge_0: fct_user_daily WHERE n_purchases < 0
unique_combination__fct_user_daily__user_pseudo_id__activity_date: (FROM fct_user_daily SELECT count(*) AS n GROUP BY user_pseudo_id, activity_date) WHERE n > 1
expression_is_true__fct_user_daily__paying_flag_matches_revenue: fct_user_daily WHERE paying_flag <> (gross_revenue > 0)
not_null__mart_retention_overall__cohort_date: mart_retention_overall WHERE cohort_date IS NULL
not_null__mart_retention_overall__day_number: mart_retention_overall WHERE day_number IS NULL
expression_is_true__mart_retention_overall__cohort_size__gt_0: mart_retention_overall WHERE cohort_size <= 0
expression_is_true__mart_retention_overall__retention_pct__between_0_1: mart_retention_overall WHERE retention_pct < 0 OR retention_pct > 1
expression_is_true__mart_retention_overall__retention_pct_trailing_4w_avg__between_0_1: mart_retention_overall WHERE retention_pct_trailing_4w_avg < 0 OR retention_pct_trailing_4w_avg > 1
unique_combination__mart_retention_overall__cohort_date__day_number: (FROM mart_retention_overall SELECT count(*) AS n GROUP BY cohort_date, day_number) WHERE n > 1
expression_is_true__mart_retention_overall__retained_le_size: mart_retention_overall WHERE retained_users > cohort_size
not_null__mart_retention_by_platform__cohort_date: mart_retention_by_platform WHERE cohort_date IS NULL
not_null__mart_retention_by_platform__install_platform: mart_retention_by_platform WHERE install_platform IS NULL
not_null__mart_retention_by_platform__day_number: mart_retention_by_platform WHERE day_number IS NULL
expression_is_true__mart_retention_by_platform__cohort_size__gt_0: mart_retention_by_platform WHERE cohort_size <= 0
expression_is_true__mart_retention_by_platform__retention_pct__between_0_1: mart_retention_by_platform WHERE retention_pct < 0 OR retention_pct > 1
expression_is_true__mart_retention_by_platform__retention_pct_trailing_4w_avg__between_0_1: mart_retention_by_platform WHERE retention_pct_trailing_4w_avg < 0 OR retention_pct_trailing_4w_avg > 1
unique_combination__mart_retention_by_platform__cohort_date__install_platform__day_number: (FROM mart_retention_by_platform SELECT count(*) AS n GROUP BY cohort_date, install_platform, day_number) WHERE n > 1
expression_is_true__mart_retention_by_platform__retained_le_size: mart_retention_by_platform WHERE retained_users > cohort_size
not_null__mart_revenue_overall__cohort_date: mart_revenue_overall WHERE cohort_date IS NULL
not_null__mart_revenue_overall__day_number: mart_revenue_overall WHERE day_number IS NULL
expression_is_true__mart_revenue_overall__gross_revenue__ge_0: mart_revenue_overall WHERE gross_revenue < 0
expression_is_true__mart_revenue_overall__paying_users__ge_0: mart_revenue_overall WHERE paying_users < 0
unique_combination__mart_revenue_overall__cohort_date__day_number: (FROM mart_revenue_overall SELECT count(*) AS n GROUP BY cohort_date, day_number) WHERE n > 1
expression_is_true__mart_revenue_overall__paying_le_size: mart_revenue_overall WHERE paying_users > cohort_size
expression_is_true__mart_revenue_overall__arppu_consistent: mart_revenue_overall WHERE cum_paying_users <> 0 AND abs(cum_arppu - cum_revenue / cum_paying_users) >= 0.0001
not_null__mart_revenue_by_platform__cohort_date: mart_revenue_by_platform WHERE cohort_date IS NULL
not_null__mart_revenue_by_platform__install_platform: mart_revenue_by_platform WHERE install_platform IS NULL
not_null__mart_revenue_by_platform__day_number: mart_revenue_by_platform WHERE day_number IS NULL
expression_is_true__mart_revenue_by_platform__gross_revenue__ge_0: mart_revenue_by_platform WHERE gross_revenue < 0
expression_is_true__mart_revenue_by_platform__paying_users__ge_0: mart_revenue_by_platform WHERE paying_users < 0
unique_combination__mart_revenue_by_platform__cohort_date__install_platform__day_number: (FROM mart_revenue_by_platform SELECT count(*) AS n GROUP BY cohort_date, install_platform, day_number) WHERE n > 1
expression_is_true__mart_revenue_by_platform__paying_le_size: mart_revenue_by_platform WHERE paying_users > cohort_size
"""


def _checks() -> list[tuple[str, str, str]]:
    out = []
    for line in VIOLATIONS.strip().split("\n"):
        name, rows = line.split(": ", 1)
        check_id, _, severity = name.partition(" ")
        out.append((check_id, severity or "error", rows))
    return out


def suite_sql(wanted: Callable[[str, str], bool] = lambda kind, table: True) -> str:
    """One row a check of the wanted kinds and tables."""
    arms = []
    for check_id, severity, rows in _checks():
        kind, table, _ = check_id.split("__", 2)
        if wanted(kind, table):
            arms.append(f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, '{kind}' AS kind, '{severity}' AS severity, n AS n_violations, "
                        f"CASE WHEN n = 0 THEN 'pass' ELSE '{'warn' if severity == 'warn' else 'fail'}' END AS status "
                        f"FROM (SELECT count(*) AS n FROM {rows}) AS t")
    return "\nUNION ALL\n".join(arms)
