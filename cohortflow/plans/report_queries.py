"""Registered dashboard/report queries (§2.12) and top-k / slice reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.operators import marts as M
from cohortflow.operators import reports as R
from cohortflow.plans import oracle
from cohortflow.plans.quality_queries import sql_prefix
from cohortflow.plans.registry import MAX_DAY, TRAILING, pipeline, register

W = R.HEADLINE_DAY
AXIS = ", ".join(str(d) for d in R.DAY_AXIS)
SEL = "(SELECT selected FROM sel)"


def _sql(body: str, source: str = "events") -> str:
    prefix = sql_prefix() if source == "events" else oracle.with_marts(MAX_DAY, TRAILING, source)
    return prefix + f""",
sel AS (SELECT max(cohort_date) AS selected FROM dim
        WHERE cohort_date <= (SELECT max(activity_date) FROM fct) - {MAX_DAY})
{body}"""


def _ctx(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return p, R.max_full_cohort(p.report_dates)


register("rpt_max_full_cohort", _sql(
    f"SELECT {SEL} AS selected_cohort, max(activity_date) AS max_activity_date FROM fct"))(
    lambda spark, d: pipeline(spark, d).report_dates)

register("rpt_header_retention", _sql(
    f"""SELECT day_number, retention_pct, CAST(retention_pct_trailing_4w_avg AS DOUBLE) AS baseline
FROM mart_retention_overall WHERE cohort_date = {SEL} AND day_number IN (1, 3, 7)"""))(
    lambda spark, d: (lambda p, c: R.rpt_header_retention(p.mart_retention_overall, c))(*_ctx(spark, d)))

register("rpt_header_revenue", _sql(
    f"""SELECT CAST(cum_arpu AS DOUBLE) AS cum_arpu, CAST(cum_arpu_trailing_4w_avg AS DOUBLE) AS cum_arpu_baseline,
       CAST(paying_share AS DOUBLE) AS paying_share
FROM mart_revenue_overall WHERE cohort_date = {SEL} AND day_number = {W}"""))(
    lambda spark, d: (lambda p, c: R.rpt_header_revenue(p.mart_revenue_overall, c))(*_ctx(spark, d)))

_PAY_BASELINE = (f"(SELECT CAST(avg(paying_share) AS DOUBLE) FROM mart_revenue_overall "
                 f"WHERE day_number = {W} AND cohort_date < {SEL} AND cohort_date >= {SEL} - {R.BASELINE_DAYS})")

register("rpt_header_pay_baseline", _sql(f"SELECT {_PAY_BASELINE} AS paying_share_baseline"))(
    lambda spark, d: (lambda p, c: R.rpt_header_pay_baseline(p.mart_revenue_overall, c))(*_ctx(spark, d)))

register("rpt_kpi_deltas", _sql(f"""SELECT kpi, value, baseline, value - baseline AS delta,
       CASE WHEN value - baseline IS NULL THEN 'no baseline'
            WHEN abs(value - baseline) < threshold THEN 'neutral'
            WHEN value - baseline > 0 THEN 'up' ELSE 'down' END AS status
FROM (
    SELECT 'ARPU @ D{W}' AS kpi, CAST(cum_arpu AS DOUBLE) AS value,
           CAST(cum_arpu_trailing_4w_avg AS DOUBLE) AS baseline, CAST({R.NOISE_THRESHOLDS['arpu']} AS DOUBLE) AS threshold
    FROM mart_revenue_overall WHERE cohort_date = {SEL} AND day_number = {W}
    UNION ALL
    SELECT 'Pay share @ D{W}', CAST(paying_share AS DOUBLE), CAST({_PAY_BASELINE} AS DOUBLE),
           CAST({R.NOISE_THRESHOLDS['paying_share']} AS DOUBLE)
    FROM mart_revenue_overall WHERE cohort_date = {SEL} AND day_number = {W}
    UNION ALL
    SELECT 'D' || day_number || ' retention', retention_pct, CAST(retention_pct_trailing_4w_avg AS DOUBLE),
           CAST({R.NOISE_THRESHOLDS['retention']} AS DOUBLE)
    FROM mart_retention_overall WHERE cohort_date = {SEL} AND day_number IN (1, 3, 7)
) tiles"""))(
    lambda spark, d: (lambda p, c: R.rpt_kpi_deltas(p.mart_retention_overall, p.mart_revenue_overall, c))(
        *_ctx(spark, d)))

_TRI = ", ".join(f"max(CASE WHEN day_number = {x} THEN retention_pct END) AS d{x}" for x in R.DAY_AXIS)
register("rpt_cohort_triangle", _sql(
    f"""SELECT cohort_date, cohort_size, {_TRI} FROM mart_retention_overall
WHERE day_number IN ({AXIS}) GROUP BY cohort_date, cohort_size"""))(
    lambda spark, d: R.rpt_cohort_triangle(pipeline(spark, d).mart_retention_overall))

register("rpt_current_vs_baseline_retention", _sql(
    f"""SELECT day_number, CAST(retention_pct AS DOUBLE) AS selected,
       CAST(retention_pct_trailing_4w_avg AS DOUBLE) AS baseline
FROM mart_retention_overall WHERE cohort_date = {SEL} AND day_number IN ({AXIS})"""))(
    lambda spark, d: (lambda p, c: R.rpt_current_vs_baseline(
        p.mart_retention_overall, c, "retention_pct", "retention_pct_trailing_4w_avg"))(*_ctx(spark, d)))

register("rpt_current_vs_baseline_arpu", _sql(
    f"""SELECT day_number, CAST(cum_arpu AS DOUBLE) AS selected,
       CAST(cum_arpu_trailing_4w_avg AS DOUBLE) AS baseline
FROM mart_revenue_overall WHERE cohort_date = {SEL} AND day_number IN ({AXIS})"""))(
    lambda spark, d: (lambda p, c: R.rpt_current_vs_baseline(
        p.mart_revenue_overall, c, "cum_arpu", "cum_arpu_trailing_4w_avg"))(*_ctx(spark, d)))

_WEEKS = ", ".join(str(7 * k) for k in range(R.COMPARISON_WEEKS))
register("rpt_cohort_series_weekly", _sql(
    f"""SELECT cohort_date, count(*) AS cohort_size FROM dim
WHERE CAST({SEL} - cohort_date AS INTEGER) IN ({_WEEKS}) GROUP BY cohort_date"""))(
    lambda spark, d: (lambda p, c: R.rpt_cohort_series_weekly(p.mart_retention_overall, c))(*_ctx(spark, d)))

register("rpt_cohort_curves", _sql(
    f"""SELECT cohort_date, day_number, CAST(cum_arpu AS DOUBLE) AS cum_arpu,
       CAST(paying_share AS DOUBLE) AS paying_share
FROM mart_revenue_overall
WHERE CAST({SEL} - cohort_date AS INTEGER) IN ({_WEEKS}) AND day_number IN ({AXIS})"""))(
    lambda spark, d: (lambda p, c: R.rpt_cohort_curves(p.mart_revenue_overall, c))(*_ctx(spark, d)))

register("rpt_d7_weekly", _sql(
    f"""SELECT CAST(date_trunc('week', cohort_date) AS DATE) AS week,
       CAST(sum(retained_users) AS DOUBLE) / nullif(CAST(sum(cohort_size) AS DOUBLE), 0) AS ret
FROM mart_retention_overall WHERE day_number = {W} GROUP BY 1"""))(
    lambda spark, d: R.rpt_d7_weekly(pipeline(spark, d).mart_retention_overall))

register("rpt_d7_weekly_by_platform", _sql(
    f"""SELECT CAST(date_trunc('week', cohort_date) AS DATE) AS week, install_platform,
       CAST(sum(retained_users) AS DOUBLE) / nullif(CAST(sum(cohort_size) AS DOUBLE), 0) AS ret
FROM mart_retention_by_platform WHERE day_number = {W} GROUP BY 1, 2"""))(
    lambda spark, d: R.rpt_d7_weekly(pipeline(spark, d).mart_retention_by_platform, ["install_platform"]))

_FIRST = "(SELECT min(cohort_date) FROM dim)"
register("rpt_d7_weekly_without_first_cohort", _sql(
    f"""SELECT CAST(date_trunc('week', cohort_date) AS DATE) AS week,
       CAST(sum(retained_users) AS DOUBLE) / nullif(CAST(sum(cohort_size) AS DOUBLE), 0) AS ret
FROM mart_retention_overall WHERE day_number = {W} AND cohort_date <> {_FIRST} GROUP BY 1"""))(
    lambda spark, d: R.rpt_d7_weekly(pipeline(spark, d).mart_retention_overall, left_censored=False))

register("rpt_period_retention", _sql(
    f"""SELECT day_number, CAST(sum(retained_users) AS DOUBLE) / nullif(CAST(sum(cohort_size) AS DOUBLE), 0) AS ret
FROM mart_retention_overall WHERE day_number IN ({AXIS}) AND cohort_date <> {_FIRST} GROUP BY 1"""))(
    lambda spark, d: R.rpt_period_retention(pipeline(spark, d).mart_retention_overall))

register("rpt_platform_revenue_weighted", _sql(
    f"""SELECT install_platform, day_number,
       CAST(sum(cum_revenue) AS DOUBLE) / nullif(CAST(sum(cohort_size) AS DOUBLE), 0) AS cum_arpu_w,
       CAST(sum(cum_paying_users) AS DOUBLE) / nullif(CAST(sum(cohort_size) AS DOUBLE), 0) AS paying_share_w
FROM mart_revenue_by_platform WHERE day_number IN ({AXIS}) GROUP BY 1, 2"""))(
    lambda spark, d: R.rpt_platform_revenue_weighted(pipeline(spark, d).mart_revenue_by_platform))

register("latest_n_cohorts", _sql(
    f"""SELECT cohort_date, count(*) AS cohort_size FROM dim
WHERE cohort_date <= (SELECT max(activity_date) FROM fct) - {W}
GROUP BY cohort_date ORDER BY cohort_date DESC LIMIT 5"""))(
    lambda spark, d: (lambda p: R.latest_n_cohorts(p.mart_retention_overall, p.report_dates))(pipeline(spark, d)))

_TOP5 = """top5 AS (
    SELECT install_country FROM (SELECT install_country, count(*) AS n FROM dim
                                 WHERE install_country IS NOT NULL GROUP BY 1)
    ORDER BY n DESC, install_country ASC LIMIT 5
),
dim_top5 AS (
    SELECT d.*, coalesce(t.install_country, 'Other') AS install_country_top5
    FROM dim d LEFT JOIN top5 t ON d.install_country = t.install_country
)"""
register("top5_plus_other", _sql(
    f""", {_TOP5}
SELECT install_country_top5, count(*) AS n_users FROM dim_top5 GROUP BY 1""".replace("\n, ", ",\n", 1)))(
    lambda spark, d: R.top_n_plus_other(pipeline(spark, d).dim_users, "install_country", 5, "Other",
                                        "install_country_top5")
    .groupBy("install_country_top5").agg(F.count(F.lit(1)).alias("n_users")))

register("baseline_calendar_28d", _sql(
    f"""SELECT cohort_date, day_number, paying_share,
       CAST(avg(paying_share) OVER (PARTITION BY day_number ORDER BY cohort_date
            RANGE BETWEEN INTERVAL {R.BASELINE_DAYS} DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)
            AS DECIMAL(18, 4)) AS paying_share_calendar_{R.BASELINE_DAYS}d
FROM mart_revenue_overall""", source="orders"))(
    lambda spark, d: R.baseline_calendar_28d(pipeline(spark, d, "orders").mart_revenue_overall))

register("sort_report", _sql(
    f"""SELECT cohort_date, day_number, retention_pct FROM mart_retention_overall
WHERE day_number IN ({AXIS}) ORDER BY cohort_date DESC, day_number"""))(
    lambda spark, d: pipeline(spark, d).mart_retention_overall.where(F.col("day_number").isin(*R.DAY_AXIS))
    .select("cohort_date", "day_number", "retention_pct")
    .orderBy(F.col("cohort_date").desc(), F.col("day_number").asc()))
