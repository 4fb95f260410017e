"""Registered data-quality queries (generic suite, singular checks, drift)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.operators import quality as Q
from cohortflow.operators import spine
from cohortflow.plans import oracle
from cohortflow.plans.quality_sql import suite_sql
from cohortflow.plans.registry import MAX_DAY, TRAILING, pipeline, register
from cohortflow.session import shared_scratch_path
from cohortflow.sources.loads import BATCH, append_batch, write_table

TABLE_ALIASES = {
    "source_events": "raw_events", "stg_events": "stg", "int_user_install": "install",
    "int_user_daily_activity": "activity", "int_user_daily_revenue": "revenue",
    "day_numbers": "spine", "dim_users": "dim", "fct_user_daily": "fct",
}


def sql_prefix() -> str:
    aliases = ",\n".join(f"{a} AS (SELECT * FROM {b})" for a, b in TABLE_ALIASES.items())
    return oracle.with_marts(MAX_DAY, TRAILING) + ",\n" + aliases + "\n"


def pipeline_tables(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    t = dict(p.tables())
    t["source_events"] = p.raw
    # the spine as every cohort of the published mart has it
    t["day_numbers"] = spine.published(p.mart_retention_overall, MAX_DAY)
    return t


CHECKS = Q.pipeline_checks(MAX_DAY)
register("dq_suite", sql_prefix() + suite_sql())(
    lambda spark, sf_dir: Q.run_checks(spark, pipeline_tables(spark, sf_dir), CHECKS, pipeline(spark, sf_dir).counted))

for _kind in ("not_null", "unique", "unique_combination", "accepted_values", "accepted_range",
              "relationships", "expression_is_true"):
    _subset = [c for c in CHECKS if c.kind == _kind]
    register(f"dq_{_kind}", sql_prefix() + suite_sql(lambda kind, table, k=_kind: kind == k))(
        (lambda sub: lambda spark, sf_dir: Q.run_checks(spark, pipeline_tables(spark, sf_dir), sub))(_subset))


def _totals_sql(lhs: str, rhs: str) -> str:
    return sql_prefix() + f"""SELECT CAST(coalesce(l, 0) <> coalesce(r, 0) AS BIGINT) AS n_violations,
       CAST(l AS DOUBLE) AS lhs, CAST(r AS DOUBLE) AS rhs
FROM (SELECT ({lhs}) AS l, ({rhs}) AS r) t"""


def _rows_sql(source: str, violation: str) -> str:
    return sql_prefix() + f"""SELECT CAST(count(*) FILTER (WHERE {violation}) AS BIGINT) AS n_violations,
       CAST(count(*) AS DOUBLE) AS lhs,
       CAST(count(*) - count(*) FILTER (WHERE {violation}) AS DOUBLE) AS rhs
FROM {source}"""


_IN_WINDOW = (f"FROM stg s JOIN dim d ON d.user_pseudo_id = s.user_pseudo_id "
              f"WHERE s.event_name = 'in_app_purchase' "
              f"AND CAST(s.event_date_utc - d.cohort_date AS INTEGER) BETWEEN 0 AND {MAX_DAY}")

register("chk_revenue_reconciliation", _totals_sql(
    f"SELECT CAST(sum(cum_revenue) AS DECIMAL(18, 4)) FROM mart_revenue_overall WHERE day_number = {MAX_DAY}",
    f"SELECT CAST(sum(s.event_value_in_usd) AS DECIMAL(18, 4)) {_IN_WINDOW}"))(
    lambda spark, d: (lambda p: Q.chk_revenue_reconciliation(
        spark, p.stg_events, p.dim_users, p.mart_revenue_overall, MAX_DAY))(pipeline(spark, d)))

register("chk_n_purchases_reconciliation", _totals_sql(
    f"SELECT sum(n_purchases) FROM fct WHERE day_number BETWEEN 0 AND {MAX_DAY}",
    f"SELECT count(*) {_IN_WINDOW}"))(
    lambda spark, d: (lambda p: Q.chk_n_purchases_reconciliation(
        spark, p.stg_events, p.dim_users, p.fct_user_daily, MAX_DAY))(pipeline(spark, d)))

register("chk_paying_users_reconciliation", _totals_sql(
    f"SELECT count(DISTINCT f.user_pseudo_id) FROM fct f JOIN dim d ON d.user_pseudo_id = f.user_pseudo_id "
    f"WHERE f.day_number BETWEEN 0 AND {MAX_DAY} AND f.paying_flag",
    f"SELECT count(DISTINCT s.user_pseudo_id) {_IN_WINDOW} AND s.event_value_in_usd > 0"))(
    lambda spark, d: (lambda p: Q.chk_paying_users_reconciliation(
        spark, p.stg_events, p.dim_users, p.fct_user_daily, MAX_DAY))(pipeline(spark, d)))

register("chk_cohort_size_reconciliation", _totals_sql(
    "SELECT sum(cohort_size) FROM mart_retention_overall WHERE day_number = 0",
    "SELECT count(*) FROM dim"))(
    lambda spark, d: (lambda p: Q.chk_cohort_size_reconciliation(
        spark, p.dim_users, p.mart_retention_overall))(pipeline(spark, d)))

register("chk_d0_full_retention", _rows_sql(
    "mart_retention_overall WHERE day_number = 0", "retained_users <> cohort_size OR retention_pct <> 1.0"))(
    lambda spark, d: Q.chk_d0_full_retention(spark, pipeline(spark, d).mart_retention_overall))

register("chk_d0_full_retention_by_platform", _rows_sql(
    "mart_retention_by_platform WHERE day_number = 0", "retained_users <> cohort_size OR retention_pct <> 1.0"))(
    lambda spark, d: Q.chk_d0_full_retention(spark, pipeline(spark, d).mart_retention_by_platform))

register("chk_cum_revenue_monotonic", _rows_sql(
    "(SELECT cum_revenue, lag(cum_revenue) OVER (PARTITION BY cohort_date ORDER BY day_number) AS prev "
    "FROM mart_revenue_overall) x WHERE prev IS NOT NULL", "cum_revenue < prev"))(
    lambda spark, d: Q.chk_cum_revenue_monotonic(spark, pipeline(spark, d).mart_revenue_overall))

register("chk_cum_revenue_monotonic_by_platform", _rows_sql(
    "(SELECT cum_revenue, lag(cum_revenue) OVER (PARTITION BY cohort_date, install_platform "
    "ORDER BY day_number) AS prev FROM mart_revenue_by_platform) x WHERE prev IS NOT NULL", "cum_revenue < prev"))(
    lambda spark, d: Q.chk_cum_revenue_monotonic(spark, pipeline(spark, d).mart_revenue_by_platform,
                                                 ["install_platform"]))

register("chk_fct_dim_cohort_date", _rows_sql(
    "fct f JOIN dim d ON d.user_pseudo_id = f.user_pseudo_id", "f.cohort_date <> d.cohort_date"))(
    lambda spark, d: (lambda p: Q.chk_fct_dim_cohort_date(spark, p.fct_user_daily, p.dim_users))(
        pipeline(spark, d)))

register("chk_revenue_days_are_activity_days", sql_prefix() + """SELECT
    CAST(count(*) FILTER (WHERE a.user_pseudo_id IS NULL) AS BIGINT) AS n_violations,
    CAST(count(*) AS DOUBLE) AS lhs,
    CAST(count(*) FILTER (WHERE a.user_pseudo_id IS NOT NULL) AS DOUBLE) AS rhs
FROM revenue r LEFT JOIN activity a
  ON a.user_pseudo_id = r.user_pseudo_id AND a.activity_date = r.activity_date""")(
    lambda spark, d: (lambda p: Q.chk_revenue_days_are_activity_days(
        spark, p.int_user_daily_revenue, p.int_user_daily_activity))(pipeline(spark, d)))

def _drift_sql(before: str = "") -> str:
    where = lambda col: f" WHERE {col} < {before}" if before else ""
    return f"""SELECT
    (SELECT avg(CAST(d = 1 AS DOUBLE)) FROM (SELECT user_pseudo_id, count(*) AS d FROM activity{where("activity_date")}
                                             GROUP BY 1) u) AS one_day_user_share,
    avg(CAST(coalesce(traffic_medium = '(none)', false) AS DOUBLE)) AS none_medium_share,
    avg(CAST(device_os IS NULL AS DOUBLE)) AS null_os_share,
    (SELECT avg(CAST(is_reinstall AS DOUBLE)) FROM install{where("cohort_date")}) AS reinstall_share
FROM stg{where("event_date_utc")}"""


def _drift(p, before=None):
    at = lambda df, col: df if before is None else df.where(F.col(col) < before)
    return Q.dq_drift_metrics(at(p.stg_events, "event_date_utc"), at(p.int_user_install, "cohort_date"),
                              at(p.int_user_daily_activity, "activity_date"))


register("dq_drift_metrics", sql_prefix() + _drift_sql())(lambda spark, d: _drift(pipeline(spark, d)))

_HALF = "(SELECT max(event_date_utc) - 14 FROM stg)"


def _drift_watch(spark, d):
    """The baseline is stored as of a fortnight before the end, then all the data is held against it."""
    p = pipeline(spark, d)
    half = F.date_sub(p.stg_events.agg(F.max("event_date_utc")).scalar(), 14)
    path = shared_scratch_path(spark, "drift_baseline")
    write_table(_drift(p, half), path)
    return Q.dq_drift_status(_drift(p), spark.read.parquet(path), 0.05)


register("dq_drift_watch", sql_prefix() + f""", now AS ({_drift_sql()}),
past AS ({_drift_sql(_HALF)}),
n AS (UNPIVOT now ON one_day_user_share, none_medium_share, null_os_share, reinstall_share INTO NAME metric VALUE value),
b AS (UNPIVOT past ON one_day_user_share, none_medium_share, null_os_share, reinstall_share INTO NAME metric VALUE baseline)
SELECT metric, value, baseline, value - baseline AS delta,
       CASE WHEN value - baseline IS NULL THEN 'no baseline' WHEN abs(value - baseline) > 0.05 THEN 'warn' ELSE 'pass' END AS status
FROM n LEFT JOIN b USING (metric)""")(_drift_watch)

#: Days before the last one as of which the watchers ran; each run is stored under its id.
_RUNS = {f"run-{i}": back for i, back in enumerate((12, 9, 6, 3, 0))}


def _drift_trend(spark, d):
    """Five stored runs, one of them retried, each against the mean of the three before it."""
    p = pipeline(spark, d)
    path = shared_scratch_path(spark, "drift_history")
    for run, back in [*_RUNS.items(), ("run-4", 0)]:
        before = F.date_sub(p.stg_events.agg(F.max("event_date_utc")).scalar(), back - 1)
        history = append_batch(_drift(p, before), path, run)
    return Q.dq_drift_trend(history, BATCH, 3, 0.05)


_RUN_ROWS = "\nUNION ALL ".join(f"SELECT '{run}' AS run, r.* FROM ({_drift_sql(f'(SELECT max(event_date_utc) - {back - 1} FROM stg)')}) r"
                                for run, back in _RUNS.items())
register("dq_drift_trend", sql_prefix() + f""", runs AS ({_RUN_ROWS}),
v AS (UNPIVOT runs ON one_day_user_share, none_medium_share, null_os_share, reinstall_share INTO NAME metric VALUE value),
t AS (SELECT *, avg(value) OVER w AS baseline, count(value) OVER w AS n_runs FROM v
      WINDOW w AS (PARTITION BY metric ORDER BY run ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT *, value - baseline AS delta,
       CASE WHEN value - baseline IS NULL THEN 'no history' WHEN abs(value - baseline) > 0.05 THEN 'warn' ELSE 'pass' END AS status
FROM t""")(_drift_trend)
