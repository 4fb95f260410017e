"""Data-quality operators.

Generic checks (7 kinds) return the violating rows — empty means pass — and
``run_checks`` evaluates a whole suite into one row per check. Row-level kinds
(not_null, accepted_values, accepted_range, expression_is_true) of the same
table are folded into ONE aggregation pass (``count_if`` per check, then an
unpivot), so a suite of 35 not-null checks costs one scan, not 35; counted while
the table is written (``row_metrics``), they cost none. Uniqueness
is a ``groupBy`` with map-side partial counts; relationships a ``left_anti``.

Expressions are SQL text with the NULL rule of the reference's generic test:
a row violates when ``NOT (expr)`` is TRUE, so NULL passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow import constants as C

ROW_LEVEL = ("not_null", "accepted_values", "accepted_range", "expression_is_true")


# ---- the seven generic kinds, as violating-row operators ---------------------

def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """Duplicated non-NULL values (one row per value, with its count)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def dq_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def dq_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(col).isin(list(values)))


def dq_accepted_range(df: DataFrame, col: str, min_value=None, max_value=None) -> DataFrame:
    return df.where(~_range_ok(col, min_value, max_value))


def dq_relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (``left_anti``)."""
    keys = parent.select(F.col(parent_col).alias(col))
    return child.where(F.col(col).isNotNull()).join(keys, col, "left_anti")


def dq_expression_is_true(df: DataFrame, expr: str, col: str | None = None) -> DataFrame:
    return df.where(~F.expr(_expression(expr, col)))


def _range_ok(col: str, lo, hi):
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def _expression(expr: str, col: str | None) -> str:
    return f"{col} {expr}" if col else expr


# ---- suites -----------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    column: str | None = None
    args: Mapping = field(default_factory=dict)
    severity: str = "error"

    @property
    def check_id(self) -> str:
        if self.kind == "unique_combination":
            target = "__".join(self.args["columns"])
        elif self.kind == "expression_is_true":
            target = (self.column + "__" if self.column else "") + self.args["name"]
        else:
            target = self.column or ""
        return f"{self.kind}__{self.table}__{target}"

    def violation_condition(self):
        """Row-level kinds: Column that is TRUE on a violating row."""
        c = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return ~c.isin(list(self.args["values"]))
        if self.kind == "accepted_range":
            return ~_range_ok(self.column, self.args.get("min_value"), self.args.get("max_value"))
        if self.kind == "expression_is_true":
            return ~F.expr(_expression(self.args["expr"], self.column))
        raise ValueError(self.kind)

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.kind == "unique":
            return dq_unique(df, self.column)
        if self.kind == "unique_combination":
            return dq_unique_combination(df, self.args["columns"])
        if self.kind == "relationships":
            return dq_relationships(df, self.column, tables[self.args["to"]], self.args["field"])
        return df.where(self.violation_condition())


def _result(c: Check, n: Column) -> Column:
    return F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.table).alias("table_name"),
                    F.lit(c.kind).alias("kind"), F.lit(c.severity).alias("severity"),
                    n.cast("bigint").alias("n_violations"))


def row_metrics(checks: Sequence[Check], table: str, only: Column | None = None) -> dict[str, Column]:
    """Counts of the row-level checks of ``table``, by check id, to be taken while its rows (or those
    ``only`` holds for) are written."""
    return {c.check_id: F.count_if(c.violation_condition() if only is None else only & c.violation_condition())
            for c in checks if c.table == table and c.kind in ROW_LEVEL}


def run_checks(spark: SparkSession, tables: Mapping[str, DataFrame], checks: Sequence[Check],
               counted: Mapping[str, int] | None = None) -> DataFrame:
    """One row per check: check_id, table_name, kind, severity, n_violations, status.

    Check metadata rides along as literals, so the suite is one union of
    per-table aggregates with no joins and no driver-built tables. ``counted`` holds
    counts of row-level checks taken while the tables were written; those add no scan.
    """
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    known = [c for c in checks if c.check_id in (counted or {})]
    if known:
        rows = F.array(*[_result(c, F.lit(counted[c.check_id])) for c in known])
        parts.append(spark.range(1).select(F.explode(rows).alias("r")))
    for c in checks:
        if c in known:
            continue
        if c.kind in ROW_LEVEL:
            by_table.setdefault(c.table, []).append(c)
        else:
            n = c.violations(tables).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(n.select(_result(c, F.col("_n")).alias("r")))
    for table, cs in by_table.items():
        wide = tables[table].agg(*[F.count_if(c.violation_condition()).alias(f"c{i}") for i, c in enumerate(cs)])
        parts.append(wide.select(F.explode(F.array(*[_result(c, F.col(f"c{i}")) for i, c in enumerate(cs)])).alias("r")))
    counts = reduce(DataFrame.unionByName, parts).select("r.*")
    return counts.select(
        "check_id", "table_name", "kind", "severity", "n_violations",
        F.when(F.col("n_violations") == 0, F.lit("pass"))
         .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")).alias("status"))


def pipeline_checks(max_day: int = C.MAX_DAY_NUMBER) -> list[Check]:
    """The 71 generic checks declared on the source and every model."""
    nn = lambda t, *cols: [Check(t, "not_null", c) for c in cols]
    ex = lambda t, name, expr, col=None, sev="error": Check(t, "expression_is_true", col,
                                                             {"name": name, "expr": expr}, sev)
    combo = lambda t, *cols: Check(t, "unique_combination", None, {"columns": list(cols)})
    rel = lambda t, col, sev="error": Check(t, "relationships", col,
                                           {"to": "dim_users", "field": "user_pseudo_id"}, sev)
    checks: list[Check] = []
    # fixed values: columns, expressions and severities as the models declare them
    # source contract
    checks += nn("source_events", "user_pseudo_id", "event_timestamp", "event_name", "platform")
    checks.append(Check("source_events", "accepted_values", "platform", {"values": list(C.PLATFORMS)}))
    # staging
    checks += nn("stg_events", "user_pseudo_id", "event_timestamp", "event_ts_utc", "event_date_utc",
                 "event_name", "platform", "device_category")
    checks.append(combo("stg_events", "user_pseudo_id", "event_timestamp", "event_name"))
    checks.append(ex("stg_events", "value_only_on_purchases",
                     f"event_value_in_usd is null or (event_value_in_usd > 0 and event_name = '{C.PURCHASE_EVENT}')"))
    # spine
    checks += nn("day_numbers", "day_number")
    checks.append(Check("day_numbers", "unique", "day_number"))
    checks.append(Check("day_numbers", "accepted_range", "day_number", {"min_value": 0, "max_value": max_day}))
    # intermediate
    checks += nn("int_user_install", "user_pseudo_id")
    checks.append(Check("int_user_install", "unique", "user_pseudo_id"))
    checks += nn("int_user_install", "cohort_date")
    for t in ("int_user_daily_activity", "int_user_daily_revenue"):
        checks += nn(t, "user_pseudo_id")
        checks.append(rel(t, "user_pseudo_id", "warn"))
        checks += nn(t, "activity_date")
    # core marts
    checks += nn("dim_users", "user_pseudo_id")
    checks.append(Check("dim_users", "unique", "user_pseudo_id"))
    checks += nn("dim_users", "cohort_date", "install_platform")
    checks += nn("fct_user_daily", "user_pseudo_id")
    checks.append(rel("fct_user_daily", "user_pseudo_id"))
    checks += nn("fct_user_daily", "cohort_date", "activity_date", "day_number")
    checks.append(ex("fct_user_daily", "ge_0", ">= 0", "day_number"))
    checks.append(ex("fct_user_daily", "ge_1", ">= 1", "events"))
    checks.append(ex("fct_user_daily", "ge_0", ">= 0", "engagement_sec"))
    checks.append(ex("fct_user_daily", "ge_0", ">= 0", "gross_revenue"))
    checks.append(ex("fct_user_daily", "ge_0", ">= 0", "n_purchases"))
    checks.append(combo("fct_user_daily", "user_pseudo_id", "activity_date"))
    checks.append(ex("fct_user_daily", "paying_flag_matches_revenue", "paying_flag = (gross_revenue > 0)"))
    # report marts
    for t, sl in (("mart_retention_overall", ()), ("mart_retention_by_platform", ("install_platform",))):
        checks += nn(t, "cohort_date", *sl, "day_number")
        checks.append(ex(t, "gt_0", "> 0", "cohort_size"))
        checks.append(ex(t, "between_0_1", "between 0 and 1", "retention_pct"))
        checks.append(ex(t, "between_0_1", "between 0 and 1", "retention_pct_trailing_4w_avg"))
        checks.append(combo(t, "cohort_date", *sl, "day_number"))
        checks.append(ex(t, "retained_le_size", "retained_users <= cohort_size"))
    for t, sl in (("mart_revenue_overall", ()), ("mart_revenue_by_platform", ("install_platform",))):
        checks += nn(t, "cohort_date", *sl, "day_number")
        checks.append(ex(t, "ge_0", ">= 0", "gross_revenue"))
        checks.append(ex(t, "ge_0", ">= 0", "paying_users"))
        checks.append(combo(t, "cohort_date", *sl, "day_number"))
        checks.append(ex(t, "paying_le_size", "paying_users <= cohort_size"))
        if not sl:
            checks.append(ex(t, "arppu_consistent",
                             "cum_arppu is null or abs(cum_arppu - cum_revenue / nullif(cum_paying_users, 0)) "
                             f"< {C.ARPPU_TOLERANCE}"))
    return checks


# ---- singular checks: one row (n_violations, lhs, rhs); 0 violations = pass ----

def _one_row(spark: SparkSession, n, lhs, rhs) -> DataFrame:
    return spark.range(1).select(n.cast("bigint").alias("n_violations"),
                                 lhs.cast("double").alias("lhs"), rhs.cast("double").alias("rhs"))


def _totals_check(spark, lhs_df: DataFrame, rhs_df: DataFrame) -> DataFrame:
    """Compare two one-row totals (scalar subqueries, not a cross join)."""
    lhs, rhs = lhs_df.scalar(), rhs_df.scalar()
    bad = F.coalesce(lhs, F.lit(0)) != F.coalesce(rhs, F.lit(0))
    return _one_row(spark, bad.cast("int"), lhs, rhs)


def _purchase_days_in_window(stg: DataFrame, dim: DataFrame, max_day: int, value_positive: bool = False):
    """Staging purchases pre-aggregated to (user, day) before meeting the user
    dimension — a hot user costs one row per day in the join, not its events."""
    p = stg.where(F.col("event_name") == C.PURCHASE_EVENT)
    if value_positive:
        p = p.where(F.col("event_value_in_usd") > 0)
    per_day = p.groupBy("user_pseudo_id", "event_date_utc").agg(
        F.sum("event_value_in_usd").alias("value"), F.count(F.lit(1)).alias("n"))
    return (per_day.join(dim.select("user_pseudo_id", "cohort_date"), "user_pseudo_id")
                   .where(F.datediff("event_date_utc", "cohort_date").between(0, max_day)))


def chk_revenue_reconciliation(spark, stg, dim, mart_revenue_overall, max_day=30):
    lhs = mart_revenue_overall.where(F.col("day_number") == max_day).agg(
        F.sum("cum_revenue").cast("decimal(18,4)"))
    rhs = _purchase_days_in_window(stg, dim, max_day).agg(F.sum("value").cast("decimal(18,4)"))
    return _totals_check(spark, lhs, rhs)


def chk_n_purchases_reconciliation(spark, stg, dim, fct, max_day=30):
    lhs = fct.where(F.col("day_number").between(0, max_day)).agg(F.sum("n_purchases"))
    rhs = _purchase_days_in_window(stg, dim, max_day).agg(F.sum("n"))
    return _totals_check(spark, lhs, rhs)


def chk_paying_users_reconciliation(spark, stg, dim, fct, max_day=30):
    lhs = (fct.where(F.col("day_number").between(0, max_day) & F.col("paying_flag"))
              .join(dim.select("user_pseudo_id"), "user_pseudo_id")
              .agg(F.count_distinct("user_pseudo_id")))
    rhs = _purchase_days_in_window(stg, dim, max_day, value_positive=True).agg(F.count_distinct("user_pseudo_id"))
    return _totals_check(spark, lhs, rhs)


def chk_cohort_size_reconciliation(spark, dim, mart_retention_overall):
    lhs = mart_retention_overall.where(F.col("day_number") == 0).agg(F.sum("cohort_size"))
    rhs = dim.agg(F.count(F.lit(1)))
    return _totals_check(spark, lhs, rhs)


def _row_check(spark, df: DataFrame, violation) -> DataFrame:
    """n_violations = rows where ``violation`` holds; lhs = rows checked, rhs = rows passing."""
    agg = df.agg(F.count_if(violation).alias("n"), F.count(F.lit(1)).alias("rows"))
    return agg.select(F.col("n").cast("bigint").alias("n_violations"),
                      F.col("rows").cast("double").alias("lhs"),
                      (F.col("rows") - F.col("n")).cast("double").alias("rhs"))


def chk_d0_full_retention(spark, mart_retention):
    d0 = mart_retention.where(F.col("day_number") == 0)
    return _row_check(spark, d0, (F.col("retained_users") != F.col("cohort_size"))
                      | (F.col("retention_pct") != F.lit(1.0)))


def chk_cum_revenue_monotonic(spark, mart_revenue, slice_cols: Sequence[str] = ()):
    w = Window.partitionBy("cohort_date", *slice_cols).orderBy("day_number")
    lagged = mart_revenue.select("cum_revenue", F.lag("cum_revenue").over(w).alias("prev"))
    return _row_check(spark, lagged.where(F.col("prev").isNotNull()), F.col("cum_revenue") < F.col("prev"))


def chk_fct_dim_cohort_date(spark, fct, dim):
    j = fct.select("user_pseudo_id", "cohort_date").join(
        dim.select("user_pseudo_id", F.col("cohort_date").alias("dim_cohort_date")), "user_pseudo_id")
    return _row_check(spark, j, F.col("cohort_date") != F.col("dim_cohort_date"))


def chk_revenue_days_are_activity_days(spark, revenue, activity):
    orphans = revenue.join(activity.select("user_pseudo_id", "activity_date"),
                           ["user_pseudo_id", "activity_date"], "left_anti")
    n = orphans.agg(F.count(F.lit(1))).scalar()
    total = revenue.agg(F.count(F.lit(1))).scalar()
    return _one_row(spark, n, total, total - n)


def dq_drift_metrics(stg: DataFrame, install: DataFrame, rollup_days: DataFrame) -> DataFrame:
    """Drift watchers as one aggregate row: one-day-user share, '(none)' medium
    share, NULL OS share, reinstall share (compare against a stored baseline)."""
    days = rollup_days.groupBy("user_pseudo_id").agg(F.count(F.lit(1)).alias("d"))
    one_day = days.agg(F.avg((F.col("d") == 1).cast("double"))).scalar()
    ev = stg.agg(
        F.avg(F.coalesce(F.col("traffic_medium") == "(none)", F.lit(False)).cast("double")).alias("none_medium_share"),
        F.avg(F.col("device_os").isNull().cast("double")).alias("null_os_share"),
    )
    reinstall = install.agg(F.avg(F.col("is_reinstall").cast("double"))).scalar()
    return ev.select(one_day.alias("one_day_user_share"), "none_medium_share", "null_os_share",
                     reinstall.alias("reinstall_share"))


def dq_drift_status(metrics: DataFrame, baseline: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """The watchers' row against a stored one of an earlier run: a row a metric, ``pass`` / ``warn``.

    A watcher never fails a build. A metric that either side lacks is ``no baseline``.
    """
    names = metrics.columns
    now = metrics.unpivot([], names, "metric", "value")
    then = baseline.select(*[F.col(c).cast("double") for c in names if c in baseline.columns]).unpivot(
        [], [c for c in names if c in baseline.columns], "metric", "baseline")
    delta = F.col("value") - F.col("baseline")
    status = (F.when(delta.isNull(), F.lit("no baseline")).when(F.abs(delta) > F.lit(tolerance), F.lit("warn"))
               .otherwise(F.lit("pass")))
    return now.join(then, "metric", "left").select("metric", "value", "baseline", delta.alias("delta"), status.alias("status"))


def dq_drift_trend(history: DataFrame, run_col: str, window: int = 5, tolerance: float = 0.05) -> DataFrame:
    """Every stored run of the watchers against the mean of the ``window`` runs before it.

    One row a run and metric; a run without an earlier value is ``no history``. A watcher never fails a build.
    """
    names = [c for c in history.columns if c != run_col]
    values = history.select(F.col(run_col).alias("run"), *[F.col(c).cast("double") for c in names]).unpivot(["run"], names, "metric", "value")
    before = Window.partitionBy("metric").orderBy("run").rowsBetween(-window, -1)
    delta = F.col("value") - F.col("baseline")
    status = (F.when(delta.isNull(), F.lit("no history")).when(F.abs(delta) > F.lit(tolerance), F.lit("warn"))
               .otherwise(F.lit("pass")))
    return (values.withColumn("baseline", F.avg("value").over(before)).withColumn("n_runs", F.count("value").over(before))
            .select("run", "metric", "value", "baseline", "n_runs", delta.alias("delta"), status.alias("status")))
