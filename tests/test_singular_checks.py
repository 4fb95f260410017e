"""Each singular check on tables that hold, then with one violation seeded; drift against a stored baseline."""

from __future__ import annotations

import pytest
from conftest import d, dec, make_stg
from pyspark.sql import functions as F

from cohortflow.operators import quality as Q
from cohortflow.operators.spine import published
from cohortflow.plans.pipeline import Pipeline
from cohortflow.plans.quality_sql import suite_sql


@pytest.fixture(scope="module")
def tables(spark):
    buy = dict(event_name="in_app_purchase", event_value_in_usd=dec(2), platform="IOS")
    stg = make_stg(spark, [
        dict(user_pseudo_id="a", event_name="first_open", ts="2018-06-12T10:00:00", platform="IOS"),
        dict(user_pseudo_id="a", ts="2018-06-14T10:00:00", **buy),
        dict(user_pseudo_id="b", event_name="first_open", ts="2018-06-13T10:00:00", platform="ANDROID"),
        dict(user_pseudo_id="b", ts="2018-06-13T11:00:00", **(buy | {"platform": "ANDROID"})),
        dict(user_pseudo_id="c", event_name="e", ts="2018-06-13T10:00:00", platform="IOS")])
    p = Pipeline(stg, max_day=5)
    p.__dict__["stg_events"] = stg
    return {k: v.cache() for k, v in p.tables().items()} | {"_p": p}


def one(df):
    return df.collect()[0].n_violations


CASES = {
    "revenue": (lambda s, t: Q.chk_revenue_reconciliation(s, t["stg_events"], t["dim_users"], t["mart_revenue_overall"], 5),
                "mart_revenue_overall", lambda df: df.withColumn("cum_revenue", F.col("cum_revenue") + F.when(F.col("cohort_date") == d("2018-06-13"), 1).otherwise(0))),
    "purchases": (lambda s, t: Q.chk_n_purchases_reconciliation(s, t["stg_events"], t["dim_users"], t["fct_user_daily"], 5),
                  "fct_user_daily", lambda df: df.withColumn("n_purchases", F.col("n_purchases") + (F.col("user_pseudo_id") == "c").cast("int"))),
    "payers": (lambda s, t: Q.chk_paying_users_reconciliation(s, t["stg_events"], t["dim_users"], t["fct_user_daily"], 5),
               "fct_user_daily", lambda df: df.withColumn("paying_flag", F.col("paying_flag") | (F.col("user_pseudo_id") == "c"))),
    "cohort size": (lambda s, t: Q.chk_cohort_size_reconciliation(s, t["dim_users"], t["mart_retention_overall"]),
                    "dim_users", lambda df: df.where("user_pseudo_id <> 'c'")),
    "d0": (lambda s, t: Q.chk_d0_full_retention(s, t["mart_retention_overall"]),
           "mart_retention_overall", lambda df: df.withColumn("retained_users", F.when(F.col("cohort_date") == d("2018-06-13"), F.lit(1).cast("bigint")).otherwise(F.col("retained_users")))),
    "d0 by platform": (lambda s, t: Q.chk_d0_full_retention(s, t["mart_retention_by_platform"]),
                       "mart_retention_by_platform", lambda df: df.withColumn("retention_pct", F.when(F.col("install_platform") == "ANDROID", F.lit(0.5)).otherwise(F.col("retention_pct")))),
    "monotonic": (lambda s, t: Q.chk_cum_revenue_monotonic(s, t["mart_revenue_overall"]),
                  "mart_revenue_overall", lambda df: df.withColumn("cum_revenue", F.when((F.col("day_number") == 4) & (F.col("cohort_date") == d("2018-06-12")), F.lit(dec(1))).otherwise(F.col("cum_revenue")))),
    "monotonic by platform": (lambda s, t: Q.chk_cum_revenue_monotonic(s, t["mart_revenue_by_platform"], ["install_platform"]),
                              "mart_revenue_by_platform", lambda df: df.withColumn("cum_revenue", F.when((F.col("day_number") == 4) & (F.col("install_platform") == "ANDROID"), F.lit(dec(1))).otherwise(F.col("cum_revenue")))),
    "cohort dates": (lambda s, t: Q.chk_fct_dim_cohort_date(s, t["fct_user_daily"], t["dim_users"]),
                     "dim_users", lambda df: df.withColumn("cohort_date", F.when(F.col("user_pseudo_id") == "b", F.lit(d("2018-06-11"))).otherwise(F.col("cohort_date")))),
    "revenue days": (lambda s, t: Q.chk_revenue_days_are_activity_days(s, t["int_user_daily_revenue"], t["int_user_daily_activity"]),
                     "int_user_daily_activity", lambda df: df.where("activity_date <> date'2018-06-14'")),
}


@pytest.mark.parametrize("name", CASES)
def test_check_passes_then_finds_the_seeded_violation(spark, tables, name):
    check, table, spoil = CASES[name]
    assert one(check(spark, tables)) == 0
    assert one(check(spark, tables | {table: spoil(tables[table])})) == 1


def test_spine_check_can_fail(spark):
    spine = spark.createDataFrame([(0,), (1,), (1,), (None,), (31,)], "day_number int")
    checks = [c for c in Q.pipeline_checks(30) if c.table == "day_numbers"]
    got = {r.kind: r.n_violations for r in Q.run_checks(spark, {"day_numbers": spine}, checks).collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_range": 1}


@pytest.mark.parametrize("spoil, kind, n", [
    (lambda m: m, None, 0),
    (lambda m: m.where("NOT (cohort_date = DATE'2024-01-02' AND day_number = 3)"), "not_null", 1),       # a later cohort lacks a day
    (lambda m: m.where("day_number <> 3"), "not_null", 1),                                                # all lack it
    (lambda m: m.unionByName(m.where("cohort_date = DATE'2024-01-02' AND day_number = 2")), "unique", 1),  # one has it twice
    (lambda m: m.unionByName(m.where("cohort_date = DATE'2024-01-02' AND day_number = 2").withColumn("day_number", F.lit(5))),
     "accepted_range", 1),
])
def test_spine_checks_see_every_cohort(spark, spoil, kind, n):
    mart = spark.sql("SELECT DATE'2024-01-01' + c AS cohort_date, d AS day_number FROM "
                     "(SELECT explode(sequence(0, 2)) AS c) LATERAL VIEW explode(sequence(0, 4)) AS d")
    checks = [c for c in Q.pipeline_checks(4) if c.table == "day_numbers"]
    got = {r.kind: r.n_violations for r in Q.run_checks(spark, {"day_numbers": published(spoil(mart), 4)}, checks).collect()}
    assert got == {"not_null": 0, "unique": 0, "accepted_range": 0} | ({kind: n} if kind else {})


def test_sql_names_the_same_checks():
    names = {(c.check_id, c.severity) for c in Q.pipeline_checks(30)}
    assert len(names) == 71
    sql = suite_sql()
    assert all(f"'{i}' AS check_id" in sql for i, _ in names) and sql.count(" AS check_id") == 71


def test_drift_is_held_against_a_stored_row(spark):
    now = spark.createDataFrame([(0.5, 0.7, None, 0.1)], "a double, b double, c double, e double")
    then = spark.createDataFrame([(0.52, 0.5, 0.1)], "a double, b double, c double")
    got = {r.metric: r.status for r in Q.dq_drift_status(now, then, 0.05).collect()}
    assert got == {"a": "pass", "b": "warn", "c": "no baseline", "e": "no baseline"}


def test_drift_trend_looks_at_the_runs_before(spark):
    rows = [(f"r{i}", v, 0.5) for i, v in enumerate((0.1, 0.3, 0.2, 0.9))] + [("r4", None, 0.5)]
    history = spark.createDataFrame(rows, "run_id string, a double, b double")
    got = {(r.run, r.metric): (r.n_runs, None if r.baseline is None else round(r.baseline, 9), r.status)
           for r in Q.dq_drift_trend(history, "run_id", 2, 0.05).collect()}
    assert [got[f"r{i}", "a"] for i in range(5)] == [(0, None, "no history"), (1, 0.1, "warn"), (2, 0.2, "pass"), (2, 0.25, "warn"),
                                                     (2, 0.55, "no history")]
    assert {got[f"r{i}", "b"][2] for i in range(1, 5)} == {"pass"}
