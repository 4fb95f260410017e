"""Quality kinds on violating data; load patterns are idempotent; plan shape."""

from __future__ import annotations

from conftest import d
from pyspark.sql import functions as F

from cohortflow.operators import daily
from cohortflow.operators import quality as Q
from cohortflow.plans.pipeline import Pipeline
from cohortflow.session import shared_scratch_path
from cohortflow.sources import loads as L

SF = "/root/testdata/sf0.001"


def test_generic_kinds_find_violations(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, "X"), (1, "b", -1, "IOS"), (None, "c", 3, None), (2, "c", None, "ANDROID")],
        "k int, name string, n int, platform string")
    parent = spark.createDataFrame([(1,)], "k int")
    assert Q.dq_not_null(df, "k").count() == 1
    assert Q.dq_unique(df, "k").count() == 1                      # k=1 twice; NULL ignored
    assert Q.dq_unique_combination(df, ["k", "name"]).count() == 0
    assert Q.dq_accepted_values(df, "platform", ["ANDROID", "IOS"]).count() == 1   # NULL passes
    assert Q.dq_accepted_range(df, "n", 0, 4).count() == 2
    assert Q.dq_relationships(df, "k", parent, "k").count() == 1  # k=2 orphan; NULL ignored
    assert Q.dq_expression_is_true(df, ">= 0", "n").count() == 1  # NULL passes


def test_run_checks_statuses(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    checks = [Q.Check("t", "not_null", "b"), Q.Check("t", "unique", "a", severity="warn"),
              Q.Check("t", "not_null", "a")]
    got = {r.check_id: (r.n_violations, r.status) for r in Q.run_checks(spark, {"t": df}, checks).collect()}
    assert got == {"not_null__t__b": (1, "fail"), "unique__t__a": (1, "warn"), "not_null__t__a": (0, "pass")}


def test_merge_increment_is_idempotent_and_complete(spark):
    p = Pipeline.from_events(spark, SF)
    raw = p.raw
    day = F.expr("CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)")
    path = shared_scratch_path(spark, "test_merge")
    L.load_by_day(raw.where(day < d("2024-01-20")), path)
    batch = raw.where(day >= d("2024-01-15"))
    once = L.merge_increment(path, batch)
    n_once = once.count()
    twice = L.merge_increment(path, batch)
    assert twice.count() == n_once == p.stg_events.count()
    assert twice.exceptAll(p.stg_events.select(*twice.columns)).count() == 0


def test_fact_join_reads_buckets_without_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = Pipeline.from_events(spark, SF, persist=True)
        plan = daily.fact_enriched(p.rollup, p.int_user_install)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        join_part = plan.split("SortMergeJoin", 1)[1]
        assert "Exchange" not in join_part, plan
        scan = p.mart_retention_overall, p.retention()._jdf.queryExecution().executedPlan().toString()
        assert scan[1].count("fct_enriched") == 1 and "user_day" not in scan[1].replace("fct_user_day", "")
        p.close()
        assert not [t for t in spark.catalog.listTables() if t.name in p.scratch.tables]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_pruning_on_written_layout(spark):
    p = Pipeline.from_events(spark, SF)
    t = L.write_table(p.fct_user_daily, shared_scratch_path(spark, "test_layout"), ["activity_date"],
                      ["user_pseudo_id"])
    q = t.where(F.col("activity_date") == d("2024-01-10"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(activity_date" in plan
    assert q.count() == p.fct_user_daily.where(F.col("activity_date") == d("2024-01-10")).count()


def test_build_publishes_all_tables_and_gates(spark):
    from cohortflow.plans.build import QualityGateError, run_build
    p = Pipeline.from_events(spark, SF)
    raw_path = shared_scratch_path(spark, "test_raw")
    p.raw.write.parquet(raw_path)
    raw = L.scan_raw_events(spark, raw_path)
    out = shared_scratch_path(spark, "test_build")
    res = run_build(spark, raw_path, out)
    assert res.count() == 71 and res.where("status = 'fail'").count() == 0
    stg = spark.read.parquet(f"{out}/stg_events")
    assert stg.count() == p.stg_events.count()
    assert spark.read.parquet(f"{out}/mart_revenue_by_platform").count() == p.mart_revenue_by_platform.count()
    bad = raw.withColumn("platform", F.lit("WEB"))
    try:
        run_build(spark, bad, shared_scratch_path(spark, "test_build_bad"))
        raise AssertionError("gate did not stop the build")
    except QualityGateError as e:
        assert "accepted_values__source_events__platform" in str(e)


def test_row_checks_are_counted_while_tables_are_written(spark):
    """The counts equal a scan's, also where there are violations, and the suite's plan scans less."""
    p = Pipeline.from_events(spark, SF)
    spoilt = p.raw.withColumn("platform", F.when(F.pmod(F.xxhash64("user_pseudo_id"), F.lit(7)) == 0, F.lit(None)).otherwise(F.col("platform")))
    pipe = Pipeline(spoilt, persist=True)
    checks = [c for c in Q.pipeline_checks() if c.kind in Q.ROW_LEVEL and c.table not in ("source_events", "day_numbers")]
    tables, counted = pipe.tables(), pipe.counted
    assert set(counted) == {c.check_id for c in checks}
    scanned = {r.check_id: r.n_violations for r in Q.run_checks(spark, tables, checks).collect()}
    assert counted == scanned and scanned["not_null__stg_events__platform"] > 0 and scanned["not_null__dim_users__install_platform"] > 0
    plan = lambda known: Q.run_checks(spark, tables, checks, known)._jdf.queryExecution().executedPlan().toString()
    assert plan(None).count("FileScan") >= 9 and plan(counted).count("FileScan") == 0
    pipe.close()


def test_event_key_check_reads_buckets_without_exchange(spark):
    """Staging is bucketed by the dedup's own exchange: neither the write nor the check shuffles all events once more."""
    pipe = Pipeline(Pipeline.from_events(spark, SF).raw, persist=True)
    key = ["user_pseudo_id", "event_timestamp", "event_name"]
    plan = Q.dq_unique_combination(pipe.stg_events, key)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert Q.dq_unique_combination(pipe.stg_events, key).count() == 0
    twice = pipe.stg_events.unionByName(pipe.stg_events.limit(3))
    assert Q.dq_unique_combination(twice, key).count() == 3
    pipe.close()
