"""Refreshes: merge, backfill, full refresh and incremental rollup change what they must and nothing else."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from conftest import d
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.operators import staging
from cohortflow.plans import incremental as I
from cohortflow.plans.build import run_build
from cohortflow.plans.pipeline import Pipeline
from cohortflow.session import PAGE_ROWS, ensure_checkpoint_dir, shared_scratch_path
from cohortflow.sources import loads as L
from cohortflow.sources.schema import RAW_EVENTS
from cohortflow.sources.snapshots import SnapshotStore
from cohortflow.streaming.ingest import raw_event_stream

SF = "/root/testdata/sf0.001"
DAY = ("CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)")
FACT = "user_pseudo_id string, cohort_date date, day_number int"


@pytest.fixture(scope="module")
def raw(spark):
    path = shared_scratch_path(spark, "refresh_raw")
    Pipeline.from_events(spark, SF).raw.write.parquet(path)
    return L.scan_raw_events(spark, path)


def files(path: str) -> dict[str, float]:
    return {str(f): f.stat().st_mtime_ns for f in Path(path.removeprefix("file:")).rglob("part-*")}


def scratch_folders(spark) -> int:
    return len(list(Path(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables").glob("*")))


def fact(spark, rows):
    return spark.createDataFrame([(u, d(c), n) for u, c, n in rows], FACT)


def as_set(df) -> set:
    return {tuple(str(x) for x in r) for r in df.select("user_pseudo_id", "cohort_date", "day_number").collect()}


def test_full_refresh_drops_vanished_partitions(spark):
    path = shared_scratch_path(spark, "full")
    L.write_table(fact(spark, [("a", "2024-01-01", 0), ("b", "2024-01-02", 0)]), path, ["cohort_date"])
    out = L.write_table(fact(spark, [("b", "2024-01-02", 1)]), path, ["cohort_date"])
    assert as_set(out) == {("b", "2024-01-02", "1")}
    again = L.write_table(out.withColumn("day_number", F.col("day_number") + 1), path, ["cohort_date"])  # from itself
    assert as_set(again) == {("b", "2024-01-02", "2")}


def test_failed_refresh_keeps_the_old_table(spark):
    path = shared_scratch_path(spark, "kept")
    L.write_table(fact(spark, [("a", "2024-01-01", 0)]), path, ["cohort_date"])
    bad = fact(spark, [("a", "2024-01-02", 0)]).withColumn("day_number", F.expr("raise_error('broken')").cast("int"))
    with pytest.raises(Exception, match="broken"):
        L.write_table(bad, path, ["cohort_date"])
    assert as_set(spark.read.parquet(path)) == {("a", "2024-01-01", "0")}


def test_only_a_missing_path_is_no_table(spark, tmp_path):
    assert L.read_if_exists(spark, f"{tmp_path}/none") is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        L.read_if_exists(spark, f"{tmp_path}/empty")


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_merge_reads_and_writes_only_its_days(spark, raw, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        path = shared_scratch_path(spark, "pruned")
        L.load_by_day(raw, path)
        days = [d("2024-01-10"), d("2024-01-11")]
        kept = spark.read.parquet(path).where(L.in_parts("event_date_utc", days))
        read = set(kept.inputFiles())
        scan = kept._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in scan and "event_date_utc" in scan.split("PartitionFilters: [")[1].split("]")[0]
        old, folders = files(path), None
        for _ in range(3):
            L.merge_increment(path, raw.where(F.expr(DAY).isin(days)))
            assert folders in (None, scratch_folders(spark))      # scratch does not pile up
            folders = scratch_folders(spark)
        new = files(path)
        untouched = {f for f in old if "2024-01-10" not in f and "2024-01-11" not in f}
        assert all(new.get(f) == old[f] for f in untouched)
        assert len(read) >= 1 and not {f for f in new if f not in old and "2024-01-1" not in f}
        assert spark.read.parquet(path).count() == staging.stg_events(raw).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


OLD = [("a", "2024-01-05", 0), ("a", "2024-01-05", 1), ("b", "2024-01-05", 0), ("c", "2024-01-06", 0), ("e", "2024-01-09", 0),
       ("f", "2024-01-02", 0), ("g", "2024-01-12", 0)]


@pytest.mark.parametrize("new", [
    [("a", "2024-01-03", 0), ("a", "2024-01-03", 1), *OLD[2:]],                      # moved inside the range
    [OLD[2], *OLD[4:]],                                                              # user gone, cohort 01-06 empty
    [("a", "2024-01-01", 0), ("a", "2024-01-01", 1), *OLD[2:]],                      # moved out over the border
    [*OLD[:4], ("e", "2024-01-04", 0), *OLD[5:]],                                    # moved in over the border
    [*OLD[:5], ("f", "2024-01-03", 0), OLD[6]],                                      # the only user of an outer cohort moves in
])
def test_backfill_follows_moved_users(spark, new):
    path = shared_scratch_path(spark, "backfill")
    L.write_table(fact(spark, OLD), path, ["cohort_date"], ["user_pseudo_id"])
    for _ in range(2):
        L.backfill_range(path, fact(spark, new), d("2024-01-03"), d("2024-01-07"))
        assert as_set(spark.read.parquet(path)) == as_set(fact(spark, new))


def test_backfill_leaves_cohorts_it_has_no_business_with(spark):
    path = shared_scratch_path(spark, "backfill_rest")
    L.write_table(fact(spark, OLD), path, ["cohort_date"], ["user_pseudo_id"])
    changed = [(u, c, n + 5) for u, c, n in OLD]
    assert L.backfill_range(path, fact(spark, changed), d("2024-01-05"), d("2024-01-06")) == [d("2024-01-05"), d("2024-01-06")]
    want = {r if r[1] in ("2024-01-05", "2024-01-06") else o for r, o in zip(changed, OLD)}
    assert as_set(spark.read.parquet(path)) == as_set(fact(spark, sorted(want)))


def test_backfilled_mart_gets_new_trailing_values(spark):
    """A fact whose cohorts changed, then its mart: rows that look back at the changed cohorts follow."""
    rows = [(f"c{i}", str(d("2024-01-01") + dt.timedelta(days=i)), n) for i in range(12) for n in range(1 + i % 3)]
    mart = lambda df: df.groupBy("cohort_date").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "trailing", F.avg("n").over(Window.orderBy("cohort_date").rowsBetween(-3, -1)))
    fact_path, mart_path = shared_scratch_path(spark, "bf_fact"), shared_scratch_path(spark, "bf_mart")
    L.write_table(fact(spark, rows), fact_path, ["cohort_date"])
    L.write_table(mart(fact(spark, rows)), mart_path, ["cohort_date"])
    new = fact(spark, [*rows, ("x", "2024-01-04", 0), ("x", "2024-01-04", 1)])
    replaced = L.backfill_range(fact_path, new, d("2024-01-04"), d("2024-01-04"))
    done = L.backfill_range(mart_path, mart(new), d("2024-01-04"), d("2024-01-04"), user_col=None, trailing=3, also=replaced)
    assert done == [d(f"2024-01-0{i}") for i in (4, 5, 6, 7)]
    got = {(str(r.cohort_date), r.n, r.trailing) for r in spark.read.parquet(mart_path).collect()}
    assert got == {(str(r.cohort_date), r.n, r.trailing) for r in mart(new).collect()}


def test_incremental_rollup_equals_a_full_build(spark, raw):
    """Late rows before the first event of some users move their cohorts; other days are not rewritten."""
    stg, rollup = shared_scratch_path(spark, "inc_stg"), shared_scratch_path(spark, "inc_rollup")
    cut = d("2024-01-15")
    late = (F.expr(DAY) < d("2024-01-06")) & (F.pmod(F.xxhash64("user_pseudo_id"), F.lit(3)) == 0)
    base = raw.where((F.expr(DAY) < cut) & ~late)
    I.write_rollup(L.load_by_day(base, stg), rollup)
    batch = raw.where(late | (F.expr(DAY) >= cut))
    now = L.merge_increment(stg, batch)
    days = I.touched_days(staging.stg_events(batch))
    old = files(rollup)
    refreshed = I.refresh_rollup(now, rollup, days)
    kept = {f for f in old if not any(str(x) in f for x in days)}
    assert kept and all(files(rollup).get(f) == old[f] for f in kept)
    got, want = I.derived_tables(refreshed, 10), Pipeline(raw, max_day=10).tables()
    for name in ("int_user_install", "mart_retention_overall", "mart_retention_by_platform", "mart_revenue_overall", "mart_revenue_by_platform"):
        cols = got[name].columns
        a, b = got[name], want[name].select(*cols)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


def test_source_columns_must_be_the_contracts(spark, raw):
    drifted = {
        "missing": raw.drop("platform"),
        "unexpected": raw.withColumn("surprise", F.lit(1)),
        "type_changed": raw.withColumn("event_timestamp", F.col("event_timestamp").cast("string")),
    }
    for what, df in drifted.items():
        path = shared_scratch_path(spark, f"drift_{what}")
        df.write.parquet(path)
        assert [w for _, w in L.contract_drift(L.footer_schema(spark, path))] == [what]
        out = shared_scratch_path(spark, "drift_out")
        with pytest.raises(L.SchemaDriftError, match=what):
            run_build(spark, path, out)
        assert L.read_if_exists(spark, f"{out}/stg_events") is None
        with pytest.raises(L.SchemaDriftError):
            raw_event_stream(spark, path)
    assert L.contract_drift(RAW_EVENTS) == [] and L.contract_drift(T.StructType(RAW_EVENTS.fields[1:])) == [(RAW_EVENTS.fields[0].name, "missing")]


def test_zero_hours_is_a_limit(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    as_of = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    assert L.freshness(df, "ts", as_of, 0.0, 0.0).collect()[0].status == "error"
    assert L.freshness(df, "ts", as_of, 24.0, None).collect()[0].status == "pass"


def test_an_append_retried_or_delivered_twice_adds_once(spark):
    path = shared_scratch_path(spark, "appended")
    one, two = fact(spark, OLD[:3]), fact(spark, OLD[3:])
    bad = one.withColumn("day_number", F.expr("raise_error('broken')").cast("int"))
    with pytest.raises(Exception, match="broken"):
        L.append_batch(bad, path, "b1", ["cohort_date"])
    assert L.read_if_exists(spark, f"{path}/batch_id=b1") is None
    L.append_batch(one, path, "b1", ["cohort_date"])
    before = files(path)
    L.append_batch(two, path, "b1", ["cohort_date"])                     # the id is taken: refused
    assert files(path) == before and as_set(spark.read.parquet(path)) == as_set(one)
    out = L.append_batch(two, path, "b2", ["cohort_date"])
    assert as_set(out) == as_set(fact(spark, OLD)) and out.count() == len(OLD)
    assert {r[0] for r in out.where("cohort_date = DATE'2024-01-09'").select("batch_id").collect()} == {"b2"}
    with pytest.raises(ValueError):
        L.append_batch(two, path, "../x")


def test_a_stored_table_changes_all_its_partitions_in_one_switch(spark, monkeypatch):
    table = L.StoredTable(SnapshotStore(spark, shared_scratch_path(spark, "stored")), "fact")
    table.replace(fact(spark, OLD), "cohort_date", None, ["user_pseudo_id"])
    new = [(u, c, n + 5) for u, c, n in OLD if c != "2024-01-06"]

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(SnapshotStore, "_switch", killed)
    with pytest.raises(KeyboardInterrupt):
        L.backfill_range(table, fact(spark, new), d("2024-01-05"), d("2024-01-09"))
    assert as_set(table.read("cohort_date")) == as_set(fact(spark, OLD))
    monkeypatch.undo()
    for _ in range(2):
        L.backfill_range(table, fact(spark, new), d("2024-01-05"), d("2024-01-09"))
        want = {r for r in new if r[1] >= "2024-01-05" and r[1] <= "2024-01-09"} | {r for r in OLD if r[1] in ("2024-01-02", "2024-01-12")}
        assert as_set(table.read("cohort_date")) == as_set(fact(spark, sorted(want)))


def test_a_merge_into_a_stored_table_equals_a_merge_into_a_folder(spark, raw):
    table = L.StoredTable(SnapshotStore(spark, shared_scratch_path(spark, "stored_stg")), "stg_events")
    L.merge_increment(table, raw.where(F.expr(DAY) < d("2024-01-10")))
    opened = len(table.store.current().parts("stg_events"))
    out = L.merge_increment(table, raw.where(F.expr(DAY) >= d("2024-01-08")))
    assert opened == 9 and out.count() == staging.stg_events(raw).count()


def scanned_rows(df) -> int:
    """Rows that the file scans of a collected query gave on, after skipped row groups and pages."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_look_up_by_the_cluster_column_skips_row_groups_and_pages(spark):
    users = spark.range(200_000).selectExpr("concat('u', lpad(id * 7, 9, '0')) AS user_pseudo_id", "DATE'2024-01-01' + CAST(id % 2 AS INT) AS day", "id AS x")
    path = shared_scratch_path(spark, "clustered")
    table = L.write_table(users.repartition(3), path, ["day"], ["user_pseudo_id"])
    one = table.where("user_pseudo_id = 'u000700000'")          # id 100,000
    assert [r.x for r in one.select("x").collect()] == [100_000]
    assert scanned_rows(one.select("x")) <= 2 * PAGE_ROWS < 0.06 * 200_000
    absent = table.where("user_pseudo_id = 'u000700001'")       # inside every file's range, in none of them: bloom filter
    assert scanned_rows(absent.select("x")) == 0
    few = L.write_table(users.where("id < 100").coalesce(1), shared_scratch_path(spark, "few"), ["day"], ["user_pseudo_id"])
    assert max(Path(f.removeprefix("file:")).stat().st_size for f in few.inputFiles()) < 20_000  # the filter fits the values
