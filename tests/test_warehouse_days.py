"""A day new to the warehouse is staged once; days it holds are merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.operators import staging
from cohortflow.plans.pipeline import Pipeline
from cohortflow.plans.warehouse import Warehouse
from cohortflow.session import shared_scratch_path
from cohortflow.sources import loads as L

SF = "/root/testdata/sf0.001"
DAY = "CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)"


def test_new_days_are_not_deduplicated_again(spark, monkeypatch):
    path = shared_scratch_path(spark, "warehouse_days_raw")
    Pipeline.from_events(spark, SF).raw.write.parquet(path)
    raw = L.scan_raw_events(spark, path)
    raw = raw.unionByName(raw.limit(3).withColumn("event_timestamp", F.lit(None).cast("bigint")))  # a batch with a null day
    calls, dedup = [], staging.dedup_staged
    monkeypatch.setattr(staging, "dedup_staged", lambda df: calls.append(1) or dedup(df))
    warehouse = Warehouse(spark, shared_scratch_path(spark, "warehouse_days"))
    late = F.pmod(F.xxhash64("user_pseudo_id"), F.lit(10)) == 0
    old = F.expr(f"{DAY} < DATE'2024-01-25'")
    warehouse.apply(raw.where(old & ~late))
    assert len(calls) == 1  # the staging of the batch itself
    warehouse.apply(raw.where(late | ~F.coalesce(old, F.lit(False)) | F.expr(f"{DAY} >= DATE'2024-01-22'")))  # held, new and null days
    assert len(calls) == 3
    want, got = staging.stg_events(raw), warehouse.table("stg_events").select(*staging.STAGING_COLUMN_NAMES)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
