"""Streaming ingest: restart on the same checkpoint picks up only new files,
re-delivered duplicates resolve by the batch dedup rule."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cohortflow.plans.pipeline import Pipeline
from cohortflow.plans.warehouse import Warehouse
from cohortflow.session import shared_scratch_path
from cohortflow.streaming import ingest
from cohortflow.streaming.ingest import ingest_available

SF = "/root/testdata/sf0.001"


def test_two_rounds_with_redelivery(spark):
    p = Pipeline.from_events(spark, SF)
    raw = p.raw
    day = F.expr("CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)")
    landing, stg, ckpt = (shared_scratch_path(spark, n) for n in ("landing", "stg", "ckpt"))
    cut = raw.agg(F.max(day)).scalar()
    first = raw.where(day < F.date_sub(cut, 10))
    second = raw.where(day >= F.date_sub(cut, 14))      # overlaps 4 days: re-delivered rows
    first.write.mode("append").parquet(landing)
    n1 = ingest_available(spark, landing, stg, ckpt).count()
    assert n1 == p.stg_events.where(F.col("event_date_utc") < F.date_sub(F.lit(cut), 10)).count()
    second.write.mode("append").parquet(landing)
    out = ingest_available(spark, landing, stg, ckpt)
    want = p.stg_events
    assert out.count() == want.count()
    assert out.select(*want.columns).exceptAll(want).count() == 0


def test_a_drifted_file_that_arrives_mid_stream_is_set_aside(spark):
    p = Pipeline.from_events(spark, SF)
    raw = p.raw.where(F.col("event_timestamp").isNotNull())
    part = lambda i: raw.where(F.pmod(F.xxhash64("user_pseudo_id"), F.lit(3)) == i).coalesce(1)
    landing, stg, ckpt, aside = (shared_scratch_path(spark, n) for n in ("drift landing", "drift_stg", "drift_ckpt", "drift_aside"))
    part(0).write.mode("append").parquet(landing)
    assert ingest_available(spark, landing, stg, ckpt, quarantine_path=aside).count() > 0
    # three drifted files beside a good one
    part(1).write.mode("append").parquet(landing)
    part(2).drop("platform").write.mode("append").parquet(landing)
    part(2).withColumn("event_timestamp", F.col("event_timestamp").cast("string")).write.mode("append").parquet(landing)
    part(2).withColumn("surprise", F.lit(1)).write.mode("append").parquet(landing)
    out = ingest_available(spark, landing, stg, ckpt, max_files_per_trigger=2, quarantine_path=aside)
    want = p.stg_events.where(F.pmod(F.xxhash64("user_pseudo_id"), F.lit(3)) != 2)
    assert out.count() == want.count() and out.select(*want.columns).exceptAll(want).count() == 0
    seen = {(r.column_name, r.problem) for r in spark.read.parquet(aside).collect()}
    assert seen == {("platform", "missing"), ("event_timestamp", "type_changed"), ("surprise", "unexpected")}
    # delivered again as the contract has it
    part(2).write.mode("append").parquet(landing)
    assert ingest_available(spark, landing, stg, ckpt, quarantine_path=aside).count() == p.stg_events.count()


def test_without_a_quarantine_a_drifted_file_stops_the_stream(spark, monkeypatch):
    raw = Pipeline.from_events(spark, SF).raw.limit(50)
    landing, stg, ckpt = (shared_scratch_path(spark, n) for n in ("stop_landing", "stop_stg", "stop_ckpt"))
    raw.write.mode("append").parquet(landing)
    n = ingest_available(spark, landing, stg, ckpt).count()
    raw.withColumn("surprise", F.lit(1)).write.mode("append").parquet(landing)
    stream = ingest.raw_event_stream
    monkeypatch.setattr(ingest, "raw_event_stream", lambda s, path, m, check_start: stream(s, path, m, False))  # it came after the start
    with pytest.raises(StreamingQueryException, match="surprise"):
        ingest.start_ingest(spark, landing, stg, ckpt).awaitTermination()
    assert spark.read.parquet(stg).count() == n


def test_a_stream_keeps_a_warehouse(spark):
    p = Pipeline.from_events(spark, SF, max_day=6, trailing=3, persist=True)
    landing, ckpt = (shared_scratch_path(spark, n) for n in ("wh_landing", "wh_ckpt"))
    p.raw.repartition(2, "user_pseudo_id").write.mode("append").parquet(landing)
    w = Warehouse(spark, shared_scratch_path(spark, "wh_stream"), max_day=6, trailing=3, user_buckets=4)
    assert ingest.ingest_available(spark, landing, w, ckpt, max_files_per_trigger=1).count() == p.stg_events.count()
    assert w.store.current().version == 2                       # two micro-batches
    for name in ("dim_users", "mart_revenue_overall"):
        a, b = w.table(name), getattr(p, name)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    p.close()
