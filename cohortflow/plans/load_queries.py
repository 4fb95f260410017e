"""Registered source / sink / load-pattern queries (§2.2, §2.9).

Each query performs its write into a fresh folder under the shared checkpoint
directory and returns the table read back, so the check sees what landed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortflow.operators import quality as Q
from cohortflow.plans import oracle
from cohortflow.plans.quality_sql import suite_sql
from cohortflow.plans.registry import MAX_DAY, pipeline, raw_path, register
from cohortflow.session import shared_scratch_path
from cohortflow.sources import loads as L
from cohortflow.sources.schema import STAGING_COLUMNS
from cohortflow.sources.snapshots import SnapshotStore


def _sql(body: str) -> str:
    return oracle.model_ctes(MAX_DAY) + "\n" + body


_RAW_FLAT = ("user_pseudo_id", "event_timestamp", "event_name", "event_date", "platform",
             "event_bundle_sequence_id", "event_value_in_usd")


def _scan_raw(spark, d):
    raw = L.scan_raw_events(spark, raw_path(spark, d))
    return raw.select(*_RAW_FLAT, F.size("event_params").cast("bigint").alias("n_params"),
                      F.size("user_properties").cast("bigint").alias("n_user_properties"))


register("scan_raw_events", _sql(
    f"SELECT {', '.join(_RAW_FLAT)}, CAST(len(event_params) AS BIGINT) AS n_params, "
    "CAST(len(user_properties) AS BIGINT) AS n_user_properties FROM raw_events"))(_scan_raw)

_SOURCE_CHECKS = [c for c in Q.pipeline_checks(MAX_DAY) if c.table == "source_events"]


def _source_contract(spark, d):
    """Declared checks of the source, and its columns as the files' footers have them."""
    path = raw_path(spark, d)
    drift = len(L.contract_drift(L.footer_schema(spark, path)))
    raw = L.scan_raw_events(spark, path)
    checks = Q.run_checks(spark, {"source_events": raw}, _SOURCE_CHECKS)
    schema_row = spark.range(1).select(
        F.lit("schema__source_events").alias("check_id"), F.lit("source_events").alias("table_name"),
        F.lit("schema").alias("kind"), F.lit("error").alias("severity"),
        F.lit(drift).cast("bigint").alias("n_violations"),
        F.lit("pass" if drift == 0 else "fail").alias("status"))
    return checks.unionByName(schema_row)


register("source_contract", oracle.model_ctes(MAX_DAY) + ",\nsource_events AS (SELECT * FROM raw_events)\n"
         + suite_sql(lambda kind, table: table == "source_events")
         + "\nUNION ALL\nSELECT 'schema__source_events', 'source_events', 'schema', 'error', CAST(0 AS BIGINT), 'pass'")(_source_contract)

register("load_count", _sql("SELECT count(*) AS n_rows FROM stg"))(
    lambda spark, d: L.load_count(pipeline(spark, d).stg_events))

register("write_table", _sql("SELECT * FROM stg"))(
    lambda spark, d: L.write_table(pipeline(spark, d).stg_events, shared_scratch_path(spark, "stg_full")))

register("view_layer", _sql("SELECT * FROM activity"))(
    lambda spark, d: L.view_layer(pipeline(spark, d).int_user_daily_activity, "int_user_daily_activity_v"))


def _load_by_day(spark, d):
    path = shared_scratch_path(spark, "stg_by_day")
    t = L.load_by_day(pipeline(spark, d).raw, path)
    return t.groupBy("event_date_utc").agg(F.count(F.lit(1)).alias("n_rows"))


register("load_by_day", _sql("SELECT event_date_utc, count(*) AS n_rows FROM stg GROUP BY 1"))(_load_by_day)


def _cutoff(stg, days_back: int = 7):
    return F.date_sub(stg.agg(F.max("event_date_utc")).scalar(), days_back)


def _append_days(spark, d):
    stg = pipeline(spark, d).stg_events
    path = shared_scratch_path(spark, "stg_append")
    cut = _cutoff(stg)
    L.append_batch(stg.where(F.col("event_date_utc") < cut), path, "history", ["event_date_utc"])
    new_days = stg.where(F.col("event_date_utc") >= cut)
    L.append_batch(new_days, path, "week-1", ["event_date_utc"])
    return L.append_batch(new_days, path, "week-1", ["event_date_utc"]).drop(L.BATCH)  # delivered twice


register("append_days", _sql("SELECT * FROM stg"))(_append_days)


def _merge_increment(spark, d):
    """Initial load of the older days, then a batch re-delivering the last
    three loaded days (duplicates) plus the new days, applied twice."""
    p = pipeline(spark, d)
    raw = p.raw
    utc_day = F.expr("CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)")
    cut = _cutoff(p.stg_events)
    table = L.StoredTable(SnapshotStore(spark, shared_scratch_path(spark, "stg_merge")), "stg_events")
    L.merge_increment(table, raw.where(utc_day < cut))
    batch = raw.where(utc_day >= F.date_sub(cut, 3))
    L.merge_increment(table, batch)
    return L.merge_increment(table, batch)


register("merge_increment", _sql("SELECT * FROM stg"))(_merge_increment)

register("layout_partition_cluster", _sql("SELECT * FROM fct"))(
    lambda spark, d: L.write_table(pipeline(spark, d).fct_user_daily, shared_scratch_path(spark, "fct_layout"),
                                   ["activity_date"], ["user_pseudo_id"]))


def _backfill(spark, d):
    """A fact table built while a fifth of the latest fortnight's users lacked their first two days (so
    their cohorts came out later), then backfilled over that fortnight from the whole fact."""
    fct = pipeline(spark, d).fct_user_daily
    table = L.StoredTable(SnapshotStore(spark, shared_scratch_path(spark, "fct_by_cohort")), "fct_user_daily")
    last = fct.agg(F.max("cohort_date")).first()[0]
    start = last - dt.timedelta(days=13)
    late = (F.pmod(F.xxhash64("user_pseudo_id"), F.lit(5)) == 0) & (F.col("cohort_date") >= F.lit(start))
    seen = F.min("activity_date").over(Window.partitionBy("user_pseudo_id"))
    moved = (fct.where(late & (F.col("day_number") >= 2)).withColumn("cohort_date", seen)
             .withColumn("day_number", F.datediff("activity_date", "cohort_date")))
    table.replace(fct.where(~late).unionByName(moved), "cohort_date", None, ["user_pseudo_id"])
    L.backfill_range(table, fct, start, last)
    return table.read("cohort_date")


register("backfill_range", _sql("SELECT * FROM fct"))(_backfill)

AS_OF = "2024-02-01 00:00:00"
register("freshness", _sql(f"""SELECT max(event_ts_utc) AS max_loaded_at,
       CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(event_ts_utc)) AS DOUBLE) / 3.6e9 AS age_hours,
       CASE WHEN CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(event_ts_utc)) AS DOUBLE) / 3.6e9 > 48 THEN 'error'
            WHEN CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(event_ts_utc)) AS DOUBLE) / 3.6e9 > 24 THEN 'warn'
            ELSE 'pass' END AS status
FROM stg"""))(
    lambda spark, d: L.freshness(pipeline(spark, d).stg_events, "event_ts_utc",
                                 F.lit(AS_OF).cast("timestamp_ntz"), 24.0, 48.0))

register("schema_drift", _sql("\nUNION ALL\n".join(
    f"SELECT {i + 1} AS position, '{n}' AS column_name, '{t}' AS expected_type, '{t}' AS actual_type, "
    f"'ok' AS status, count({n}) AS n_non_null FROM stg" for i, (n, t) in enumerate(STAGING_COLUMNS))))(
    lambda spark, d: L.schema_drift(pipeline(spark, d).stg_events))


def _stream_ingest(spark, d):
    """Raw events land as day-grouped files; a file stream drains them in
    several micro-batches, each merged into staging."""
    from cohortflow.streaming.ingest import ingest_available
    p = pipeline(spark, d)
    src = shared_scratch_path(spark, "raw_landing")
    utc_day = F.expr("CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)")
    # range partitions on (day, ts): several landing files (several micro-batches), as many as the
    # session shuffles into, and a day holding a large share of the rows is split across them
    p.raw.repartitionByRange(utc_day, F.col("event_timestamp")).write.mode("overwrite").parquet(src)
    return ingest_available(spark, src, shared_scratch_path(spark, "stg_stream"),
                            shared_scratch_path(spark, "stream_ckpt"), max_files_per_trigger=2)


register("stream_ingest", _sql("SELECT * FROM stg"))(_stream_ingest)


_WAREHOUSES: dict[tuple[str, str], object] = {}


def refreshed_warehouse(spark, d):
    """A warehouse after an initial load of the older days and a batch that re-delivers three loaded days,
    brings late events of a tenth of the users (which move cohorts) and adds the rest. Once a session and folder."""
    from cohortflow.plans.warehouse import Warehouse
    key = (spark.sparkContext.applicationId, d)
    if key not in _WAREHOUSES:
        p = pipeline(spark, d)
        raw = p.raw
        utc_day = F.expr("CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)")
        cut = _cutoff(p.stg_events)
        late = (F.pmod(F.xxhash64("user_pseudo_id"), F.lit(10)) == 0) & (utc_day < F.date_sub(cut, 7))
        warehouse = Warehouse(spark, shared_scratch_path(spark, "warehouse"), max_day=MAX_DAY, trailing=28)
        warehouse.apply(raw.where((utc_day < cut) & ~late))
        warehouse.apply(raw.where(late | (utc_day >= F.date_sub(cut, 3))))
        _WAREHOUSES[key] = warehouse
    return _WAREHOUSES[key]


def _refreshed(table: str):
    return lambda spark, d: refreshed_warehouse(spark, d).table(table)


register("incremental_refresh", oracle.revenue_sql(("install_platform",), MAX_DAY, 28))(_refreshed("mart_revenue_by_platform"))
register("incremental_retention", oracle.retention_sql((), MAX_DAY, 28))(_refreshed("mart_retention_overall"))
register("incremental_fct_user_daily", _sql("SELECT * FROM fct"))(_refreshed("fct_user_daily"))
register("incremental_dim_users", _sql("SELECT * FROM dim"))(_refreshed("dim_users"))
