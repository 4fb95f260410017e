"""Load patterns: scans, full-refresh and partitioned writes, incremental merge,
backfill, freshness and schema-drift checks. Parquet only.

A full refresh is written beside the table and swapped in, so a partition that
vanished from the output vanishes from the table, and a failed job leaves the old
table. A refresh of some partitions names them: those written are replaced, those
named but empty are removed. Re-running either is idempotent. Writes go
through a ``REBALANCE`` on the partition column: AQE splits an oversized day
(skew) and coalesces tiny ones, so file sizes stay even without a driver loop
over days.
"""

from __future__ import annotations

import bisect
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.operators import staging
from cohortflow.session import Scratch, clustered, path_exists, remove_path, rename_new, swap_in
from cohortflow.sources.schema import RAW_EVENTS, STAGING_COLUMNS
from cohortflow.sources.snapshots import SnapshotStore


#: Column of appended rows that names their batch.
BATCH = "batch_id"


class SchemaDriftError(RuntimeError):
    pass


def scan_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan with the declared contract schema (no inference)."""
    return spark.read.schema(RAW_EVENTS).parquet(path)


def contract_drift(actual: T.StructType, expected: T.StructType = RAW_EVENTS) -> list[tuple[str, str]]:
    """Columns of a source that break its contract: (name, missing / unexpected / type_changed).

    ``actual`` is the schema in the files' footers; a scan with the declared schema would turn a
    missing column into NULLs and drop an extra one without a word.
    """
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    out = [(n, "missing" if n not in have else "type_changed") for n, t in want.items() if have.get(n) != t]
    return out + [(n, "unexpected") for n in have if n not in want]


def footer_schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def require_contract(spark: SparkSession, path: str, expected: T.StructType = RAW_EVENTS) -> None:
    """Stop a load whose source does not have exactly the contract's columns."""
    drift = contract_drift(footer_schema(spark, path), expected)
    if drift:
        raise SchemaDriftError(f"{path}: " + ", ".join(f"{n} {what}" for n, what in drift))


def load_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def _writer(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]):
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    writer = out.write.partitionBy(*partition_by) if partition_by else out.write
    return clustered(writer, cluster_by[0]) if cluster_by else writer


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """Full refresh (or append) of a table, optionally partitioned / clustered; returns the table."""
    spark = df.sparkSession
    if mode == "append":
        _writer(df, partition_by, cluster_by).mode("append").parquet(path)
    else:
        staged = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex[:8]}"
        _writer(df, partition_by, cluster_by).mode(mode).parquet(staged)
        swap_in(spark, staged, path)
    return spark.read.parquet(path)


def replace_partitions(df: DataFrame, path: str, part_col: str, parts: Sequence, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Make the partitions ``parts`` of a table hold exactly the rows of ``df``.

    ``df`` must not read from ``path``. A listed partition without rows is removed; others stay.
    """
    spark = df.sparkSession
    _writer(df, [part_col], cluster_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    filled = {r[0] for r in df.select(part_col).distinct().collect()}
    for part in parts:
        if part not in filled and part is not None:
            remove_path(spark, f"{path.rstrip('/')}/{part_col}={part}")
    return spark.read.parquet(path)


class PathTable:
    """A partitioned table in a plain folder. A refresh replaces one partition after the other."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, part_col: str, parts: Sequence | None = None) -> DataFrame | None:
        df = read_if_exists(self.spark, self.path)
        return df if df is None or parts is None else df.where(in_parts(part_col, parts))

    def replace(self, df: DataFrame, part_col: str, parts: Sequence, cluster_by: Sequence[str] = ()) -> DataFrame:
        return replace_partitions(df, self.path, part_col, parts, cluster_by)


class StoredTable:
    """A table of a ``SnapshotStore``: a refresh of many partitions is one switch, so readers and crashes see
    all of the old ones or all of the new ones."""

    def __init__(self, store: SnapshotStore, name: str):
        self.spark, self.store, self.name = store.spark, store, name

    def read(self, part_col: str, parts: Sequence | None = None) -> DataFrame | None:
        now = self.store.current()
        return now.read(self.name, parts=parts) if self.name in now.tables else None

    def replace(self, df: DataFrame, part_col: str, parts: Sequence | None, cluster_by: Sequence[str] = ()) -> DataFrame:
        refresh = self.store.refresh()
        refresh.replace(self.name, df, part_col, parts, cluster_by)
        return refresh.publish().read(self.name)


Target = str | PathTable | StoredTable


def as_table(spark: SparkSession, target: Target) -> PathTable | StoredTable:
    return PathTable(spark, target) if isinstance(target, str) else target


def append_batch(df: DataFrame, path: str, batch_id: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
    """Append a batch once: its rows carry ``batch_id``, and a batch whose id is there already is left as it is.

    The batch is written into a hidden folder and renamed to ``batch_id=<id>`` when it is whole, so a failed
    append leaves nothing to read, and its retry, or a second delivery, adds nothing twice. Returns the table.
    """
    if not re.fullmatch(r"[A-Za-z0-9.-][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits, '.', '_' and '-' only")
    spark, base = df.sparkSession, path.rstrip("/")
    done = f"{base}/{BATCH}={batch_id}"
    if not path_exists(spark, done):
        staged = f"{base}/_appending-{uuid.uuid4().hex[:8]}"
        _writer(df, partition_by, cluster_by).mode("overwrite").parquet(staged)
        if not rename_new(spark, staged, done):  # another writer of the same batch was first
            remove_path(spark, staged)
    schema = T.StructType([*df.schema.fields, T.StructField(BATCH, T.StringType())])
    return spark.read.schema(schema).option("basePath", base).parquet(base)


def in_parts(col: str, parts: Sequence) -> Column:
    """A literal list of partition values: the planner prunes files by it, whatever the join strategy."""
    some = [p for p in parts if p is not None]
    cond = F.col(col).isin(some) if some else F.lit(False)
    return cond | F.col(col).isNull() if len(some) < len(parts) else cond


def distinct_days(df: DataFrame, col: str) -> list:
    """Distinct days of a batch: one value a calendar day, however many rows."""
    return sorted((r[0] for r in df.select(col).distinct().collect()), key=lambda d: (d is not None, d))


def view_layer(df: DataFrame, name: str) -> DataFrame:
    """Lazy view: a named logical plan, re-planned by every consumer."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def load_by_day(raw: DataFrame, path: str, day_col: str = "event_date_utc") -> DataFrame:
    """Stage every day in one job: dedup + type, then a partitioned write.

    Replaces the reference's per-day driver loop; days are partitions of one
    write, AQE balances them, and dynamic overwrite keeps re-runs idempotent.
    """
    return write_table(staging.stg_events(raw), path, [day_col], ["user_pseudo_id"])


def merge_increment(target: Target, new_raw: DataFrame, day_col: str = "event_date_utc") -> DataFrame:
    """Upsert a batch of raw events into the day-partitioned staging table (a path or a stored table).

    The batch is staged and written once. Only its days' partitions of the table are read (literals in the
    scan, or folders named by the pointer); the union is deduplicated on the event key with the staging
    tie-breaks and replaces those partitions, in one switch for a stored table. Late rows and re-delivered
    duplicates both land correctly; applying the same batch twice equals once. The scratch tables are deleted.
    """
    spark = new_raw.sparkSession
    table = as_table(spark, target)
    if isinstance(table, PathTable) and table.read(day_col) is None:
        return load_by_day(new_raw, table.path, day_col)
    cols = [n for n, _ in STAGING_COLUMNS]
    with Scratch(spark) as scratch:
        incoming = scratch.table(staging.stg_events(new_raw).select(*cols), "merge_batch")
        days = distinct_days(incoming, day_col)
        kept = table.read(day_col, days)
        both = incoming if kept is None else kept.select(*cols).unionByName(incoming)
        merged = scratch.table(staging.dedup_staged(both), "merge_result")
        return table.replace(merged, day_col, days, ["user_pseudo_id"])


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where the path does not exist; every other error is raised."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _moved_cohorts(table: DataFrame, rebuilt: DataFrame, inside: Column, part_col: str, user_col: str) -> list:
    """Cohorts outside the range that hold, in either version, a user who is inside it in the other."""
    users = table.where(inside).select(user_col).union(rebuilt.where(inside).select(user_col)).distinct()
    outside = [df.where(~inside).select(user_col, part_col).distinct().join(users, user_col, "left_semi").select(part_col)
               for df in (table, rebuilt)]
    return distinct_days(outside[0].union(outside[1]), part_col)


def following(cohorts: Sequence, changed: Sequence, n: int) -> list:
    """The next ``n`` cohorts after each changed one (their trailing windows look back at it)."""
    ordered, hit = sorted(cohorts), set()
    for c in changed:
        at = bisect.bisect_right(ordered, c)
        hit.update(ordered[at:at + n])
    return sorted(hit)


def backfill_range(target: Target, rebuilt: DataFrame, start, end, part_col: str = "cohort_date",
                   user_col: str | None = "user_pseudo_id", trailing: int = 0,
                   also: Sequence = ()) -> list:
    """Make the table equal ``rebuilt`` for the cohorts in [start, end]; returns the cohorts replaced.

    A cohort of the range that has become empty is removed. Users who moved across the range's
    border change other cohorts too: with ``user_col``, those are replaced as well. A table of
    trailing averages (a mart) has no users: give it the fact's replaced cohorts in ``also`` and
    the number of cohorts its window looks back in ``trailing``, and the cohorts that follow each
    changed one are replaced too. Running it twice equals once; a stored table changes in one switch.
    """
    spark = rebuilt.sparkSession
    stored = as_table(spark, target)
    table = stored.read(part_col)
    inside = F.col(part_col).between(F.lit(start), F.lit(end))
    changed = set(also)
    for df in (table, rebuilt):
        changed.update(distinct_days(df.where(inside), part_col))
    if user_col:
        changed.update(_moved_cohorts(table, rebuilt, inside, part_col, user_col))
    if trailing:
        known = set(distinct_days(table, part_col)) | set(distinct_days(rebuilt, part_col))
        changed.update(following(known, changed, trailing))
    cohorts = sorted(changed)
    with Scratch(spark) as scratch:
        rows = scratch.table(rebuilt.where(in_parts(part_col, cohorts)), "backfill")
        stored.replace(rows, part_col, cohorts, [user_col] if user_col else [])
    return cohorts


def freshness(df: DataFrame, ts_col: str, as_of: Column, warn_after_hours: float = 24.0,
              error_after_hours: float | None = 48.0) -> DataFrame:
    """Age of the newest row against ``as_of``: pass / warn / error."""
    newest = F.max(ts_col)
    age = F.timestamp_diff("MICROSECOND", newest, as_of).cast("double") / F.lit(3.6e9)
    status = F.when(age > F.lit(float("inf") if error_after_hours is None else error_after_hours), F.lit("error")) \
              .when(age > F.lit(warn_after_hours), F.lit("warn")).otherwise(F.lit("pass"))
    return df.agg(F.max(ts_col).alias("max_loaded_at"), age.alias("age_hours"), status.alias("status"))


def schema_drift(df: DataFrame, expected: Sequence[tuple[str, str]] = STAGING_COLUMNS) -> DataFrame:
    """Per expected column: actual type, status (ok / type_changed / missing)
    and its non-NULL row count (one pass); unexpected extra columns are listed
    with status ``unexpected``."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    exp = dict(expected)
    names = [n for n, _ in expected] + [n for n in actual if n not in exp]
    counts = df.agg(*[F.count(F.col(n)).alias(n) for n in names if n in actual])
    rows = []
    for i, n in enumerate(names):
        e, a = exp.get(n), actual.get(n)
        status = "unexpected" if e is None else "missing" if a is None else "ok" if a == e else "type_changed"
        nn = F.col(n) if a is not None else F.lit(None).cast("bigint")
        rows.append(F.struct(F.lit(i + 1).alias("position"), F.lit(n).alias("column_name"),
                             F.lit(e).cast("string").alias("expected_type"), F.lit(a).cast("string").alias("actual_type"),
                             F.lit(status).alias("status"), nn.alias("n_non_null")))
    return counts.select(F.explode(F.array(*rows)).alias("c")).select("c.*")
