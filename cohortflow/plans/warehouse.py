"""A maintained warehouse: a batch of events changes only what depends on it.

``Warehouse.apply`` merges a batch into staging, finds the (user, day) rows that differ, and carries
that change set through every derived table as differences:

- users whose rows changed get new totals (old plus difference), days, first event and cohort; only
  their buckets of the user table are read;
- a histogram of ``events_total`` gets the old values of those users taken out and the new ones put in,
  and the p99 is computed from it; of all other users, only those between the old and the new cut
  change their outlier flag, and they are looked up only where the histogram has any;
- fact rows of changed (user, day) pairs, and all days of users whose cohort or install attributes
  moved, are taken out and put in; a user's days are on record, so only those days are read;
- cohort cells and sizes take the signed sums of those fact and user rows;
- marts are computed anew from the cells of the changed cohorts and of the ``trailing`` cohorts after
  each, whose baselines look back at them.

All tables are published in one step (``sources.snapshots``): a failure leaves the state before. The
first batch is a full build by the same path, and applying a batch twice equals once.

Events without a timestamp have no day: they are staged and counted, but a user who has no other events is
not in the user table (the source checks stop such a batch before it gets here).

Sizes: a batch's days, the changed buckets and cohorts are short lists on the driver (one value a day
or bucket). Every join is on the user or the event key; a user has one row a day at most by then.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import constants as C
from cohortflow.functions.numeric import DEC4
from cohortflow.operators import daily, marts, staging, users
from cohortflow.operators.quantiles import exact_percentiles
from cohortflow.session import Scratch, path_bytes
from cohortflow.sources.loads import distinct_days, in_parts
from cohortflow.sources.schema import STAGING_COLUMNS
from cohortflow.sources.snapshots import Refresh, Snapshot, SnapshotStore, part_name

USER, STG_DAY, DAY, COHORT, BUCKET = "user_pseudo_id", "event_date_utc", "activity_date", "cohort_date", "user_bucket"
#: Staged bytes of the first batch a user bucket, and the least number of buckets.
BUCKET_BYTES, MIN_BUCKETS = 128 << 20, 8
INSTALL_ATTRIBUTES = (COHORT, "install_platform", "install_country", "install_traffic_medium", "install_app_id",
                      "first_event_name", "is_reinstall")
CELL_MEASURES = ("retained_users", "gross_revenue", "paying_users")
#: Writes that do not need each other are submitted side by side, so that small ones share the cluster.
WRITERS = 6


def _values(df: DataFrame, col: str) -> list:
    """Distinct days, cohorts or buckets: one value each, however many rows."""
    return distinct_days(df, col)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


class Warehouse:
    """Tables under ``root``: stg_events, user_day, users, events_histogram, fct_user_daily, cohort_cells,
    cohort_sizes and the marts by no slice and by ``slice_cols``."""

    def __init__(self, spark: SparkSession, root: str, max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS,
                 slice_cols: Sequence[str] = ("install_platform",), p: float = C.OUTLIER_PERCENTILE, user_buckets: int | None = None):
        self.spark, self.store = spark, SnapshotStore(spark, root)
        self.max_day, self.trailing, self.slice_cols, self.p = max_day, trailing, list(slice_cols), p
        self.user_buckets = user_buckets

    # -- reading --------------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        """A table of the published state; ``int_user_install`` and ``dim_users`` are views of ``users``."""
        now = self.store.current()
        if name == "int_user_install":
            return now.read("users").select(*users.INSTALL_COLUMNS)
        if name == "dim_users":
            return now.read("users").select(*users.DIM_COLUMNS)
        table = now.read(name)
        return daily.fct_user_daily(table) if name == "fct_user_daily" else table

    def mart_names(self) -> dict[str, tuple[str, list[str]]]:
        """Mart table -> (family, slice columns)."""
        out = {f"mart_{family}_overall": (family, []) for family in ("retention", "revenue")}
        if self.slice_cols:
            by = "_".join(c.removeprefix("install_") for c in self.slice_cols)
            out |= {f"mart_{family}_by_{by}": (family, self.slice_cols) for family in ("retention", "revenue")}
        return out

    # -- the refresh ------------------------------------------------------------------
    def apply(self, raw_batch: DataFrame) -> dict:
        """Merge a batch of raw events. Returns the partitions read and written, by table."""
        with Scratch(self.spark) as scratch, ThreadPoolExecutor(WRITERS) as pool:
            return self._apply(raw_batch, scratch, pool)

    def _apply(self, raw_batch: DataFrame, scratch: Scratch, pool: ThreadPoolExecutor) -> dict:
        new = self.store.refresh()
        old = new.base
        settings = {"max_day": self.max_day, "trailing": self.trailing, "slice_cols": self.slice_cols, "p": self.p}
        if old.version and {k: old.meta[k] for k in settings} != settings:
            raise ValueError(f"the warehouse was built with {old.meta}, not {settings}: build a new one")

        # staging: only the batch's days
        cols = [n for n, _ in STAGING_COLUMNS]
        incoming = scratch.table(staging.stg_events(raw_batch).select(*cols), "batch")
        batch_bytes = path_bytes(self.spark, scratch.path_of["batch"])
        days = _values(incoming, STG_DAY)
        if not days:
            return {"read": {}, "written": {}}
        staged = self._staged(old, incoming, days, scratch)
        rollup = scratch.table(daily.user_day_rollup(staged), "user_day")
        writes = [pool.submit(new.replace, "stg_events", staged, STG_DAY, days, [USER]),
                  pool.submit(new.replace, "user_day", rollup, DAY, days, [USER])]

        # user-day rows that differ, and what depends on them
        changes = scratch.table(self._changes(old.read("user_day", rollup.schema, days), rollup), "changes")
        if not changes.isEmpty():
            buckets = old.meta.get("user_buckets") or self.user_buckets or max(MIN_BUCKETS, -(-batch_bytes // BUCKET_BYTES))
            moved = scratch.table(self._user_changes(old, changes, rollup.schema, buckets), "user_changes")
            cut = pool.submit(self._users, old, new, moved, scratch)
            deltas = scratch.table(self._fact_deltas(old, changes, moved, rollup.schema), "fact_deltas")
            writes += [pool.submit(self._fact, old, new, deltas), *self._marts(old, new, deltas, moved, scratch, pool)]
            new.meta |= {**settings, "user_buckets": buckets, "events_p99": cut.result()}
        for write in writes:
            write.result()
        new.publish()
        return {"read": dict(old.opened), "written": dict(new.written)}

    @staticmethod
    def _staged(old: Snapshot, incoming: DataFrame, days: list, scratch: Scratch) -> DataFrame:
        """Staged rows of the batch's days after it. A day that the table does not hold yet takes the staged batch
        as it is: an event's copies share its timestamp, so none of them lies in another day."""
        there = set(old.parts("stg_events"))
        held = [d for d in days if part_name(d) in there]
        if not held:
            return incoming
        fresh = [d for d in days if part_name(d) not in there]
        again = old.read("stg_events", incoming.schema, held).unionByName(incoming.where(in_parts(STG_DAY, held)))
        return scratch.table(staging.dedup_staged(again).unionByName(incoming.where(in_parts(STG_DAY, fresh))), "staged")

    @staticmethod
    def _changes(before: DataFrame, after: DataFrame) -> DataFrame:
        """(user, day, was, is): user-day rows that differ; a missing side is null."""
        row = lambda df, name: df.select(F.col(USER).alias(f"{name}_user"), F.col(DAY).alias(f"{name}_day"),
                                         F.struct(*df.columns).alias(name))
        both = row(before, "was").join(row(after, "is"), _same("was_user", "is_user") & _same("was_day", "is_day"), "full_outer")
        return both.where(~_same("was", "is")).select(F.coalesce("was_user", "is_user").alias(USER),
                                                      F.coalesce("was_day", "is_day").alias(DAY), "was", "is")

    def _user_changes(self, old: Snapshot, changes: DataFrame, rollup_schema: T.StructType, buckets: int) -> DataFrame:
        """(user, was, is): rows of the user table before and after, for users of the change set."""
        here = F.col("is").isNotNull()
        flag = lambda side: F.coalesce(F.col(f"{side}.reinstall_seen"), F.lit(False)).cast("long")
        zero = lambda side, c: F.coalesce(F.col(f"{side}.{c}"), F.lit(0))
        per_user = changes.groupBy(USER).agg(
            F.sum(zero("is", "events") - zero("was", "events")).alias("d_events"),
            F.sum(flag("is") - flag("was")).alias("d_reinstall"),
            F.collect_set(F.when(here, F.col(DAY))).alias("present"),  # at most the batch's days
            F.collect_set(F.when(~here, F.col(DAY))).alias("absent"),
            F.min_by("is.first_event", F.when(here, F.col(DAY))).alias("earliest"),
        ).withColumn(BUCKET, F.pmod(F.xxhash64(USER), F.lit(buckets)).cast("int"))
        day_type = rollup_schema[DAY].dataType
        install = T.StructType([
            *[T.StructField(c, day_type if c == COHORT else T.BooleanType() if c == "is_reinstall" else T.StringType())
              for c in (USER, *INSTALL_ATTRIBUTES)],
            T.StructField("events_total", T.LongType()), T.StructField("first_event", rollup_schema["first_event"].dataType),
            T.StructField("reinstall_days", T.LongType()), T.StructField("days", T.ArrayType(day_type)),
            T.StructField(BUCKET, T.IntegerType()), T.StructField("is_outlier_events", T.BooleanType())])
        known = old.read("users", install, _values(per_user, BUCKET))
        both = per_user.join(known.select(F.col(USER).alias("_user"), F.struct(*install.fieldNames()).alias("was")),
                             _same(USER, "_user"), "left").drop("_user")
        before = F.coalesce(F.col("was.days"), F.array().cast(T.ArrayType(day_type)))
        both = (both.withColumn("days", F.array_sort(F.array_distinct(F.concat(F.array_except(before, "absent"), "present"))))
                .withColumn(COHORT, F.get("days", F.lit(0))))
        # the first day's event: from the change set, as before, or (a first day vanished) from that day's rows
        in_batch, as_before = F.array_contains("present", F.col(COHORT)), _same(COHORT, f"was.{COHORT}")
        lost = both.where(F.col(COHORT).isNotNull() & ~in_batch & ~as_before).select(USER, COHORT)
        next_day = old.read("user_day", rollup_schema, _values(lost, COHORT)).select(
            F.col(USER).alias("_user"), F.col(DAY).alias("_day"), F.col("first_event").alias("_next"))
        both = both.join(next_day, _same(USER, "_user") & (F.col(COHORT) == F.col("_day")), "left").withColumn(
            "first_event", F.when(in_batch, F.col("earliest")).when(as_before, F.col("was.first_event")).otherwise(F.col("_next")))
        both = (both.withColumn("reinstall_days", F.coalesce(F.col("was.reinstall_days"), F.lit(0)) + F.col("d_reinstall"))
                .withColumn("events_total", F.coalesce(F.col("was.events_total"), F.lit(0)) + F.col("d_events"))
                .withColumn("is_reinstall", F.col("reinstall_days") > 0)
                .withColumn("is_outlier_events", F.lit(None).cast("boolean")))
        for out, attr in (("install_platform", "platform"), ("install_country", "country"), ("install_traffic_medium", "traffic_medium"),
                          ("install_app_id", "app_id"), ("first_event_name", "event_name")):
            both = both.withColumn(out, F.col(f"first_event.{attr}"))
        now = F.when(F.col(COHORT).isNotNull(), F.struct(*install.fieldNames()))
        return both.select(USER, BUCKET, "was", now.alias("is"))

    def _users(self, old: Snapshot, new: Refresh, moved: DataFrame, scratch: Scratch) -> float | None:
        """Histogram, p99 and user table; returns the p99."""
        values = T.StructType([T.StructField("events_total", T.LongType()), T.StructField("n_users", T.LongType())])
        side = lambda name, sign: moved.where(F.col(name).isNotNull()).select(
            F.col(f"{name}.events_total").alias("events_total"), F.lit(sign).cast("long").alias("n_users"))
        histogram = scratch.table(_union([old.read("events_histogram", values), side("was", -1), side("is", 1)])
                                  .groupBy("events_total").agg(F.sum("n_users").alias("n_users")).where("n_users <> 0"), "histogram")
        new.replace("events_histogram", histogram)
        p99 = exact_percentiles(histogram, "events_total", [self.p], ["p99"], freq="n_users").first()
        p99 = p99["p99"] if p99 else None
        before = old.meta.get("events_p99")
        touched = set(_values(moved, BUCKET))
        if before is not None and p99 is not None and before != p99:
            between = (F.col("events_total") > min(before, p99)) & (F.col("events_total") <= max(before, p99))
            if not histogram.where(between).isEmpty():  # flags of users that the batch does not name
                touched |= set(_values(old.read("users").where(between), BUCKET))
        now = moved.where(F.col("is").isNotNull()).select("is.*")
        kept = old.read("users", now.schema, sorted(touched)).join(moved.select(F.col(USER).alias("_user")), _same(USER, "_user"), "left_anti")
        cut = F.lit(p99).cast("double")
        new.replace("users", kept.unionByName(now).withColumn("is_outlier_events", F.col("events_total") > cut), BUCKET,
                    sorted(touched), ["events_total"])
        return p99

    @staticmethod
    def _fact_deltas(old: Snapshot, changes: DataFrame, moved: DataFrame, rollup_schema: T.StructType) -> DataFrame:
        """Fact rows to take out (sign -1) and to put in (+1)."""
        side = lambda df, name: df.where(F.col(name).isNotNull()).select(f"{name}.*")
        install = lambda name: side(moved, name).select(USER, *INSTALL_ATTRIBUTES)
        attributes = lambda name: F.struct(*[F.col(f"{name}.{c}") for c in INSTALL_ATTRIBUTES])
        redated = moved.where(F.col("was").isNotNull() & F.col("is").isNotNull() & ~attributes("was").eqNullSafe(attributes("is")))
        elsewhere = (redated.select(USER, F.explode("was.days").alias(DAY))
                     .join(changes.select(USER, DAY), [USER, DAY], "left_anti"))
        rest = old.read("user_day", rollup_schema, _values(elsewhere, DAY)).join(elsewhere, [USER, DAY], "left_semi")
        before = daily.fact_enriched(side(changes, "was").unionByName(rest), install("was"))
        after = daily.fact_enriched(side(changes, "is").unionByName(rest), install("is"))
        return before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))

    @staticmethod
    def _fact(old: Snapshot, new: Refresh, deltas: DataFrame) -> None:
        days, keys = _values(deltas, DAY), [USER, DAY]
        kept = old.read("fct_user_daily", deltas.drop("sign").schema, days).join(
            deltas.where("sign < 0").select(*keys), keys, "left_anti")
        new.replace("fct_user_daily", kept.unionByName(deltas.where("sign > 0").drop("sign")), DAY, days, [USER])

    def _marts(self, old: Snapshot, new: Refresh, deltas: DataFrame, moved: DataFrame, scratch: Scratch, pool: ThreadPoolExecutor) -> list:
        grain = [COHORT, *self.slice_cols]
        sign = F.col("sign")
        by_cell = deltas.where(F.col("day_number").between(0, self.max_day)).groupBy(*grain, "day_number").agg(
            F.sum(sign).alias("retained_users"), F.sum(sign * F.col("gross_revenue")).cast(DEC4).alias("gross_revenue"),
            F.sum(sign * F.col("paying_flag").cast("int")).alias("paying_users"))
        by_cell = scratch.table(by_cell.where(" OR ".join(f"{m} <> 0" for m in CELL_MEASURES)), "cell_deltas")
        side = lambda name, n: moved.where(F.col(name).isNotNull()).select(
            *[F.col(f"{name}.{c}") for c in grain], F.lit(n).cast("long").alias("cohort_size"))
        by_size = scratch.table(side("was", -1).unionByName(side("is", 1)).groupBy(*grain)
                                .agg(F.sum("cohort_size").alias("cohort_size")).where("cohort_size <> 0"), "size_deltas")
        changed = _values(by_cell.select(COHORT).union(by_size.select(COHORT)), COHORT)
        cells = scratch.table(
            old.read("cohort_cells", by_cell.schema, changed).unionByName(by_cell).groupBy(*grain, "day_number")
            .agg(*[F.sum(m).cast(by_cell.schema[m].dataType).alias(m) for m in CELL_MEASURES]).where("retained_users <> 0"), "cells")
        writes = [pool.submit(new.replace, "cohort_cells", cells, COHORT, changed, [*self.slice_cols, "day_number"])]
        # one row a cohort and slice, written whole
        sizes_before = old.read("cohort_sizes", by_size.schema)
        sizes = scratch.table(sizes_before.unionByName(by_size).groupBy(*grain)
                              .agg(F.sum("cohort_size").alias("cohort_size")).where("cohort_size <> 0"), "sizes")
        writes.append(pool.submit(new.replace, "cohort_sizes", sizes))
        hit = by_cell.select(*grain).union(by_size.select(*grain)).distinct()
        sums = [F.sum(m).cast(by_cell.schema[m].dataType).alias(m) for m in CELL_MEASURES]
        for slices in ([], self.slice_cols) if self.slice_cols else ([],):
            targets, inputs = self._cohorts(sizes_before, sizes, hit, slices)
            own = [COHORT, *slices]
            size = sizes.where(in_parts(COHORT, inputs)).groupBy(*own).agg(F.sum("cohort_size").alias("cohort_size"))
            rest = old.read("cohort_cells", by_cell.schema, [c for c in inputs if c not in set(changed)])
            cell = cells.where(in_parts(COHORT, inputs)).unionByName(rest).groupBy(*own, "day_number").agg(*sums)
            for name, (family, by) in self.mart_names().items():
                if by == slices:
                    mart = (marts.retention_metrics(size, cell.select(*own, "day_number", "retained_users"), slices, self.max_day, self.trailing)
                            if family == "retention" else
                            marts.revenue_metrics(size, cell.drop("retained_users"), slices, self.max_day, self.trailing))
                    writes.append(pool.submit(new.replace, name, mart.where(in_parts(COHORT, targets)), COHORT, targets, [*slices, "day_number"]))
        return writes

    def _cohorts(self, before: DataFrame, after: DataFrame, hit: DataFrame, slices: Sequence[str]) -> tuple[list, list]:
        """Cohorts whose mart rows change, and those that their rows are computed from.

        A row changes with its own cohort and with the ``trailing`` ones before it in its slice. Old and
        new cohorts are ordered together: whatever stands between two of them has changed itself.
        """
        own = [COHORT, *slices]
        known = before.select(*own).union(after.select(*own)).distinct()
        marked = known.join(hit.select(*[F.col(c).alias(f"_{c}") for c in own]).distinct(),
                            reduce(lambda a, b: a & b, [_same(c, f"_{c}") for c in own]), "left")
        in_slice = Window.partitionBy(F.lit(0), *slices).orderBy(COHORT)
        at = F.max(F.col(f"_{COHORT}").isNotNull()).over(in_slice.rowsBetween(-self.trailing, 0))
        targets = _values(marked.withColumn("_t", at).where("_t"), COHORT)
        back = F.max(in_parts(COHORT, targets)).over(in_slice.rowsBetween(0, self.trailing))
        inputs = _values(after.select(*own).distinct().withColumn("_n", back).where("_n"), COHORT)
        return targets, inputs
