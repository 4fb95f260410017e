"""Mergeable exact distinct users: a dictionary of dense ids, and bitmaps by day.

``count(distinct user)`` cannot be merged: a new day means counting all days again, and each question
shuffles its own (key, user) pairs. Here a user gets a dense id once. Every day's rows become, for
each key of each question, bitmaps of 32,768 ids with the number of rows; days combine by OR, so any
set of days is exact, and a new or repaired day replaces its own rows only. One pass over the raw
events of a day serves all questions.

The tables live in a ``SnapshotStore`` (``user_ids``, ``user_bitmaps`` by day) and change in one switch.
A bitmap has a fixed 4 KB, so the form pays where the users of a key fill their buckets; a key with
few users a day costs 4 KB a bucket it touches. Rows without a user count as rows only. A hot user or
key is summed before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.session import Scratch
from cohortflow.sources.loads import distinct_days
from cohortflow.sources.snapshots import Snapshot, SnapshotStore

IDS, BITMAPS, DAY, USER = "user_ids", "user_bitmaps", "day", "user_pseudo_id"
#: Question -> the columns that make its key (two at most).
QUESTIONS = {"all": (), "platform": ("platform",), "event": ("event_name",), "traffic": ("traffic_source.source", "traffic_source.medium")}
_INDEX_BITS = 33  # of monotonically_increasing_id: the row inside its partition


def _id_schema(raw: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(USER, raw.schema[USER].dataType), T.StructField("uid", T.LongType())])


def new_ids(users: DataFrame, first: int, scratch: Scratch) -> DataFrame:
    """(user, uid): dense ids from ``first`` (1 in all, as bitmap buckets begin there) on, by position in written partitions (one count a partition on the driver)."""
    placed = scratch.table(users.withColumn("_place", F.monotonically_increasing_id()), "new_users")
    part, inside = F.shiftright("_place", _INDEX_BITS), F.col("_place").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    starts, total = [], first
    for p, n in sorted(tuple(r) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((p, total))
        total += n
    offsets = placed.sparkSession.createDataFrame(starts, "_part long, _before long")
    return placed.withColumn("_part", part).join(offsets, "_part").select(USER, (F.col("_before") + inside).alias("uid"))


def day_bitmaps(raw: DataFrame, ids: DataFrame, day: Column) -> DataFrame:
    """(day, question, k1, k2, bucket, n_rows, users) of raw events."""
    used = sorted({c for cols in QUESTIONS.values() for c in cols})
    name = {c: f"c{i}" for i, c in enumerate(used)}
    cells = raw.groupBy(day.alias(DAY), USER, *[F.col(c).alias(name[c]) for c in used]).agg(F.count(F.lit(1)).alias("n"))
    known = cells.join(ids, USER, "left")
    key = lambda cols, i: F.col(name[cols[i]]).cast("string") if i < len(cols) else F.lit(None).cast("string")
    asked = F.array(*[F.struct(F.lit(q).alias("question"), key(cols, 0).alias("k1"), key(cols, 1).alias("k2")) for q, cols in QUESTIONS.items()])
    rows = known.select(DAY, "n", "uid", F.explode(asked).alias("a"))
    return rows.groupBy(DAY, "a.question", "a.k1", "a.k2", F.bitmap_bucket_number("uid").alias("bucket")).agg(
        F.sum("n").alias("n_rows"), F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("users"))


class DistinctUsers:
    def __init__(self, store: SnapshotStore, day: Column):
        self.store, self.day = store, day

    def update(self, raw: DataFrame) -> Snapshot:
        """Put the days of ``raw``, which it holds completely, in the place of what is known of them."""
        with Scratch(self.store.spark) as scratch:
            new = self.store.refresh()
            days = distinct_days(raw.select(self.day.alias(DAY)), DAY)
            ids = new.base.read(IDS, _id_schema(raw))
            unknown = raw.select(USER).where(F.col(USER).isNotNull()).distinct().join(ids, USER, "left_anti")
            first = new.meta.get("next_uid", 1)
            added = scratch.table(new_ids(unknown, first, scratch), "ids")
            generation = len(new.base.parts(IDS))
            new.replace(IDS, added.withColumn("generation", F.lit(generation)), "generation", [generation], [USER])
            bitmaps = day_bitmaps(raw, ids.select(USER, "uid").unionByName(added), self.day)
            new.replace(BITMAPS, bitmaps, DAY, days, ["question", "k1", "k2", "bucket"])
            new.meta["next_uid"] = first + added.count()
            return new.publish()

    def counts(self, question: str, days: list | None = None) -> DataFrame:
        """(k1, k2, n_rows, n_users) over all days, or some of them."""
        rows = self.store.current().read(BITMAPS, parts=days).where(F.col("question") == question)
        buckets = rows.groupBy("k1", "k2", "bucket").agg(F.sum("n_rows").alias("n_rows"), F.bitmap_or_agg("users").alias("users"))
        return buckets.groupBy("k1", "k2").agg(F.sum("n_rows").alias("n_rows"), F.sum(F.bitmap_count("users")).alias("n_users"))
