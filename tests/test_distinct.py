"""Bitmap counts equal ``count(distinct)``, over all days, some days, and after days come in or are repaired."""

from __future__ import annotations

import random

from conftest import d
from pyspark.sql import functions as F

from cohortflow.operators.distinct import QUESTIONS, DistinctUsers
from cohortflow.session import shared_scratch_path
from cohortflow.sources.snapshots import SnapshotStore

RAW = ("user_pseudo_id string, on date, platform string, event_name string, "
       "traffic_source struct<source: string, medium: string>")


def rows(seed: int, days: range, n: int) -> list[tuple]:
    r = random.Random(seed)
    return [(r.choice((None, *(f"u{i}" for i in range(90)))), d(f"2024-01-{r.choice(days):02d}"), r.choice(("IOS", "ANDROID", None)),
             r.choice(("a", "b", "hot", "hot", "hot")), r.choice((None, ("s", None), ("s", "m"), ("t", "m")))) for _ in range(n)]


def want(data: list[tuple], question: str) -> set:
    key = {"all": lambda r: (None, None), "platform": lambda r: (r[2], None), "event": lambda r: (r[3], None),
           "traffic": lambda r: r[4] or (None, None)}[question]
    groups: dict = {}
    for r in data:
        groups.setdefault(key(r), []).append(r[0])
    return {(*k, len(us), len(set(us) - {None})) for k, us in groups.items()}


def test_counts_stay_exact_as_days_come_and_change(spark):
    frame = lambda data: spark.createDataFrame(data, RAW).repartition(5)
    users = DistinctUsers(SnapshotStore(spark, shared_scratch_path(spark, "distinct")), F.col("on"))
    known = rows(1, range(1, 6), 600)
    users.update(frame(known))
    for batch in (rows(2, range(6, 9), 300), rows(3, range(4, 6), 200)):  # new days; two days again, with other rows
        users.update(frame(batch))
        days = {r[1] for r in batch}
        known = [r for r in known if r[1] not in days] + batch
    for question in QUESTIONS:
        assert {tuple(r) for r in users.counts(question).collect()} == want(known, question), question
    some = [d("2024-01-04"), d("2024-01-07")]
    assert {tuple(r) for r in users.counts("event", some).collect()} == want([r for r in known if r[1] in some], "event")
    ids = users.store.current().read("user_ids").select("user_pseudo_id", "uid").collect()
    assert sorted(r.uid for r in ids) == list(range(1, len(ids) + 1)) and len({r.user_pseudo_id for r in ids}) == len(ids)


def test_ids_of_many_users_fill_several_buckets(spark):
    raw = spark.range(100_000).selectExpr("concat('u', id) AS user_pseudo_id", "DATE'2024-01-01' AS on", "'IOS' AS platform", "'e' AS event_name",
                                          "named_struct('source', 's', 'medium', 'm') AS traffic_source").repartition(7)
    users = DistinctUsers(SnapshotStore(spark, shared_scratch_path(spark, "distinct_many")), F.col("on"))
    users.update(raw)
    bitmaps = users.store.current().read("user_bitmaps")
    assert bitmaps.where("question = 'all'").count() == 4            # dense ids: ceil(100,000 / 32,768)
    assert tuple(users.counts("platform").first()) == ("IOS", None, 100_000, 100_000)
