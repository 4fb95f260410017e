"""The maintained warehouse equals a full build after every batch, touches what the batch touches, and
shows either the state before a refresh or the one after it."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from conftest import d
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.operators.quantiles import exact_percentiles
from cohortflow.plans.pipeline import Pipeline
from cohortflow.plans.warehouse import Warehouse
from cohortflow.session import shared_scratch_path
from cohortflow.sources import loads as L
from cohortflow.sources.snapshots import ConcurrentRefreshError, SnapshotStore

SF = "/root/testdata/sf0.001"
UTC_DAY = "CAST(timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)"
TABLES = ("stg_events", "int_user_install", "dim_users", "fct_user_daily", "mart_retention_overall", "mart_retention_by_platform",
          "mart_revenue_overall", "mart_revenue_by_platform")


@pytest.fixture(scope="module")
def raw(spark):
    path = shared_scratch_path(spark, "warehouse_raw")
    Pipeline.from_events(spark, SF).raw.write.parquet(path)
    return L.scan_raw_events(spark, path)


def contents(df, cols) -> list[str]:
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


def assert_equal(warehouse: Warehouse, raw, max_day: int, trailing: int, tables=TABLES, **kw) -> None:
    pipe = Pipeline(raw, max_day=max_day, trailing=trailing, persist=True, **kw)
    for name in tables:
        a, b = warehouse.table(name), getattr(pipe, name)
        assert sorted(a.columns) == sorted(b.columns), name
        assert contents(a, a.columns) == contents(b, a.columns), name
    pipe.close()


def test_batches_equal_a_full_build(spark, raw):
    """Initial load, new days with late events that move cohorts, then one late event of one user."""
    w = Warehouse(spark, shared_scratch_path(spark, "warehouse"), max_day=10, trailing=5, user_buckets=16)
    late = (F.expr(UTC_DAY) < d("2024-01-06")) & (F.pmod(F.xxhash64("user_pseudo_id"), F.lit(3)) == 0)
    user = raw.groupBy("user_pseudo_id").agg(F.count_distinct(F.expr(UTC_DAY)).alias("n"), F.min(F.expr(UTC_DAY)).alias("first")).where(
        "n >= 3 AND first >= DATE'2024-01-08'").orderBy("user_pseudo_id").first()["user_pseudo_id"]
    first_day = raw.where(F.col("user_pseudo_id") == user).agg(F.min(F.expr(UTC_DAY))).first()[0]
    single = (F.col("user_pseudo_id") == user) & (F.expr(UTC_DAY) == first_day)
    cut = d("2024-01-15")
    first = raw.where((F.expr(UTC_DAY) < cut) & ~late & ~single)
    w.apply(first)
    assert_equal(w, first, 10, 5, TABLES[1:5])

    w.apply(raw.where((late | (F.expr(UTC_DAY) >= d("2024-01-13"))) & ~single))  # re-delivers two days
    assert_equal(w, raw.where(~single), 10, 5, TABLES[4:])

    total = {t: len(w.store.current().parts(t)) for t in ("stg_events", "user_day", "users", "fct_user_daily")}
    days = w.table("int_user_install").where(F.col("user_pseudo_id") == user).count()
    done = w.apply(raw.where(single))
    assert_equal(w, raw, 10, 5)
    assert days == 1 and done["read"]["stg_events"] == 1 and done["read"]["users"] <= 2 < total["users"]
    n_days = w.table("fct_user_daily").where(F.col("user_pseudo_id") == user).count()
    assert done["read"]["fct_user_daily"] <= n_days < total["fct_user_daily"]       # only the moved user's own days
    assert done["read"]["user_day"] <= n_days + 1
    assert done["written"]["users"] <= 2 and done["written"]["fct_user_daily"] <= n_days

    version = w.store.current().version
    again = w.apply(raw.where(single))
    assert_equal(w, raw, 10, 5, TABLES[3:4])
    assert set(again["written"]) == {"stg_events", "user_day"} and w.store.current().version == version + 1


def events(spark, rows):
    """Raw events from (user, day, n events, value, platform)."""
    base = Pipeline.from_events(spark, SF).raw
    template = base.limit(1)
    out = []
    for user, day, n, value, platform in rows:
        for k in range(n):
            out.append((user, day, k, value, platform))
    new = spark.createDataFrame(out, "u string, d date, k int, v double, p string")
    row = template.crossJoin(new)
    micros = F.unix_micros(F.col("d").cast("timestamp")) + F.col("k") * 1_000_000
    schema = base.schema
    cols = {"user_pseudo_id": F.col("u"), "event_timestamp": micros, "event_value_in_usd": F.col("v"), "platform": F.col("p"),
            "event_name": F.when(F.col("k") == 0, "in_app_purchase").otherwise("session_start"),
            "event_bundle_sequence_id": F.lit(1), "event_server_timestamp_offset": F.lit(0)}
    return row.select(*[cols[f.name].cast(f.dataType).alias(f.name) if f.name in cols else F.col(f.name) for f in schema])


def test_random_merges_keep_p99_and_flags(spark):
    r = random.Random(5)
    root = shared_scratch_path(spark, "warehouse_p99")
    w, rows = Warehouse(spark, root, max_day=6, trailing=3, user_buckets=8, p=0.9), []
    cuts = []
    for batch in range(3):
        new = [(f"u{r.randint(0, 60)}", d(f"2024-01-{r.randint(1, 9):02d}"), r.choice((1, 2, 3, 8 * batch + 1)), float(r.randint(0, 3)),
                r.choice(("IOS", "ANDROID"))) for _ in range(40)]
        # one delivery per (user, day): a repeated pair only adds events
        rows += new
        w.apply(events(spark, new))
        cuts.append(w.store.current().meta["events_p99"])
        install = w.table("int_user_install")
        assert cuts[-1] == exact_percentiles(install, "events_total", [0.9]).first()[0]
        flags = w.table("dim_users").join(install.select("user_pseudo_id", "events_total"), "user_pseudo_id")
        assert flags.where(F.col("is_outlier_events") != (F.col("events_total") > cuts[-1])).count() == 0
    assert len(set(cuts)) > 1
    assert_equal(w, events(spark, rows), 6, 3, ("int_user_install", "dim_users", "mart_revenue_by_platform"), p99=0.9)


def test_users_whose_first_day_vanishes(spark):
    """A day's rows replaced by fewer: the change set takes rows out, users get their next day, or go."""
    w = Warehouse(spark, shared_scratch_path(spark, "warehouse_gone"), max_day=4, trailing=2, user_buckets=4)
    w.apply(events(spark, [("a", d("2024-01-01"), 2, 1.0, "IOS"), ("a", d("2024-01-03"), 1, 2.0, "ANDROID"), ("b", d("2024-01-01"), 1, 0.0, "IOS")]))
    old = w.store.current()
    before = old.read("user_day", None, [d("2024-01-01")])
    changes = w._changes(before, before.where("false"))
    moved = {x["user_pseudo_id"]: x for x in w._user_changes(old, changes, before.schema, 4).collect()}
    assert moved["b"]["is"] is None and moved["b"]["was"]["events_total"] == 1
    now = moved["a"]["is"]
    assert (now["cohort_date"], now["install_platform"], now["events_total"], now["days"]) == (d("2024-01-03"), "ANDROID", 1, [d("2024-01-03")])


def test_a_crash_before_the_switch_leaves_the_old_state(spark, monkeypatch):
    root = shared_scratch_path(spark, "warehouse_crash")
    w = Warehouse(spark, root, max_day=4, trailing=2, user_buckets=4)
    first = events(spark, [("a", d("2024-01-02"), 2, 1.0, "IOS"), ("b", d("2024-01-03"), 1, 2.0, "IOS")])
    batch = events(spark, [("a", d("2024-01-01"), 1, 5.0, "ANDROID"), ("c", d("2024-01-03"), 4, 0.0, "IOS")])
    w.apply(first)
    version, open_reader = w.store.current().version, w.table("fct_user_daily")
    rows = sorted(map(str, open_reader.collect()))

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(SnapshotStore, "_switch", killed)  # everything is written, nothing switched
    with pytest.raises(KeyboardInterrupt):
        w.apply(batch)
    monkeypatch.undo()
    fresh = Warehouse(spark, root, max_day=4, trailing=2)
    assert fresh.store.current().version == version
    assert sorted(map(str, fresh.table("fct_user_daily").collect())) == rows
    assert_equal(fresh, first, 4, 2, TABLES[2:4])
    fresh.apply(batch)                                       # the retry
    assert sorted(map(str, open_reader.collect())) == rows   # a reader keeps the state it opened
    left = fresh.store.clean(keep=1)
    assert left > 0 and len(fresh.store.versions()) == 1
    assert_equal(fresh, first.unionByName(batch), 4, 2)


def test_only_one_of_two_writers_publishes(spark):
    store = SnapshotStore(spark, shared_scratch_path(spark, "two_writers"))
    df = spark.createDataFrame([(1, d("2024-01-01")), (2, None)], "x int, day date")
    a, b = store.refresh(), store.refresh()
    a.replace("t", df, "day")
    b.replace("t", df.withColumn("x", F.col("x") + 10), "day")
    a.publish()
    with pytest.raises(ConcurrentRefreshError):
        b.publish()
    assert sorted(r["x"] for r in store.current().read("t").collect()) == [1, 2]
    assert [r["x"] for r in store.current().read("t", parts=[None]).collect()] == [2]
    c = store.refresh()
    c.replace("t", df.where("x = 2"), "day", [None, d("2024-01-01")])
    c.publish()
    assert store.current().parts("t") == ["__HIVE_DEFAULT_PARTITION__"]
    e = store.refresh()
    with pytest.raises(ValueError, match="outside"):
        e.replace("t", df, "day", [None])
    assert store.current().read("none", T.StructType([])).count() == 0
    assert Path(store.root.removeprefix("file:"), "t").exists()
