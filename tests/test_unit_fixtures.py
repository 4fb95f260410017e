"""The 12 documented unit fixtures against our builders.

Fixed values: the input rows and the expected rows of each fixture must equal the documented ones.
"""

from __future__ import annotations

from decimal import Decimal

from conftest import d, dec, make_dim, make_fact, make_stg
from pyspark.sql import functions as F

from cohortflow.operators import daily, marts, users


def _rows(df, *cols, order=("cohort_date", "day_number")):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*order).collect()]


# 1 ---------------------------------------------------------------------------
def test_install_reinstall_flag(spark):
    stg = make_stg(spark, [
        dict(user_pseudo_id="R", event_name="first_open", ts="2018-06-12T10:00:00", previous_first_open_count=5),
        dict(user_pseudo_id="R", event_name="screen_view", ts="2018-06-12T10:01:00"),
        dict(user_pseudo_id="N", event_name="screen_view", ts="2018-06-13T09:00:00"),
    ])
    inst = users.int_user_install(daily.user_day_rollup(stg))
    got = {r.user_pseudo_id: r.is_reinstall for r in inst.collect()}
    assert got == {"R": True, "N": False}


# 2-4 -------------------------------------------------------------------------
def _rollup(spark, rows):
    """rows: (user, date, events, engagement_sec, sessions, revenue|None, n_purchases)"""
    data = [(u, d(dt_), ev, eng * 1000, s, None if rev is None else dec(rev), n) for u, dt_, ev, eng, s, rev, n in rows]
    return spark.createDataFrame(data, "user_pseudo_id string, activity_date date, events long, engagement_msec long, "
                                       "n_sessions_proxy long, gross_revenue_raw decimal(28,4), n_purchases long")


def _install(spark, rows):
    return spark.createDataFrame(
        [(u, d(c), "ANDROID", None, None, None, "first_open", False, 1) for u, c in rows],
        "user_pseudo_id string, cohort_date date, install_platform string, install_country string, "
        "install_traffic_medium string, install_app_id string, first_event_name string, is_reinstall boolean, "
        "events_total long")


def test_fact_active_with_purchase(spark):
    f = daily.fct_user_daily(daily.fact_enriched(
        _rollup(spark, [("A", "2018-06-19", 8, 60, 1, 0.99, 1)]), _install(spark, [("A", "2018-06-12")])))
    r = f.collect()[0]
    assert (r.day_number, r.events, r.gross_revenue, r.n_purchases, r.paying_flag) == (7, 8, dec(0.99), 1, True)
    assert r.engagement_sec == dec(60)


def test_fact_active_without_purchase(spark):
    f = daily.fct_user_daily(daily.fact_enriched(
        _rollup(spark, [("B", "2018-06-15", 5, 30, 1, None, 0)]), _install(spark, [("B", "2018-06-12")])))
    r = f.collect()[0]
    assert (r.day_number, r.events, r.gross_revenue, r.n_purchases, r.paying_flag) == (3, 5, dec(0), 0, False)


def test_fact_day_zero(spark):
    f = daily.fct_user_daily(daily.fact_enriched(
        _rollup(spark, [("C", "2018-08-01", 1, 5, 0, None, 0)]), _install(spark, [("C", "2018-08-01")])))
    r = f.collect()[0]
    assert (r.day_number, r.events, r.gross_revenue, r.n_purchases, r.paying_flag) == (0, 1, dec(0), 0, False)


# 5 ---------------------------------------------------------------------------
def test_dim_users_p99_boundary(spark):
    inst = spark.createDataFrame(
        [(u, d("2018-06-12"), "IOS", None, None, None, "x", False, n)
         for u, n in [("U1", 1), ("U2", 5), ("U3", 10), ("U4", 100)]],
        "user_pseudo_id string, cohort_date date, install_platform string, install_country string, "
        "install_traffic_medium string, install_app_id string, first_event_name string, is_reinstall boolean, "
        "events_total long")
    p99 = users.events_p99(inst).collect()[0].events_p99
    assert abs(p99 - 97.3) < 1e-9
    got = {r.user_pseudo_id: r.is_outlier_events for r in users.dim_users(inst).collect()}
    assert got == {"U1": False, "U2": False, "U3": False, "U4": True}


# 6-8, 11-12: revenue mart ----------------------------------------------------------
REV_COLS = ("cohort_date", "day_number", "cohort_size", "gross_revenue", "paying_users", "cum_revenue",
            "cum_paying_users", "cum_arpu", "cum_arppu", "paying_share")


def test_revenue_dry_cohort(spark):
    dim = make_dim(spark, [("U1", "2018-06-12"), ("U2", "2018-06-12")])
    fact = make_fact(spark, [("U1", "2018-06-12", 0, 0)]).where(F.lit(False))
    rows = _rows(marts.revenue_mart(dim, fact, max_day=2), *REV_COLS)
    assert len(rows) == 3
    for r in rows:
        assert r[2] == 2 and r[3] == dec(0) and r[4] == 0 and r[5] == dec(0) and r[6] == 0
        assert r[7] == dec(0) and r[8] is None and r[9] == dec(0)


def test_revenue_dry_and_paying_cohorts(spark):
    dim = make_dim(spark, [("U1", "2018-06-12"), ("U2", "2018-06-12"), ("P1", "2018-06-13")])
    fact = make_fact(spark, [("P1", "2018-06-13", 0, 5)])
    rows = _rows(marts.revenue_mart(dim, fact, max_day=1), *REV_COLS)
    assert [r[8] for r in rows[:2]] == [None, None]
    assert rows[2][3:] == (dec(5), 1, dec(5), 1, dec(5), dec(5), dec(1))
    assert rows[3][3:] == (dec(0), 0, dec(5), 1, dec(5), dec(5), dec(1))


def test_revenue_cumulative(spark):
    dim = make_dim(spark, [(f"U{i}", "2018-06-12") for i in range(1, 11)])
    fact = make_fact(spark, [("U1", "2018-06-12", 0, 0.99), ("U2", "2018-06-12", 2, 1.50)])
    rows = _rows(marts.revenue_mart(dim, fact, max_day=2), *REV_COLS)
    assert [r[5] for r in rows] == [dec(0.99), dec(0.99), dec(2.49)]
    assert [r[6] for r in rows] == [1, 1, 2]
    assert [r[7] for r in rows] == [dec(0.099), dec(0.099), dec(0.249)]
    assert [r[8] for r in rows] == [dec(0.99), dec(0.99), dec(1.245)]
    assert [r[9] for r in rows] == [dec(0.1), dec(0.1), dec(0.2)]


def test_revenue_trailing_arpu(spark):
    dim = make_dim(spark, [("U1", "2018-06-12"), ("U2", "2018-06-13"), ("U3", "2018-06-14"), ("U4", "2018-06-15")])
    fact = make_fact(spark, [("U1", "2018-06-12", 0, 1), ("U2", "2018-06-13", 0, 2)])
    rows = _rows(marts.revenue_mart(dim, fact, max_day=0), "cum_arpu", "cum_arpu_trailing_4w_avg")
    assert [r[0] for r in rows] == [dec(1), dec(2), dec(0), dec(0)]
    assert [r[1] for r in rows] == [None, dec(1), dec(1.5), dec(1)]


def test_revenue_same_user_pays_twice(spark):
    dim = make_dim(spark, [("U1", "2018-06-12")])
    fact = make_fact(spark, [("U1", "2018-06-12", 0, 1), ("U1", "2018-06-12", 2, 1)])
    rows = _rows(marts.revenue_mart(dim, fact, max_day=2), "paying_users", "cum_paying_users")
    assert rows == [(1, 1), (0, 1), (1, 2)]


# 9-10: retention mart ---------------------------------------------------------------
def test_retention_trailing_window(spark):
    dim = make_dim(spark, [("U1", "2018-06-12"), ("U2", "2018-06-13"), ("U3", "2018-06-14"), ("U4", "2018-06-15")])
    fact = make_fact(spark, [("U1", "2018-06-12", 7, 0), ("U2", "2018-06-13", 7, 0)])
    m = marts.retention_mart(dim, fact, max_day=7).where(F.col("day_number") == 7)
    rows = _rows(m, "retention_pct", "retention_pct_trailing_4w_avg")
    assert [r[0] for r in rows] == [1.0, 1.0, 0.0, 0.0]
    assert [r[1] for r in rows] == [None, dec(1), dec(1), Decimal("0.6667")]


def test_retention_by_platform_trailing(spark):
    dim = make_dim(spark, [("I1", "2018-06-12", "IOS"), ("I2", "2018-06-13", "IOS"),
                           ("A1", "2018-06-12", "ANDROID"), ("A2", "2018-06-13", "ANDROID")])
    fact = make_fact(spark, [("I1", "2018-06-12", 7, 0, "IOS"), ("A2", "2018-06-13", 7, 0, "ANDROID")])
    m = marts.retention_mart(dim, fact, ["install_platform"], max_day=7).where(F.col("day_number") == 7)
    got = {(r.install_platform, str(r.cohort_date)): (r.retention_pct, r.retention_pct_trailing_4w_avg)
           for r in m.collect()}
    assert got[("IOS", "2018-06-12")] == (1.0, None)
    assert got[("IOS", "2018-06-13")] == (0.0, dec(1))
    assert got[("ANDROID", "2018-06-12")] == (0.0, None)
    assert got[("ANDROID", "2018-06-13")] == (1.0, dec(0))
