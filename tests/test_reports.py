"""Dashboard queries on crafted marts: statuses, pivots, calendar baselines."""

from __future__ import annotations

from conftest import d, dec
from pyspark.sql import functions as F

from cohortflow.operators import reports as R


def _ret(spark, rows):
    """rows: (cohort, day, size, retained, pct, trailing)"""
    return spark.createDataFrame(
        [(d(c), n, s, r, p, None if t is None else dec(t)) for c, n, s, r, p, t in rows],
        "cohort_date date, day_number int, cohort_size long, retained_users long, retention_pct double, "
        "retention_pct_trailing_4w_avg decimal(18,4)")


def _rev(spark, rows):
    """rows: (cohort, day, size, cum_arpu, arpu_trailing, paying_share)"""
    return spark.createDataFrame(
        [(d(c), n, s, dec(a), None if t is None else dec(t), dec(ps)) for c, n, s, a, t, ps in rows],
        "cohort_date date, day_number int, cohort_size long, cum_arpu decimal(18,4), "
        "cum_arpu_trailing_4w_avg decimal(18,4), paying_share decimal(18,4)")


def test_kpi_statuses(spark):
    c = "2018-09-04"
    ret = _ret(spark, [(c, 1, 10, 5, 0.5, 0.4), (c, 3, 10, 3, 0.3, 0.298), (c, 7, 10, 1, 0.1, None)])
    rev = _rev(spark, [(c, 7, 10, 1.0, 1.2, 0.3), ("2018-08-20", 7, 10, 0.5, None, 0.2),
                       ("2018-08-01", 7, 10, 0.5, None, 0.9)])
    got = {r.kpi: r.status for r in R.rpt_kpi_deltas(ret, rev, F.lit(d(c))).collect()}
    assert got == {"D1 retention": "up", "D3 retention": "neutral", "D7 retention": "no baseline",
                   "ARPU @ D7": "down", "Pay share @ D7": "up"}


def test_calendar_baseline_uses_28_calendar_days(spark):
    c = "2018-09-04"
    rev = _rev(spark, [(c, 7, 10, 1, None, 0.3), ("2018-08-20", 7, 10, 1, None, 0.2),
                       ("2018-08-07", 7, 10, 1, None, 0.4), ("2018-08-06", 7, 10, 1, None, 0.9)])
    v = spark.range(1).select(R.calendar_baseline(rev, F.lit(d(c)))).collect()[0][0]
    assert v == 0.30000000000000004 or v == 0.3   # 08-07 and 08-20 are inside [c - 28, c); 08-06 is not


def test_triangle_pivot(spark):
    ret = _ret(spark, [("2018-09-01", n, 4, 4 - min(n, 3), (4 - min(n, 3)) / 4, None) for n in range(31)])
    tri = R.rpt_cohort_triangle(ret).collect()[0]
    assert (tri.d0, tri.d1, tri.d3, tri.d30) == (1.0, 0.75, 0.25, 0.25)


def test_default_cohort_has_its_whole_window(spark):
    from conftest import make_stg

    from cohortflow.plans.pipeline import Pipeline
    stg = make_stg(spark, [dict(user_pseudo_id=u, event_name="e", ts=f"2018-09-{day:02d}T10:00:00", platform="IOS")
                           for u, day in (("a", 1), ("b", 5), ("c", 9), ("c", 13))])
    for max_day, want in ((4, "2018-09-09"), (8, "2018-09-05"), (12, "2018-09-01"), (30, None)):
        p = Pipeline(stg, max_day=max_day)
        p.__dict__["stg_events"] = stg
        row = p.report_dates.collect()[0]
        assert row.selected_cohort == (want and d(want)) and row.max_activity_date == d("2018-09-13")


def test_first_cohort_is_left_out_of_period_averages(spark):
    ret = _ret(spark, [("2018-06-12", 7, 100, 90, 0.9, None), ("2018-06-13", 7, 10, 1, 0.1, None), ("2018-06-14", 7, 30, 1, 1 / 30, None)])
    assert R.rpt_period_retention(ret).collect()[0].ret == 2 / 40
    assert R.rpt_period_retention(ret, left_censored=True).collect()[0].ret == 92 / 140
    assert [r.ret for r in R.rpt_d7_weekly(ret, left_censored=False).collect()] == [2 / 40]
    assert [r.ret for r in R.rpt_d7_weekly(ret).collect()] == [92 / 140]


def test_calendar_baseline_is_not_rounded(spark):
    c = "2018-09-04"
    rev = _rev(spark, [(c, 7, 10, 1, None, 0.3), ("2018-08-20", 7, 10, 1, None, 0.2), ("2018-08-21", 7, 10, 1, None, 0.2),
                       ("2018-08-22", 7, 10, 1, None, 0.1)])
    v = spark.range(1).select(R.calendar_baseline(rev, F.lit(d(c)))).collect()[0][0]
    assert v == 5000 / 3 / 10000
