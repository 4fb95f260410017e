"""Mart builders vs a brute-force Python computation on random fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortflow.operators import marts

MAX_DAY, TRAILING = 4, 3
BASE = dt.date(2018, 6, 1)


def dec4(x: float | None):
    if x is None:
        return None
    return (Decimal(x * 10000.0).quantize(Decimal(1), ROUND_HALF_UP) / 10000).quantize(Decimal("0.0001"))


fixtures = st.lists(
    st.tuples(st.integers(0, 6),                                   # cohort offset
              st.lists(st.tuples(st.integers(0, MAX_DAY + 2),      # active day numbers
                                 st.sampled_from([0, 0, 1, 2.5])), max_size=4)),
    min_size=1, max_size=12)


def _frames(spark, users):
    dim, fact = [], []
    for i, (c, days) in enumerate(users):
        cohort = BASE + dt.timedelta(days=c)
        dim.append((f"u{i}", cohort, "IOS"))
        seen = set()
        for n, rev in days:
            if n in seen:
                continue
            seen.add(n)
            g = Decimal(str(rev)).quantize(Decimal("0.0001"))
            fact.append((f"u{i}", cohort, n, g, g > 0, "IOS"))
    d = spark.createDataFrame(dim, "user_pseudo_id string, cohort_date date, install_platform string")
    f = spark.createDataFrame(fact, "user_pseudo_id string, cohort_date date, day_number int, "
                                    "gross_revenue decimal(18,4), paying_flag boolean, install_platform string")
    return dim, fact, d, f


@settings(max_examples=6, deadline=None)
@given(fixtures)
def test_retention_and_revenue_brute_force(spark, users):
    dim, fact, d, f = _frames(spark, users)
    cohorts = sorted({c for _, c, _ in dim})
    size = {c: sum(1 for _, x, _ in dim if x == c) for c in cohorts}
    ret = {(r.cohort_date, r.day_number): r for r in marts.retention_mart(d, f, (), MAX_DAY, TRAILING).collect()}
    rev = {(r.cohort_date, r.day_number): r for r in marts.revenue_mart(d, f, (), MAX_DAY, TRAILING).collect()}
    assert len(ret) == len(rev) == len(cohorts) * (MAX_DAY + 1)
    for n in range(MAX_DAY + 1):
        pcts = []
        for k, c in enumerate(cohorts):
            retained = sum(1 for u, x, dn, *_ in fact if x == c and dn == n)
            pct = retained / size[c]
            r = ret[(c, n)]
            assert (r.cohort_size, r.retained_users, r.retention_pct) == (size[c], retained, pct)
            window = pcts[max(0, k - TRAILING):k]
            want = dec4(sum(window) / len(window)) if window else None
            assert r.retention_pct_trailing_4w_avg == want
            pcts.append(pct)
    for c in cohorts:
        cum, cum_pay = Decimal(0), 0
        for n in range(MAX_DAY + 1):
            day_rows = [(g, p) for u, x, dn, g, p, _ in fact if x == c and dn == n]
            cum += sum((g for g, _ in day_rows), Decimal(0))
            cum_pay += sum(1 for _, p in day_rows if p)
            r = rev[(c, n)]
            assert r.cum_revenue == cum and r.cum_paying_users == cum_pay
            assert r.cum_arpu == dec4(float(cum) / size[c])
            assert r.cum_arppu == (dec4(float(cum) / cum_pay) if cum_pay else None)
            assert r.paying_share == dec4(cum_pay / size[c])
