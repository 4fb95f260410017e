"""Rules the reference states but does not unit-test (FIXTURES.md 'worth adding')."""

from __future__ import annotations

from conftest import d, dec, make_dim, make_fact, make_stg
from pyspark.sql import functions as F

from cohortflow.operators import daily, marts, staging, users
from cohortflow.sources.schema import PARAM_BAG, RAW_EVENTS


def _raw(spark, rows):
    base = {f.name: None for f in RAW_EVENTS.fields}
    data = []
    for r in rows:
        x = dict(base)
        x.update(r)
        x.setdefault("event_params", [])
        data.append(x)
    return spark.createDataFrame(data, RAW_EVENTS)


def test_dedup_lowest_bundle_nulls_last(spark):
    raw = _raw(spark, [
        dict(user_pseudo_id="u", event_timestamp=1, event_name="e", event_bundle_sequence_id=9, event_date="a"),
        dict(user_pseudo_id="u", event_timestamp=1, event_name="e", event_bundle_sequence_id=3, event_date="b"),
        dict(user_pseudo_id="u", event_timestamp=1, event_name="e", event_bundle_sequence_id=None, event_date="c"),
        dict(user_pseudo_id="v", event_timestamp=1, event_name="e", event_bundle_sequence_id=None, event_date="d"),
        dict(user_pseudo_id="v", event_timestamp=1, event_name="e", event_bundle_sequence_id=7, event_date="e"),
    ])
    got = {r.user_pseudo_id: r.event_date for r in staging.stg_events(raw).collect()}
    assert got == {"u": "b", "v": "e"}


def test_dedup_does_not_depend_on_the_order_of_copies(spark):
    """Copies with equal sequence numbers that differ in one column only, in both orders."""
    base = dict(user_pseudo_id="u", event_timestamp=1, event_name="e", event_bundle_sequence_id=3, event_server_timestamp_offset=1)
    for column, values in {"platform": ["IOS", "ANDROID", None], "event_previous_timestamp": [7, None, 3],
                           "geo": [{"country": "B"}, {"country": "A"}, None], "event_params": [[], None, [
                               {"key": "ga_session_id", "value": {"int_value": 4}}]]}.items():
        rows = [dict(base, **{column: v}) for v in values]
        got = {str(staging.stg_events(_raw(spark, order).coalesce(1)).collect()) for order in (rows, rows[::-1], rows[1:] + rows[:1])}
        assert len(got) == 1, column


def test_dedup_plans_partial_top1_before_shuffle(spark):
    raw = _raw(spark, [dict(user_pseudo_id="u", event_timestamp=1, event_name="e")])
    plan = staging.stg_events(raw)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_empty_params_give_null(spark):
    raw = _raw(spark, [dict(user_pseudo_id="u", event_timestamp=1, event_name="e", event_params=[])])
    r = staging.stg_events(raw).collect()[0]
    assert r.engagement_time_msec is None and r.screen_class is None and r.ga_session_id is None


def test_first_event_tie_broken_by_name(spark):
    stg = make_stg(spark, [
        dict(user_pseudo_id="u", event_name="session_start", ts="2018-06-12T10:00:00", platform="IOS"),
        dict(user_pseudo_id="u", event_name="first_open", ts="2018-06-12T10:00:00", platform="IOS"),
    ])
    r = users.int_user_install(daily.user_day_rollup(stg)).collect()[0]
    assert r.first_event_name == "first_open" and r.events_total == 2


def test_null_valued_purchase_day(spark):
    stg = make_stg(spark, [
        dict(user_pseudo_id="u", event_name="in_app_purchase", ts="2018-06-12T10:00:00"),
        dict(user_pseudo_id="u", event_name="in_app_purchase", ts="2018-06-12T11:00:00"),
    ])
    rollup = daily.user_day_rollup(stg)
    rev = daily.int_user_daily_revenue(rollup).collect()[0]
    assert rev.gross_revenue is None and rev.n_purchases == 2
    fct = daily.fct_user_daily(daily.fact_enriched(rollup, users.int_user_install(rollup))).collect()[0]
    assert fct.gross_revenue == dec(0) and fct.n_purchases == 2 and fct.paying_flag is False


def test_day_window_bounds(spark):
    dim = make_dim(spark, [("U1", "2018-06-01")])
    fact = make_fact(spark, [("U1", "2018-06-01", 0, 0), ("U1", "2018-06-01", 30, 0), ("U1", "2018-06-01", 31, 0)])
    m = marts.retention_mart(dim, fact, max_day=30)
    got = {r.day_number: r.retained_users for r in m.collect()}
    assert len(got) == 31 and got[30] == 1 and got[0] == 1 and 31 not in got


def test_right_censored_cells_are_zero(spark):
    dim = make_dim(spark, [("U1", "2018-06-01")])
    fact = make_fact(spark, [("U1", "2018-06-01", 0, 0)])
    m = marts.revenue_mart(dim, fact, max_day=5)
    assert all(r.gross_revenue == dec(0) for r in m.where("day_number > 0").collect())


def test_param_number_mixed_slots(spark):
    from cohortflow.functions.params import param_number
    bag = [{"key": "level", "value": {"string_value": None, "int_value": None, "float_value": None,
                                      "double_value": 2.5}}]
    df = spark.createDataFrame([(bag,), ([],)], PARAM_BAG.simpleString().join(["b ", ""]))
    assert [r[0] for r in df.select(param_number("b", "level")).collect()] == [2.5, None]


def test_to_dec4_rounds_half_away(spark):
    from cohortflow.functions.numeric import to_dec4
    df = spark.createDataFrame([(0.00005,), (-0.00005,), (1.23456,), (None,)], "x double")
    got = [r[0] for r in df.select(to_dec4(F.col("x"))).collect()]
    assert got[2] == dec(1.2346) and got[3] is None


def test_marts_have_no_cartesian_products(spark):
    dim = make_dim(spark, [("U1", "2018-06-01")])
    fact = make_fact(spark, [("U1", "2018-06-01", 0, 1)])
    for m in (marts.retention_mart(dim, fact), marts.revenue_mart(dim, fact, ["install_platform"])):
        plan = m._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_distributed_percentile_matches_spark_percentile(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from cohortflow.operators.quantiles import exact_percentiles

    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.integers(min_value=-1000, max_value=10**6), min_size=1, max_size=300),
           st.integers(min_value=1, max_value=32))
    def check(values, bins):
        df = spark.createDataFrame([(v,) for v in values], "x long")
        got = list(exact_percentiles(df, "x", ps, bins=bins).collect()[0])
        want = df.agg(F.percentile("x", ps)).collect()[0][0]
        assert got == want

    check()


def test_adapter_keeps_every_driver_row(spark):
    from cohortflow.sources.adapter import DUPLICATE_EVERY, adapt_events
    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    n_events = events.count()
    n_dups = events.where(F.col("event_id") % DUPLICATE_EVERY == 0).count()
    raw = adapt_events(spark, sf)
    assert raw.count() == n_events + n_dups
    assert staging.stg_events(raw).count() == n_events
