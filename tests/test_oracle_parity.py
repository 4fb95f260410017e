"""Registered queries vs their DuckDB oracles on the driver tables (sf0.001)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from cohortflow.plans.registry import ORACLE, QUERIES
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
CORE = ["stg_events", "int_user_install", "dim_users", "fct_user_daily", "mart_retention_overall",
        "mart_revenue_by_platform", "mart_revenue_orders_by_segment", "dq_suite", "chk_revenue_reconciliation",
        "rpt_kpi_deltas", "prof_param_keys", "merge_increment", "stream_ingest"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cohort_date", "day_number", "cohort_size", "retained_users", "retention_pct",
                          "retention_pct_trailing_4w_avg"]
    assert df.count() > 0


@pytest.mark.parametrize("name", CORE)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [x[0] for x in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_quality_suite_has_no_failures(spark):
    res = E.queries()["dq_suite"](spark, SF)
    assert res.count() == 71
    assert res.where("status = 'fail'").count() == 0
    singular = [k for k in QUERIES if k.startswith("chk_")]
    assert len(singular) == 10
    for k in singular:
        assert E.queries()[k](spark, SF).collect()[0].n_violations == 0, k
