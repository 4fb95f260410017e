"""Incremental refresh after a staging merge.

A rollup row (user, day) depends only on that user's staged events of that UTC
day. The rollup table is therefore partitioned by day: after ``merge_increment``
re-stages some days, only those days' staging partitions are read and only their
rollup partitions are replaced. User-level facts (cohort date, install
attributes, p99), the fact and the four marts are then derived from the
refreshed rollup: a late event that moves a user's cohort re-dates that user's
whole fact history without touching the events of any other day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortflow import constants as C
from cohortflow.operators import daily, marts, users
from cohortflow.session import Scratch
from cohortflow.sources.loads import distinct_days, in_parts, replace_partitions, write_table

DAY = "event_date_utc"
ROLLUP_DAY = "activity_date"


def touched_days(batch_staged: DataFrame) -> list:
    """Distinct UTC days of a staged batch (one value a day)."""
    return distinct_days(batch_staged, DAY)


def write_rollup(stg_table: DataFrame, path: str) -> DataFrame:
    return write_table(daily.user_day_rollup(stg_table), path, [ROLLUP_DAY], ["user_pseudo_id"])


def refresh_rollup(stg_table: DataFrame, path: str, days: Sequence) -> DataFrame:
    """Recompute the rollup partitions of ``days`` from their staging partitions; others are not read or written."""
    with Scratch(stg_table.sparkSession) as scratch:
        fresh = scratch.table(daily.user_day_rollup(stg_table.where(in_parts(DAY, days))), "rollup_days")
        return replace_partitions(fresh, path, ROLLUP_DAY, days, ["user_pseudo_id"])


def derived_tables(rollup: DataFrame, max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS) -> dict[str, DataFrame]:
    install = users.int_user_install(rollup)
    dim = users.dim_users(install)
    fact = daily.fact_enriched(rollup, install)
    return {
        "int_user_install": install, "dim_users": dim, "fct_user_daily": daily.fct_user_daily(fact),
        "mart_retention_overall": marts.retention_mart(dim, fact, (), max_day, trailing),
        "mart_retention_by_platform": marts.retention_mart(dim, fact, ["install_platform"], max_day, trailing),
        "mart_revenue_overall": marts.revenue_mart(dim, fact, (), max_day, trailing),
        "mart_revenue_by_platform": marts.revenue_mart(dim, fact, ["install_platform"], max_day, trailing),
    }
