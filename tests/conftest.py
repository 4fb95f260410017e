from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from cohortflow.operators.daily import first_event_struct  # noqa: E402
from cohortflow.session import local_session  # noqa: E402
from cohortflow.sources.schema import STAGING_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app_name="cohortflow-tests")
    yield s


def micros(ts: str) -> int:
    d = dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc)
    return int(d.timestamp()) * 1_000_000 + d.microsecond


def make_stg(spark, rows: list[dict]):
    """Staging rows from partial dicts; ``ts`` (ISO, UTC) fills the time columns."""
    full = []
    for r in rows:
        r = dict(r)
        if "ts" in r:
            us = micros(r.pop("ts"))
            r["event_timestamp"] = us
        full.append(r)
    schema = T.StructType([T.StructField(n, T.DataType.fromDDL(t) if t != "timestamp_ntz" else T.TimestampNTZType())
                           for n, t in STAGING_COLUMNS])
    base = spark.createDataFrame([{k: r.get(k) for k, _ in STAGING_COLUMNS} for r in full], schema)
    ts = F.expr("timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return base.withColumn("event_ts_utc", ts).withColumn("event_date_utc", ts.cast("date"))


def dec(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.0001"))


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def make_dim(spark, rows):
    """rows: (user, cohort_date[, platform])"""
    out = []
    for r in rows:
        out.append((r[0], d(r[1]), r[2] if len(r) > 2 else "ANDROID"))
    return spark.createDataFrame(out, "user_pseudo_id string, cohort_date date, install_platform string")


def make_fact(spark, rows):
    """rows: (user, cohort_date, day_number, gross_revenue, platform?)"""
    out = []
    for r in rows:
        g = dec(r[3])
        out.append((r[0], d(r[1]), int(r[2]), g, g > 0, r[4] if len(r) > 4 else "ANDROID"))
    return spark.createDataFrame(
        out, "user_pseudo_id string, cohort_date date, day_number int, gross_revenue decimal(18,4), "
             "paying_flag boolean, install_platform string")


__all__ = ["make_stg", "make_dim", "make_fact", "dec", "d", "micros", "first_event_struct"]
