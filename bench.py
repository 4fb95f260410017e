"""Benchmark: build the persisted tables step by step, then run the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_SMALL_DIR (default:
the tables at a tenth of the scale beside it, where they exist). The small scale runs first; it
warms the JVM up and gives each query's growth. Every query is executed in full through the
``noop`` sink (no collect). Prints ONE JSON line; ``value`` is the total at BENCH_SF_DIR.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "stg_events", "int_user_install", "dim_users", "fct_user_daily",
    "mart_retention_overall", "mart_retention_by_platform", "mart_revenue_overall", "mart_revenue_by_platform",
    "mart_retention_orders_by_segment", "mart_revenue_orders_by_segment",
    "dq_suite", "chk_revenue_reconciliation", "chk_paying_users_reconciliation",
    "rpt_kpi_deltas", "rpt_cohort_triangle", "rpt_d7_weekly_by_platform",
    "prof_volume", "prof_events_per_user", "prof_param_keys",
    "merge_increment",
]


#: Tables in build order; each is written once, so its time is its own.
STEPS = ["stg_events", "rollup", "int_user_install", "dim_users", "fact_enriched", "mart_retention_overall",
         "mart_retention_by_platform", "mart_revenue_overall", "mart_revenue_by_platform", "report_dates"]


def run(spark, sf_dir: str) -> tuple[dict[str, float], dict[str, float]]:
    """Seconds of the build steps and of the queries at one scale."""
    from cohortflow.plans import profile_queries, registry

    sc, build, times = spark.sparkContext, {}, {}

    def timed(into: dict[str, float], name: str, what) -> None:
        sc.setJobDescription(f"bench:{name}")  # tags stages in the event log (tools/stages.py)
        t = time.time()
        what()
        into[name] = round(time.time() - t, 3)

    for source in ("events", "orders"):
        timed(build, f"{source}.raw", lambda: registry.raw_path(spark, sf_dir, source))
        p = registry.pipeline(spark, sf_dir, source)
        for step in STEPS if source == "events" else STEPS[:5]:
            timed(build, f"{source}.{step}", lambda: getattr(p, step))
    timed(build, "events.distinct_users", lambda: profile_queries.distinct_users(spark, sf_dir))
    for name in HEADLINE:
        timed(times, name, lambda: registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    return build, times


def refresh(spark, sf_dir: str) -> dict:
    """Seconds of a warehouse's first batch (all but the last day) and of the last day's batch, and the share of
    the partitions that the latter reads."""
    from pyspark.sql import functions as F

    from cohortflow.plans import registry
    from cohortflow.plans.warehouse import Warehouse
    from cohortflow.session import shared_scratch_path
    from cohortflow.sources.loads import scan_raw_events

    raw, day = scan_raw_events(spark, registry.raw_path(spark, sf_dir)), F.expr("event_timestamp div 86400000000")
    last = raw.agg(F.max(day)).first()[0]
    w, out = Warehouse(spark, shared_scratch_path(spark, "bench_warehouse")), {}
    for name, rows in (("first_batch", raw.where(day < last)), ("last_day", raw.where(day == last))):
        t = time.time()
        done = w.apply(rows)
        out[name] = round(time.time() - t, 3)
    now = w.store.current()
    return out | {"read_share": {k: round(done["read"].get(k, 0) / max(1, len(now.parts(k))), 2) for k in ("stg_events", "user_day", "users", "fct_user_daily")}}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cohortflow.session import local_session

    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app_name="cohortflow-bench")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    tenth = f"{sf_dir[:m.start()]}sf{float(m.group(1)) / 10:g}" if m else ""
    small_dir = os.environ.get("BENCH_SMALL_DIR", tenth)
    small = run(spark, small_dir) if small_dir and os.path.isdir(small_dir) else ({}, {})
    build, times = run(spark, sf_dir)
    total = lambda b, q: round(sum(b.values()) + sum(q.values()), 3)
    queries = {"build_base_tables": round(sum(build.values()), 3), **times}
    print(json.dumps({"metric": "headline_total_sec", "value": total(build, times), "unit": "sec", "queries": queries,
                      "build": build, "small": {"dir": small_dir, "value": total(*small), "build": small[0], "queries": small[1]},
                      "refresh": refresh(spark, sf_dir),
                      "growth": {n: round(times[n] / max(t, 1e-3), 2) for n, t in small[1].items()},
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))


if __name__ == "__main__":
    main()
