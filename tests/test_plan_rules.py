"""Design rules checked on the physical plan of every query of the analytics registry:
every query scans tables, no cartesian / nested-loop joins, no Python UDF evaluation, and every
single-partition exchange sits on a partial aggregate or a limit (so no
unpartitioned window or global sort funnels rows into one task)."""

from __future__ import annotations

import re

from cohortflow.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def test_plans_follow_the_scale_rules(spark):
    bad = {}
    for name, query in QUERIES.items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        issues = [p for p in FORBIDDEN if p in plan]
        if "FileScan" not in plan:          # every query reads the tables (or tables derived from them)
            issues.append("reads no table")
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                child = lines[i + 1] if i + 1 < len(lines) else ""
                if not re.search(r"partial_|LocalLimit|TakeOrderedAndProject", child):
                    issues.append(child.strip()[:120])
        if issues:
            bad[name] = issues
    assert not bad, bad
