"""Summarize stage timings from a Spark event log (no web UI needed).

usage: COHORTFLOW_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/stages.py <that dir> [top_n]
"""

from __future__ import annotations

import io
import json
import sys
from collections import defaultdict
from pathlib import Path


def _lines(path: Path):
    """Event-log lines; rolling logs are folders of (possibly zstd) parts."""
    if path.suffix == ".zstd":
        import zstandard
        with path.open("rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with path.open() as fh:
            yield from fh


def main() -> None:
    log_dir = Path(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, by_name = [], defaultdict(lambda: [0, 0.0, 0])
    stage_desc: dict[int, str] = {}
    for f in sorted(p for p in log_dir.rglob("*") if p.is_file() and not p.name.startswith(".")):
        for line in _lines(f):
            if not line.strip():
                continue
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description")
                for sid in ev.get("Stage IDs", []):
                    if desc:
                        stage_desc[sid] = desc
                continue
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
            name = stage_desc.get(info["Stage ID"]) or info.get("Stage Name", "?").split(" at ")[0]
            stages.append((dur, info["Stage ID"], name, info.get("Number of Tasks", 0)))
            agg = by_name[name]
            agg[0] += 1
            agg[1] += dur
            agg[2] += info.get("Number of Tasks", 0)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total:.1f} s of stage time")
    print("slowest stages:")
    for dur, sid, name, tasks in sorted(stages, reverse=True)[:top]:
        print(f"  {dur:7.2f}s  stage {sid:5d}  tasks={tasks:4d}  {name}")
    print("by operation:")
    for name, (n, dur, tasks) in sorted(by_name.items(), key=lambda kv: -kv[1][1])[:top]:
        print(f"  {dur:7.2f}s  x{n:4d}  tasks={tasks:5d}  {name}")


if __name__ == "__main__":
    main()
