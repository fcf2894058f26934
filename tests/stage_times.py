"""Summarise a Spark event log: per job, its stages with task count, summed
task time and the slowest task.
Usage: python tests/stage_times.py <event log file or rolling event log folder>"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict

import zstandard


def _lines(path: str):
    files = [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")] if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as raw:
            stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
            yield from io.TextIOWrapper(stream, encoding="utf-8")


def main(path: str) -> None:
    stages, tasks, jobs = {}, defaultdict(list), []
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                jobs.append((ev["Job ID"], ev.get("Stage IDs", []), ev.get("Properties", {}).get("spark.job.description", "")))
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                stages[info["Stage ID"]] = (info["Stage Name"], info.get("Completion Time", 0) - info.get("Submission Time", 0))
            elif kind == "SparkListenerTaskEnd":
                t = ev["Task Info"]
                tasks[ev["Stage ID"]].append(t["Finish Time"] - t["Launch Time"])
    for job_id, stage_ids, desc in jobs:
        done = [s for s in stage_ids if s in stages]
        if not done:
            continue
        print(f"job {job_id} {desc[:60]}")
        for s in done:
            name, wall = stages[s]
            ts = tasks.get(s, [])
            print(f"  stage {s:4d} wall {wall:6d} ms  tasks {len(ts):4d}  sum {sum(ts):7d} ms  max {max(ts or [0]):6d} ms  {name[:50]}")


if __name__ == "__main__":
    main(sys.argv[1])
