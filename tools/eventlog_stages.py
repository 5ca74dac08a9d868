"""Summarise a Spark event log (as written by ``BENCH_EVENT_LOG_DIR=... python bench.py``):
the slowest stages with their task counts, and per-job wall times.

    python tools/eventlog_stages.py /path/to/eventlog_v2_<app-id> [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard

                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = {}, {}
    for e in events(path):
        ev = e.get("Event")
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages[si["Stage ID"]] = (dur, si["Number of Tasks"], si["Stage Name"])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
    for sid, (dur, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:>5}  {dur:8.2f}s  {tasks:>6} tasks  {name[:80]}")
    print(f"{len(stages)} stages, {sum(v[0] for v in stages.values()):.2f}s stage time, "
          f"{len(jobs)} jobs, {sum((b - a) / 1000 for a, b in jobs.values() if b):.2f}s job time")


if __name__ == "__main__":
    main()
