"""Summarise stage and task times from a Spark event log (no UI needed).

Usage: python tools/stage_times.py <event log file or eventlog_v2_* folder> [top_n]

Prints the slowest stages (wall time, task count, summed task run time,
shuffle read/write bytes) and the per-job totals.
"""

from __future__ import annotations

import io
import json
import os
import re
import sys


def _lines(path: str):
    """Event lines from a log file or a rolling log folder (``eventlog_v2_*``
    with ``events_<n>_*`` parts, optionally zstd-compressed)."""
    files = [path]
    if os.path.isdir(path):
        parts = [f for f in os.listdir(path) if f.startswith("events_")]
        parts.sort(key=lambda f: int(re.match(r"events_(\d+)_", f).group(1)))
        files = [os.path.join(path, f) for f in parts]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def _stage(info: dict) -> dict:
    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
    return {"name": info.get("Stage Name", "")[:60],
            "ms": (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0),
            "tasks": info.get("Number of Tasks"),
            "run_ms": acc.get("internal.metrics.executorRunTime", 0),
            "shuffle_read": (acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                             + acc.get("internal.metrics.shuffle.read.localBytesRead", 0)),
            "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten", 0)}


def main(argv: list[str]) -> int:
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 20
    stages: dict[int, dict] = {}
    jobs: dict[int, dict] = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            stages[ev["Stage Info"]["Stage ID"]] = _stage(ev["Stage Info"])
        elif kind == "SparkListenerJobStart":
            jobs[ev["Job ID"]] = {"start": ev.get("Submission Time", 0)}
        elif kind == "SparkListenerJobEnd" and ev["Job ID"] in jobs:
            jobs[ev["Job ID"]]["ms"] = ev.get("Completion Time", 0) - jobs[ev["Job ID"]]["start"]
    print(f"{len(jobs)} jobs, {len(stages)} stages, total job wall "
          f"{sum(j.get('ms', 0) for j in jobs.values()) / 1000:.1f}s")
    print(f"{'stage':>6} {'wall ms':>9} {'tasks':>6} {'run ms':>9} {'shuf rd':>10} {'shuf wr':>10}  name")
    for sid, s in sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]:
        print(f"{sid:>6} {s['ms']:>9} {s['tasks']:>6} {s['run_ms']:>9} {s['shuffle_read']:>10} "
              f"{s['shuffle_write']:>10}  {s['name']}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
