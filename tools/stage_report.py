"""Summarise a Spark event log: per stage, tasks, wall time, summed task time, shuffle bytes.

Usage: python tools/stage_report.py <event-log-file>
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True)) if os.path.isdir(path) else [path]
    for f in files:
        if os.path.isfile(f):
            yield from open(f)


def main(path: str) -> None:
    stages = {}
    tasks = defaultdict(lambda: {"n": 0, "run": 0, "max": 0, "sr": 0, "sw": 0, "gc": 0, "cpu": 0})
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            stages[info["Stage ID"]] = (info["Stage Name"][:60], info.get("Number of Tasks"),
                                        info.get("Completion Time", 0) - info.get("Submission Time", 0))
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            t = tasks[ev["Stage ID"]]
            t["n"] += 1
            run = m.get("Executor Run Time", 0)
            t["run"] += run
            t["max"] = max(t["max"], run)
            t["gc"] += m.get("JVM GC Time", 0)
            t["cpu"] += m.get("Executor CPU Time", 0) // 1_000_000
            t["sr"] += (m.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) + \
                (m.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
            t["sw"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    print(f"{'stage':>5} {'tasks':>5} {'wall ms':>8} {'sum ms':>8} {'max ms':>7} {'shuf rd MB':>10} {'shuf wr MB':>10} {'gc ms':>7} {'cpu ms':>7}  name")
    for sid in sorted(stages):
        name, n, wall = stages[sid]
        t = tasks[sid]
        print(f"{sid:5d} {t['n']:5d} {wall:8d} {t['run']:8d} {t['max']:7d} {t['sr']/1e6:10.1f} {t['sw']/1e6:10.1f} {t['gc']:7d} {t['cpu']:7d}  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
