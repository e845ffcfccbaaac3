"""Per-stage task times from a Spark event log folder (zstd or plain).

    python tools/stage_times.py <eventlog dir or file>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        if path.endswith(".zstd"):
            import zstandard

            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            data = io.TextIOWrapper(reader, encoding="utf-8")
        else:
            data = io.TextIOWrapper(fh, encoding="utf-8")
        yield from data


def main(target: str) -> None:
    files = glob.glob(os.path.join(target, "events*")) if os.path.isdir(target) else [target]
    stages, tasks = {}, {}
    for f in sorted(files):
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:48], si["Number of Tasks"],
                                          si.get("Completion Time", 0) - si.get("Submission Time", 0))
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                tasks.setdefault(ev["Stage ID"], []).append(
                    (m.get("Executor Run Time", 0), m.get("Executor CPU Time", 0) // 1_000_000,
                     m.get("JVM GC Time", 0)))
    for sid in sorted(stages):
        name, ntask, wall = stages[sid]
        tt = tasks.get(sid, [(0, 0, 0)])
        print(f"stage {sid:3d} tasks={ntask:4d} wall={wall:6d}ms max_task={max(t[0] for t in tt):6d}ms "
              f"sum_run={sum(t[0] for t in tt):7d}ms cpu={sum(t[1] for t in tt):7d}ms "
              f"gc={sum(t[2] for t in tt):5d}ms  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
