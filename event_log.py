"""Summarise a Spark event log (written with spark.eventLog.enabled): per job,
its stages with task counts and wall time, slowest first.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/evlog-XXXXXX) python bench.py q20_dimension_merge_fk_remap
    python event_log.py <that dir>/<application log folder or file> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    """Event lines from a log file or a rolling event-log folder (zstd or plain)."""
    files = ([os.path.join(path, n) for n in sorted(os.listdir(path)) if n.startswith("events_")]
             if os.path.isdir(path) else [path])
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard

            with open(fp, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(fp, encoding="utf-8") as f:
                yield from f


def summarise(path: str, top: int = 15) -> list[tuple[float, int, str, int]]:
    stages: dict[int, dict] = {}
    for line in _lines(path):
        if line.strip():
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                took = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
                stages[info["Stage ID"]] = {"name": info.get("Stage Name", ""), "tasks": info.get("Number of Tasks", 0),
                                            "seconds": took}
    rows = sorted(((v["seconds"], k, v["name"], v["tasks"]) for k, v in stages.items()), reverse=True)
    return rows[:top]


if __name__ == "__main__":
    for sec, sid, name, tasks in summarise(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15):
        print(f"stage {sid:5d} {sec:7.2f}s tasks={tasks:4d} {name[:90]}")
