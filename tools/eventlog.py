"""Summarise a Spark event log: time per job group and the slowest stages.

usage: python tools/eventlog.py <event-log-file> [top_n]
Job groups are the bench's query names (bench.py sets one per query).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a plain file, or a rolling (v2) log folder
    whose parts may be zstd-compressed."""
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    job_group, job_start, job_time = {}, {}, defaultdict(float)
    job_count = defaultdict(int)
    stage_job, stages = {}, []
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                group = props.get("spark.jobGroup.id", "-")
                job_group[ev["Job ID"]] = group
                job_start[ev["Job ID"]] = ev["Submission Time"]
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerJobEnd":
                jid = ev["Job ID"]
                g = job_group.get(jid, "-")
                job_time[g] += (ev["Completion Time"] - job_start.get(jid, ev["Completion Time"])) / 1e3
                job_count[g] += 1
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if "Submission Time" in info and "Completion Time" in info:
                    dur = (info["Completion Time"] - info["Submission Time"]) / 1e3
                    g = job_group.get(stage_job.get(info["Stage ID"]), "-")
                    stages.append((dur, g, info["Stage ID"], info["Number of Tasks"],
                                   info["Stage Name"][:70]))
    print(f"{'job group':28s} {'jobs':>5s} {'job sec':>8s}")
    for g, t in sorted(job_time.items(), key=lambda kv: -kv[1]):
        print(f"{g:28s} {job_count[g]:5d} {t:8.2f}")
    print(f"\nslowest stages:\n{'sec':>7s} {'tasks':>6s}  group / stage")
    for dur, g, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{dur:7.2f} {tasks:6d}  {g} / {sid} {name}")


if __name__ == "__main__":
    main()
