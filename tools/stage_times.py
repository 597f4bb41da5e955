"""Per-job timings from a Spark event log (no UI needed).

Run a job with ``CIVIC_EVENT_LOG=<folder>`` (see ``civic_mart.session``), then:
    python tools/stage_times.py <folder> [job-group]
Prints per job group the number of jobs and busy time, then the slowest jobs with
their stages (name, duration, tasks).  A one-task stage on a large input shows
missing parallelism; many short jobs show per-job overhead.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import sys


def read_events(folder: str):
    for path in sorted(glob.glob(f"{folder}/*/*") + glob.glob(f"{folder}/*")):
        if path.endswith(".crc") or "appstatus" in path:
            continue
        try:
            with open(path, "rb") as fh:
                raw = fh.read()
        except IsADirectoryError:
            continue
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            try:
                yield json.loads(line)
            except json.JSONDecodeError:
                continue


def main(folder: str, group: str | None = None, top: int = 15) -> None:
    jobs, stages = {}, {}
    for e in read_events(folder):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            props = e.get("Properties", {})
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "group": props.get("spark.jobGroup.id"),
                                 "stages": e["Stage IDs"]}
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:40], si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      si["Number of Tasks"])
    if group:
        jobs = {k: v for k, v in jobs.items() if v["group"] == group}
    per = collections.defaultdict(lambda: [0, 0])
    for v in jobs.values():
        per[v["group"]][0] += 1
        per[v["group"]][1] += v.get("end", v["start"]) - v["start"]
    for g, (n, ms) in sorted(per.items(), key=lambda kv: -kv[1][1]):
        print(f"{str(g):32s} jobs={n:4d} busy_ms={ms}")
    print("-- slowest jobs")
    for j, v in sorted(jobs.items(), key=lambda kv: -(kv[1].get("end", 0) - kv[1]["start"]))[:top]:
        print(j, v["group"], v.get("end", 0) - v["start"], "ms", [stages.get(s) for s in v["stages"] if s in stages])


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None)
