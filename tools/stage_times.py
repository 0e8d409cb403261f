"""Summarise a Spark event log: per stage, tasks, wall time and shuffle bytes.

Usage: python tools/stage_times.py <event log folder or file> [top N]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _files(path: str) -> list[str]:
    if os.path.isfile(path):
        return [path]
    return sorted(p for p in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(p))


def _lines(path: str):
    """Lines of a plain or zstd-compressed event log file."""
    if path.endswith(".zstd") or path.endswith(".zst"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(argv: list[str]) -> None:
    top = int(argv[2]) if len(argv) > 2 else 15
    stages = []
    for f in _files(argv[1]):
        for line in _lines(f):
            if True:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                stages.append((dur, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:60],
                               acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                               acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                               + (acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0)))
    stages.sort(reverse=True)
    print(f"{'sec':>7} {'stage':>5} {'tasks':>5}  {'shuffle_w':>10} {'shuffle_r':>10}  name")
    for dur, sid, n, name, w, r in stages[:top]:
        print(f"{dur:7.2f} {sid:5d} {n:5d}  {int(w or 0):10d} {int(r or 0):10d}  {name}")
    print(f"stages: {len(stages)}, total stage seconds: {sum(s[0] for s in stages):.2f}")


if __name__ == "__main__":
    main(sys.argv)
