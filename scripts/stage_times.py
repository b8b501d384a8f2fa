"""Stage times from a Spark event log (the UI stays off): one line per stage of one SQL
execution, with its task count, start/end relative to the execution start, and the
records it read and shuffled.

    BENCH_EVENT_LOG=1 python bench.py tfidf_terms     # writes <scratch>/events/<app>
    python scripts/stage_times.py <scratch>/events/<app> [execution id]

Without an execution id the last SQL execution in the log is shown.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    for f in sorted(glob.glob(os.path.join(path, "events_*"))) or [path]:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode("utf-8", "replace").splitlines()


def main() -> None:
    path = sys.argv[1]
    stages: dict[int, dict] = {}
    executions: dict[str, list] = {}
    for line in _lines(path):
        if not line.startswith("{"):
            continue
        e = json.loads(line)
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            sql = e.get("Properties", {}).get("spark.sql.execution.id")
            for sid in e["Stage IDs"]:
                stages.setdefault(sid, {})["sql"] = sql
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
            stages.setdefault(info["Stage ID"], {}).update(
                tasks=info["Number of Tasks"],
                start=info.get("Submission Time", 0),
                end=info.get("Completion Time", 0),
                read=acc.get("internal.metrics.input.recordsRead")
                or acc.get("internal.metrics.shuffle.read.recordsRead"),
                written=acc.get("internal.metrics.shuffle.write.recordsWritten"),
            )
        elif kind.endswith("SparkListenerSQLExecutionStart"):
            executions[str(e["executionId"])] = [e["time"], None]
        elif kind.endswith("SparkListenerSQLExecutionEnd"):
            executions[str(e["executionId"])][1] = e["time"]
    exec_id = sys.argv[2] if len(sys.argv) > 2 else str(max(int(k) for k in executions))
    t0, t1 = executions[exec_id]
    print(f"execution {exec_id}: {(t1 - t0) / 1000:.3f} s")
    for sid in sorted(stages):
        s = stages[sid]
        if s.get("sql") == exec_id and "start" in s:
            print(f"  stage {sid:4d} tasks {s['tasks']:4d} {(s['start'] - t0) / 1000:7.3f}-"
                  f"{(s['end'] - t0) / 1000:7.3f} s  records read {s['read']}  shuffled {s['written']}")


if __name__ == "__main__":
    main()
