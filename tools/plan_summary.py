"""Run registered jobs and print what Spark's event log has of each: jobs,
stages, rows read from files, rows and megabytes shuffled.  Everything that a
job runs counts, also the tables that it writes on the way.
Usage: python tools/plan_summary.py [sf_dir] [names...]"""

from __future__ import annotations

import json
import os
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ripplekit import jobs  # noqa: E402
from ripplekit.session import local_session  # noqa: E402

COLUMNS = ("jobs", "stages", "rows_read", "rows_moved", "mb_moved")


def figures(log: Path) -> dict[str, dict[str, float]]:
    """Per job group (the name of a query) the sums over its tasks."""
    out: dict[str, dict[str, float]] = defaultdict(lambda: dict.fromkeys(COLUMNS, 0))
    group_of: dict[int, str] = {}
    for line in log.open():
        e = json.loads(line)
        kind = e["Event"].rpartition(".")[2]
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id") or "-"
            out[group]["jobs"] += 1
            group_of.update(dict.fromkeys(e["Stage IDs"], group))
        elif kind == "SparkListenerStageCompleted":
            out[group_of.get(e["Stage Info"]["Stage ID"], "-")]["stages"] += 1
        elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m, o = e["Task Metrics"], out[group_of.get(e["Stage ID"], "-")]
            o["rows_read"] += m["Input Metrics"]["Records Read"]
            o["rows_moved"] += m["Shuffle Write Metrics"]["Shuffle Records Written"]
            o["mb_moved"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"] / 1e6
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(jobs.JOBS)
    folder = tempfile.mkdtemp(prefix="events-")
    spark = local_session(8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}",
                                    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        jobs.JOBS[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    found = figures(next(Path(folder).iterdir()))
    print(f"{'query':24s} " + " ".join(f"{c:>10s}" for c in COLUMNS))
    for name in names:
        print(f"{name:24s} " + " ".join(f"{found[name][c]:10.0f}" for c in COLUMNS))


if __name__ == "__main__":
    main()
