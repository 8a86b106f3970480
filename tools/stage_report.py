"""Per-query stages, shuffle volume and task balance from Spark's event log.

    python tools/stage_report.py [sf_dir] [key ...]

Keeps the tables as ``bench.py`` does, runs each query once under its own job group with the event log written
to a fresh temp folder, then reads the log: stages, tasks, shuffle bytes written and read, and the slowest task
against the median task of its stage (a skew indicator).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402

from bench import HEADLINE  # noqa: E402
from marquee.plans import registry  # noqa: E402
from marquee.plans.tables import MovieTables  # noqa: E402
from marquee.session import build_session  # noqa: E402


def read_events(log_dir: str):
    for path in sorted(glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*.zstd"))):
        with open(path, "rb") as fh:
            raw = fh.read()
        text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode() if path.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            yield json.loads(line)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    keys = [a for a in args if not a.startswith("/")] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="marquee-eventlog-")
    spark = build_session(
        "local[8]", shuffle_partitions=16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log_dir}
    )
    spark.sparkContext.setLogLevel("ERROR")
    how = os.environ.get("REUSE", "persist")
    t = MovieTables.from_driver_tables(spark, sf_dir).reuse(how, ("movies", "ratings", "tags", "genre_rows"), spread_to=8)
    for df in (t.movies, t.ratings, t.tags, t.genre_rows):
        df.write.format("noop").mode("overwrite").save()
    registry.pin_tables(spark, sf_dir, t)
    qs = registry.queries()
    for key in keys:
        spark.sparkContext.setJobGroup(key, key)
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    group_of_stage, tasks = {}, {}
    for e in read_events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                group_of_stage[s] = group
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            read = m.get("Shuffle Read Metrics") or {}
            write = m.get("Shuffle Write Metrics") or {}
            info = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(
                (
                    info["Finish Time"] - info["Launch Time"],
                    read.get("Remote Bytes Read", 0) + read.get("Local Bytes Read", 0),
                    write.get("Shuffle Bytes Written", 0),
                )
            )
    print("| key | stages | tasks | shuffle written MB | shuffle read MB | worst stage: max / median task ms |")
    print("|---|---|---|---|---|---|")
    for key in keys:
        stages = [s for s, g in group_of_stage.items() if g == key and s in tasks]
        all_tasks = [x for s in stages for x in tasks[s]]
        worst = max(
            ((max(d for d, _, _ in tasks[s]), statistics.median(d for d, _, _ in tasks[s])) for s in stages),
            key=lambda p: p[0] - p[1],
            default=(0, 0),
        )
        print(
            f"| `{key}` | {len(stages)} | {len(all_tasks)} | {sum(w for _, _, w in all_tasks) / 1e6:.2f} | "
            f"{sum(r for _, r, _ in all_tasks) / 1e6:.2f} | {worst[0]} / {int(worst[1])} |"
        )


if __name__ == "__main__":
    main()
