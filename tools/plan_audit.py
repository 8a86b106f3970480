"""Print the physical operators that matter at scale for every registered query.

    python tools/plan_audit.py [sf_dir] [--no-broadcast]

``--no-broadcast`` sets both broadcast thresholds to -1, so every join is planned as with sides too large to send.

Counts shuffles (Exchange), join strategies, aggregate kinds and windows in the executed (AQE final) plan,
and flags the shapes that must not appear: Cartesian products, sort-based aggregates, Python UDFs.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.plans import registry  # noqa: E402
from marquee.session import build_session  # noqa: E402

WATCH = [
    "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
    "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "ShuffledHashJoin",
    "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window ", "WindowGroupLimit", "TakeOrderedAndProject",
    "InMemoryTableScan", "ReusedExchange", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
]
BAD = ("CartesianProduct", "SortAggregate", "BatchEvalPython")
MODEL = {"als_predictions", "als_predicted_records", "als_metrics", "recommendations", "recommendation_ranks"}
SKIP_WRITERS = {"scan_movies", "scan_ratings", "scan_tags", "sink_csv_roundtrip", "save_tables", "export_summaries"}


def final_only(plan: str) -> str:
    """Drop every ``== Initial Plan ==`` block of the AQE plan text (kept: the final plans)."""
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_indent is not None:
            if indent >= skip_indent and "== Final Plan ==" not in line:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        out.append(line)
    return "\n".join(out)


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    extra = {}
    if "--no-broadcast" in sys.argv:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    for key, fn in registry.queries().items():
        if key in SKIP_WRITERS or key in MODEL:
            continue
        df = fn(spark, sf_dir)
        df.collect()  # runs this frame's own QueryExecution, so its AQE plan is final
        executed = df._jdf.queryExecution().executedPlan()
        if executed.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            executed = executed.executedPlan()  # the final plan AQE ran
        plan = final_only(executed.toString())
        counts = {w.strip(): len(re.findall(re.escape(w), plan)) for w in WATCH}
        shown = ", ".join(f"{k}={v}" for k, v in counts.items() if v)
        flag = " <-- " + ",".join(b for b in BAD if counts.get(b)) if any(counts.get(b) for b in BAD) else ""
        print(f"| `{key}` | {shown or 'no shuffle'}{flag} |")


if __name__ == "__main__":
    main()
