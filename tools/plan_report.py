"""Summarise the physical plan of every batch query (PLANS.md).

    python tools/plan_report.py [sf_dir] > PLANS.md

For each query: planned shuffles (hash / range / single-partition
exchanges), broadcast exchanges, Parquet scans with the columns they read,
aggregate kinds, windows, generators and Python operators - the things that
decide how the query behaves at scale.  Plans are taken before execution
(AQE may still turn a shuffle join into a broadcast at run time).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridcat.plans import queries  # noqa: E402
from gridcat.session import get_session  # noqa: E402

SIDE_EFFECT = {"stream_job_gate", "stream_new_files", "stream_upsert", "stream_product_gate", "stream_status_dedupe",
               "stream_product_outcomes", "notification_sink", "stream_file_rows"}


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    cols = [len(s.split(",")) for s in scans]
    return {
        "shuffles": plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
        + plan.count("Exchange SinglePartition") + plan.count("Exchange RoundRobinPartitioning"),
        "broadcasts": plan.count("BroadcastExchange"),
        "scans": len(scans),
        "cols_read": "/".join(str(c) for c in cols),
        "aggs": ",".join(sorted({a for a in ("HashAggregate", "SortAggregate", "ObjectHashAggregate")
                                 if a in plan})),
        "window": "Window" in plan,
        "explode": "Generate" in plan,
        "python": ",".join(sorted({p for p in ("MapInPandas", "FlatMapGroupsInPandas", "BatchEvalPython",
                                                "ArrowEvalPython") if p in plan})),
        "joins": ",".join(sorted({j for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
                                               "BroadcastNestedLoopJoin", "CartesianProduct") if j in plan})),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    print("| query | shuffles | broadcasts | scans (columns read) | joins | aggregates | window | explode | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(queries.queries().items()):
        if name in SIDE_EFFECT:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['scans']} ({s['cols_read']}) | {s['joins']} | "
              f"{s['aggs']} | {'yes' if s['window'] else ''} | {'yes' if s['explode'] else ''} | {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main()
