"""
SQL metrics (files/partitions read, shuffle bytes) and operators.

    python tests/plan_facts.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _nodes(plan):
    out = [plan]
    children = plan.children()
    for i in range(children.size()):
        out.extend(_nodes(children.apply(i)))
    # AQE query stages (result, shuffle, broadcast) are leaves wrapping a plan.
    if "QueryStage" in plan.getClass().getSimpleName():
        out.extend(_nodes(plan.plan()))
    return out


def facts(df) -> dict:
    qe = df._jdf.queryExecution()
    t0 = time.perf_counter()
    qe.toRdd().count()  # runs this DataFrame's own (adaptive) plan
    sec = time.perf_counter() - t0
    plan = qe.executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    out = {"sec": round(sec, 3), "files_read": 0, "partitions_read": 0, "shuffle_bytes": 0, "operators": set()}
    for n in _nodes(plan):
        name = n.nodeName()
        out["operators"].add(name)
        metrics = n.metrics()
        def m(key):
            opt = metrics.get(key)
            return int(opt.get().value()) if opt.isDefined() else 0
        if name.startswith("Scan"):
            out["files_read"] += m("numFiles")
            out["partitions_read"] += m("numPartitions")
        if "Exchange" in name or name == "ShuffleQueryStage":
            out["shuffle_bytes"] += m("dataSize")
    out["operators"] = sorted(o for o in out["operators"] if o in (
        "WindowGroupLimit", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "Generate", "Window",
        "HashAggregate", "ObjectHashAggregate", "SortAggregate"))
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or ["flatten_all", "dedup_latest_event", "capitalize_unaccent", "upsert_replace",
                         "rolling_scan_date", "rolling_scan_componentwise", "key_constraint_report"]
    from quarry.session import build_session
    import __spark_entry__ as e

    spark = build_session("local[8]", 16)
    qs = e.queries()
    for name in names:
        try:
            facts(qs[name](spark, sf_dir))  # warm
            print(json.dumps({"name": name, **facts(qs[name](spark, sf_dir))}), flush=True)
        except Exception as exc:
            print(json.dumps({"name": name, "error": repr(exc)[:300]}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
