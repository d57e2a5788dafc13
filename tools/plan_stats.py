"""Shuffle bytes, joins and exchanges of registered queries.

Usage: python tools/plan_stats.py SF_DIR name [name ...]

Runs each query once (noop sink) with Spark's event log written to a new
scratch folder, sums the shuffle bytes written by the query's jobs (tagged by
job group), and counts join and exchange operators in the final adaptive
plan.  ``KOHORT_NO_BROADCAST=1`` disables size-based broadcast joins, which
gives the plan shape of large inputs.  Prints one JSON line per query.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kohort.plans import catalog  # noqa: E402
from kohort.session import get_session  # noqa: E402


def main(argv):
    sf_dir, names = argv[0], argv[1:]
    log_dir = tempfile.mkdtemp(prefix="kohort-eventlog-")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
             "spark.eventLog.compress": "false"}
    if os.environ.get("KOHORT_NO_BROADCAST"):
        extra["spark.sql.autoBroadcastJoinThreshold"] = "-1"
        extra["spark.sql.adaptive.autoBroadcastJoinThreshold"] = "-1"
    spark = get_session("local[8]", app="kohort-plan-stats", shuffle_partitions=16, extra=extra)
    catalog.load_all()
    plans = {}
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plans[name] = plan
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()

    stage_group, shuffle = {}, {n: 0 for n in names}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    written = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    if group in shuffle:
                        shuffle[group] += written
    for name in names:
        plan = plans[name]
        # the executed (non-final) plan string may repeat subtrees; count operators once per line
        joins = len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", plan))
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        print(json.dumps({"query": name, "shuffle_bytes": shuffle[name], "joins": joins,
                          "exchanges": exchanges,
                          "broadcast": not os.environ.get("KOHORT_NO_BROADCAST")}))


if __name__ == "__main__":
    main(sys.argv[1:])
