"""Summarize every plan that each registered flight and traffic query runs.

Usage: python tools/plan_report.py [sf_dir] [--large]

``--large`` turns automatic broadcast off, so joins plan as they would on
inputs far above the broadcast threshold.  Each query is executed; the final
adaptive plans of all its executions count, those that write tables to the
checkpoint folder and that collect small results included.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contrail.session import get_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    large = "--large" in args
    args = [a for a in args if a != "--large"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from contrail.plans import catalog

    spark = get_session("local[8]", shuffle_partitions=16)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-plans-"))
    if large:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    store = spark._jsparkSession.sharedState().statusStore()
    print("| query | executions | shuffles | SMJ | BHJ | table scans | partial limit | python |")
    print("|---|---|---|---|---|---|---|---|")
    seen = store.executionsCount()
    for name, build in catalog.queries().items():
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        found = store.executionsList(int(seen), 10_000)
        seen = store.executionsCount()
        plans = [found.apply(i).physicalPlanDescription().split("== Initial Plan ==")[0] for i in range(found.size())]
        tree = "\n".join(p.split("\n\n")[0] for p in plans)  # the trees, without the details by node
        scans = len(re.findall(r"Scan parquet", tree))
        print(f"| {name} | {len(plans)} | {len(re.findall(r'- Exchange|ShuffleQueryStage', tree)) // 2} | "
              f"{tree.count('SortMergeJoin')} | {tree.count('BroadcastHashJoin')} | {scans} | "
              f"{'yes' if 'WindowGroupLimit' in tree else ''} | {'yes' if re.search('EvalPython|InPandas', tree) else ''} |")
    spark.stop()


if __name__ == "__main__":
    main()
