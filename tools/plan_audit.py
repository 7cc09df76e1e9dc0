"""Audit the physical plan of every query of the catalog.

usage: python tools/plan_audit.py [sf_dir]
Plans are made with automatic broadcasts and AQE off, so that joins show the shuffles they
would need on large tables. Lists shuffles, single-partition exchanges, tables scanned more
than once, Python operators, nested-loop joins, and single-partition windows or sorts. Parts
that a query checkpoints while it is built are not in its final plan.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FLAGS = {
    "nested-loop join": r"BroadcastNestedLoopJoin|CartesianProduct",
    "python row UDF": r"BatchEvalPython",
    "python operator": r"MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas|MapInArrow",
    "single-partition exchange before window/sort": r"Exchange SinglePartition[^\n]*\n(?:[^\n]*\n){0,2}[^\n]*\b(Window|Sort) \[",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from obsframe.plans.catalog import all_queries
    from obsframe.session import get_spark
    spark = get_spark(master="local[8]", shuffle_partitions=8, extra={
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "2000",
        "spark.ui.showConsoleProgress": "false"})
    print("| query | shuffles | single-partition exchanges | scans (times; columns read; pushed filters) | flags |")
    print("|---|---|---|---|---|")
    for name, (fn, _sql) in all_queries().items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin)", plan))
        singles = len(re.findall(r"Exchange SinglePartition", plan))
        found = [k for k, rx in FLAGS.items() if re.search(rx, plan)]
        scans = Counter()
        for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: [^\[\n]*\[[^\]]*/([a-z_]+)\.parquet\]"
                             r"(?:[^\n]*?PushedFilters: \[([^\]]*)\])?", plan):
            cols, table, pushed = m.group(1), m.group(2), m.group(3) or ""
            pushed = ", ".join(p for p in pushed.split(", ") if p and not p.startswith("IsNotNull"))
            scans[f"{table}({len(cols.split(','))} cols{'; ' + pushed if pushed else ''})"] += 1
        listed = "; ".join(f"{n} x {t}" if n > 1 else t for t, n in sorted(scans.items()))
        print(f"| {name} | {shuffles} | {singles} | {listed} | {'; '.join(found) or '-'} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
