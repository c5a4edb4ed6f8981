"""Print the shape of key physical plans: exchanges, joins, windows, scans
with their pushed filters and read schema. Usage: python tools/show_plans.py [sf_dir] [id ...]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronage.registry import QUERIES  # noqa: E402
from patronage.session import get_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Scan parquet|FileScan|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                  r"BroadcastNestedLoopJoin|CartesianProduct|Window|Expand|Generate|SortAggregate|HashAggregate|"
                  r"ObjectHashAggregate|InMemoryTableScan|Subquery|TakeOrderedAndProject)")


def shape(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: InMemoryFileIndex \[[^\]]*\]", "", line)
            out.append(line[:220])
    return out


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or ["src4", "agg3", "rnk1", "fea1", "agg19"]
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for n in names:
        df = QUERIES[n](spark, sf)
        print(f"=== {n}")
        for line in shape(df._jdf.queryExecution().executedPlan().toString()):
            print(line)


if __name__ == "__main__":
    main()
