"""Print the physical plan of registered queries, with a one-line summary.

    python tools/plans.py [sf_dir] [query ...]

The summary counts shuffles (``Exchange``), file scans, partial+final
group limits and broadcasts in the plan Spark starts from; adaptive
execution may later reuse identical exchanges and turn small joins into
broadcasts.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loamline.plans.catalog import QUERIES  # noqa: E402
from loamline.session import get_spark  # noqa: E402


def summary(plan: str) -> str:
    ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
    scans = len(re.findall(r"FileScan parquet", plan))
    wgl = len(re.findall(r"WindowGroupLimit", plan))
    bhj = len(re.findall(r"BroadcastHashJoin", plan))
    smj = len(re.findall(r"SortMergeJoin", plan))
    return f"exchanges={ex} scans={scans} window_group_limits={wgl} broadcast_joins={bhj} sort_merge_joins={smj}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        if len(sys.argv) > 2:
            df.explain("formatted")
        print(f"{name:26s} {summary(df._jdf.queryExecution().executedPlan().toString())}")


if __name__ == "__main__":
    main()
