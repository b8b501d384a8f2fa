"""Executed-plan report: run each query once and summarise its final (AQE) physical plan.

    python scripts/plan_report.py [sf_dir] [query ...]

Prints one line per query: parquet scans per table, shuffle exchanges, reused exchanges,
broadcasts, join strategies, aggregates, windows, top-k nodes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placerank.plans.catalog import QUERIES  # noqa: E402
from placerank.plans.inspect import count_nodes, executed_plan  # noqa: E402
from placerank.session import local_session  # noqa: E402

HEADLINE = ["top_items", "popularity_score_sales", "tfidf_terms", "keyword_ranking", "hybrid_recommendations"]


def summarise(plan: str) -> dict:
    scans = {}
    for table in re.findall(r"FileScan parquet [^\n]*?/([A-Za-z_]+)\.parquet", plan):
        scans[table] = scans.get(table, 0) + 1
    shuffles = len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
    return {
        "scans": scans,
        "shuffle_exchanges": shuffles,
        "reused_exchanges": count_nodes(plan, "ReusedExchange"),
        "broadcasts": count_nodes(plan, "BroadcastExchange"),
        "joins": {j: count_nodes(plan, j) for j in
                  ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
                   "CartesianProduct") if count_nodes(plan, j)},
        "aggregates": count_nodes(plan, "HashAggregate") + count_nodes(plan, "ObjectHashAggregate"),
        "windows": count_nodes(plan, "Window"),
        "window_group_limits": count_nodes(plan, "WindowGroupLimit"),
        "take_ordered": count_nodes(plan, "TakeOrderedAndProject"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or HEADLINE
    spark = local_session()
    for name in names:
        plan = executed_plan(QUERIES[name](spark, sf_dir))
        print(name, summarise(plan))
        if os.environ.get("PLAN_DUMP"):
            print(plan)


if __name__ == "__main__":
    main()
