"""Executed-plan inspection: what actually ran after AQE re-planned the query.

``explain()`` before an action shows the initial adaptive plan; exchange reuse and
broadcast conversion are decided at run time, so these helpers run the DataFrame once and
read its final physical plan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame) -> str:
    """Run ``df``'s own physical plan (rows are counted in the JVM, not collected) and
    return its final, AQE-adjusted form as text."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return final_section(qe.executedPlan().toString())


def final_section(plan: str) -> str:
    """The ``== Final Plan ==`` part of an adaptive plan (the plan itself otherwise)."""
    if "== Final Plan ==" not in plan:
        return plan
    body = plan.split("== Final Plan ==", 1)[1]
    return body.split("== Initial Plan ==", 1)[0]


def count_nodes(plan: str, node: str) -> int:
    return len(re.findall(rf"\b{re.escape(node)}\b", plan))


def scans_of(plan: str, table: str) -> int:
    """Parquet scans of a file named ``table``.parquet in the plan (reused exchanges and
    broadcasts are not scans)."""
    return len(re.findall(rf"FileScan parquet [^\n]*{re.escape(table)}\.parquet", plan)) or len(
        re.findall(rf"Location: [^\n]*{re.escape(table)}\.parquet", plan)
    )


def summary(plan: str) -> dict[str, int]:
    nodes = ["Exchange", "ReusedExchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
             "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate",
             "SortAggregate", "Window", "WindowGroupLimit", "TakeOrderedAndProject", "FileScan"]
    return {n: count_nodes(plan, n) for n in nodes}
