"""Physical-plan facts used to review every registered query."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df: DataFrame) -> str:
    """The physical plan as Spark prints it (initial plan under AQE)."""
    return df._jdf.queryExecution().executedPlan().toString()


def plan_facts(df: DataFrame) -> dict:
    text = plan_text(df)

    def count(pattern: str) -> int:
        return len(re.findall(pattern, text))

    return {
        "exchanges": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"
                           r"|Exchange RoundRobinPartitioning"),
        "broadcasts": count(r"BroadcastExchange"),
        "hash_joins": count(r"BroadcastHashJoin|ShuffledHashJoin"),
        "sort_merge_joins": count(r"SortMergeJoin"),
        "pair_joins": sum(count(n) for n in PAIR_NODES),
        "windows": count(r"\bWindow\b"),
        "python": sum(count(n) for n in PYTHON_NODES),
        "subqueries": count(r"Subquery subquery#|ReusedSubquery"),
        "pushed_filters": count(r"PushedFilters: \[[^\]]+\]"),
    }


def _children(node) -> list:
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def physical_root(df: DataFrame):
    """The physical plan with its exchanges (under AQE: the current plan,
    i.e. the initial one before any stage has run)."""
    plan = df._jdf.queryExecution().executedPlan()
    return plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan


def input_rows(df: DataFrame) -> Counter:
    """Runs ``df``; rows that its scans read, by table (a table read twice counts twice)."""
    df.collect()
    read: Counter = Counter()

    def walk(node) -> None:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "ReusedExchange":
            return
        if name.startswith("Scan parquet"):
            table = re.search(r"/(\w+)\.parquet", node.toString())
            read[table[1] if table else "?"] += node.metrics().apply("numOutputRows").value()
        subqueries = node.subqueries()
        for child in _children(node) + [subqueries.apply(i) for i in range(subqueries.size())]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return read


def shuffled_rows(df: DataFrame, table_marker: str) -> list[int]:
    """Runs ``df``; rows written by each exchange that moves rows of the scan, without an aggregate between."""
    df.collect()
    found = []

    def unaggregated(node) -> bool:
        name = node.nodeName()
        if "Aggregate" in name or name.endswith("QueryStage"):
            return False
        return ("Scan" in name and table_marker in node.toString()) or any(unaggregated(c) for c in _children(node))

    def walk(node) -> None:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange" and unaggregated(node.child()):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for child in _children(node):
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def raw_shuffles(df: DataFrame, table_marker: str) -> list[str]:
    """Exchanges that would move raw rows of the scan whose description
    contains ``table_marker``, i.e. with no aggregate and no membership filter
    (a Bloom filter of the keys the join keeps) between the scan and the
    exchange. An empty list means every shuffle of that table's rows is
    pre-aggregated or cut to the wanted keys (or the table is only
    broadcast/streamed)."""
    found = []

    def scans_below(node, seen_agg: bool) -> bool:
        name = node.nodeName()
        if name.startswith("InMemoryTableScan"):
            # a persisted relation: judge the plan that produced the cache
            return scans_below(node.relation().cachedPlan(), seen_agg)
        if "Scan" in name and table_marker in node.toString():
            return not seen_agg
        agg = seen_agg or "Aggregate" in name or (name == "Filter" and "getbit(" in node.toString().split("\n")[0])
        return any(scans_below(c, agg) for c in _children(node))

    def walk(node):
        if node.nodeName() == "Exchange" and "Broadcast" not in node.toString().split("\n")[0]:
            if any(scans_below(c, False) for c in _children(node)):
                found.append(node.toString().split("\n")[0][:120])
        for c in _children(node):
            walk(c)

    walk(physical_root(df))
    return found
