"""Physical-plan properties that matter at scale (checked on the sf0.001 plans)."""

import re

import pytest

from conftest import SF_SMALL, plan_string
from kestrel.plans.queries import QUERIES

# Queries whose main plan must not funnel rows through one partition.
NO_SINGLE_PARTITION = [
    "text_lines", "bigram_count", "word_count", "firewall_parse", "firewall_log",
    "blocked_sources", "csv_positional_project", "group_total_join_back", "group_count_argmax",
    "kv_tab_parse", "edge_list", "edge_symmetrize", "triangles", "range_xor_checksum",
]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, name):
    plan = plan_string(QUERIES[name](spark, SF_SMALL))
    for bad in ("EvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", NO_SINGLE_PARTITION)
def test_no_single_partition_exchange(spark, name):
    plan = plan_string(QUERIES[name](spark, SF_SMALL))
    assert "SinglePartition" not in plan, name


def test_single_partition_only_over_bounded_inputs(spark):
    """Top-k: the single-partition step sees at most k distinct counts per task."""
    plan = plan_string(QUERIES["bigram_top_k"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan


def test_scans_are_pruned(spark):
    plan = plan_string(QUERIES["bigram_count"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("lang" not in s and "source" not in s for s in schemas)
    plan = plan_string(QUERIES["edge_list"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("l_quantity" not in s and "o_totalprice" not in s for s in schemas)


def test_blocked_filter_pushed_before_join(spark):
    """The 'Blocked' test is a filter directly on the events scan, before any exchange."""
    plan = plan_string(QUERIES["firewall_log"](spark, SF_SMALL))
    on_scan = re.findall(r"\+- Filter \((\d+)\)\n[ :|]*\+- Scan parquet\s+\(\d+\)", plan)
    conditions = {i: re.search(rf"\({i}\) Filter\n[^\n]*\nCondition : ([^\n]*)", plan).group(1) for i in on_scan}
    assert any("Contains" in c and "Blocked" in c for c in conditions.values()), conditions


@pytest.mark.parametrize("name", ["total_order_sort", "custom_range_sort", "skewed_range_sort"])
def test_positions_route_rows_once(spark, name):
    """One exchange of whole rows (by range id); numbering adds none, nothing sorts to
    aggregate, and the totals read the same exchange."""
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = plan_string(df)
    plan = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")]
    tree = plan.split("\n\n")[0]
    assert "ReusedExchange" in tree and "SortAggregate" not in tree
    assert "hashpartitioning(_range" not in plan


def test_bounds_hold_no_payload(spark):
    from kestrel.operators import rangesort

    df = spark.range(100).selectExpr("id as k", "repeat('x', 50) as wide")
    plan = plan_string(rangesort.total_order_sort(df, ["k"], 3, repeated_rows=False, tie_cols=[]))
    collected = re.findall(r"collect_list\(([^)]*)\)", plan)
    assert collected and not any("wide" in c for c in collected)


@pytest.mark.parametrize("name", ["text_lines", "bigram_count", "word_count"])
def test_text_queries_shuffle_only_for_the_count(spark, name):
    plan = plan_string(QUERIES[name](spark, SF_SMALL))
    kinds = re.findall(r"\nArguments: (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)
    assert kinds.count("hashpartitioning") <= 1 and "RoundRobin" not in kinds and "SinglePartition" not in kinds


def test_argmax_hashes(spark):
    """Every input row goes through hash aggregates; only the winners' smallest id, if it is a
    string, is aggregated by sorting."""
    assert "SortAggregate" not in plan_string(QUERIES["group_count_argmax_docs"](spark, SF_SMALL))
    plan = plan_string(QUERIES["group_count_argmax"](spark, SF_SMALL))
    sorted_ones = re.findall(r"\(\d+\) SortAggregate\n.*?\n.*?\n(Functions[^\n]*)", plan)
    assert sorted_ones and all("min(" in f and "max(" not in f and "count(" not in f for f in sorted_ones)
