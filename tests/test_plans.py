"""Physical plans: what must be pruned, pushed or aggregated before a shuffle."""

from dataclasses import replace

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from relocate import Selector, checks
from relocate.checks import fixtures as fx

FOLDER = "/root/testdata/sf0.001"
QUERIES = dict(checks.QUERIES)

# Queries whose plan is made of stored results; building them runs streams or whole jobs.
LONG = {"sync_ties_and_nulls", "load_announced_files", "load_append", "load_append_delimited", "retry_replay", "relocate_and_validate", "sync_increments", "stream_load", "stream_rerun_noop"}
LONG |= {"relocate_by_catalog", "purge_and_reload", "export_again_without_key", "compact_by_size", "apply_changes", "apply_late_changes"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in LONG])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for forbidden in ("NestedLoop", "CartesianProduct", "Python", "MapInPandas", "ArrowEval"):
        assert forbidden not in text


def test_reconcile_has_one_shuffle_and_no_join(spark):
    text = plan(QUERIES["reconcile_full"](spark, FOLDER))
    assert text.count("Exchange") == 1
    assert "Join" not in text
    assert "partial_sum" in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_metrics_shuffle_dates_not_texts(spark):
    text = plan(QUERIES["partition_metrics"](spark, FOLDER))
    below_shuffle = text[text.index("Exchange") :]
    assert "replace(" not in below_shuffle and "trunc(" in below_shuffle


def test_upsert_limits_each_key_before_the_shuffle(spark):
    text = plan(QUERIES["upsert_by_key"](spark, FOLDER))
    below_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_staged_partitions_are_pruned(spark):
    text = plan(QUERIES["read_staged_parquet"](spark, FOLDER))
    assert "PartitionFilters: [isnotnull(pt" in text
    assert "Exchange" not in text


@pytest.mark.parametrize("text", ["RANGE(p199605,p199702)", "EACH(p199605,p199611)", "STARTWITH(p199605)"])
def test_selected_months_reach_the_scan(spark, text):
    spec = replace(fx.ORDERS, selector=Selector.parse(text))
    rows = spec.rows(fx.table(spark, FOLDER, "orders"))
    assert "GreaterThanOrEqual(o_orderdate,1996-05-01T00:00)" in plan(rows)
    assert "replace(" not in plan(rows)


def test_filter_is_pushed_with_two_columns(spark):
    text = plan(QUERIES["scan_filtered"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "o_custkey" not in text


def test_compacted_table_is_read_by_key_without_a_shuffle(spark):
    text = plan(QUERIES["read_after_compaction"](spark, FOLDER))
    assert "Exchange" not in text and "Window" not in text


def test_bounds_are_found_by_hash_joins_without_a_shuffle(spark):
    text = plan(QUERIES["assign_many_text_ranges"](spark, FOLDER))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_bucketed_table_needs_no_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["stage_bucketed"](spark, FOLDER))
