"""What the physical plans must not contain, and what they must push down."""

import re

import pytest

from tallyloom import catalog
from tallyloom import fixtures as fx
from tallyloom.catalog import jobs
from tallyloom.plans.weekly import provider_spans, week_anchor, with_week
from tallyloom.session import materialize, scratch_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in catalog.queries() if k != "job_neural_net"])
def test_no_cross_joins_and_no_python(spark, folder, key):
    text = plan(catalog.queries()[key](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "ExistingRDD"):
        assert bad not in text, (key, bad)


@pytest.mark.parametrize("key, columns", [
    ("group_sum", {"event_id", "user_id", "event_type", "value", "p_partkey", "p_type", "p_size"}),
    ("select_columns", {"p_partkey", "p_size", "p_brand"}),
    ("join_inner_diff_keys", {"o_orderkey", "o_custkey", "c_custkey", "c_mktsegment"}),
    ("min_max_by", {"ts", "user_id"}),
])
def test_only_needed_columns_are_read(spark, folder, key, columns):
    text = plan(catalog.queries()[key](spark, folder))
    read = {c.split(":")[0] for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text) for c in schema.split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark, folder):
    assert "In(p_partkey, [2,4])" in plan(catalog.queries()["lookup_rows_by_label"](spark, folder))


@pytest.mark.parametrize("key", ["join_left_lookup", "anti_unmapped", "join_range_week", "daypart_alias", "day_abbrev_to_name"])
def test_lookups_do_not_shuffle_the_rows(spark, folder, key):
    text = plan(catalog.queries()[key](spark, folder))
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


def test_large_lookup_falls_back_to_a_shuffle(spark, folder):
    """Above the broadcast threshold the same call plans a shuffled join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100)
    try:
        assert "SortMergeJoin" in plan(catalog.queries()["join_left_lookup"](spark, folder))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sums_combine_before_the_shuffle(spark, folder):
    text = plan(catalog.queries()["map_or_unassigned"](spark, folder))
    networks = text[: text.index("raw_market")] if "raw_market" in text else text
    above, below = networks.split("Join", 1)  # printed from the top down
    assert "partial_sum" in above and "partial_sum" in below


def test_reports_read_the_written_cuts_only(spark, folder):
    text = plan(catalog.queries()["job_report_cuts"](spark, folder))
    assert "events.parquet" not in text


def test_the_fact_is_built_from_written_sums(spark, folder):
    assert "events.parquet" not in plan(jobs.delivery_fact(fx.Tables(spark, folder)))


def test_weeks_are_arithmetic(spark, folder):
    daily = fx.measured(fx.Tables(spark, folder))
    anchors = materialize(week_anchor(provider_spans(daily), None), "anchors")
    text = plan(with_week(daily, anchors))
    assert "BroadcastHashJoin" in text and "BroadcastNestedLoopJoin" not in text and "hashpartitioning" not in text


def test_intermediates_go_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or scratch_dir(spark).startswith(shared.rstrip("/") + "/")
    kept = materialize(spark.range(3), "three")
    assert scratch_dir(spark) in plan(kept) and kept.count() == 3


def test_the_split_sorts_and_writes_no_rows(spark, folder):
    text = plan(catalog.queries()["job_train_test_split"](spark, folder))
    assert not re.search("Exchange|Sort|Window", text)


def test_the_graph_is_two_scans_of_hash_aggregates(spark, folder):
    text = plan(catalog.queries()["job_graph_edges"](spark, folder))
    assert "SortAggregate" not in text and text.count("events.parquet") <= 2
