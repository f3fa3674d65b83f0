"""Shape of the physical plans: what reaches the scan, how often data is shuffled, skew."""

import re

import pytest
from pyspark.sql import functions as F

from edgeloom.operators import lineage, ranking
from edgeloom.plans.registry import QUERIES
from edgeloom.sources import star

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(set(QUERIES) - {"stream_total", "stream_latency", "stream_latency_complete"})


def plan_of(frame, capsys, execute=False):
    if execute:
        frame.collect()
    capsys.readouterr()
    frame.explain()
    text = capsys.readouterr().out
    return text.split("== Initial Plan ==")[0] if execute else text


@pytest.fixture
def large(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def eager_skew(large):
    """Skew handling that already sets in at a few kilobytes."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: large.conf.get(key) for key in small}
    for key, value in small.items():
        large.conf.set(key, value)
    yield large
    for key, value in before.items():
        large.conf.set(key, value)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(large, capsys, name):
    plan = plan_of(QUERIES[name](large, SF_DIR), capsys)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan


def scans(plan):
    return re.findall(r"FileScan parquet \[([^\]]*)\].*?ReadSchema", plan)


def test_scans_read_only_what_is_used(spark, capsys):
    plan = plan_of(QUERIES["top_mentioned"](spark, SF_DIR), capsys)
    assert len(scans(plan)) == 1 and scans(plan)[0].count("#") == 3
    assert "EqualTo(l_returnflag,N)" in plan
    plan = plan_of(QUERIES["run_duration"](spark, SF_DIR), capsys)
    assert "In(event_type, [error,purchase,signup])" in plan
    assert scans(plan)[0].count("#") == 3


def test_report_is_one_scan_per_network_and_one_shuffle(large, capsys):
    for name in ("user_report_full", "user_report_100", "sql_user_report_100"):
        plan = plan_of(QUERIES[name](large, SF_DIR), capsys)
        assert len(scans(plan)) == 4
        assert plan.count("Exchange") == 1
        assert "Join" not in plan
    assert "TakeOrderedAndProject" in plan


def test_unused_measures_are_pruned(spark, capsys):
    plan = plan_of(QUERIES["user_report_full"](spark, SF_DIR), capsys)
    assert "social_rows" not in plan and "mention_edges" not in plan


def test_top_k_never_sorts_everything(spark, capsys):
    for name in ("top_followed_10", "top_mentioned_10", "user_report_100"):
        plan = plan_of(QUERIES[name](spark, SF_DIR), capsys)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_leaders_are_broadcast_whatever_the_threshold(large, capsys):
    for name in ("top5_followed_mentions", "sql_top5_followed_mentions"):
        plan = plan_of(QUERIES[name](large, SF_DIR), capsys)
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan


def test_more_leaders_than_the_bound_shuffle_no_raw_edge(large, capsys):
    """One user holds half of the mention edges."""
    social = large.range(3000).selectExpr("id AS follower", "id % 50 AS followed")
    mention = large.range(20000).selectExpr(
        "id AS mentioner", "IF(id % 2 = 0, 7, id % 60) AS mentioned", "1 AS occur"
    )
    results = {}
    for bound in (20, 19):
        frame = ranking.leaders_with_mentions(social, mention, k=20, broadcast_rows=bound)
        plan = plan_of(frame, capsys)
        assert ("Broadcast" in plan) == (bound == 20)
        for below in re.findall(r"Exchange hashpartitioning\(mentioned.*\n(.*)", plan):
            assert "HashAggregate" in below and "partial_sum(" in below
        results[bound] = [tuple(r) for r in frame.collect()]
    assert results[20] == results[19] and len(results[19]) == 10  # even ids have none


def test_runs_are_scanned_once_from_the_start(large, capsys):
    """The plan before execution: one scan of the runs, its second use a reused exchange."""
    frame = QUERIES["lineage_latency"](large, SF_DIR)
    frame.collect()
    capsys.readouterr()
    frame.explain()
    text = capsys.readouterr().out
    initial = text.split("== Initial Plan ==")[1]
    scanned = [s for s in scans(initial) if "o_orderdate" in s]
    assert len(scanned) == 2 and len({re.sub(r"#\d+", "", s) for s in scanned}) == 1
    final = text.split("== Initial Plan ==")[0]
    assert len([s for s in scans(final) if "o_orderdate" in s]) == 1
    assert "ReusedExchange" in final


def test_declared_distinct_edges_save_their_shuffles(large, capsys):
    placed = star.table(large, SF_DIR, "orders").selectExpr("o_custkey source", "o_orderkey target")
    held = star.table(large, SF_DIR, "lineitem").selectExpr("l_orderkey source", "l_partkey target")
    plain = plan_of(lineage.two_hop_impact(placed, held), capsys)
    declared = plan_of(lineage.two_hop_impact(placed, held, distinct_edges=True), capsys)
    assert plain.count("Exchange hashpartitioning") == 5
    assert declared.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize("name, tables", [
    ("ledger_running", 1), ("lineage_latency", 2), ("lineage_latency_report", 2),
])
def test_inputs_are_read_once(large, capsys, name, tables):
    plan = plan_of(QUERIES[name](large, SF_DIR), capsys, execute=True)
    assert "isFinalPlan=true" in plan
    assert len(scans(plan)) == tables
    assert "ReusedExchange" in plan


def test_a_run_with_most_events_is_split(eager_skew, capsys):
    """One run holds half of all events, all within its wait."""
    spark = eager_skew
    runs = spark.range(2000).select(
        F.col("id").alias("run_id"), F.timestamp_seconds("id").alias("started_at")
    )
    events = spark.range(40000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 2000).alias("run_id"),
        F.timestamp_micros(7_000_000 + F.col("id") * 100).alias("arrived_at"),
    )
    result = lineage.arrival_latency(runs, events)
    plan = plan_of(result, capsys, execute=True)
    assert "Join(skew=true)" in plan
    assert result.where("run_id = 7").collect()[0]["latency_us"] == 0
    assert result.count() == 2000


def test_a_hub_with_most_edges_is_split(eager_skew, capsys):
    spark = eager_skew
    first = spark.range(20000).select(
        F.col("id").alias("source"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("target"),
    )
    second = spark.range(1000).select(F.col("id").alias("source"), (-F.col("id")).alias("target"))
    result = lineage.two_hop_impact(first, second)
    plan = plan_of(result, capsys, execute=True)
    assert "Join(skew=true)" in plan
    pairs = {(s, 5 if s % 3 == 0 else s) for s in range(20000)}
    assert result.count() == sum(1 for _, via in pairs if via < 1000)
