import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from edgeloom.operators import lineage
from edgeloom.operators.reconcile import missing_items, possibly_among

START = datetime(2024, 1, 1)
US = timedelta(microseconds=1)
RUNS = "run_id int, started_at timestamp_ntz"
EVENTS = "run_id int, arrived_at timestamp_ntz"


def at(seconds):
    return START + timedelta(seconds=seconds)


def latencies(spark, runs, events, **options):
    frame = lineage.arrival_latency(
        spark.createDataFrame(runs, RUNS), spark.createDataFrame(events, EVENTS), **options
    )
    return {r["run_id"]: r for r in frame.collect()}


def test_wait_limit_is_strict_and_earliest_wins(spark):
    limit = timedelta(seconds=lineage.MAX_WAIT_SECONDS)
    got = latencies(
        spark,
        [(1, at(0)), (2, at(0)), (3, at(0)), (4, at(0)), (5, at(0)), (6, None), (None, at(0))],
        [(1, at(0) + limit - US), (2, at(0) + limit), (3, at(9)), (3, at(5)), (3, at(7)),
         (4, at(0) - US), (5, at(0)), (6, at(1)), (None, at(1)), (1, None)],
    )
    assert got[1]["latency_us"] == 29_999_999 and got[1]["latency_ms"] == 29_999.999
    assert got[2]["latency_us"] is None and got[2]["arrived_at"] is None
    assert got[3]["latency_ms"] == 5000.0 and got[3]["arrived_at"] == at(5)
    assert got[4]["latency_us"] is None
    assert got[5]["latency_us"] == 0
    assert got[6]["latency_us"] is None
    assert got[None]["latency_us"] is None
    assert len(got) == 7


def test_repeated_runs_count_once_from_the_first_start(spark):
    got = latencies(spark, [(1, at(4)), (1, at(2)), (1, at(2))], [(1, at(3)), (1, at(3))])
    assert len(got) == 1 and got[1]["latency_ms"] == 1000.0


@pytest.mark.parametrize("seed", range(3))
def test_latency_against_brute_force(spark, seed):
    rng = random.Random(seed)
    wait = rng.choice([1.0, 2.5, 10.0])
    runs = [(k, at(rng.uniform(-60, 60))) for k in range(20) for _ in range(rng.choice([1, 1, 2]))]
    events = [(rng.choice([None, *range(25)]), at(rng.uniform(-60, 60))) for _ in range(400)]
    got = latencies(spark, runs, events, max_wait=wait)
    for key in range(20):
        start = min(s for k, s in runs if k == key)
        end = start + timedelta(seconds=wait)
        first = min((a for k, a in events if k == key and start <= a < end), default=None)
        assert got[key]["started_at"] == start
        assert got[key]["arrived_at"] == first
        assert got[key]["latency_us"] == (None if first is None else (first - start) // US)
    assert len(got) == 20


def test_several_keys(spark):
    runs = spark.createDataFrame([("a", 1, at(0)), ("b", 1, at(0))],
                                 "job string, run int, started_at timestamp")
    events = spark.createDataFrame([("b", 1, at(2))], "job string, run int, arrived_at timestamp")
    frame = lineage.arrival_latency(runs, events, keys=["job", "run"])
    assert {(r["job"], r["run"]): r["latency_ms"] for r in frame.collect()} == {
        ("a", 1): None, ("b", 1): 2000.0}


def report_of(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "latency_us bigint")
    return lineage.latency_report(frame).collect()[0].asDict()


def test_latency_report(spark):
    assert report_of(spark, [1000, 2500, None, None]) == {
        "avg_ms": 1.75, "max_ms": 2.5, "min_ms": 1.0, "count": 2, "timeout_count": 2,
        "success_rate": 50.0}


def test_latency_report_of_more_than_64_bits(spark):
    assert report_of(spark, [6 * 10**18] * 4)["avg_ms"] == 6e15


def test_latency_report_without_arrivals_or_runs(spark):
    zeros = {"avg_ms": 0.0, "max_ms": 0.0, "min_ms": 0.0, "count": 0, "success_rate": 0.0}
    assert report_of(spark, [None]) == {**zeros, "timeout_count": 1}
    assert report_of(spark, []) == {**zeros, "timeout_count": 0}


def test_size_report_counts_utf8_bytes(spark):
    frame = spark.createDataFrame([('{"k":"é"}',), ("{}",), (None,)], "payload string")
    assert lineage.size_report(frame).collect()[0].asDict() == {
        "avg_bytes": 6.0, "max_bytes": 10, "min_bytes": 2, "count": 2}
    assert lineage.size_report(frame.limit(0)).collect()[0].asDict() == {
        "avg_bytes": 0.0, "max_bytes": 0, "min_bytes": 0, "count": 0}


def test_performance_report_is_both_reports(spark):
    runs = spark.createDataFrame([(1000,), (None,)], "latency_us bigint")
    events = spark.createDataFrame([("{}",), ("[1]",), (None,)], "payload string")
    both = lineage.performance_report(runs, events).collect()[0].asDict()
    latency = lineage.latency_report(runs).collect()[0].asDict()
    size = lineage.size_report(events).collect()[0].asDict()
    latency["latency_count"], size["size_count"] = latency.pop("count"), size.pop("count")
    assert both == {**latency, **size}


def test_run_durations(spark):
    events = [
        (1, "START", at(0)), (1, "COMPLETE", at(2)),
        (2, "START", at(0)), (2, "START", at(1)), (2, "COMPLETE", at(3)), (2, "FAIL", at(5)),
        (3, "START", at(0)), (3, "RUNNING", at(9)),
        (4, "FAIL", at(1)),
        (5, "START", at(0)), (5, "COMPLETE", at(4)), (5, "FAIL", at(4)),
        (6, "RUNNING", at(1)),
    ]
    frame = spark.createDataFrame(events, "run int, kind string, at timestamp_ntz")
    got = {r["run"]: r for r in lineage.run_durations(frame, ["run"], "at", "kind").collect()}
    assert {k: (r["duration_s"], r["outcome"]) for k, r in got.items()} == {
        1: (2.0, "COMPLETED"), 2: (5.0, "FAILED"), 3: (None, "RUNNING"), 4: (None, "FAILED"),
        5: (4.0, "FAILED")}
    assert got[2]["started_at"] == at(0) and got[2]["duration_us"] == 5_000_000


def test_two_hop_impact_of_the_datasets(spark):
    rng = random.Random(5)
    first = [(rng.randrange(6), rng.randrange(6)) for _ in range(25)] + [(1, 2)] * 9 + [(None, 3)]
    second = [(rng.randrange(6), rng.randrange(6)) for _ in range(25)] + [(2, 5)] * 9 + [(None, 4)]
    got = lineage.two_hop_impact(
        spark.createDataFrame(first, "source int, target int"),
        spark.createDataFrame(second, "source int, target int"),
    )
    expected = {(a, d) for a, b in first for c, d in second if b is not None and b == c}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_missing_items(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("b",)], "name string")
    landed = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "name string")
    names = lambda frame: sorted((r["name"] for r in frame.collect()), key=repr)
    assert names(missing_items(expected, landed, ["name"])) == ["b", "c", None]
    assert names(missing_items(expected, landed, ["name"], force=True)) == ["a", "b", "c", None]
    assert names(missing_items(expected, landed.limit(0), ["name"])) == ["a", "b", "c", None]
    assert names(missing_items(landed, landed.where("name is not null"), ["name"])) == [None]


def test_reach_at_a_hub_is_counted_without_its_pairs(spark):
    """2,000 items reach 2,000 others through one in the middle; a few reach little."""
    first = spark.range(2000).selectExpr("id AS source", "-1 AS target").union(
        spark.range(3).selectExpr("id + 5000 AS source", "-2 AS target"))
    second = spark.range(2000).selectExpr("-1 AS source", "id AS target").union(
        spark.range(4).selectExpr("-2 AS source", "id AS target"))
    reached = {r["source"]: r["reached"] for r in lineage.two_hop_reach(first, second).collect()}
    assert len(reached) == 2003
    assert reached[5000] == 4 and abs(reached[17] - 2000) < 60


@pytest.mark.parametrize("hub_pairs", [0, 6, 40, 1 << 20])
def test_exact_reach_at_hubs_and_elsewhere(spark, hub_pairs):
    rng = random.Random(hub_pairs)
    first = [(rng.randrange(30), rng.randrange(12)) for _ in range(150)] + [(1, None), (None, 3), (40, 99)]
    second = [(rng.choice([0, 0, 1, rng.randrange(12)]), rng.choice([rng.randrange(-9, 90), rng.randrange(2 ** 62), None]))
              for _ in range(300)] + [(None, 5), (3, -(2 ** 62))]
    expected = {}
    for s, via in first:
        expected.setdefault(s, set()).update(t for v, t in second if via is not None and v == via and t is not None)
    found = lineage.two_hop_reach_exact(
        spark.createDataFrame(first, "source long, target long"),
        spark.createDataFrame(second, "source long, target long"), hub_pairs=hub_pairs,
    )
    assert {r["source"]: r["reached"] for r in found.collect()} == {s: len(t) for s, t in expected.items() if t}
    assert found.dtypes == [("source", "bigint"), ("reached", "bigint")]


def test_a_hub_makes_no_pairs(spark):
    """Every source and target meet at one item; no row of the plan is a pair of them."""
    n = 3000
    ins = spark.range(n).selectExpr("id AS source", "0L AS target")
    outs = spark.range(n).selectExpr("0L AS source", "id AS target")
    found = lineage.two_hop_reach_exact(ins, outs, hub_pairs=1000)
    assert found.agg(F.min("reached"), F.max("reached"), F.count("*")).first()[:] == (n, n, n)
    rows = []

    def visit(node):
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            rows.append(metrics.apply("numOutputRows").value())
        name = node.getClass().getSimpleName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else (
            [node.plan()] if name.endswith("QueryStageExec") else [])
        for child in [*below, *(node.children().apply(i) for i in range(node.children().size()))]:
            visit(child)

    found.collect()
    visit(found._jdf.queryExecution().executedPlan())
    assert rows and max(rows) <= 2 * n


@pytest.mark.parametrize("nobody", [7, None])
def test_sources_of_one_item_share_its_count(spark, nobody):
    """400 sources at a hub that reaches 300 thinly spread ids: no row per source and block of ids."""
    n = 400
    ins = spark.range(n).selectExpr("id AS source", "0L AS target").union(
        spark.createDataFrame([(nobody, 0), (nobody, 1), (n + 1, 1), (n + 1, 1), (n + 2, 9)], "source long, target long"))
    outs = spark.range(300).selectExpr("0L AS source", "id * 40000 AS target").union(
        spark.createDataFrame([(1, 40000), (1, 5), (1, 5), (1, None)], "source long, target long"))
    found = lineage.two_hop_reach_exact(ins, outs, hub_pairs=500)
    expected = {k: 300 for k in range(n)} | {nobody: 301, n + 1: 2}
    rows = found.collect()
    assert {r["source"]: r["reached"] for r in rows} == expected and len(rows) == len(expected)
    made = []

    def visit(node):
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            made.append(metrics.apply("numOutputRows").value())
        name = node.getClass().getSimpleName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else (
            [node.plan()] if name.endswith("QueryStageExec") else [])
        for child in [*below, *(node.children().apply(i) for i in range(node.children().size()))]:
            visit(child)

    found.collect()
    visit(found._jdf.queryExecution().executedPlan())
    assert made and max(made) <= 2 * n


@pytest.mark.parametrize("bits", [6, 12, 24])
def test_missing_items_with_a_filter_on_what_landed(spark, bits):
    rng = random.Random(bits)
    name = lambda i: f"n{i}" if i else None
    expected = [(name(rng.randrange(60)), rng.randrange(3)) for _ in range(80)]
    landed = [(name(rng.randrange(4000)), rng.randrange(3)) for _ in range(6000)]
    wanted = spark.createDataFrame(expected, "name string, part int")
    there = spark.createDataFrame(landed, "name string, part int")
    plain = missing_items(wanted, there, ["name", "part"])
    found = missing_items(wanted, there, ["name", "part"], filter_bits=bits)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count()
    left = possibly_among(there, wanted.distinct(), ["name", "part"], bits).count()
    real = sum(r in set(expected) and r[0] is not None for r in landed)
    assert real <= left and (bits < 24 or left < real + 10)
    nothing = missing_items(wanted.limit(0), there, ["name", "part"], filter_bits=bits)
    assert nothing.collect() == []


def test_the_filter_comes_before_the_shuffle(spark):
    wanted = spark.range(50).withColumnRenamed("id", "item")
    landed = spark.range(0, 200_000, 1, 8).withColumnRenamed("id", "item")
    found = missing_items(wanted, landed, ["item"], filter_bits=20)
    assert found.collect() == []
    shuffled = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            shuffled.append(node.metrics().apply("shuffleRecordsWritten").value())
        below = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else (
            [node.plan()] if name.endswith("QueryStageExec") else [])
        for child in [*below, *(node.children().apply(i) for i in range(node.children().size()))]:
            visit(child)

    visit(found._jdf.queryExecution().executedPlan())
    assert shuffled and max(shuffled) < 1000
