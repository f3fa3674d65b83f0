import random
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
import pytest

from edgeloom.operators.lineage import arrival_latency
from edgeloom.plans import registry
from edgeloom.sources import star
from edgeloom.streaming.ledger import append_snapshots, stream_total
from edgeloom.streaming.lineage import NEVER, earliest_arrivals, stream_latency, stream_latency_timed
from edgeloom.streaming.sources import drain, drain_complete, drain_to_parquet, land_in_order, parquet_stream

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.mark.parametrize("files_per_trigger", [None, 1])
def test_total_over_several_files(spark, tmp_path, files_per_trigger):
    path = str(tmp_path / "counts")
    spark.createDataFrame([(1,)] * 30 + [(None,)], "value int").repartition(3).write.parquet(path)
    spark.createDataFrame([(9,)], "value int").write.parquet(path + "_old")  # not part of it
    counts = parquet_stream(spark, path, files_per_trigger)
    result = drain_complete(stream_total(counts), "total")
    assert [r["value"] for r in result.collect()] == [30]


def latencies(frame):
    return {r["run_id"]: (r["started_at"], r["arrived_at"], r["latency_us"], r["latency_ms"])
            for r in frame.collect()}


@pytest.mark.parametrize("batches, how", [
    (1, {"salts": 1}), (3, {"salts": 1}), (3, {"salts": 4}), (1, {"buckets": 3}), (3, {"buckets": 1}),
    (3, {"buckets": 5}),
])
def test_latency_of_final_runs_equals_batch(spark, tmp_path, batches, how):
    runs = [(k, at(k * 10)) for k in range(60)]
    events = []
    for k in range(60):
        start = k * 10
        events += {0: [], 1: [(k, at(start + 30))], 2: [(k, at(start - 1)), (k, at(start + 29.9))],
                   3: [(k, at(start + 7)), (k, at(start + 3)), (k, at(start + 3))]}[k % 4]
    run_frame = spark.createDataFrame(runs, "run_id int, started_at timestamp")
    event_frame = spark.createDataFrame(events, "run_id int, arrived_at timestamp")
    # One file per batch and side, in time order, as they would land.
    for name, frame, column in (("runs", run_frame, "started_at"),
                                ("events", event_frame, "arrived_at")):
        for i in range(batches):
            low, high = at(600 / batches * i), at(600 / batches * (i + 1))
            if i == 0:
                low = at(-100)
            if i == batches - 1:
                high = at(1000)
            frame.where((frame[column] >= low) & (frame[column] < high)).coalesce(1).write.mode(
                "append").parquet(str(tmp_path / name))
    stream = (stream_latency_timed if "buckets" in how else stream_latency)(
        parquet_stream(spark, str(tmp_path / "runs"), 1 if batches > 1 else None),
        parquet_stream(spark, str(tmp_path / "events"), 1 if batches > 1 else None),
        allowed_delay="200 seconds", **how,
    )
    final = drain_to_parquet(stream, "latency")
    batch = arrival_latency(run_frame, event_frame)
    assert final.dtypes == batch.dtypes
    watermark = min(max(s for _, s in runs), max(a for _, a in events)) - timedelta(seconds=200)
    closed = {k: v for k, v in latencies(batch).items()
              if v[0] + timedelta(seconds=30) <= watermark}
    assert 0 < len(closed) < 60
    assert final.count() == len(closed)
    assert latencies(final) == closed


def test_the_named_folder_is_read_and_no_other(spark, tmp_path):
    for name, value in (("a", 1), ("a,b", 5), ("b", 9)):
        spark.createDataFrame([(value,)], "value int").write.parquet(str(tmp_path / name))
    for name, value in (("a", 1), ("a,b", 5), ("b", 9)):
        path = str(tmp_path / name)
        counts = parquet_stream(spark, path, schema="value int")
        assert [r["value"] for r in drain_complete(stream_total(counts), "n").collect()] == [value]


@pytest.mark.parametrize("name", ["x{y}", "q[1]", "a*", "a?", "a\\b"])
def test_paths_that_read_as_patterns_are_refused(spark, name):
    with pytest.raises(ValueError, match="path of a file stream"):
        parquet_stream(spark, f"/tmp/{name}", schema="value int")


def test_state_of_the_registered_stream_stays_small(spark):
    """Its batches are as wide as the wait; state is a row per bucket."""
    sf_dir = "/root/testdata/sf0.001"
    drained = registry._drained_latency(spark, sf_dir, batch_rows=1)
    assert 0 < drained.largest_state() <= registry.STREAM_BUCKETS
    moved = [w for w in drained.watermarks() if w.year > 1970]
    assert len(set(moved)) > 50
    few = registry._drained_latency(spark, sf_dir)
    assert sorted(map(tuple, few.output.collect())) == sorted(map(tuple, drained.output.collect()))


def test_open_runs_are_all_that_is_held():
    """What a bucket keeps over many batches, counted: open runs, and arrivals not yet passed."""
    from edgeloom.streaming import lineage

    class State:
        blob, watermark = None, 0

        exists = property(lambda self: self.blob is not None)
        get = property(lambda self: self.blob)
        getCurrentWatermarkMs = lambda self: self.watermark
        setTimeoutTimestamp = lambda self, ms: setattr(self, "due", ms)
        update = lambda self, new: setattr(self, "blob", new)
        remove = lambda self: setattr(self, "blob", None)

    state, update, wait = State(), lineage._bucket(["key_0"], 30_000_000), 30
    rng, final, held = random.Random(3), {}, []
    runs = {f"r{k}": 10 * k for k in range(300)}
    rows = [(k, t, True) for k, t in runs.items()]
    rows += [(k, t + rng.randrange(100), False) for k, t in runs.items() for _ in range(20)]
    for batch in range(32):
        part = [r for r in rows if batch * 100 <= r[1] < batch * 100 + 100]
        frame = pd.DataFrame({"key_0": [r[0] for r in part], "start": [r[2] for r in part],
                              "us": [r[1] * 1_000_000 for r in part]})
        for out in update((0,), iter([frame]), state):
            final |= {r.key_0: r.arrived for r in out.itertuples()}
        state.watermark = max(batch * 100 + 99 - 10, 0) * 1000
        held.append(0 if state.blob is None else pa.ipc.open_stream(state.blob[0]).read_all().num_rows)
    for k, t in runs.items():
        first = min((a for n, a, s in rows if n == k and not s and t <= a < t + wait), default=None)
        if t < 2800:
            assert final[k] == first * 1_000_000 if first is not None else pd.isna(final[k])
    # A batch has ten runs and 200 events.
    assert max(held) < 150 and state.due > 0


def test_rows_are_looked_at_a_bounded_number_of_times(monkeypatch):
    """A batch of many parts costs in proportion to its rows, not to parts times the state."""
    from edgeloom.streaming import lineage

    looked_at = []

    def counted(open_runs, loose, keys, wait):
        looked_at.append(len(open_runs) + len(loose))
        return earliest_arrivals(open_runs, loose, keys, wait)

    class State:
        exists, get = False, None
        getCurrentWatermarkMs = lambda self: 0
        setTimeoutTimestamp = lambda self, ms: None
        update = lambda self, new: setattr(self, "get", new)

    monkeypatch.setattr(lineage, "earliest_arrivals", counted)
    monkeypatch.setattr(lineage, "AT_ONCE", 50, raising=False)
    parts = [pd.DataFrame({"key_0": [f"r{i}_{k}" for k in range(100)], "start": [k % 2 == 0 for k in range(100)],
                           "us": [1000 + k for k in range(100)]}) for i in range(64)]
    state = State()
    assert list(lineage._bucket(["key_0"], 30_000_000)((0,), iter(parts), state)) == []
    assert pa.ipc.open_stream(state.get[0]).read_all().num_rows == 6400
    assert sum(looked_at) <= 4 * 6400 and max(looked_at) >= 6400


def test_earliest_arrivals_by_two_keys():
    runs = pd.DataFrame({"a": ["x", "x", "y"], "b": ["1", "2", None], "started": [10, 20, 30],
                         "arrived": [NEVER, 25, NEVER]})
    loose = pd.DataFrame({"a": ["x", "x", "x", "z"], "b": ["1", "1", "2", "1"], "us": [14, 9, 21, 5]})
    found, left = earliest_arrivals(runs, loose, ["a", "b"], 5)
    assert sorted(map(str, found.fillna("").itertuples(index=False, name=None))) == sorted(
        map(str, [("x", "1", 10, 14), ("x", "2", 20, 21), ("y", "", 30, NEVER)]))
    assert sorted(left.itertuples(index=False, name=None)) == [("x", "1", 9), ("z", "1", 5)]


def test_a_drained_stream_has_no_more_state_stores_than_buckets(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        drained = registry._drained_latency(spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = {o["numShufflePartitions"] for p in drained.progress for o in p["stateOperators"]}
    assert stores == {registry.STREAM_BUCKETS}


def test_a_run_given_several_starts_counts_from_the_first():
    runs = pd.DataFrame({"k": ["a", "a", None], "started": [50, 20, 5], "arrived": [60, NEVER, NEVER]})
    loose = pd.DataFrame({"k": ["a", "a", "b"], "us": [10, 45, 7]})
    found, left = earliest_arrivals(runs, loose, ["k"], 30)
    assert found.fillna("none").values.tolist() == [["a", 20, 45], ["none", 5, NEVER]]
    assert left.values.tolist() == [["a", 10], ["b", 7]]


def test_slices_land_in_the_order_of_time(spark, tmp_path):
    rows = [(i, at(i * 10) if i % 7 else None) for i in range(100)]
    frame = spark.createDataFrame(rows, "value int, slice timestamp").repartition(5)
    path = str(tmp_path / "slices")
    land_in_order(frame, path, "slice", at(0), 200.0, 5)
    stream = parquet_stream(spark, path, 1, schema="value int, slice timestamp")
    seen = []
    query = stream.writeStream.foreachBatch(
        lambda df, n: seen.append(sorted(r["value"] for r in df.collect()))
    ).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    number = lambda i: min(i * 10 // 200, 4) if i % 7 else 4
    assert seen == [[i for i in range(100) if number(i) == s] for s in range(5)]


def test_snapshots_are_written_once_per_batch(spark, tmp_path):
    """Also where a batch is run again that was written but never committed."""
    path, out, log = (str(tmp_path / n) for n in ("counts", "snapshots", "log"))
    land = lambda values: spark.createDataFrame(
        [(v,) for v in values], "value int").coalesce(1).write.mode("append").parquet(path)
    run = lambda: sorted(map(tuple, append_snapshots(
        parquet_stream(spark, path, 1, schema="value int"), out, log).collect()))
    land([None])
    assert run() == [(0, None)]
    land([1, 2])
    land([3, None])
    assert run() == [(0, None), (1, 3), (2, 6)]
    for name in ("2", ".2.crc"):
        (tmp_path / "log" / "commits" / name).unlink(missing_ok=True)
    assert run() == [(0, None), (1, 3), (2, 6)]
    land([10])
    assert run() == [(0, None), (1, 3), (2, 6), (3, 16)]


def test_stream_restarts_from_its_checkpoint(spark, tmp_path):
    """Files that land after the first run are added to its total, not counted anew."""
    path, checkpoint = str(tmp_path / "counts"), str(tmp_path / "checkpoint")
    seen = []
    for n in (3, 4):
        landed = spark.createDataFrame([(1,)] * n, "value int").coalesce(1)
        landed.write.mode("append").parquet(path)
        query = (
            stream_total(parquet_stream(spark, path)).writeStream.format("memory")
            .queryName("restarted").option("checkpointLocation", checkpoint)
            .outputMode("complete").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        seen.append((spark.table("restarted").collect()[0]["value"],
                     sum(p["numInputRows"] for p in query.recentProgress)))
    assert seen == [(3, 3), (7, 4)]
