import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row

from edgeloom.operators import ledger as totals
from edgeloom.sources import ledger

START = datetime(2024, 1, 1)


def values(spark, table):
    return sorted((r["value"] for r in spark.table(table).collect()), key=lambda v: v or 0)


def test_ledger_keeps_every_snapshot(spark, tmp_path):
    for _ in range(2):  # creating twice is harmless
        ledger.create_counts(spark, "t_counts", str(tmp_path / "counts"))
        ledger.create_sums(spark, "t_sums", str(tmp_path / "sums"))
    ledger.append_total(spark, "t_counts", "t_sums")
    assert values(spark, "t_sums") == [None]
    ledger.append_count(spark, "t_counts")
    ledger.append_total(spark, "t_counts", "t_sums")
    assert values(spark, "t_sums") == [None, 1]
    ledger.append_counts(spark.createDataFrame([(1,)] * 5, "value int"), "t_counts")
    ledger.append_total(spark, "t_counts", "t_sums")
    assert values(spark, "t_sums") == [None, 1, 6]
    assert values(spark, "t_counts") == [1] * 6
    for table in ("t_counts", "t_sums"):
        spark.sql(f"DROP TABLE {table}")


def test_managed_tables(spark):
    ledger.create_counts(spark, "m_counts")
    ledger.append_count(spark, "m_counts", 4)
    assert totals.ledger_total(spark.table("m_counts")).collect()[0]["value"] == 4
    spark.sql("DROP TABLE m_counts")


def brute_force(counts, every):
    slot = lambda ts: (ts - datetime(1970, 1, 1)) // every
    known = [(slot(ts), v) for ts, v in counts if ts is not None]
    if not known:
        return []
    first, last = min(s for s, _ in known), max(s for s, _ in known)
    return [
        (datetime(1970, 1, 1) + (s + 1) * every, sum(v or 0 for k, v in known if k <= s))
        for s in range(first, last + 1)
    ]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("chunk_ticks", [1, 3, 1440])
def test_running_totals_with_gaps(spark, kind, chunk_ticks):
    rng = random.Random(chunk_ticks)
    counts = [(START + timedelta(seconds=rng.randrange(4000) + 9000 * rng.randrange(3)),
               rng.choice([None, 1, 2])) for _ in range(40)]
    counts += [(START + timedelta(seconds=300), 1), (None, 5)]  # exactly on a tick; no time
    frame = spark.createDataFrame(counts, f"ts {kind}, value int")
    result = totals.running_totals(frame, "ts", "value", 300, chunk_ticks)
    assert result.dtypes == [("tick", kind), ("total", "bigint")]
    assert sorted(tuple(r) for r in result.collect()) == brute_force(counts, timedelta(seconds=300))


def test_running_totals_before_1970(spark):
    counts = [(datetime(1969, 12, 31, 23, 59), 1), (datetime(1970, 1, 1, 0, 4), 1)]
    frame = spark.createDataFrame(counts, "ts timestamp_ntz, value int")
    result = totals.running_totals(frame, "ts", "value", 60, 4)
    assert sorted(tuple(r) for r in result.collect()) == brute_force(counts, timedelta(minutes=1))


def test_running_totals_of_nothing(spark):
    frame = spark.createDataFrame([], "ts timestamp, value int")
    assert totals.running_totals(frame, "ts", "value", 60).collect() == []


def files_read(frame):
    """Files that the frame's scan opens."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    return int(plan.collectLeaves().head().metrics().apply("numFiles").value())


def test_a_total_reads_only_what_has_landed_since(spark, tmp_path):
    ledger.create_counts(spark, "i_counts", str(tmp_path / "counts"))
    ledger.create_sums(spark, "i_sums", str(tmp_path / "sums"))
    ledger.create_marks(spark, "i_marks", str(tmp_path / "marks"))
    ledger.append_total(spark, "i_counts", "i_sums", "i_marks")
    assert values(spark, "i_sums") == [None] and spark.table("i_marks").count() == 0
    seen, opened = [None], []
    for n in (3, 1, 5, 2):
        for _ in range(n):
            ledger.append_count(spark, "i_counts", 2)
        mark = spark.table("i_marks").first()
        opened.append(files_read(ledger.files_since(spark.table("i_counts"), mark)))
        ledger.append_total(spark, "i_counts", "i_sums", "i_marks")
        seen.append((seen[-1] or 0) + 2 * n)
    assert opened == [3, 1, 5, 2]
    ledger.append_total(spark, "i_counts", "i_sums", "i_marks")
    assert values(spark, "i_sums") == [*seen, seen[-1]]
    # A mark lost with a failed run costs reading, not counts.
    ledger._overwrite(spark, "i_marks", [])
    ledger.append_count(spark, "i_counts", 1)
    ledger.append_total(spark, "i_counts", "i_sums", "i_marks")
    ledger.compact(spark, "i_counts", str(tmp_path / "compacted"), marks="i_marks")
    ledger.append_total(spark, "i_counts", "i_sums", "i_marks")
    ledger.append_count(spark, "i_counts", 1)
    ledger.append_total(spark, "i_counts", "i_sums", "i_marks")
    assert values(spark, "i_sums")[-3:] == [23, 23, 24]
    assert ledger_sum(spark, "i_counts") == 24
    for table in ("i_counts", "i_sums", "i_marks"):
        spark.sql(f"DROP TABLE {table}")


def ledger_sum(spark, table):
    return totals.ledger_total(spark.table(table)).first()["value"]


def test_files_of_the_mark_s_own_instant_count_once(spark, tmp_path):
    """Stores keep times to the second or worse: what lands in the same instant is told by name."""
    path = str(tmp_path / "counts")
    for i in range(3):
        spark.createDataFrame([(i,)], "value int").coalesce(1).write.mode("append").parquet(path)
    files = sorted((tmp_path / "counts").glob("*.parquet"))
    for f in files:
        os.utime(f, (1_700_000_000, 1_700_000_000))
    counts = spark.read.schema("value int").parquet(path)
    mark = Row(until=datetime(2023, 11, 14, 22, 13, 20), files=[f.name for f in files[:2]])
    left = ledger.files_since(counts, mark)
    own = spark.read.parquet(str(files[2])).first()["value"]
    assert [r["value"] for r in left.collect()] == [own]
    assert ledger.files_since(counts, None).count() == 3
