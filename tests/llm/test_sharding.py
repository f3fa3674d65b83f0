import zlib

import pytest
from helpers import awkward, clashing, frame
from pyspark.sql import functions as F

from edgeloom.llm import sharding
from edgeloom.llm.queries import QUERIES


def brute(rows, n):
    slim = sorted(
        ((d is not None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1)
         for d, t, *_ in rows))
    total, at, out, slots = sum(s for *_, s in slim), 0, [], {}
    for known, d, crc, size in slim:
        shard = min(n - 1, (2 * at + size) * n // (2 * total))
        out.append((d if known else None, size, crc, "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        at += size
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 3, 8])
def test_awkward_rows(spark, n):
    assert rows_of(sharding.shard_report(clashing(frame(spark, awkward())), n)) == brute(awkward(), n)


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    result = QUERIES["op3_sharding"](spark, sf_dir)
    assert rows_of(result) == brute([(r["doc_id"], r["text"]) for r in docs], 8)
    sizes = result.groupBy("shard").agg(F.sum("size").alias("b")).collect()
    largest = max(r["b"] for r in result.groupBy("doc_id").agg(F.max("size").alias("b")).collect())
    assert max(r["b"] for r in sizes) - min(r["b"] for r in sizes) <= 2 * largest


def test_one_row_larger_than_all_shares(spark):
    rows = [(1, "a"), (2, "b" * 10_000), (3, "c")]
    assert rows_of(sharding.shard_report(frame(spark, rows))) == brute(rows, 8)


def test_empty_table_and_whole_documents(spark):
    assert sharding.shard_report(frame(spark, [])).collect() == []
    docs = clashing(frame(spark, awkward()))
    whole = sharding.shard_documents(docs)
    assert set(whole.columns) == set(docs.columns)
    assert whole.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).isEmpty()
    assert whole.count() == docs.count()
    assert dict(whole.dtypes)["shard"] == "int"


def test_a_repeated_key_is_spread(spark):
    rows = [(7, "same")] * 3000 + [(i, "x") for i in range(1000)]
    shards = sharding.shard_report(frame(spark, rows)).groupBy("shard").count().collect()
    assert len(shards) == 8
