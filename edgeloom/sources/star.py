"""Edge tables derived from the star-schema test tables.

Every mapping is a projection of a whole table, at most with the edge kind as
filter, so it adds no shuffle: scans prune to two or three columns and the kind
reaches Parquet as a pushed filter. The three interaction networks split
``lineitem`` by its return flag. Ids stay 64-bit. Receivers come from three
different id ranges (parts, suppliers, orders), which leaves users without
followers, mentions, replies or retweets for the outer joins to meet.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from edgeloom.sources.edges import EdgeTableSet

# Columns used here, with their types in the files. Stating them spares a job
# that reads a footer to infer the schema.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
                "l_returnflag string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


class StarEdgeTables(EdgeTableSet):
    """The edge tables of one data folder, each read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    @cached_property
    def _lineitem(self) -> DataFrame:
        return table(self._spark, self._sf_dir, "lineitem")

    @cached_property
    def social(self) -> DataFrame:
        return self._lineitem.selectExpr("l_orderkey AS follower", "l_partkey AS followed")

    @cached_property
    def retweet(self) -> DataFrame:
        return self._interactions("R", "l_partkey AS tweeter", "l_orderkey AS tweeted")

    @cached_property
    def reply(self) -> DataFrame:
        return self._interactions("A", "l_partkey AS replier", "l_suppkey AS replied")

    @cached_property
    def mention(self) -> DataFrame:
        return self._interactions("N", "l_suppkey AS mentioner", "l_partkey AS mentioned")

    @cached_property
    def activity(self) -> DataFrame:
        return table(self._spark, self._sf_dir, "events").selectExpr(
            "user_id AS userA", "event_id AS userB",
            "CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS INT) AS timestamp",
            "event_type AS interaction",
        )

    def _interactions(self, flag: str, source: str, target: str) -> DataFrame:
        return self._lineitem.where(f"l_returnflag = '{flag}'").selectExpr(
            source, target, "CAST(l_quantity AS INT) AS occur"
        )


def runs(orders: DataFrame) -> DataFrame:
    """Orders as job runs: key and start."""
    return orders.selectExpr("o_orderkey AS run_id", "o_orderdate AS started_at")


def arrivals(lineitem: DataFrame) -> DataFrame:
    """Shipments as lineage events of the run with the same key."""
    return lineitem.selectExpr("l_orderkey AS run_id", "l_shipdate AS arrived_at")
