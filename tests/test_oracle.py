"""Every registered query against its SQL in DuckDB, over the whole test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from edgeloom.plans.oracle import ORACLE
from edgeloom.plans.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normalized(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
         "TIMESTAMP": "timestamp_ntz"}


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: KINDS[str(d[1])] for d in result.description}
    assert dict(frame.dtypes) == kinds
    expected = normalized(result.fetchall(), columns)
    actual = normalized([tuple(r) for r in frame.collect()], frame.columns)
    assert actual == expected


def test_entry_has_rows(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["user_id", "followers_count", "mentions_count", "replies_count",
                             "retweets_count"]
    assert frame.count() == 100
