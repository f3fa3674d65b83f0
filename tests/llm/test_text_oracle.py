"""Queries that SQL can express, against it, over whole tables."""

import duckdb
import pytest

from edgeloom.llm import decontaminate
from edgeloom.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"
KINDS = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert dict(frame.dtypes) == {d[0]: KINDS[str(d[1])] for d in result.description}
    expected = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr) == expected
    assert expected


def test_short_items_match_sql(spark):
    """The benchmark table has none; the SQL is checked with some beside it."""
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    duck.execute(f"""CREATE VIEW benchmark AS SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet' UNION ALL
        SELECT 100000 + n, array_to_string(w[3:2 + n], ' ') FROM range(1, 5) AS t(n),
          (SELECT string_split(text, ' ') AS w FROM documents WHERE length(text) > 200 ORDER BY doc_id LIMIT 1)""")
    items = spark.createDataFrame(duck.execute("SELECT item_id, text FROM benchmark").fetchall(),
                                  "item_id long, text string")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = decontaminate.leak_report(docs, items).select(
        "doc_id", "item_id", "n_shingles", "n_found", "containment")
    expected = duck.execute(ORACLE["op10_decontamination"]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert sum(r[2] == 1 for r in expected) > 10


def test_all_thirteen_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14)) and set(ORACLE) < set(QUERIES)
