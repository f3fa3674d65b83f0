import gzip

import pytest
from pyspark.sql import types as T

from edgeloom.operators import ranking
from edgeloom.plans import ingest_job
from edgeloom.sources import edges

LINES = "1 2 3\n1 3 x\n2 2 1 9\n4\n5 2\n\n6 3 99999999999\n7 3 2\n# c 1\n"
ROWS = [
    (1, 2, 3), (1, 3, None), (2, 2, 1), (4, None, None), (5, 2, None), (6, 3, 99999999999), (7, 3, 2),
    (None, None, 1),
]


def gz(path, text):
    with gzip.open(path, "wt") as out:
        out.write(text)
    return str(path)


@pytest.fixture
def mention_file(tmp_path):
    return gz(tmp_path / "mention_network.edgelist.gz", LINES)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_permissive_text(spark, mention_file):
    frame = edges.read_edges(spark, mention_file, edges.edge_schemas()["mention_network"])
    assert rows(frame) == sorted(ROWS, key=repr)
    assert {kind for _, kind in frame.dtypes} == {"bigint"}


def test_count_is_of_edges_and_sum_of_weights(spark, mention_file):
    frame = edges.read_edges(spark, mention_file, edges.edge_schemas()["mention_network"])
    assert {r["mentioned"]: r["mentions"] for r in ranking.mention_counts(frame).collect()} == {
        2: 2, 3: 2, None: 1}
    assert {r["mentioned"]: r["mentions"] for r in ranking.mentions_received(frame).collect()} == {
        2: 4, 3: 100000000001, None: 1}


def test_failfast_raises(spark, mention_file):
    frame = edges.read_edges(
        spark, mention_file, edges.edge_schemas()["mention_network"], mode="FAILFAST"
    )
    with pytest.raises(Exception, match="(?i)malformed"):
        frame.collect()


def test_corrupt_column_keeps_the_line(spark, mention_file):
    frame = edges.read_edges(
        spark, mention_file, edges.edge_schemas()["mention_network"], corrupt_column="raw"
    )
    bad = {r["raw"] for r in frame.collect()} - {None}
    assert {"1 3 x", "2 2 1 9", "4", "# c 1"} <= bad
    assert not {"1 2 3", "6 3 99999999999"} & bad


def test_numbers_beyond_32_bits(spark, tmp_path):
    path = gz(tmp_path / "wide.gz", "99999999999 1 3000000000\n")
    wide = edges.read_edges(spark, path, edges.edge_schemas()["mention_network"])
    narrow = edges.read_edges(spark, path, edges.edge_schemas(T.IntegerType())["mention_network"])
    assert rows(wide) == [(99999999999, 1, 3000000000)]
    assert rows(narrow) == [(None, 1, None)]
    path = gz(tmp_path / "time.gz", "1 2 2208988800 MT\n")
    activity = edges.read_edges(spark, path, edges.edge_schemas()["activity_time"])
    assert rows(activity) == [(1, 2, 2208988800, "MT")]


def test_malformed_lines_are_counted_and_kept(spark, tmp_path):
    sources = {
        "mention_network": gz(tmp_path / "mention.gz", LINES),
        "social_network": gz(tmp_path / "social.gz", "1 2\n2 3\n"),
    }
    written = edges.ingest(
        spark, sources, str(tmp_path / "parquet"), corrupt_dir=str(tmp_path / "bad")
    )
    assert (written["mention_network"].rows, written["mention_network"].malformed) == (8, 5)
    assert (written["social_network"].rows, written["social_network"].malformed) == (2, 0)
    kept = {r["value"] for r in spark.read.text(str(tmp_path / "bad/mention_network")).collect()}
    assert kept == {"1 3 x", "2 2 1 9", "4", "5 2", "# c 1"}
    assert not (tmp_path / "bad/social_network").exists()
    with pytest.raises(Exception, match="(?i)malformed"):
        edges.ingest(spark, sources, str(tmp_path / "strict"), mode="FAILFAST")


@pytest.mark.parametrize("write_partitions", [None, 3])
def test_ingest_five_tables(spark, tmp_path, write_partitions):
    contents = {
        "social_network": ("1 2\n2 3\n3 1\n4 1\n", [(1, 2), (2, 3), (3, 1), (4, 1)]),
        "retweet_network": ("1 2 5\n", [(1, 2, 5)]),
        "reply_network": ("", []),
        "mention_network": (LINES, ROWS),
        "activity_time": ("1 2 1341100972 MT\n", [(1, 2, 1341100972, "MT")]),
    }
    sources = ingest_job.source_paths(str(tmp_path), prefix="p-")
    for table, (text, _) in contents.items():
        gz(sources[table], text)
    target = str(tmp_path / "parquet")
    for _ in range(2):  # a second run overwrites
        written = edges.ingest(spark, sources, target, write_partitions=write_partitions)
    assert {t: done.path for t, done in written.items()} == {
        t: f"{target}/{t}" for t in edges.TABLES}
    for table, frame in edges.read_tables(spark, target).items():
        assert rows(frame) == sorted(contents[table][1], key=repr)
        assert frame.schema.fieldNames() == edges.edge_schemas()[table].fieldNames()


def test_plain_text_and_other_separators(spark, tmp_path):
    path = tmp_path / "plain.tsv"
    path.write_text("1\t2\n")
    frame = edges.read_edges(spark, str(path), edges.edge_schemas()["social_network"], sep="\t")
    assert rows(frame) == [(1, 2)]
