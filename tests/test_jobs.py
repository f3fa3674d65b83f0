"""The jobs from the command line, one after the other, on a small network."""

import gzip

import pytest

from edgeloom.operators.lineage import two_hop_impact
from edgeloom.plans import analysis_job, ingest_job, ledger_job
from edgeloom.sources.files import landed_files, missing_files

FILES = {
    "x-social_network.edgelist.gz": "1 2\n3 2\n1 4\n",
    "x-retweet_network.edgelist.gz": "1 2 5\n1 2 1\n",
    "x-reply_network.edgelist.gz": "1 4 2\n",
    "x-mention_network.edgelist.gz": "1 2 3\n5 2 4\n5 6 1\n",
    "x-activity_time.txt.gz": "1 2 1341100972 MT\n",
}


def land(folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        with gzip.open(folder / name, "wt") as out:
            out.write(FILES[name])


def test_ingest_then_analysis(spark, tmp_path, capsys):
    land(tmp_path / "raw", FILES)
    ingest_job.main([str(tmp_path / "raw"), str(tmp_path / "parquet"), "--prefix", "x-"])
    analysis_job.main([str(tmp_path / "parquet"), str(tmp_path / "results")])
    out = capsys.readouterr().out
    assert all(name in out for name in analysis_job.RESULT_ORDER)
    assert out.count(" in SQL") == 2

    def saved(name):
        return [tuple(r) for r in spark.read.parquet(str(tmp_path / "results" / name)).collect()]

    assert saved("top_followed") == [(2, 2), (4, 1)]
    assert saved("top_mentioned") == [(2, 2), (6, 1)]
    assert saved("top_followed_mentions") == [(2, 2, 7)]
    assert saved("top_100_users") == [(2, 2, 7, 0, 6), (4, 1, 0, 2, 0), (6, 0, 1, 0, 0)]


def test_ingest_names_missing_files(spark, tmp_path):
    names = list(FILES)
    folder = tmp_path / "partial"
    land(folder, names[:3])
    with pytest.raises(SystemExit, match="x-activity_time.txt.gz, x-mention_network.edgelist.gz"):
        ingest_job.main([str(folder), str(tmp_path / "parquet"), "--prefix", "x-"])
    found = {r["name"] for r in landed_files(spark, str(folder)).collect()}
    assert found == set(names[:3])
    lacking = lambda where, **kw: {r["name"] for r in missing_files(
        spark, names, str(where), **kw).collect()}
    assert lacking(folder) == set(names[3:])
    assert lacking(folder, force=True) == set(names)
    assert lacking(tmp_path / "nowhere") == set(names)


def test_ledger_jobs(spark):
    for job in ("sum", "count", "count", "sum"):
        ledger_job.main([job])
    assert sorted(r["value"] or 0 for r in spark.table("sums").collect()) == [0, 2]
    assert spark.table("counts").count() == 2
    assert spark.table("marks").first()["value"] == 2
    for name in ("counts", "sums", "marks"):
        spark.sql(f"DROP TABLE {name}")


def test_impact_of_a_source_file_on_the_results(spark):
    """From raw table over ingested table to the results computed from it."""
    ingested = [(f"raw/{t}", t) for t in ("social", "retweet", "reply", "mention", "activity")]
    analysed = [
        ("social", "top_followed"), ("mention", "top_mentioned"),
        ("social", "top_followed_mentions"), ("mention", "top_followed_mentions"),
        *[(t, "top_100_users") for t in ("social", "mention", "reply", "retweet")],
    ]
    edges = "source string, target string"
    impact = two_hop_impact(
        spark.createDataFrame(ingested, edges), spark.createDataFrame(analysed, edges)
    )
    reached = {}
    for row in impact.collect():
        reached.setdefault(row["source"], set()).add(row["target"])
    assert reached["raw/social"] == {"top_followed", "top_followed_mentions", "top_100_users"}
    assert reached["raw/reply"] == {"top_100_users"}
    assert "raw/activity" not in reached
