"""Rankings and the user report: NULLs, ties, missing sides; union form = join form = SQL."""

import random

import pytest

from edgeloom.operators import ranking, report
from edgeloom.plans import analysis_job, sql_queries
from edgeloom.sources import edges


def make_tables(spark, social=(), retweet=(), reply=(), mention=(), activity=()):
    schemas = edges.edge_schemas()
    data = {"social_network": social, "retweet_network": retweet, "reply_network": reply,
            "mention_network": mention, "activity_time": activity}
    return edges.EdgeTables(**{
        view: spark.createDataFrame(list(data[table]), schemas[table])
        for table, view in edges.VIEW_NAMES.items()
    })


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def unordered(frame):
    return sorted(rows(frame), key=repr)


def full_report(tables):
    return report.user_report(report.user_profile(tables))


def random_tables(spark, seed):
    rng = random.Random(seed)

    def user():
        return rng.choice([None, *range(1, 12)])

    def weighted(n):
        return [(user(), user(), rng.choice([None, 1, 2, 5])) for _ in range(n)]

    return make_tables(
        spark, social=[(user(), user()) for _ in range(60)],
        retweet=weighted(15), reply=weighted(10), mention=weighted(25),
    )


def test_counts_skip_null_followers_but_keep_the_user(spark):
    tables = make_tables(spark, social=[(None, 7), (1, 8), (None, 8), (2, None)])
    assert unordered(ranking.top_followed(tables.social)) == [(7, 0), (8, 1), (None, 1)]


def test_ties_go_to_the_lower_id(spark):
    tables = make_tables(spark, social=[(1, 9), (1, 3), (2, 3), (1, 5), (1, 4)])
    assert rows(ranking.top_followed(tables.social)) == [(3, 2), (4, 1), (5, 1), (9, 1)]
    assert rows(ranking.top(ranking.follower_counts(tables.social), "followers",
                            by="followed", k=2)) == [(3, 2), (4, 1)]


def test_leader_without_mentions_is_absent(spark):
    tables = make_tables(
        spark, social=[(1, 2), (3, 2), (1, 4)], mention=[(1, 4, 3), (2, 4, 4), (1, 9, 1)]
    )
    assert rows(ranking.leaders_with_mentions(tables.social, tables.mention)) == [(4, 1, 7)]


def test_only_the_k_most_followed_are_leaders(spark):
    social = [(i, user) for user in range(1, 8) for i in range(user)]
    mention = [(0, user, 10 * user) for user in range(1, 8)]
    tables = make_tables(spark, social=social, mention=mention)
    expected = [(u, u, 10 * u) for u in (7, 6, 5, 4, 3)]
    assert rows(ranking.leaders_with_mentions(tables.social, tables.mention)) == expected
    assert rows(ranking.leaders_with_mentions(tables.social, tables.mention, k=1)) == expected[:1]


def test_report_fills_missing_sides_with_zero(spark):
    tables = make_tables(
        spark, social=[(1, 2)], mention=[(1, 3, 4)], reply=[(9, 5, 6)], retweet=[(9, 6, 2)]
    )
    assert unordered(full_report(tables)) == [
        (2, 1, 0, 0, 0), (3, 0, 4, 0, 0), (5, 0, 0, 6, 0), (6, 0, 0, 0, 2)]


def test_senders_are_not_users(spark):
    tables = make_tables(spark, social=[(1, 2)], mention=[(8, 2, 1)])
    assert unordered(report.user_universe(tables)) == [(2,)]
    assert unordered(full_report(tables)) == [(2, 1, 1, 0, 0)]


def test_null_user_is_all_zero(spark):
    tables = make_tables(spark, mention=[(1, None, 4)], reply=[(1, None, 4)])
    assert rows(full_report(tables)) == [(None, 0, 0, 0, 0)]


def test_empty_tables(spark):
    tables = make_tables(spark)
    assert rows(full_report(tables)) == []
    assert rows(ranking.top_followed(tables.social)) == []
    assert rows(ranking.leaders_with_mentions(tables.social, tables.mention)) == []


@pytest.mark.parametrize("seed", range(4))
def test_all_forms_agree(spark, seed):
    tables = random_tables(spark, seed)
    tables.register_views()
    profile = report.user_profile(tables).cache()
    built = full_report(tables)
    assert unordered(built) == unordered(sql_queries.sql_user_report(spark))
    assert unordered(built.select("user_id")) == unordered(report.user_universe(tables))
    assert rows(report.top_users(built, 5)) == rows(sql_queries.sql_user_report_100(spark))[:5]
    assert rows(ranking.top_followed(tables.social)) == rows(sql_queries.sql_top_followed(spark))
    assert rows(ranking.top_followed(tables.social)) == rows(report.followed_in(profile))
    assert rows(ranking.top_mentioned(tables.mention)) == rows(report.mentioned_in(profile))
    leaders = rows(ranking.leaders_with_mentions(tables.social, tables.mention))
    assert leaders == rows(sql_queries.sql_top5_followed_mentions(spark))
    assert leaders == rows(report.leaders_in(profile))
    profile.unpersist()


def test_saved_results_are_sorted_and_previewed(spark, tmp_path):
    tables = random_tables(spark, 11)
    saved = analysis_job.save_results(spark, tables, str(tmp_path / "results"))
    assert sorted(p.name for p in (tmp_path / "results").iterdir()) == sorted(
        [*analysis_job.RESULT_ORDER, analysis_job.PROFILES])
    assert unordered(saved["top_followed"]) == unordered(ranking.top_followed(tables.social))
    shown = analysis_job.preview(saved, rows=3)
    for name, direct in {
        "top_followed": ranking.top_followed(tables.social),
        "top_mentioned": ranking.top_mentioned(tables.mention),
        "top_followed_mentions": ranking.leaders_with_mentions(tables.social, tables.mention),
        "top_100_users": report.top_users(full_report(tables)),
    }.items():
        assert rows(shown[name]) == rows(direct)[:3]
        assert saved[name].dtypes == direct.dtypes


def test_report_types_follow_the_inputs(spark):
    assert full_report(make_tables(spark)).dtypes == [
        ("user_id", "bigint"), ("followers_count", "bigint"), ("mentions_count", "bigint"),
        ("replies_count", "bigint"), ("retweets_count", "bigint")]


JOIN_FORM = """
SELECT everyone.user_id, COALESCE(f.n, 0), COALESCE(m.n, 0), COALESCE(r.n, 0), COALESCE(t.n, 0)
FROM (SELECT followed AS user_id FROM social UNION SELECT mentioned FROM mention
      UNION SELECT replied FROM reply UNION SELECT tweeted FROM retweet) AS everyone
LEFT JOIN (SELECT followed AS id, COUNT(follower) AS n FROM social GROUP BY followed) AS f
  ON f.id = everyone.user_id
LEFT JOIN (SELECT mentioned AS id, SUM(occur) AS n FROM mention GROUP BY mentioned) AS m
  ON m.id = everyone.user_id
LEFT JOIN (SELECT replied AS id, SUM(occur) AS n FROM reply GROUP BY replied) AS r
  ON r.id = everyone.user_id
LEFT JOIN (SELECT tweeted AS id, SUM(occur) AS n FROM retweet GROUP BY tweeted) AS t
  ON t.id = everyone.user_id
"""


@pytest.mark.parametrize("seed", [1, 2])
def test_stacked_reports_equal_the_chain_of_outer_joins(spark, seed):
    tables = random_tables(spark, seed)
    tables.register_views()
    expected = unordered(spark.sql(JOIN_FORM))
    assert unordered(full_report(tables)) == expected
    assert unordered(sql_queries.sql_user_report(spark)) == expected
