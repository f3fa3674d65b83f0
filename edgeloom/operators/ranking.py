"""Rankings of users by the edges they receive.

Groupings aggregate before the shuffle, so a user receiving a large share of
all edges costs one row per map task. Every ordering ends with the user id:
ties at a cut are settled the same way on every run, and the range shuffle
behind a full sort can split the many users that share one small count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def received(edges: DataFrame, target: str, measure: Column) -> DataFrame:
    """One row per ``target`` with the given aggregate over its incoming edges."""
    return edges.groupBy(target).agg(measure)


def ranked(df: DataFrame, *measures: str, by: str) -> DataFrame:
    """Descending by the measures, user id ascending among equals."""
    return df.orderBy(*[F.desc(m) for m in measures], F.asc(by))


def top(df: DataFrame, *measures: str, by: str, k: int) -> DataFrame:
    return ranked(df, *measures, by=by).limit(k)


def follower_counts(
    social: DataFrame, source: str = "follower", target: str = "followed"
) -> DataFrame:
    """Number of known followers per followed user."""
    return received(social, target, F.count(source).alias("followers"))


def mention_counts(
    mention: DataFrame, target: str = "mentioned", weight: str = "occur"
) -> DataFrame:
    """Number of mention edges with a weight per mentioned user; not the sum of weights."""
    return received(mention, target, F.count(weight).alias("mentions"))


def mentions_received(mention: DataFrame) -> DataFrame:
    return received(mention, "mentioned", F.sum("occur").alias("mentions"))


def replies_received(reply: DataFrame) -> DataFrame:
    return received(reply, "replied", F.sum("occur").alias("replies"))


def retweets_received(retweet: DataFrame) -> DataFrame:
    return received(retweet, "tweeted", F.sum("occur").alias("retweets"))


def top_followed(social: DataFrame) -> DataFrame:
    """All followed users, most followers first."""
    return ranked(follower_counts(social), "followers", by="followed")


def top_mentioned(mention: DataFrame) -> DataFrame:
    """All mentioned users, most mention edges first."""
    return ranked(mention_counts(mention), "mentions", by="mentioned")


def leaders_with_mentions(
    social: DataFrame, mention: DataFrame, k: int = 5, broadcast_rows: int = 100_000
) -> DataFrame:
    """The k most followed users with the sum of their mention weights.

    A leader nobody mentioned is absent (inner join). No raw mention edge is ever
    shuffled, however many belong to one user. Up to ``broadcast_rows`` leaders (a
    few MB) are broadcast: edges are filtered where they are read and summed in
    each task. More leaders than that meet one row per mentioned user, summed in
    each task as well. Both ways give the same rows. Ordering the at most k results
    as a top-k spares them a range shuffle.
    """
    leaders = top(follower_counts(social), "followers", by="followed", k=k)
    if k <= broadcast_rows:
        totals = (
            mention.join(F.broadcast(leaders), mention["mentioned"] == leaders["followed"])
            .groupBy("followed", "followers")
            .agg(F.sum("occur").alias("mentions"))
        )
    else:
        summed = mentions_received(mention)
        totals = leaders.join(summed, leaders["followed"] == summed["mentioned"]).select(
            "followed", "followers", "mentions"
        )
    return top(totals, "followers", by="followed", k=k)
