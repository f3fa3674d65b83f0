"""The per-user report: followers, mentions, replies and retweets received."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.measures import or_zero
from edgeloom.operators.ranking import ranked, top
from edgeloom.sources.edges import EdgeTableSet

# Measures of a user profile. "_rows" tells whether the user occurs in that
# network at all, which a zero or NULL measure does not.
PROFILE_MEASURES = (
    "social_rows", "followers", "mention_rows", "mention_edges",
    "mentions", "replies", "retweets",
)


def user_universe(tables: EdgeTableSet) -> DataFrame:
    """Every user that receives an edge in any network, once; senders alone do not count."""
    ids = [
        tables.social.select(F.col("followed").alias("user_id")),
        tables.mention.select(F.col("mentioned").alias("user_id")),
        tables.reply.select(F.col("replied").alias("user_id")),
        tables.retweet.select(F.col("tweeted").alias("user_id")),
    ]
    everyone = ids[0]
    for more in ids[1:]:
        everyone = everyone.union(more)
    return everyone.distinct()


def _contribution(edges: DataFrame, target: str, **measures: str) -> DataFrame:
    """One row per edge: the receiver and what the edge adds to each measure."""
    return edges.selectExpr(
        f"{target} AS user_id",
        *[f"CAST({measures.get(m, 'NULL')} AS BIGINT) AS {m}" for m in PROFILE_MEASURES],
    )


def user_profile(tables: EdgeTableSet) -> DataFrame:
    """All measures of all receiving users from one pass over each network.

    The users of the report are exactly the keys of its four aggregates, so the
    networks are stacked and grouped once: four scans and one shuffle of
    partially aggregated rows, instead of a distinct, four aggregates and four
    outer joins over eight scans. Measures a caller does not use are pruned down
    to the scans.
    """
    stacked = (
        _contribution(tables.social, "followed", social_rows="1",
                      followers="IF(follower IS NOT NULL, 1, NULL)")
        .union(_contribution(tables.mention, "mentioned", mention_rows="1",
                             mention_edges="IF(occur IS NOT NULL, 1, NULL)", mentions="occur"))
        .union(_contribution(tables.reply, "replied", replies="occur"))
        .union(_contribution(tables.retweet, "tweeted", retweets="occur"))
    )
    return stacked.groupBy("user_id").agg(*[F.sum(m).alias(m) for m in PROFILE_MEASURES])


def user_report(profile: DataFrame) -> DataFrame:
    """Report columns from profiles; edges to an unknown (NULL) user count for nobody."""
    def measure(name: str) -> Column:
        return or_zero(F.when(F.col("user_id").isNotNull(), F.col(name)))

    return profile.select(
        "user_id",
        measure("followers").alias("followers_count"),
        measure("mentions").alias("mentions_count"),
        measure("replies").alias("replies_count"),
        measure("retweets").alias("retweets_count"),
    )


def top_users(report: DataFrame, k: int = 100) -> DataFrame:
    """The k users with most followers, then most mentions."""
    return top(report, "followers_count", "mentions_count", by="user_id", k=k)


def followed_in(profile: DataFrame) -> DataFrame:
    """``top_followed`` from profiles."""
    counts = profile.where(F.col("social_rows").isNotNull()).select(
        F.col("user_id").alias("followed"), or_zero(F.col("followers")).alias("followers")
    )
    return ranked(counts, "followers", by="followed")


def mentioned_in(profile: DataFrame) -> DataFrame:
    """``top_mentioned`` from profiles."""
    counts = profile.where(F.col("mention_rows").isNotNull()).select(
        F.col("user_id").alias("mentioned"), or_zero(F.col("mention_edges")).alias("mentions")
    )
    return ranked(counts, "mentions", by="mentioned")


def leaders_in(profile: DataFrame, k: int = 5) -> DataFrame:
    """``leaders_with_mentions`` from profiles: the leaders' rows already hold their totals."""
    followed = profile.where(F.col("social_rows").isNotNull()).select(
        F.col("user_id").alias("followed"), or_zero(F.col("followers")).alias("followers"),
        "mention_rows", "mentions",
    )
    leaders = top(followed, "followers", by="followed", k=k)
    mentioned = leaders.where(
        F.col("mention_rows").isNotNull() & F.col("followed").isNotNull()
    ).select("followed", "followers", "mentions")
    return top(mentioned, "followers", by="followed", k=k)
