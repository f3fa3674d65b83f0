"""The analyses as SQL text over the views ``social``, ``mention``, ``reply``, ``retweet``.

Same results as the DataFrame forms. Register the views with
``EdgeTables.register_views``. As there, the report stacks what the networks
contribute and groups once: four scans and one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOP_FOLLOWED = """
SELECT followed, COUNT(follower) AS followers
FROM social
GROUP BY followed
ORDER BY followers DESC, followed
"""

TOP5_FOLLOWED_MENTIONS = f"""
WITH leaders AS ({TOP_FOLLOWED} LIMIT 5)
SELECT /*+ BROADCAST(leaders) */ followed, followers, SUM(occur) AS mentions
FROM mention JOIN leaders ON mentioned = followed
GROUP BY followed, followers
ORDER BY followers DESC, followed
LIMIT 5
"""

USER_REPORT = """
WITH contributions AS (
  SELECT followed AS user_id, 'followers' AS measure,
         CASE WHEN follower IS NOT NULL THEN 1L END AS amount FROM social
  UNION ALL SELECT mentioned, 'mentions', CAST(occur AS BIGINT) FROM mention
  UNION ALL SELECT replied, 'replies', CAST(occur AS BIGINT) FROM reply
  UNION ALL SELECT tweeted, 'retweets', CAST(occur AS BIGINT) FROM retweet
)
SELECT user_id,
       COALESCE(SUM(amount) FILTER (WHERE known AND measure = 'followers'), 0) AS followers_count,
       COALESCE(SUM(amount) FILTER (WHERE known AND measure = 'mentions'), 0) AS mentions_count,
       COALESCE(SUM(amount) FILTER (WHERE known AND measure = 'replies'), 0) AS replies_count,
       COALESCE(SUM(amount) FILTER (WHERE known AND measure = 'retweets'), 0) AS retweets_count
FROM (SELECT *, user_id IS NOT NULL AS known FROM contributions)
GROUP BY user_id
"""

USER_REPORT_100 = USER_REPORT + """
ORDER BY followers_count DESC, mentions_count DESC, user_id
LIMIT 100
"""


def sql_top_followed(spark: SparkSession) -> DataFrame:
    return spark.sql(TOP_FOLLOWED)


def sql_top5_followed_mentions(spark: SparkSession) -> DataFrame:
    return spark.sql(TOP5_FOLLOWED_MENTIONS)


def sql_user_report(spark: SparkSession) -> DataFrame:
    return spark.sql(USER_REPORT)


def sql_user_report_100(spark: SparkSession) -> DataFrame:
    return spark.sql(USER_REPORT_100)
