"""SQL for DuckDB with the results of the registered queries, over the same tables."""

from __future__ import annotations

EDGE_TABLES = """
WITH social AS (
  SELECT l_orderkey AS follower, l_partkey AS followed FROM lineitem
),
retweet AS (
  SELECT l_partkey AS tweeter, l_orderkey AS tweeted, CAST(l_quantity AS INT) AS occur
  FROM lineitem WHERE l_returnflag = 'R'
),
reply AS (
  SELECT l_partkey AS replier, l_suppkey AS replied, CAST(l_quantity AS INT) AS occur
  FROM lineitem WHERE l_returnflag = 'A'
),
mention AS (
  SELECT l_suppkey AS mentioner, l_partkey AS mentioned, CAST(l_quantity AS INT) AS occur
  FROM lineitem WHERE l_returnflag = 'N'
),
activity AS (
  SELECT user_id AS userA, event_id AS userB,
         CAST(epoch_us(ts) // 1000000 AS INT) AS timestamp, event_type AS interaction
  FROM events
)
"""

# Written independently of the Spark forms where SQL allows: places by window
# function, report figures by correlated subquery.
_FOLLOWED = "SELECT followed, COUNT(follower) AS followers FROM social GROUP BY followed"
_MENTIONED = "SELECT mentioned, COUNT(occur) AS mentions FROM mention GROUP BY mentioned"

_TOP_FOLLOWED = f"SELECT * FROM ({_FOLLOWED}) ORDER BY followers DESC, followed\n"
_TOP_MENTIONED = f"SELECT * FROM ({_MENTIONED}) ORDER BY mentions DESC, mentioned\n"

_LEADERS = f"""
SELECT followed, followers,
       (SELECT CAST(SUM(occur) AS BIGINT) FROM mention WHERE mentioned = followed) AS mentions
FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY followers DESC, followed) AS place FROM ({_FOLLOWED})
)
WHERE place <= 5 AND followed IN (SELECT mentioned FROM mention)
"""

_UNIVERSE = """
SELECT DISTINCT user_id FROM (
  SELECT followed AS user_id FROM social UNION ALL SELECT mentioned FROM mention
  UNION ALL SELECT replied FROM reply UNION ALL SELECT tweeted FROM retweet
)
"""

_REPORT = f"""
SELECT user_id,
       (SELECT COUNT(follower) FROM social WHERE followed = user_id) AS followers_count,
       (SELECT CAST(COALESCE(SUM(occur), 0) AS BIGINT) FROM mention
        WHERE mentioned = user_id) AS mentions_count,
       (SELECT CAST(COALESCE(SUM(occur), 0) AS BIGINT) FROM reply
        WHERE replied = user_id) AS replies_count,
       (SELECT CAST(COALESCE(SUM(occur), 0) AS BIGINT) FROM retweet
        WHERE tweeted = user_id) AS retweets_count
FROM ({_UNIVERSE})
"""

_REPORT_100 = f"""
SELECT * FROM ({_REPORT}) ORDER BY followers_count DESC, mentions_count DESC, user_id LIMIT 100
"""

_INGEST = """
SELECT 'social_network' AS dataset, follower AS source_id, followed AS target_id,
       CAST(NULL AS BIGINT) AS occur, CAST(NULL AS BIGINT) AS timestamp,
       CAST(NULL AS VARCHAR) AS interaction
FROM social
UNION ALL SELECT 'retweet_network', tweeter, tweeted, occur, NULL, NULL FROM retweet
UNION ALL SELECT 'reply_network', replier, replied, occur, NULL, NULL FROM reply
UNION ALL SELECT 'mention_network', mentioner, mentioned, occur, NULL, NULL FROM mention
UNION ALL SELECT 'activity_time', userA, userB, NULL, timestamp, interaction FROM activity
"""

_RESULTS = f"""
SELECT 'top_followed' AS dataset, followed AS user_id, followers,
       CAST(NULL AS BIGINT) AS mentions, CAST(NULL AS BIGINT) AS followers_count,
       CAST(NULL AS BIGINT) AS mentions_count, CAST(NULL AS BIGINT) AS replies_count,
       CAST(NULL AS BIGINT) AS retweets_count
FROM ({_TOP_FOLLOWED})
UNION ALL SELECT 'top_mentioned', mentioned, NULL, mentions, NULL, NULL, NULL, NULL
FROM ({_TOP_MENTIONED})
UNION ALL SELECT 'top_followed_mentions', followed, followers, mentions, NULL, NULL, NULL, NULL
FROM ({_LEADERS})
UNION ALL SELECT 'top_100_users', user_id, NULL, NULL, followers_count, mentions_count,
                 replies_count, retweets_count
FROM ({_REPORT_100})
"""

_EVENT_TOTAL = "SELECT COUNT(*) AS value FROM events"

_RUNNING = """
WITH per_tick AS (
  SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS tick, COUNT(*) AS n FROM events GROUP BY 1
),
calendar AS (
  SELECT unnest(generate_series(MIN(tick), MAX(tick), INTERVAL 1 HOUR)) AS tick FROM per_tick
)
SELECT c.tick, CAST(SUM(COALESCE(p.n, 0)) OVER (ORDER BY c.tick) AS BIGINT) AS total
FROM calendar c LEFT JOIN per_tick p ON c.tick = p.tick
"""

_LATENCY = """
SELECT run_id, started_at, arrived_at,
       date_diff('microsecond', started_at, arrived_at) AS latency_us,
       CAST(date_diff('microsecond', started_at, arrived_at) AS DOUBLE) / 1000.0E0 AS latency_ms
FROM (
  SELECT o_orderkey AS run_id, o_orderdate AS started_at, MIN(l_shipdate) AS arrived_at
  FROM orders LEFT JOIN lineitem
    ON o_orderkey = l_orderkey AND l_shipdate >= o_orderdate
   AND l_shipdate < o_orderdate + INTERVAL 30 DAY
  GROUP BY o_orderkey, o_orderdate
)
"""

_LATENCY_FIGURES = """
COALESCE(CAST(SUM(latency_us) AS DOUBLE) / NULLIF(COUNT(latency_us), 0) / 1000.0E0, 0.0E0)
  AS avg_ms,
COALESCE(MAX(latency_ms), 0.0E0) AS max_ms,
COALESCE(MIN(latency_ms), 0.0E0) AS min_ms,
COUNT(*) - COUNT(latency_us) AS timeout_count,
COALESCE(COUNT(latency_us) * 1.0E0 / NULLIF(COUNT(*), 0) * 100.0E0, 0.0E0) AS success_rate
"""

_SIZE_FIGURES = """
COALESCE(CAST(SUM(size) AS DOUBLE) / NULLIF(COUNT(size), 0), 0.0E0) AS avg_bytes,
COALESCE(MAX(size), 0) AS max_bytes,
COALESCE(MIN(size), 0) AS min_bytes
"""

_SIZES = "SELECT CAST(octet_length(encode(props)) AS INT) AS size FROM events"

_DURATION = """
SELECT user_id, started_at, ended_at,
       date_diff('microsecond', started_at, ended_at) AS duration_us,
       CAST(date_diff('microsecond', started_at, ended_at) AS DOUBLE) / 1000000.0E0 AS duration_s,
       CASE WHEN ended_at IS NULL THEN 'RUNNING'
            WHEN failed_at = ended_at THEN 'FAILED' ELSE 'COMPLETED' END AS outcome
FROM (
  SELECT user_id,
         MIN(ts) FILTER (WHERE event_type = 'signup') AS started_at,
         MAX(ts) FILTER (WHERE event_type = 'error') AS failed_at,
         MAX(ts) FILTER (WHERE event_type IN ('purchase', 'error')) AS ended_at
  FROM events WHERE event_type IN ('signup', 'purchase', 'error')
  GROUP BY user_id
)
"""

ORACLE: dict[str, str] = {
    "top_followed": EDGE_TABLES + _TOP_FOLLOWED,
    "top_followed_10": EDGE_TABLES + _TOP_FOLLOWED + "LIMIT 10",
    "top_mentioned": EDGE_TABLES + _TOP_MENTIONED,
    "top_mentioned_10": EDGE_TABLES + _TOP_MENTIONED + "LIMIT 10",
    "top5_followed_mentions": EDGE_TABLES + _LEADERS,
    "mentions_received": EDGE_TABLES
    + "SELECT mentioned, CAST(SUM(occur) AS BIGINT) AS mentions FROM mention GROUP BY mentioned",
    "replies_received": EDGE_TABLES
    + "SELECT replied, CAST(SUM(occur) AS BIGINT) AS replies FROM reply GROUP BY replied",
    "retweets_received": EDGE_TABLES
    + "SELECT tweeted, CAST(SUM(occur) AS BIGINT) AS retweets FROM retweet GROUP BY tweeted",
    "user_universe": EDGE_TABLES + _UNIVERSE,
    "user_report_full": EDGE_TABLES + _REPORT,
    "user_report_100": EDGE_TABLES + _REPORT_100,
    "sql_top_followed": EDGE_TABLES + _TOP_FOLLOWED,
    "sql_top5_followed_mentions": EDGE_TABLES + _LEADERS,
    "sql_user_report_100": EDGE_TABLES + _REPORT_100,
    "edge_ingest": EDGE_TABLES + _INGEST,
    "result_roundtrip": EDGE_TABLES + _RESULTS,
    "ledger_total": _EVENT_TOTAL,
    "ledger_counted": "SELECT CAST(COUNT(*) + 2 AS BIGINT) AS value FROM events",
    "ledger_running": _RUNNING,
    "ledger_increments": """
SELECT CAST(part + 1 AS INTEGER) AS parts, CAST(SUM(n) OVER (ORDER BY part) AS BIGINT) AS value
FROM (SELECT event_id % 4 AS part, COUNT(*) AS n FROM events GROUP BY part)""",
    "stream_total": _EVENT_TOTAL,
    "stream_snapshots": """
SELECT batch, CAST(SUM(n) OVER (ORDER BY batch) AS BIGINT) AS total
FROM (SELECT date_diff('microsecond', first, ts) // 604800000000 AS batch, COUNT(*) AS n
      FROM events, (SELECT MIN(ts) AS first FROM events) GROUP BY batch)""",
    "missing_items": EDGE_TABLES + """
SELECT DISTINCT o_orderkey AS item FROM orders
WHERE NOT EXISTS (SELECT 1 FROM retweet WHERE tweeted = o_orderkey)""",
    "missing_items_filtered": EDGE_TABLES + """
SELECT DISTINCT o_orderkey AS item FROM orders ANTI JOIN retweet ON tweeted = o_orderkey""",
    "missing_items_forced": "SELECT DISTINCT o_orderkey AS item FROM orders",
    "lineage_latency": _LATENCY,
    "lineage_latency_report":
        f"SELECT {_LATENCY_FIGURES}, COUNT(latency_us) AS count FROM ({_LATENCY})",
    "lineage_size_report": f"SELECT {_SIZE_FIGURES}, COUNT(size) AS count FROM ({_SIZES})",
    "lineage_performance_report": f"""
SELECT * FROM
  (SELECT {_LATENCY_FIGURES}, COUNT(latency_us) AS latency_count FROM ({_LATENCY})),
  (SELECT {_SIZE_FIGURES}, COUNT(size) AS size_count FROM ({_SIZES}))""",
    "run_duration": _DURATION,
    "impact_two_hop": """
SELECT DISTINCT o_custkey AS source, l_partkey AS target
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "impact_reach": """
SELECT s_suppkey AS source, COUNT(DISTINCT c_custkey) AS reached
FROM supplier JOIN customer ON s_nationkey = c_nationkey GROUP BY s_suppkey""",
    "stream_latency_complete": _LATENCY,
    # Final runs only: those the watermark (slower stream, one day back) has
    # passed by the whole wait. The rest is still open when the input ends.
    "stream_latency": f"""
SELECT * FROM ({_LATENCY})
WHERE started_at <= LEAST((SELECT MAX(o_orderdate) FROM orders),
                          (SELECT MAX(l_shipdate) FROM lineitem))
                    - INTERVAL 1 DAY - INTERVAL 30 DAY""",
}
