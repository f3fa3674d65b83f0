"""Every query by name, over the star-schema tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.operators import ledger, lineage, ranking, reconcile, report
from edgeloom.plans import analysis_job, sql_queries
from edgeloom.session import scratch_path
from edgeloom.sources import edges, star
from edgeloom.sources import ledger as ledger_tables
from edgeloom.streaming.ledger import append_snapshots, stream_total
from edgeloom.streaming.lineage import stream_latency_timed
from edgeloom.streaming.sources import (
    Drained,
    drain,
    drain_complete,
    land_in_order,
    parquet_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

HOUR_SECONDS = 3600
# Rows of both streams that a micro-batch of the registered latency stream takes at least.
BATCH_ROWS = 1_000_000
STREAM_BUCKETS = 24
LEDGER_PARTS = 4
SNAPSHOT_SECONDS = 7 * 24 * 3600.0
# Low, so that the small tables' nations lie on both sides of it.
REACH_HUB_PAIRS = 200
# Bits of the filter that landed items pass before they are compared.
LANDED_FILTER_BITS = 20
THIRTY_DAYS_SECONDS = 30 * 24 * 3600.0


def _on_edges(build: Callable[[edges.EdgeTableSet], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(star.StarEdgeTables(spark, sf_dir))


def _on_views(build: Callable[[SparkSession], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        star.StarEdgeTables(spark, sf_dir).register_views()
        return build(spark)
    return query


def _report(tables: edges.EdgeTableSet) -> DataFrame:
    return report.user_report(report.user_profile(tables))


def _edge_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables to gzip text, from there to Parquet, and all rows of all five read back."""
    base = scratch_path(spark, "edge-ingest")
    frames = dict(star.StarEdgeTables(spark, sf_dir).items())
    sources = {name: f"{base}/text/{name}" for name in frames}
    edges.together(
        spark,
        lambda name: frames[name].write.csv(
            sources[name], sep=edges.SEPARATOR, compression="gzip"
        ),
        list(frames),
    )
    edges.ingest(spark, sources, f"{base}/parquet")
    networks = [
        frame.select(
            F.lit(name).alias("dataset"),
            F.col(frame.columns[0]).alias("source_id"), F.col(frame.columns[1]).alias("target_id"),
            *[(F.col(c) if c in frame.columns else F.lit(None).cast(kind)).alias(c)
              for c, kind in (("occur", "bigint"), ("timestamp", "bigint"), ("interaction", "string"))],
        )
        for name, frame in edges.read_tables(spark, f"{base}/parquet").items()
    ]
    return reduce(DataFrame.union, networks)


def _result_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole analysis job; the rows of its four written datasets, read back."""
    saved = analysis_job.save_results(
        spark, star.StarEdgeTables(spark, sf_dir), scratch_path(spark, "results")
    )
    measures = ("followers", "mentions", "followers_count", "mentions_count",
                "replies_count", "retweets_count")
    rows = [
        frame.select(
            F.lit(name).alias("dataset"),
            F.col(analysis_job.RESULT_ORDER[name][1]).alias("user_id"),
            *[(F.col(m) if m in frame.columns else F.lit(None).cast("bigint")).alias(m)
              for m in measures],
        )
        for name, frame in saved.items()
    ]
    return reduce(DataFrame.union, rows)


def _counts(events: DataFrame) -> DataFrame:
    return events.select("ts", F.lit(1).alias("value"))


def _ledger_total(spark: SparkSession, sf_dir: str, literals: int = 0) -> DataFrame:
    """One count per event appended to a ledger, then the snapshot its ``sums`` table holds.

    ``literals`` more counts are inserted one by one, and the table is compacted.
    """
    base = scratch_path(spark, "ledger")
    suffix = base[-32:]
    counts, sums = f"counts_{suffix}", f"sums_{suffix}"
    try:
        ledger_tables.create_counts(spark, counts, f"{base}/counts")
        ledger_tables.create_sums(spark, sums, f"{base}/sums")
        ledger_tables.append_counts(_counts(star.table(spark, sf_dir, "events")), counts)
        for _ in range(literals):
            ledger_tables.append_count(spark, counts)
        if literals:
            ledger_tables.compact(spark, counts, f"{base}/compacted")
        ledger_tables.append_total(spark, counts, sums)
        schema = spark.table(sums).schema
    finally:
        # The tables are external: dropping the names leaves the files to read.
        spark.sql(f"DROP TABLE IF EXISTS {counts}")
        spark.sql(f"DROP TABLE IF EXISTS {sums}")
    return spark.read.schema(schema).parquet(f"{base}/sums")


def _ledger_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' counts appended in four parts, the total after each: ``parts, value``.

    Every total but the first is carried on from the one before.
    """
    base = scratch_path(spark, "ledger")
    suffix = base[-32:]
    counts, sums, marks = (f"{name}_{suffix}" for name in ("counts", "sums", "marks"))
    events = star.table(spark, sf_dir, "events")
    part = F.pmod(F.col("event_id"), F.lit(LEDGER_PARTS))
    snapshots = []
    try:
        ledger_tables.create_counts(spark, counts, f"{base}/counts")
        ledger_tables.create_marks(spark, marks, f"{base}/marks")
        for i in range(LEDGER_PARTS):
            sums_i, place = f"{sums}_{i}", f"{base}/sums/parts={i + 1}"
            ledger_tables.create_sums(spark, sums_i, place)
            snapshots.append(sums_i)
            ledger_tables.append_counts(_counts(events.where(part == i)), counts)
            ledger_tables.append_total(spark, counts, sums_i, marks)
    finally:
        for name in (counts, marks, *snapshots):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema("parts int, value bigint").parquet(f"{base}/sums").select("parts", "value")


def _ledger_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts(star.table(spark, sf_dir, "events"))
    return ledger.running_totals(counts, "ts", "value", HOUR_SECONDS, chunk_ticks=24)


def _missing_items(
    spark: SparkSession, sf_dir: str, force: bool = False, filter_bits: int | None = None
) -> DataFrame:
    """Orders of which no line was returned (landed = orders with a retweet edge)."""
    expected = star.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"))
    landed = star.StarEdgeTables(spark, sf_dir).retweet.select(F.col("tweeted").alias("item"))
    return reconcile.missing_items(expected, landed, ["item"], force=force, filter_bits=filter_bits)


def _latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.arrival_latency(
        star.runs(star.table(spark, sf_dir, "orders")),
        star.arrivals(star.table(spark, sf_dir, "lineitem")),
        max_wait=THIRTY_DAYS_SECONDS,
    )


def _run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.run_durations(
        star.table(spark, sf_dir, "events"), ["user_id"], "ts", "event_type",
        start="signup", complete="purchase", fail="error",
    )


def _impact_two_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = star.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("source"), F.col("o_orderkey").alias("target")
    )
    contains = star.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("source"), F.col("l_partkey").alias("target")
    )
    # An order has one customer, and lines of one part twice are few: pairs are made
    # distinct behind the join alone.
    return lineage.two_hop_impact(placed, contains, distinct_edges=True)


def _impact_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many customers each supplier reaches by way of its nation, the tables' natural hubs."""
    seated = star.table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS source", "s_nationkey AS target")
    living = star.table(spark, sf_dir, "customer").selectExpr("c_nationkey AS source", "c_custkey AS target")
    return lineage.two_hop_reach_exact(seated, living, hub_pairs=REACH_HUB_PAIRS)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_stream(spark, f"{sf_dir}/{name}.parquet", schema=star.SCHEMAS[name])


def _stream_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drain_complete(stream_total(_counts(_stream(spark, sf_dir, "events"))), "stream-total")


def _stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' counts landed in slices of a week, and the total after each of them."""
    base = scratch_path(spark, "stream-snapshots")
    counts = _counts(star.table(spark, sf_dir, "events"))
    span = counts.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    first = span["first"] or datetime(1970, 1, 1)
    seconds = (span["last"] - first).total_seconds() if span["first"] else 0
    land_in_order(counts, f"{base}/counts", "ts", first, SNAPSHOT_SECONDS, int(seconds // SNAPSHOT_SECONDS) + 1)
    stream = parquet_stream(spark, f"{base}/counts", files_per_trigger=1, schema="ts timestamp_ntz, value int")
    return append_snapshots(stream, f"{base}/snapshots", f"{base}/checkpoint")


def time_slices(spark: SparkSession, sf_dir: str, batch_rows: int = BATCH_ROWS) -> tuple[str, str]:
    """Both streams' tables landed in slices of time, cut at the same times.

    A slice is as wide as the wait, or as so many waits as make up ``batch_rows`` on average:
    a micro-batch takes one of each stream, and state holds what the last one left open.
    """
    base = scratch_path(spark, "time-slices")
    runs = star.runs(star.table(spark, sf_dir, "orders"))
    arrivals = star.arrivals(star.table(spark, sf_dir, "lineitem"))
    both = runs.selectExpr("started_at AS at").union(arrivals.selectExpr("arrived_at"))
    span = both.agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("rows")).first()
    first = span["first"] or datetime(1970, 1, 1)
    seconds = (span["last"] - first).total_seconds() if span["first"] else 0
    slices = max(1, min(ceil(seconds / THIRTY_DAYS_SECONDS), span["rows"] // batch_rows))
    width = ceil(seconds / slices / THIRTY_DAYS_SECONDS) * THIRTY_DAYS_SECONDS or THIRTY_DAYS_SECONDS
    edges.together(
        spark,
        lambda side: land_in_order(side[0], f"{base}/{side[2]}", side[1], first, width, slices),
        [(runs, "started_at", "runs"), (arrivals, "arrived_at", "arrivals")],
    )
    return f"{base}/runs", f"{base}/arrivals"


def _drained_latency(spark: SparkSession, sf_dir: str, batch_rows: int = BATCH_ROWS) -> Drained:
    runs, arrivals = time_slices(spark, sf_dir, batch_rows)
    final = stream_latency_timed(
        parquet_stream(spark, runs, files_per_trigger=1),
        parquet_stream(spark, arrivals, files_per_trigger=1),
        max_wait=THIRTY_DAYS_SECONDS, allowed_delay="1 day", buckets=STREAM_BUCKETS,
    )
    return drain(final, "stream-latency", partitions=STREAM_BUCKETS)


def _zoneless(final: DataFrame) -> DataFrame:
    return final.select(
        "run_id", "latency_us", "latency_ms",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started_at", "arrived_at")],
    )


def _stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_drained_latency(spark, sf_dir).output)


def _stream_latency_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's final runs, and in batch those that were open when its input ended."""
    drained = _drained_latency(spark, sf_dir)
    waited = max(drained.watermarks()) - timedelta(seconds=THIRTY_DAYS_SECONDS)
    orders = star.runs(star.table(spark, sf_dir, "orders"))
    still_open = lineage.arrival_latency(
        orders.where(F.col("started_at") > F.lit(waited).cast("timestamp_ntz")),
        star.arrivals(star.table(spark, sf_dir, "lineitem")), max_wait=THIRTY_DAYS_SECONDS,
    )
    return _zoneless(drained.output).unionByName(_zoneless(still_open))


QUERIES: dict[str, Query] = {
    # Rankings
    "top_followed": _on_edges(lambda t: ranking.top_followed(t.social)),
    "top_followed_10": _on_edges(lambda t: ranking.top_followed(t.social).limit(10)),
    "top_mentioned": _on_edges(lambda t: ranking.top_mentioned(t.mention)),
    "top_mentioned_10": _on_edges(lambda t: ranking.top_mentioned(t.mention).limit(10)),
    "top5_followed_mentions": _on_edges(
        lambda t: ranking.leaders_with_mentions(t.social, t.mention)
    ),
    "mentions_received": _on_edges(lambda t: ranking.mentions_received(t.mention)),
    "replies_received": _on_edges(lambda t: ranking.replies_received(t.reply)),
    "retweets_received": _on_edges(lambda t: ranking.retweets_received(t.retweet)),
    # Report
    "user_universe": _on_edges(report.user_universe),
    "user_report_full": _on_edges(_report),
    "user_report_100": _on_edges(lambda t: report.top_users(_report(t))),
    # The same in SQL
    "sql_top_followed": _on_views(sql_queries.sql_top_followed),
    "sql_top5_followed_mentions": _on_views(sql_queries.sql_top5_followed_mentions),
    "sql_user_report_100": _on_views(sql_queries.sql_user_report_100),
    # Sources and sinks
    "edge_ingest": _edge_ingest,
    "result_roundtrip": _result_roundtrip,
    # Ledger
    "ledger_total": _ledger_total,
    "ledger_counted": lambda spark, sf_dir: _ledger_total(spark, sf_dir, literals=2),
    "ledger_running": _ledger_running,
    "ledger_increments": _ledger_increments,
    "stream_total": _stream_total,
    "stream_snapshots": _stream_snapshots,
    # Reconciliation
    "missing_items": _missing_items,
    "missing_items_forced": lambda spark, sf_dir: _missing_items(spark, sf_dir, force=True),
    "missing_items_filtered": lambda spark, sf_dir: _missing_items(
        spark, sf_dir, filter_bits=LANDED_FILTER_BITS
    ),
    # Lineage
    "lineage_latency": _latencies,
    "lineage_latency_report": lambda spark, sf_dir: lineage.latency_report(
        _latencies(spark, sf_dir)
    ),
    "lineage_size_report": lambda spark, sf_dir: lineage.size_report(
        star.table(spark, sf_dir, "events"), "props"
    ),
    "lineage_performance_report": lambda spark, sf_dir: lineage.performance_report(
        _latencies(spark, sf_dir), star.table(spark, sf_dir, "events"), "props"
    ),
    "run_duration": _run_duration,
    "impact_two_hop": _impact_two_hop,
    "impact_reach": _impact_reach,
    "stream_latency": _stream_latency,
    "stream_latency_complete": _stream_latency_complete,
}
