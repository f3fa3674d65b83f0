"""Lineage events: arrival latency, reliability, payload size, run outcome, impact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.measures import (
    MICROS_PER_SECOND,
    micros,
    micros_to_ms,
    or_zero,
    payload_bytes,
    percent,
    slot_of,
    to_micros,
)

# --- Fixed value: how long a run's event is waited for, in seconds. ---
MAX_WAIT_SECONDS = 30.0
# ----------------------------------------------------------------------


def arrival_latency(
    runs: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = ("run_id",),
    started: str = "started_at",
    arrived: str = "arrived_at",
    max_wait: float = MAX_WAIT_SECONDS,
) -> DataFrame:
    """Per run the first event arriving in ``[started, started + max_wait)``.

    Output: keys, ``started``, ``arrived``, ``latency_us``, ``latency_ms``; the
    last three are NULL for a run that timed out. A run is identified by its
    keys and starts once: of repeated rows the first start counts.

    The interval join is an equi-join on the keys plus a time slot as wide as
    the wait, so a start can only meet events of its own slot and the next.
    Each run is probed at most twice and every event is compared with one start,
    so pairs never multiply. Since the earliest arrival is grouped by the keys
    alone, behind its own (partially aggregated) shuffle, AQE is free to split a
    slot in which one run has very many events.
    """
    wait_us = to_micros(max_wait)
    # The keys as one struct, which is never NULL: no join filters one use of the runs
    # that another needs whole, so one grouping and one shuffle of them serve both joins.
    # Events without a key belong to no run.
    run = F.struct(*keys).alias("run")
    keyed = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    starts = runs.select(run, started).groupBy("run").agg(F.min(started).alias(started))

    start_us, arrived_us = micros(F.col(started)), micros(F.col(arrived))
    slot = slot_of(start_us, wait_us)
    # A run without a start has no slot, and a NULL slot meets none.
    probes = starts.select(
        "run", start_us.alias("start_us"), F.explode(F.array(slot, slot + 1)).alias("slot")
    )
    candidates = events.where(F.col(arrived).isNotNull() & keyed).select(
        run, arrived_us.alias("at_us"), slot_of(arrived_us, wait_us).alias("slot")
    )
    in_time = (F.col("at_us") >= F.col("start_us")) & (
        F.col("at_us") < F.col("start_us") + F.lit(wait_us)
    )
    first = (
        probes.join(candidates, ["run", "slot"])
        .where(in_time)
        .groupBy("run")
        .agg(F.min("at_us").alias("at_us"))
    )
    latency = F.col("at_us") - start_us
    return starts.join(first, "run", "left").select(
        *[F.col("run")[k].alias(k) for k in keys], started,
        F.timestamp_micros("at_us").cast(events.schema[arrived].dataType).alias(arrived),
        latency.alias("latency_us"), micros_to_ms(latency).alias("latency_ms"),
    )


def _latency_figures(latency_us: str, timed_out: str, count: str) -> list[Column]:
    arrivals, timeouts = F.count(latency_us), F.count_if(F.col(timed_out))
    # Whole microseconds add up exactly in any order; a decimal holds the sum of
    # more runs than 64 bits would.
    total_us = F.sum(F.col(latency_us).cast("decimal(19,0)")).cast("double")
    mean_us = F.try_divide(total_us, arrivals)
    return [
        or_zero(micros_to_ms(mean_us)).alias("avg_ms"),
        or_zero(micros_to_ms(F.max(latency_us))).alias("max_ms"),
        or_zero(micros_to_ms(F.min(latency_us))).alias("min_ms"),
        arrivals.alias(count),
        timeouts.alias("timeout_count"),
        percent(arrivals, arrivals + timeouts).alias("success_rate"),
    ]


def _size_figures(size: str, count: str) -> list[Column]:
    sizes = F.count(size)
    return [
        or_zero(F.try_divide(F.sum(size), sizes)).alias("avg_bytes"),
        or_zero(F.max(size)).alias("max_bytes"),
        or_zero(F.min(size)).alias("min_bytes"),
        sizes.alias(count),
    ]


def latency_report(latencies: DataFrame) -> DataFrame:
    """One row over ``arrival_latency``: mean, extremes, arrivals, timeouts, success rate.

    Figures of nothing are 0, the success rate included.
    """
    return latencies.select(
        "latency_us", F.col("latency_us").isNull().alias("timed_out")
    ).agg(*_latency_figures("latency_us", "timed_out", "count"))


def size_report(events: DataFrame, payload: str = "payload") -> DataFrame:
    """One row: mean, largest and smallest payload in UTF-8 bytes, and their number."""
    return events.select(payload_bytes(F.col(payload)).alias("size")).agg(
        *_size_figures("size", "count")
    )


def performance_report(
    latencies: DataFrame, events: DataFrame, payload: str = "payload"
) -> DataFrame:
    """Latency, reliability and size figures in one row, from one aggregate over both inputs."""
    runs = latencies.select(
        "latency_us", F.col("latency_us").isNull().alias("timed_out"),
        F.lit(None).cast("int").alias("size"),
    )
    sizes = events.select(
        F.lit(None).cast("bigint").alias("latency_us"),
        F.lit(None).cast("boolean").alias("timed_out"),
        payload_bytes(F.col(payload)).alias("size"),
    )
    return runs.union(sizes).agg(
        *_latency_figures("latency_us", "timed_out", "latency_count"),
        *_size_figures("size", "size_count"),
    )


def run_durations(
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    kind: str,
    start: str = "START",
    complete: str = "COMPLETE",
    fail: str = "FAIL",
) -> DataFrame:
    """Per run the first start, the last end, the time between and the outcome.

    The outcome is that of the last end (a failure wins a tie) and ``RUNNING``
    while there is none. Other event kinds are filtered out at the scan; three
    conditional extremes per run are all that is shuffled.
    """
    def when(value: str) -> Column:
        return F.when(F.col(kind) == value, F.col(at))

    ends = (
        events.where(F.col(kind).isin(start, complete, fail))
        .groupBy(*keys)
        .agg(
            F.min(when(start)).alias("started_at"),
            F.max(when(complete)).alias("completed_at"),
            F.max(when(fail)).alias("failed_at"),
        )
        .withColumn("ended_at", F.greatest("completed_at", "failed_at"))
    )
    elapsed = micros(F.col("ended_at")) - micros(F.col("started_at"))
    outcome = (
        F.when(F.col("ended_at").isNull(), "RUNNING")
        .when(F.col("failed_at") == F.col("ended_at"), "FAILED")
        .otherwise("COMPLETED")
    )
    return ends.select(
        *keys, "started_at", "ended_at",
        elapsed.alias("duration_us"),
        (elapsed.cast("double") / F.lit(float(MICROS_PER_SECOND))).alias("duration_s"),
        outcome.alias("outcome"),
    )


def _hops(
    first_hop: DataFrame, second_hop: DataFrame, source: str, target: str, distinct_edges: bool
) -> tuple[DataFrame, DataFrame]:
    left = first_hop.select(F.col(source).alias("source"), F.col(target).alias("via"))
    right = second_hop.select(F.col(source).alias("via"), F.col(target).alias("target"))
    return (left, right) if distinct_edges else (left.distinct(), right.distinct())


def two_hop_impact(
    first_hop: DataFrame, second_hop: DataFrame, source: str = "source", target: str = "target",
    distinct_edges: bool = False,
) -> DataFrame:
    """Distinct pairs of an item and what it reaches over one step of each edge list.

    Both lists are reduced to distinct edges first: copies would multiply in the
    join. With ``distinct_edges`` the caller declares them free of copies, which
    saves the two shuffles of whole edge lists; the result is the same either way.
    The pairs are grouped on both ends, behind a shuffle of their own, so AQE may
    split the join at an item with very many edges.

    The result itself holds in-degree times out-degree pairs for every item in the
    middle. Where such a hub makes it too large, ``two_hop_reach`` counts instead.
    """
    left, right = _hops(first_hop, second_hop, source, target, distinct_edges)
    return left.join(right, "via").select("source", "target").distinct()


def two_hop_reach(
    first_hop: DataFrame, second_hop: DataFrame, source: str = "source", target: str = "target",
    log2_registers: int = 14,
) -> DataFrame:
    """``source, reached``: about how many distinct items each reaches in two steps.

    What the item in the middle reaches is summed up in one sketch, and sketches are
    merged per source: the work grows with the edges, also at a hub. The relative
    error is near ``1 / 2 ** (log2_registers / 2)``; copies of edges count once.
    """
    left, right = _hops(first_hop, second_hop, source, target, distinct_edges=True)
    sketches = right.where(F.col("target").isNotNull()).groupBy("via").agg(
        F.hll_sketch_agg(F.col("target").cast("string"), F.lit(log2_registers)).alias("sketch")
    )
    return (
        left.join(sketches, "via").groupBy("source")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("reached"))
    )


def two_hop_reach_exact(
    first_hop: DataFrame, second_hop: DataFrame, source: str = "source", target: str = "target",
    hub_pairs: int = 1 << 20,
) -> DataFrame:
    """``source, reached``: how many distinct items each reaches in two steps, exactly.

    A source with one item in the middle reaches what this item does, which is counted once
    per item: work and rows grow with the edges, however many sources share it. The rest is
    for sources with several items, whose targets may overlap. An item with more than
    ``hub_pairs`` pairs of an edge in from these and an edge out is a hub. What a hub reaches is one set of
    bitmaps, of 32,768 neighbouring ids and 4 KB each; its sources take these over, and they
    are merged per source. So a hub costs its edges in from such sources times its bitmaps,
    never a pair of ends. All other items are joined edge by edge. Only sources that reach a
    hub have the rest of their pairs in bitmaps too, the others are counted as they are.
    Targets have to be whole numbers; a NULL target is nothing reached, and sources that
    reach nothing have no row.
    """
    left, right = _hops(first_hop, second_hop, source, target, distinct_edges=False)
    right = right.where(F.col("target").isNotNull()).withColumn("target", F.col("target").cast("bigint"))
    # The keys as one struct, which is never NULL: a NULL source is a source like any other.
    left = left.where(F.col("via").isNotNull()).select(F.struct("source").alias("source"), "via")
    vias = left.groupBy("source").agg(F.min("via").alias("via"), F.max("via").alias("other"))
    alone = F.col("via") == F.col("other")
    sizes = right.groupBy("via").agg(F.count("*").alias("reached"))
    single = vias.where(alone).join(sizes, "via").select("source", "reached")
    left = left.join(vias.where(~alone).select("source"), "source", "left_semi")
    ins, outs = (
        edges.where(F.col("via").isNotNull()).groupBy("via").agg(F.count("*").alias(name))
        for edges, name in ((left, "ins"), (right, "outs"))
    )
    hubs = ins.join(outs, "via").where(F.col("ins") * F.col("outs") > hub_pairs).select("via")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("target")).alias("bits")
    block = F.bitmap_bucket_number("target").alias("block")
    from_hubs = left.join(
        right.join(hubs, "via", "left_semi").groupBy("via", block).agg(bits), "via"
    ).select("source", "block", "bits")
    pairs = (
        left.join(hubs, "via", "left_anti").join(right, "via").select("source", "target").distinct()
    )
    at_hub = left.join(hubs, "via", "left_semi").select("source").distinct()
    others = pairs.join(at_hub, "source", "left_semi").groupBy("source", block).agg(bits)
    merged = (
        from_hubs.union(others).groupBy("source", "block")
        .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
        .groupBy("source").agg(F.sum("n").alias("reached"))
    )
    plain = pairs.join(at_hub, "source", "left_anti").groupBy("source").agg(F.count("*").alias("reached"))
    return single.union(merged).union(plain).select("source.source", "reached")
