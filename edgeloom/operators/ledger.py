"""Totals over an append-only ledger of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.functions.measures import MICROS_PER_SECOND, micros, or_zero, slot_of


def ledger_total(counts: DataFrame, value: str = "value") -> DataFrame:
    """Sum of all counts; NULL when there are none."""
    return counts.agg(F.sum(value).alias("value"))


def running_totals(
    counts: DataFrame,
    ts: str,
    value: str,
    every_seconds: int,
    chunk_ticks: int = 1440,
) -> DataFrame:
    """The total at every tick from the first count to the last: ``tick, total``.

    A tick closes the interval before it, so its total covers all counts with an
    earlier time. Ticks without counts repeat the previous total.

    Counts are read once and summed per tick before the shuffle; from there on
    the work depends on the length of the calendar, not on the number of counts.
    Running sums are taken within chunks of ``chunk_ticks`` ticks, side by side;
    only one row per chunk (one a day, with minute ticks) passes through the
    unpartitioned window that carries totals from chunk to chunk.
    """
    every_us = every_seconds * MICROS_PER_SECOND
    deltas = (
        counts.where(F.col(ts).isNotNull())
        .groupBy(slot_of(micros(F.col(ts)), every_us).alias("slot"))
        .agg(or_zero(F.sum(value)).cast("bigint").alias("delta"))
        .withColumn("chunk", slot_of(F.col("slot"), chunk_ticks))
    )
    by_slot = Window.partitionBy("chunk").orderBy("slot")
    within = deltas.select(
        "chunk", "slot",
        F.sum("delta").over(by_slot.rowsBetween(Window.unboundedPreceding, 0)).alias("within"),
        F.lead("slot").over(by_slot).alias("next_slot"),
    )
    by_chunk = Window.orderBy("chunk")
    chunks = (
        deltas.groupBy("chunk")
        .agg(F.sum("delta").alias("chunk_total"), F.min("slot").alias("first_slot"))
        .select(
            "chunk",
            or_zero(F.sum("chunk_total").over(
                by_chunk.rowsBetween(Window.unboundedPreceding, -1)
            )).alias("carried"),
            F.lead("first_slot").over(by_chunk).alias("next_chunk_slot"),
        )
    )
    # Every chunk has its row. A left join keeps null filters out of the two
    # sides, so that both start from one and the same shuffle of the deltas.
    totals = within.join(chunks, "chunk", "left")
    last = F.coalesce("next_slot", "next_chunk_slot", F.col("slot") + 1) - 1
    # Up to the tick before the next count; chunk by chunk, which keeps the
    # array of a very long gap small.
    size = F.lit(chunk_ticks).cast("bigint")
    chunk_start = F.col("gap_chunk") * size
    spread = (
        totals.withColumn("last", last)
        .withColumn("total", F.col("within") + F.col("carried"))
        .withColumn("gap_chunk", F.explode(F.sequence(
            slot_of(F.col("slot"), chunk_ticks), slot_of(F.col("last"), chunk_ticks)
        )))
        # One row may span a gap of very many chunks; spread them before they fill up.
        .repartition("gap_chunk")
        .withColumn("tick_slot", F.explode(F.sequence(
            F.greatest("slot", chunk_start), F.least("last", chunk_start + size - 1)
        )))
    )
    closes_at = F.timestamp_micros((F.col("tick_slot") + 1) * F.lit(every_us).cast("bigint"))
    return spread.select(closes_at.cast(counts.schema[ts].dataType).alias("tick"), "total")
