"""Sharding: contiguous shards of near-equal bytes, cut from global prefix sums.

Rows are dealt into range partitions of a total order once. Each partition then
has its byte total; the totals' running sums (one row per partition) turn a
position inside a partition into a global one, and a row belongs to the shard in
whose equal share of all bytes the middle of the row lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.tables import free_name, text_crc32, utf8_size, without, written

#: ``monotonically_increasing_id`` holds the partition above this many bits, the row below.
ROW_BITS = 33


def assign_shards(
    docs: DataFrame, n_shards: int, size: Column, order_by: list[Column]
) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Shards are contiguous in ``order_by`` (nulls first), and each holds an equal
    share of the sum of ``size`` to within one row at either end. Equal rows are
    interchangeable; a key held by a third of the rows is still spread over
    partitions, since the scan position ends the order. A row larger than a share
    leaves the shards it covers empty. ``size`` must be above 0 somewhere for
    shares to exist; rows of null size count as 0. An empty table gives no rows.
    Columns already named ``shard`` or ``slot`` are replaced.

    ``n_shards`` cut points go through the driver, no rows do.
    """
    weight = free_name("weight", docs.columns)
    place = free_name("place", docs.columns)
    seq = free_name("seq", docs.columns)
    rows = docs.select(
        *without(docs, "shard", "slot"),
        F.coalesce(size.cast("long"), F.lit(0)).alias(weight),
        F.struct(*order_by, F.monotonically_increasing_id()).alias(place),
    )
    dealt = written(
        rows.repartitionByRange(place).sortWithinPartitions(place)
        .drop(place).withColumn(seq, F.monotonically_increasing_id()),
        "shard-rows",
    )
    part = F.shiftright(seq, ROW_BITS)
    slim = dealt.select(part.alias("part"), F.col(seq).alias("seq"), F.col(weight).alias("weight"))
    offsets = _offsets(slim)

    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("bytes_before") + F.coalesce(F.sum("weight").over(before), F.lit(0))
    middle = 2 * start + F.col("weight")
    share = F.expr(f"least({n_shards - 1}, (middle * {n_shards}) div greatest(2 * bytes_all, 1))")
    cuts = (
        slim.join(F.broadcast(offsets), "part")
        .withColumn("middle", middle)
        .select(share.cast("int").alias("shard"), _index("seq").alias("index"))
        .groupBy("shard").agg(F.min("index").alias("first_index"))
        .orderBy("shard").collect()
    )
    key = free_name("part", [*dealt.columns, "rows_before"])
    index = free_name("rows_before", dealt.columns)
    numbered = dealt.withColumn(key, part).join(
        F.broadcast(offsets.select(F.col("part").alias(key), F.col("rows_before").alias(index))), key
    )
    row = F.col(index) + F.col(seq).bitwiseAND(F.lit((1 << ROW_BITS) - 1))

    def at_cut(values: list[Column]) -> Column:
        """The value of the last cut that does not lie behind the row."""
        reached = [F.when(row >= cut["first_index"], v) for cut, v in zip(cuts, values)]
        return F.greatest(*reached, F.lit(-1), F.lit(-1))

    shard = at_cut([F.lit(cut["shard"]) for cut in cuts])
    first = at_cut([F.lit(cut["first_index"]) for cut in cuts])
    return numbered.select(
        *without(docs, "shard", "slot"),
        shard.cast("int").alias("shard"), (row - first).cast("long").alias("slot"),
    )


def _offsets(slim: DataFrame) -> DataFrame:
    """Rows and bytes before each partition, and all bytes: one row per partition."""
    totals = slim.groupBy("part").agg(
        F.sum("weight").alias("bytes"), F.count("*").alias("rows")
    )
    order = Window.orderBy("part")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("bytes_all"),
    )


def _index(seq: str) -> Column:
    return F.col("rows_before") + F.col(seq).bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def shard_report(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """One row per document with its shard, in the order of ``doc_id``.

    ``size`` is the text's UTF-8 bytes plus 1 (null: 1). Repeated ids are ordered
    by checksum and size. Only the key, size and checksum are shuffled, no text.
    Equal texts are not held together: near-equal bytes could not hold beside that.
    """
    slim = docs.select(
        "doc_id", (utf8_size(F.col("text")) + 1).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return assign_shards(slim, n_shards, F.col("size"), order).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Whole documents with ``shard`` and ``slot``; the text is shuffled once."""
    order = [F.col("doc_id"), text_crc32(F.col("text")), utf8_size(F.col("text"))]
    return assign_shards(docs, n_shards, utf8_size(F.col("text")) + 1, order)
