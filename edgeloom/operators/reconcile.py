"""Expected against landed items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_items(
    expected: DataFrame, landed: DataFrame, keys: Sequence[str], force: bool = False,
    filter_bits: int | None = None,
) -> DataFrame:
    """Expected items that have not landed; all of them when ``force`` asks for a refresh.

    Both sides are reduced to their distinct keys first. That runs before the
    shuffle, so many copies of one landed item cost nothing, and the join
    reuses the partitioning of the reduction.

    Where far more has landed than is expected, ``filter_bits`` (24, say) leaves out landed
    items that are surely not expected, before anything of them is shuffled: Spark adds no such
    filter to an anti join.
    """
    wanted = expected.select(*keys).distinct()
    if force:
        return wanted
    there = landed.select(*keys)
    if filter_bits is not None:
        there = possibly_among(there, wanted, keys, filter_bits)
    return wanted.join(there.distinct(), list(keys), "left_anti")


def possibly_among(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], filter_bits: int) -> DataFrame:
    """Rows whose keys may be among those of ``wanted``: all that are, few others.

    A Bloom filter of one hash, ``2 ** filter_bits`` bits in words of 64. The words that hold a bit
    are broadcast: at most ``2 ** (filter_bits - 6)`` rows of two numbers, however large either side
    is. Of other rows about one in ``2 ** filter_bits / size of wanted`` stays. Rows with a null
    key match nothing and go. ``rows`` may have further columns, none of them ``place``, ``word``
    or ``bits``.
    """
    def place() -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(1 << filter_bits))

    bit = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    words = (
        wanted.select(place().alias("place")).groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    whole = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return (
        whole.withColumn("place", place()).withColumn("word", F.expr("place div 64"))
        .join(F.broadcast(words), "word").where(F.col("bits").bitwiseAND(bit) != 0).select(*rows.columns)
    )
